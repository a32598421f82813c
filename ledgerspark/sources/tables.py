"""Reading source tables with a fixed, typed set of columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Mapping = tuple[str, str, str, str]


def read_table(spark: SparkSession, name: str, schema: StructType | None = None) -> DataFrame:
    """Catalog table ``db.table``, or a parquet folder when ``name`` is a path.

    With ``schema`` only its columns are read, and a missing or differently
    typed column fails here instead of in a later stage.
    """
    df = spark.read.parquet(name) if "/" in name else spark.table(name)
    return df if schema is None else df.to(schema)


def in_months(period: str, first, last) -> Column:
    """Inclusive range on the period column; reaches the scan as a pushed filter."""
    return F.col(period).between(F.lit(first), F.lit(last))


def since(column: str, first) -> Column:
    """Lower bound on a source date; reaches the scan as a pushed filter."""
    return F.col(column) >= F.lit(first)


def typed_mapping(
    df: DataFrame, mappings: Iterable[Mapping], bad_values_to_null: bool = False
) -> DataFrame:
    """Keep, rename and cast the listed columns: (source, its type, target, its type).

    The source type documents the table; the cast is to the target type. A value
    that cannot be cast fails, or becomes NULL with ``bad_values_to_null``.
    """
    def converted(source: str, target_type: str) -> Column:
        column = F.col(source)
        return column.try_cast(target_type) if bad_values_to_null else column.cast(target_type)

    return df.select(
        *[converted(source, kind).alias(target) for source, _, target, kind in mappings]
    )


def typed_with_rejects(df: DataFrame, mappings: Iterable[Mapping]) -> tuple[DataFrame, Observation]:
    """``typed_mapping`` with bad values as NULL, and how many values of each target column that were.

    The counts are taken while the frame is written or read and are known (``.get``) after
    that; no job of their own is run.
    """
    mappings, seen = list(mappings), Observation()
    rejected = [
        F.count_if(F.col(source).isNotNull() & F.col(source).try_cast(kind).isNull()).alias(target)
        for source, _, target, kind in mappings
    ]
    return typed_mapping(df.observe(seen, *rejected), mappings, bad_values_to_null=True), seen


def not_deleted(df: DataFrame, flag: str = "anulado") -> DataFrame:
    """Rows whose soft-delete flag is 0; an unknown flag counts as deleted."""
    return df.where(F.col(flag) == 0)
