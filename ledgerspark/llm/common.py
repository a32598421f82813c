"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str | None) -> list[bytes]:
    """Runs of ``[^\\x20\\x09-\\x0D]`` as UTF-8; bytes.split() cuts at exactly these characters."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], Iterable[dict]], schema: T.StructType) -> DataFrame:
    """``work`` gives column lists for each Arrow batch of ``df``; one batch is in memory at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in work(batch):
                yield pa.RecordBatch.from_pydict(columns, schema=arrow)

    return df.mapInArrow(run, schema)


def parts_for(df: DataFrame, amount: float, each: float, least: int = 1) -> int:
    """Partitions so that each holds about ``each`` of ``amount``; never fewer than the session's."""
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, configured, math.ceil(amount / each))


def same(left, right):
    """Join condition that also matches nulls."""
    return left.eqNullSafe(right)


def empty_text(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))
