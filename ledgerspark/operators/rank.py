"""row_number() kept as a column, for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.values import same_key
from ledgerspark.sources.scratch import stable

# A group up to this many rows is sorted by one task.
HOT_GROUP_ROWS = 1_000_000


def rank_within(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    name: str,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Add ``name`` = position of the row among the rows with the same ``keys``.

    ``order`` lists the ascending sort columns, NULL first. Groups of more than
    ``hot_rows`` rows are ranked over many tasks: the rows are range-partitioned
    by key and order, ranked within each range, and moved on by the size of the
    ranges before. The group sizes are counted first, which runs a job.
    Rows equal in all of ``order`` are ranked by their other columns, in both ways
    alike; only rows equal in everything are interchangeable. The rank is a long.
    """
    sort = rank_order(df, keys, order)
    window = Window.partitionBy(*keys).orderBy(*sort)
    position = F.row_number().over(window).cast("long")
    key = same_key(*keys).alias("_key")
    hot = (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > hot_rows)
        .select("_key")
    )
    if hot.isEmpty():
        return df.withColumn(name, position)
    hot = stable(hot)
    keyed = df.withColumn("_key", same_key(*keys))
    cold_rows = keyed.join(hot, "_key", "left_anti").drop("_key")
    hot_group_rows = keyed.join(hot, "_key", "left_semi").drop("_key")
    ranked = cold_rows.withColumn(name, position)
    return ranked.unionByName(_rank_by_ranges(hot_group_rows, keys, order, name, hot_rows))


def rank_order(df: DataFrame, keys: list[str], order: list[str]) -> list[Column]:
    """Sort columns of a rank: ``order``, then all other columns."""
    rest = [c for c in df.columns if c not in (*keys, *order)]
    return [F.col(c).asc_nulls_first() for c in (*order, *rest)]


def _rank_by_ranges(
    df: DataFrame, keys: list[str], order: list[str], name: str, hot_rows: int
) -> DataFrame:
    columns = df.columns
    sort = [F.col(c).asc_nulls_first() for c in keys] + rank_order(df, keys, order)

    # Copies of a row are counted, not moved, and a large count is cut in blocks:
    # no range can then hold more than a block of equal rows.
    blocks = (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_block", F.explode(F.sequence(
            F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / hot_rows)
        )))
        .withColumn("_size", F.least(
            F.lit(hot_rows).cast("long"), F.col("_copies") - F.col("_block") * hot_rows
        ))
        .drop("_copies")
    )
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # The range bounds are sampled, so the cut is written down before it is used twice.
    ranged = stable(
        blocks.repartitionByRange(parts, *sort, F.col("_block"))
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_key", same_key(*keys, "_range"))
    )

    upto_previous = (Window.unboundedPreceding, -1)
    earlier_ranges = Window.partitionBy(*keys).orderBy("_range").rowsBetween(*upto_previous)
    offsets = (
        ranged.groupBy("_key", *keys, "_range")
        .agg(F.sum("_size").alias("_rows"))
        .select(
            "_key",
            F.coalesce(F.sum("_rows").over(earlier_ranges), F.lit(0)).alias("_offset"),
        )
    )
    in_range = Window.partitionBy("_key").orderBy(*sort, F.col("_block")).rowsBetween(*upto_previous)
    start = F.col("_offset") + F.col("_before")
    return (
        ranged.withColumn("_before", F.coalesce(F.sum("_size").over(in_range), F.lit(0)))
        .join(offsets, "_key")
        .select(*columns, F.explode(F.sequence(start + 1, start + F.col("_size"))).alias(name))
    )
