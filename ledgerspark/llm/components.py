"""Connected components of links, as rounds of star operations on a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.sources.scratch import stable


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``links`` (a, b).

    Each round joins every node's neighbours to its smallest one, first the larger
    neighbours, then the others, until no link changes. Minima are summed up before
    the shuffle and the joins are on one key, so a node with very many links is
    split by adaptive execution. Links of a round are written to the shared folder,
    so a lost executor costs a part of one round. Self links are taken as nodes.
    """
    nodes = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    stars = stable(_ordered(links))
    seen = _digest(stars)
    while seen[0]:
        stars = stable(_small_star(_large_star(stars)))
        now = _digest(stars)
        if now == seen:
            break
        seen = now
    return nodes.join(stars.withColumnRenamed("a", "node"), "node", "left").select(
        "node", F.coalesce("b", "node").alias("root"))


def _digest(stars: DataFrame) -> tuple:
    return tuple(stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                           F.bit_xor(F.xxhash64("b", "a", F.lit(1)))).first())


def _ordered(links: DataFrame) -> DataFrame:
    """Each link once, the larger node first."""
    return links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(stars: DataFrame) -> DataFrame:
    both = stars.union(stars.select("b", "a"))
    least = both.groupBy(F.col("a").alias("at")).agg(F.min("b").alias("m"))
    least = least.select("at", F.least("at", "m").alias("m"))
    larger = stars.select(F.col("b").alias("at"), F.col("a").alias("far"))
    return _ordered(larger.join(least, "at").select(F.col("far").alias("a"), F.col("m").alias("b")).union(
        least.select(F.col("at").alias("a"), F.col("m").alias("b"))))


def _small_star(stars: DataFrame) -> DataFrame:
    least = stars.groupBy(F.col("a").alias("at")).agg(F.min("b").alias("m"))
    moved = stars.select(F.col("a").alias("at"), F.col("b").alias("near")).join(least, "at")
    return _ordered(moved.select(F.col("near").alias("a"), F.col("m").alias("b")).union(
        least.select(F.col("at").alias("a"), F.col("m").alias("b"))))
