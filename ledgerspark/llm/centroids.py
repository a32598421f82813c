"""Centroid clustering over a vector-approximation file.

Vectors of whole numbers are kept twice in one table: in full, and as a few bits a
dimension that name the cell its number lies in. For a set of centroids, lookup tables
give the least and the greatest part of the squared distance that each cell stands for, so
the cells of a vector give an interval for its distance to each centroid. Where one interval
lies below all others the nearest centroid is known from the cells; only the other vectors
are fetched. The intervals are of the squared distance less the one to the vectors' mean:
that is the same amount for all centroids of a vector, and without it what the cells leave
open is small where the centroids are not far from each other.

Sums of clusters are carried from round to round: a round reads the cells, decides under
the centroids before and after the last move, and fetches the vectors that an interval
leaves open or that changed their cluster; only those are moved between sums. Cell bounds
come from the mean, spread, least and greatest number of each dimension over all vectors;
they steer what is fetched, never the result, which is exact in whole numbers.

No step groups vectors: tasks hand over sums by (centroid, dimension), so equal vectors or
a cluster with most of them are no hot group. Only such sums and the centroids reach the
driver, both of fixed size.

Vectors of another length, null ones and ones with a null or non-finite component are left
out. A null id counts as empty text where ids choose the first centroids; of rows with one
id all may start a centroid. With fewer vectors than centroids there are as many centroids
as vectors; ties go to the centroid with the smaller number. Whole numbers beyond 2 ** 26
count as that, as squared distances would not fit a long; a sum of distances that does not
fit one is null. An empty table gives no row; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.sources.scratch import stable

DIMS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
BITS = 6
LARGEST = 1 << 26
#: Whole numbers below this have exact scalar products in doubles.
EXACT_DOUBLE = 1 << 22
#: Place of the count among the sums of a centroid.
COUNT = -1

SUMS = T.StructType([T.StructField("centroid", T.IntegerType()), T.StructField("dim", T.IntegerType()),
                     T.StructField("total", T.LongType())])


def whole_numbers(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions of the rows that count, their components as whole numbers)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dims)
    flat = column.take(pa.array(rows)).flatten().cast(pa.float64())
    # a null component reads as not finite
    values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, dims)
    good = np.isfinite(values).all(axis=1)
    with np.errstate(over="ignore"):
        numbers = np.floor(scale * values[good]).clip(-LARGEST, LARGEST)
    return rows[good], numbers.astype(np.int32)


def packed(numbers: np.ndarray) -> pa.Array:
    """Rows of an array as binary values."""
    width = numbers.shape[1] * numbers.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(width), len(numbers), [None, pa.py_buffer(np.ascontiguousarray(numbers).tobytes())]).cast(pa.binary())


def unpacked(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    if not len(column):
        return np.zeros((0, width), dtype)
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


class Grid:
    """Cells of each dimension, and the tables that centroids give over them."""

    def __init__(self, least: np.ndarray, greatest: np.ndarray, mean: np.ndarray, spread: np.ndarray, bits: int = BITS):
        self.bits, self.cells = bits, 1 << bits
        normal = np.array([NormalDist().inv_cdf(i / self.cells) for i in range(1, self.cells)])
        cuts = np.ceil(mean[:, None] + spread[:, None] * normal).clip(least[:, None], greatest[:, None] + 1)
        #: first whole number of each cell but the lowest
        self.cuts = cuts.astype(np.int64)
        self.middle = np.rint(mean).astype(np.int64)
        self.lows = np.concatenate([least[:, None], self.cuts], axis=1)
        self.highs = np.concatenate([self.cuts - 1, greatest[:, None]], axis=1)

    def cells_of(self, numbers: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(cuts, numbers[:, d], side="right") for d, cuts in enumerate(self.cuts)],
                        axis=1).astype(np.uint8).reshape(len(numbers), -1)

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest of (x - c)^2 - (x - middle)^2 by (dimension, cell, centroid); it is linear in x."""
        c, middle = centroids.T[:, None, :], self.middle[:, None, None]
        ends = [(middle - c) * (2 * x[:, :, None] - c - middle) for x in (self.lows, self.highs)]
        return np.minimum(*ends), np.maximum(*ends)

    def nearest(self, cells: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Number of the centroid that the intervals prove nearest, -1 where they overlap."""
        low, high = tables
        least = np.zeros((len(cells), low.shape[2]), np.int64)
        most = np.zeros_like(least)
        for d in range(cells.shape[1]):
            least += low[d][cells[:, d]]
            most += high[d][cells[:, d]]
        best = most.argmin(axis=1)
        bound = most[np.arange(len(cells)), best][:, None]
        # an equal distance is won by the smaller number
        others = np.arange(low.shape[2])
        beaten = (bound < least) | ((bound == least) & (best[:, None] < others)) | (best[:, None] == others)
        return np.where(beaten.all(axis=1), best, -1)


def to_bits(cells: np.ndarray, bits: int) -> np.ndarray:
    """Cells as ``bits`` bits each, rows filled up to whole bytes."""
    return np.packbits(np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - bits:].reshape(len(cells), -1), axis=1)


def from_bits(column: pa.Array, dims: int, bits: int) -> np.ndarray:
    rows = np.unpackbits(unpacked(column, "u1", -(-dims * bits // 8)), axis=1)[:, :dims * bits].reshape(-1, dims, bits)
    return rows @ (1 << np.arange(bits - 1, -1, -1, dtype=np.uint8))


def distances(numbers: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distance of each vector to each centroid."""
    small = max(np.abs(numbers).max(initial=0), np.abs(centroids).max(initial=0)) < EXACT_DOUBLE
    if small:
        v, c = numbers.astype(np.float64), centroids.astype(np.float64)
        return ((v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((numbers.astype(np.int64) - c) ** 2).sum(1) for c in centroids], axis=1)


def exact(numbers: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return distances(numbers, centroids).argmin(axis=1) if len(numbers) else np.zeros(0, np.int64)


def whole_vectors(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """(vec_id, full): the vectors that count, as binary whole numbers."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([vectors.schema["vec_id"], T.StructField("full", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, numbers = whole_numbers(batch.column(1), dims, scale)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), packed(numbers)], schema=arrow)

    return vectors.select("vec_id", "embedding").mapInArrow(run, schema)


def grid_of(whole: DataFrame, dims: int, bits: int) -> Grid:
    """Cells from figures of all vectors; a row a dimension reaches the driver."""
    schema = "dim int, n long, least long, greatest long, total double, squares double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, least, greatest = 0, np.full(dims, LARGEST, np.int64), np.full(dims, -LARGEST, np.int64)
        total, squares = np.zeros(dims), np.zeros(dims)
        for batch in batches:
            numbers = unpacked(batch.column(0), "<i4", dims).astype(np.int64)
            if len(numbers):
                n += len(numbers)
                least, greatest = np.minimum(least, numbers.min(0)), np.maximum(greatest, numbers.max(0))
                total += numbers.sum(0)
                squares += (numbers.astype(float) ** 2).sum(0)
        if n:
            yield pa.RecordBatch.from_pydict({
                "dim": pa.array(range(dims), pa.int32()), "n": pa.array([n] * dims, pa.int64()),
                "least": least, "greatest": greatest, "total": total, "squares": squares})

    found = whole.select("full").mapInArrow(run, schema).groupBy("dim").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.sum("total").alias("total"), F.sum("squares").alias("squares")).orderBy("dim").toPandas()
    mean = (found["total"] / found["n"]).to_numpy()
    spread = np.sqrt(np.maximum(found["squares"] / found["n"] - mean ** 2, 0))
    return Grid(found["least"].to_numpy(np.int64), found["greatest"].to_numpy(np.int64), mean, spread.to_numpy(), bits)


def first_centroids(whole: DataFrame, dims: int, count: int) -> np.ndarray:
    """The vectors whose ids have the smallest hashes."""
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    drawn = whole.select(key.alias("key"), "full").orderBy("key", "full").limit(count).collect()
    return np.array([np.frombuffer(r.full, "<i4") for r in drawn], np.int64).reshape(-1, dims)


def approximated(whole: DataFrame, grid: Grid, dims: int) -> DataFrame:
    """The table (row, vec_id, cells, full); ``row`` is unique and fixed by writing it down."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([whole.schema["vec_id"], T.StructField("cells", T.BinaryType()),
                           T.StructField("full", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = grid.cells_of(unpacked(batch.column(1), "<i4", dims))
            yield pa.RecordBatch.from_arrays([batch.column(0), packed(to_bits(cells, grid.bits)), batch.column(1)], schema=arrow)

    return stable(whole.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()))


def added(sums: np.ndarray, counts: np.ndarray, numbers: np.ndarray, clusters: np.ndarray, sign: int) -> None:
    np.add.at(sums, clusters, sign * numbers.astype(np.int64))
    np.add.at(counts, clusters, sign)


def sum_rows(sums: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    table = np.concatenate([sums, counts[:, None]], axis=1)
    places = [*range(sums.shape[1]), COUNT]
    return pa.RecordBatch.from_pydict({
        "centroid": np.repeat(np.arange(len(sums), dtype=np.int32), len(places)),
        "dim": np.tile(np.array(places, np.int32), len(sums)), "total": table.ravel()})


def collected(rows: DataFrame, count: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts by centroid; ``count * (dims + 1)`` numbers reach the driver."""
    sums, counts = np.zeros((count, dims), np.int64), np.zeros(count, np.int64)
    for r in rows.groupBy("centroid", "dim").agg(F.sum("total").alias("total")).collect():
        if r.dim == COUNT:
            counts[r.centroid] = r.total
        else:
            sums[r.centroid, r.dim] = r.total
    return sums, counts


def first_sums(table: DataFrame, grid: Grid, centroids: np.ndarray) -> DataFrame:
    """Sums of all vectors under the first centroids; each vector enters a sum once, so all are read."""
    tables, (count, dims) = grid.tables(centroids), centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((count, dims), np.int64), np.zeros(count, np.int64)
        for batch in batches:
            clusters = grid.nearest(from_bits(batch.column(0), dims, grid.bits), tables)
            numbers, open_rows = unpacked(batch.column(1), "<i4", dims), clusters < 0
            clusters[open_rows] = exact(numbers[open_rows], centroids)
            added(sums, counts, numbers, clusters, 1)
        yield sum_rows(sums, counts)

    return table.select("cells", "full").mapInArrow(run, SUMS)


def wanted(table: DataFrame, grid: Grid, before: np.ndarray, after: np.ndarray) -> DataFrame:
    """``row`` of the vectors whose cells leave their cluster open or show that it changed."""
    old, new, dims = grid.tables(before), grid.tables(after), before.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = from_bits(batch.column(1), dims, grid.bits)
            was, is_now = grid.nearest(cells, old), grid.nearest(cells, new)
            fetch = (was < 0) | (is_now < 0) | (was != is_now)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(fetch))], names=["row"])

    return table.select("row", "cells").mapInArrow(run, "row long")


def moved_sums(table: DataFrame, grid: Grid, before: np.ndarray, after: np.ndarray) -> DataFrame:
    """What the sums change by from the clusters under ``before`` to those under ``after``."""
    count, dims = before.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((count, dims), np.int64), np.zeros(count, np.int64)
        for batch in batches:
            numbers = unpacked(batch.column(0), "<i4", dims)
            was, is_now = exact(numbers, before), exact(numbers, after)
            moved = was != is_now
            added(sums, counts, numbers[moved], was[moved], -1)
            added(sums, counts, numbers[moved], is_now[moved], 1)
        yield sum_rows(sums, counts)

    fetched = wanted(table, grid, before, after).join(table.select("row", "full"), "row")
    return fetched.select("full").mapInArrow(run, SUMS)


def next_centroids(centroids: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Floors of the means; a centroid without vectors stays."""
    return np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], centroids)


def assigned(table: DataFrame, grid: Grid, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of all vectors."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([table.schema["vec_id"], T.StructField("cluster", T.IntegerType()),
                           T.StructField("distance", T.LongType())])
    arrow, tables, dims = to_arrow_schema(schema), grid.tables(centroids), centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clusters = grid.nearest(from_bits(batch.column(1), dims, grid.bits), tables)
            numbers, open_rows = unpacked(batch.column(2), "<i4", dims), clusters < 0
            clusters[open_rows] = exact(numbers[open_rows], centroids)
            apart = numbers.astype(np.int64) - centroids[clusters]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(clusters, pa.int32()), pa.array((apart ** 2).sum(1), pa.int64())], schema=arrow)

    return table.select("vec_id", "cells", "full").mapInArrow(run, schema)


def cluster(vectors: DataFrame, dims: int = DIMS, count: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE,
            bits: int = BITS) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of the vectors (vec_id, embedding) that count, the final centroids)."""
    if not 1 <= bits <= 8:
        raise ValueError("one to eight bits a cell")
    whole = whole_vectors(vectors, dims, scale)
    centroids = first_centroids(whole, dims, count)
    if not len(centroids):
        none = T.StructType([vectors.schema["vec_id"], T.StructField("cluster", T.IntegerType()),
                             T.StructField("distance", T.LongType())])
        return vectors.sparkSession.createDataFrame([], none), centroids
    grid = grid_of(whole, dims, bits)
    table = approximated(whole, grid, dims)
    if rounds:
        sums, counts = collected(first_sums(table, grid, centroids), len(centroids), dims)
        before, centroids = centroids, next_centroids(centroids, sums, counts)
    for _ in range(rounds - 1):
        by, moved = collected(moved_sums(table, grid, before, centroids), len(centroids), dims)
        sums, counts = sums + by, counts + moved
        before, centroids = centroids, next_centroids(centroids, sums, counts)
    return stable(assigned(table, grid, centroids)), centroids


def clusters(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256, a row a vector that counts."""
    placed, centroids = cluster(vectors, **options)
    inertia = {r.cluster: int(r.total) for r in placed.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}  # a row a centroid

    def as_long(total: int) -> int | None:
        return total if total < 1 << 63 else None

    rows = [(c, as_long(total), as_long(sum(inertia.values())),
             hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
            for c, total in sorted(inertia.items())]
    figures = vectors.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(figures), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
