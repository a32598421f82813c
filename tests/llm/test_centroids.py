"""Clustering over approximations against SQL and plain whole-number rounds; intervals; odd rows."""

import hashlib
import math

import numpy as np
import pytest
from oracle import compare

from ledgerspark.llm import centroids


def test_query_matches_sql(spark):
    assert compare(spark, "/root/testdata/sf0.01", "op12_centroid_clustering") is None


def whole(x, scale):
    return max(-centroids.LARGEST, min(centroids.LARGEST, math.floor(scale * x)))


def plain(rows, dims=64, count=16, rounds=3, scale=64):
    """Sorted result rows for (vec_id, embedding), in Python's own numbers."""
    kept = [(i, [whole(x, scale) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    middles = [v for _, v in sorted(kept, key=lambda r: (key(r), np.array(r[1], "<i4").tobytes()))[:count]]

    def nearest():
        far = [[sum((a - b) ** 2 for a, b in zip(v, m)) for m in middles] for _, v in kept]
        return [(min(range(len(d)), key=lambda c: (d[c], c)), min(d)) for d in far]

    for _ in range(rounds):
        found = nearest()
        for c in range(len(middles)):
            members = [v for (_, v), (k, _) in zip(kept, found) if k == c]
            if members:
                middles[c] = [sum(m[d] for m in members) // len(members) for d in range(dims)]
    found = nearest()
    spent = [sum(d for k, d in found if k == c) for c in range(len(middles))]
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middles]
    return sorted(((i, c, d, spent[c], sum(spent), sha[c]) for (i, _), (c, d) in zip(kept, found)), key=repr)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def blobs(n, dims, spread, seed=0):
    draw = np.random.default_rng(seed)
    middle = draw.normal(0, 1, (7, dims))
    return [(i, [float(np.float32(x)) for x in middle[i % 7] + draw.normal(0, spread, dims)]) for i in range(n)]


@pytest.mark.parametrize("spread", [0.02, 0.5, 3.0])
def test_rounds_against_plain(spark, rows, spread):
    data = blobs(400, 64, spread)
    assert rows(centroids.clusters(frame(spark, data))) == plain(data)


@pytest.mark.parametrize("bits", [1, 3, 8])
def test_bits_do_not_change_the_result(spark, rows, bits):
    data = blobs(200, 8, 0.4)
    got = rows(centroids.clusters(frame(spark, data), dims=8, count=5, rounds=4, scale=100, bits=bits))
    assert got == plain(data, 8, 5, 4, 100)


def test_intervals_hold_and_prove():
    draw = np.random.default_rng(1)
    numbers = draw.integers(-200, 200, (500, 6)).astype(np.int32)
    grid = centroids.Grid(numbers.min(0).astype(np.int64), numbers.max(0).astype(np.int64), numbers.mean(0), numbers.std(0), 4)
    middles = numbers[:9].astype(np.int64)
    cells = grid.cells_of(numbers)
    low, high = grid.tables(middles)
    far = centroids.distances(numbers, middles)
    far_middle = ((numbers - grid.middle) ** 2).sum(1)[:, None]
    at = np.arange(6)[None, :, None], cells[:, :, None], np.arange(9)[None, None, :]
    assert (low[at].sum(1) <= far - far_middle).all() and (far - far_middle <= high[at].sum(1)).all()
    found = grid.nearest(cells, (low, high))
    assert 0 < (found >= 0).sum() < len(numbers)
    assert (found[found >= 0] == far.argmin(1)[found >= 0]).all()


def test_only_open_or_moved_vectors_are_fetched(spark):
    vectors = frame(spark, blobs(700, 64, 0.05))
    table_of = centroids.whole_vectors(vectors, 64, 64)
    grid = centroids.grid_of(table_of, 64, 4)
    table = centroids.approximated(table_of, grid, 64)
    numbers = np.array([np.frombuffer(r.full, "<i4") for r in table.orderBy("vec_id").collect()], np.int64)
    middles = np.array([numbers[i::7].mean(0) for i in range(7)]).astype(np.int64)
    assert centroids.wanted(table, grid, middles, middles).count() == 0
    swapped = middles[[1, 0, 2, 3, 4, 5, 6]]
    assert centroids.wanted(table, grid, middles, swapped).count() == 200


def test_odd_vectors(spark, rows):
    base = [0.25 * (i % 5) for i in range(64)]
    nan, inf = float("nan"), float("inf")
    data = [(None, base), (None, base), (1, base[:63]), (2, base + [0.0]), (3, [*base[:63], nan]), (4, [inf, *base[1:]]),
            (5, None), (6, []), (7, [None, *base[1:]]), (8, base), (8, [-x for x in base]), (9, [0.0] * 64),
            (10, [1e30] * 64), (11, [-3e38, *base[1:]]), (12, [-0.001] * 64)]
    got = rows(centroids.clusters(frame(spark, data)))
    want = plain(data)
    clipped = [(*r[:3], *(v if v < 1 << 63 else None for v in r[3:5]), r[5]) for r in want]
    assert got == sorted(clipped, key=repr)
    extra = frame(spark, data).selectExpr("*", "1 AS row", "'c' AS cells", "2 AS cluster", "3 AS distance", "4 AS full")
    assert rows(centroids.clusters(extra)) == got
    assert centroids.clusters(extra.limit(0)).collect() == []
    assert centroids.clusters(extra.where("vec_id = 5")).collect() == []
    assert rows(centroids.clusters(frame(spark, data, "double"))) == got


def test_equal_vectors(spark, rows):
    data = [(i, [0.5] * 64) for i in range(300)] + blobs(30, 64, 1.0)
    assert rows(centroids.clusters(frame(spark, data))) == plain(data)
