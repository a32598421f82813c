"""SimHash groups against all pairs."""

import re

import numpy as np
import pytest
import xxhash

from ledgerspark.llm import simhash
from ledgerspark.llm.queries import QUERIES


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(docs, distance=3):
    """{doc_id: (fingerprint, smallest id reachable)} by comparing all pairs."""
    ids = [d for d, _ in docs]
    prints = np.array([plain_fingerprint(t) for _, t in docs], np.uint64)
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= distance):
            root[find(int(j))] = find(i)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (f"{int(prints[i]):016x}", least[find(i)]) for i, d in enumerate(ids)}


def test_query_against_all_pairs(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = plain_groups([(r.doc_id, r.text) for r in rows])
    got = QUERIES["op10_simhash"](spark, folder).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want
    assert len(got) == len(rows)


@pytest.mark.parametrize("bucket_rows", [3, 20_000])
def test_dense_ball_and_refined_buckets(spark, bucket_rows):
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 2**63, dtype=np.uint64)
    prints = [int(centre)]
    for _ in range(700):
        flips = rng.choice(64, rng.integers(1, 4), replace=False)
        prints.append(prints[rng.integers(0, len(prints))] ^ int(sum(1 << int(b) for b in flips)))
    prints += [int(x) for x in rng.integers(0, 2**63, 300, dtype=np.uint64)]
    rows = [(i, simhash.signed(p)) for i, p in enumerate(prints)]
    got = {r.fp: r.component_id for r in simhash.near_groups(
        spark.createDataFrame(rows, "doc_id long, fp long"), bucket_rows=bucket_rows).collect()}
    values = np.array(prints, np.uint64)
    label = np.arange(len(values))
    near = np.bitwise_count(values[:, None] ^ values[None]) <= 3
    for _ in range(len(values)):
        now = np.where(near, label[None], len(values)).min(1)
        if (now == label).all():
            break
        label = now
    assert got == {fp: label[i] for i, fp in rows}


@pytest.mark.parametrize("rows", [10**3, 10**6, 10**9, 10**12])
def test_thresholds_meet_the_pigeonhole(rows):
    sample = np.random.default_rng(1).integers(0, 2**63, 200, dtype=np.uint64)
    parts = simhash.plan(sample, rows, 3)
    bits = [b for group, _ in parts for b in group]
    assert len(bits) == len(set(bits))
    left_out = [n for n in range(2, 5) if sum(t for _, t in parts) - (n - len(parts)) == 3 - n + 1]
    assert left_out


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n", None), (None, "one two", "c"), (None, "one two", "c"),
            (5, "Same Words here", None), (5, "Same Words here", None), (9, "same words HERE", "x"),
            (4, "z" * 300_000, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted((tuple(r) for r in simhash.near_duplicates(docs).collect()), key=repr)
    assert [r for r in got if r[0] in (1, 2, 3)] == [(i, "0" * 16, 1) for i in (1, 2, 3)]
    assert [r[2] for r in got if r[0] in (5, 9)] == [5, 5, 5]
    assert [r[2] for r in got if r[0] is None] == [None, None]
    kept = simhash.keep_one(docs).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 4, 5]
    assert kept[0].asDict().keys() == {"doc_id", "text", "component_id"}
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
    assert simhash.keep_one(docs.limit(0)).collect() == []
