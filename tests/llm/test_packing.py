"""Bounds against all choices, batches against a plain pass."""

import itertools
import random

import numpy as np
import pytest

from ledgerspark.llm import packing, pieces
from ledgerspark.llm.queries import PIECE_MODEL, QUERIES

PATH = pieces.tokenizer_path(PIECE_MODEL)


def padding(lengths, counts, bounds):
    return sum(n * (next(b for b in bounds if b >= x) - x) for x, n in zip(lengths, counts))


def test_bounds_against_all_choices():
    rng = random.Random(1)
    for _ in range(150):
        lengths = sorted(rng.sample(range(1, 60), rng.randrange(1, 9)))
        counts = [rng.randrange(1, 30) for _ in lengths]
        k = rng.randrange(1, 5)
        bounds = packing.best_bounds(np.array(lengths), np.array(counts), k)
        assert bounds[-1] == lengths[-1] and len(bounds) <= k
        least = min(padding(lengths, counts, [*c, lengths[-1]])
                    for n in range(min(k, len(lengths))) for c in itertools.combinations(lengths[:-1], n))
        assert padding(lengths, counts, bounds) == least
    assert packing.best_bounds(np.array([]), np.array([]), 3) == []


def check(got, budget):
    batches = {}
    for r in got:
        assert r.padding == r.bucket_tokens - r.n_tokens >= 0
        batches.setdefault((r.bucket, r.batch), []).append(r)
    by_bucket = {}
    for (bucket, batch), rows in batches.items():
        held = rows[0].bucket_tokens
        each = max(1, budget // held)
        assert sorted(r.place for r in rows) == list(range(len(rows))) and len(rows) <= each
        by_bucket.setdefault(bucket, {})[batch] = (len(rows), each)
    for bucket, found in by_bucket.items():
        assert sorted(found) == list(range(len(found)))
        assert all(n == each for b, (n, each) in found.items() if b < len(found) - 1)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op5_packing"](spark, folder).collect()
    model = pieces.PieceModel(open(PATH, "rb").read())
    want = {d.doc_id: len(model.encode(d.text or "").ids) + 1 for d in docs}
    assert {r.doc_id: r.n_tokens for r in got} == want and len(got) == len(docs)
    check(got, packing.TOKEN_BUDGET)
    lengths, counts = np.unique(list(want.values()), return_counts=True)
    exact = packing.best_bounds(lengths, counts, packing.BUCKETS)
    spent = sum(r.padding for r in got)
    least = padding(lengths.tolist(), counts.tolist(), exact)
    assert spent == least


@pytest.mark.parametrize("slot_rows", [2, 100])
def test_odd_rows(spark, slot_rows, monkeypatch):
    monkeypatch.setattr(packing, "COPIES", 7)
    texts = [None, "", " ", "a b c", "z" * 9000] + ["one two three"] * 5
    rows = [(i, t, 5) for i, t in enumerate(texts)] + [(None, "same", 1)] * 40 + [(3, "a b c", 1)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, bucket int")
    got = packing.pack(docs, PATH, buckets=3, token_budget=40, slot_rows=slot_rows).collect()
    assert len(got) == len(rows)
    check(got, 40)
    assert packing.pack(docs.limit(0), PATH).collect() == []


def test_long_lengths_against_a_plain_programme():
    rng = random.Random(8)
    for _ in range(30):
        lengths = sorted(rng.sample(range(1, 300_000), rng.randrange(2, 60)))
        counts = [rng.choice([1, 2, 5, 1000, 10 ** 9]) for _ in lengths]
        k = rng.randrange(1, 9)
        # cost[j]: least padding of the first j lengths with so many buckets
        cost = [0] + [None] * len(lengths)
        for _ in range(k):
            cost = [0] + [min(cost[i] + sum(n * (lengths[j - 1] - x) for x, n in zip(lengths[i:j], counts[i:j]))
                              for i in range(j) if cost[i] is not None) for j in range(1, len(lengths) + 1)]
        bounds = packing.best_bounds(np.array(lengths), np.array(counts), k)
        assert padding(lengths, counts, bounds) == cost[-1]


def test_very_many_lengths():
    lengths = np.arange(1, 100_001)
    bounds = packing.best_bounds(lengths, np.ones(len(lengths), np.int64), 8)
    assert len(bounds) == 8 and bounds[-1] == 100_000 and all(12_400 <= b - a <= 12_600 for a, b in zip([0, *bounds], bounds))
