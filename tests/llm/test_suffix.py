"""Passage removal against a plain table of all windows."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from ledgerspark.llm import suffix
from ledgerspark.llm.queries import QUERIES


def plain(docs, least, keep_first=False):
    """Merged spans to remove per row of (doc_id, text), in row order."""
    raw = [(t or "").encode() for _, t in docs]
    places = defaultdict(list)
    for i, data in enumerate(raw):
        for s in range(len(data) - least + 1):
            places[data[s:s + least]].append((i, s))
    gone = [np.zeros(len(r), bool) for r in raw]
    for found in places.values():
        for i, s in (found[1:] if keep_first else found) if len(found) > 1 else ():
            gone[i][s:s + least] = True
    return raw, gone


def digest_rows(docs, least):
    raw, gone = plain(docs, least)
    out = []
    for (doc_id, _), data, flags in zip(docs, raw, gone):
        spans = int((np.diff(np.concatenate(([0], flags.astype(int)))) == 1).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~flags])
        out.append((doc_id, len(data), int(flags.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, copies=3):
    rng = random.Random(seed)
    prose = lambda n: "".join(rng.choice("abcdeé \n") for _ in range(n))
    passages = [prose(rng.randrange(300, 900)) for _ in range(6)]
    docs = []
    for i in range(60):
        parts = [prose(rng.randrange(0, 500))]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(0, 150)
            parts += [p[a:len(p) - rng.randrange(0, 150)], prose(rng.randrange(0, 400))]
        docs.append((i, "".join(parts)))
    docs += [(100 + k, docs[5][1]) for k in range(copies)]
    docs += [(200, "ab" * 900), (201, "a" * 1500), (202, docs[7][1][:700] + "X" + docs[7][1][701:]),
             (203, passages[0] + passages[0]), (204, None), (205, ""), (206, "x" * 399), (207, "a" * 400)]
    return docs


OPTIONS = [{}, {"dense": 1}, {"huge": 1}, {"array_bytes": 3000}]


@pytest.mark.parametrize("options", OPTIONS, ids=str)
def test_all_copies_go(spark, options):
    docs = corpus(1)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r) for r in suffix.passage_digests(frame, **options).collect()), key=repr)
    assert got == digest_rows(docs, 400)


@pytest.mark.parametrize("options", OPTIONS, ids=str)
def test_first_copy_stays(spark, options):
    docs = corpus(2)
    frame = spark.createDataFrame([(*d, "clash", 1) for d in docs],
                                  "doc_id long, text string, spans string, tie int").repartition(3)
    got = {r.doc_id: r for r in suffix.drop_passages(frame, **options).collect()}
    raw, gone = plain(docs, 400, keep_first=True)
    for (doc_id, text), data, flags in zip(docs, raw, gone):
        if not flags.any():
            assert (got[doc_id].text, got[doc_id].spans) == (text, "clash")
            continue
        want = suffix.kept_bytes(data, [(int(i), int(i) + 1) for i in np.flatnonzero(flags)]).decode("utf-8", "ignore")
        assert got[doc_id].text == want if want.split() else doc_id not in got


def test_rows_that_repeat_an_id(spark):
    text = corpus(3)[4][1] + "z" * 10 + "".join(chr(97 + i * i % 23) for i in range(800))
    rows = [(None, text), (None, text), (1, text), (1, text), (2, "short"), (2, "short")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix.passage_digests(frame).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in got) == [
        (-1, len(text.encode()))] * 2 + [(1, len(text.encode()))] * 2 + [(2, 0)] * 2
    kept = suffix.drop_passages(frame).collect()
    assert sorted((r.doc_id or -1) for r in kept) == [-1, 2, 2]
    assert suffix.passage_digests(frame.limit(0)).collect() == []
    assert suffix.drop_passages(frame.limit(0)).collect() == []


def test_longest_factors_against_brute_force():
    rng = random.Random(7)
    for _ in range(40):
        data = bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 120)))
        size, cap = len(data), rng.choice([9, 20, 50])
        earlier, later = suffix.longest_factors(np.frombuffer(data, np.uint8), cap)

        def common(i, j):
            k = 0
            while max(i, j) + k < size and data[i + k] == data[j + k] and k < cap:
                k += 1
            return k

        for i in range(size):
            for found, others in ((earlier, range(i)), (later, range(i + 1, size))):
                best = max((common(i, j) for j in others), default=0)
                assert found[i] <= best and (found[i] >= cap) == (best >= cap) and best - found[i] < 7


def test_very_long_text(spark):
    rng = np.random.default_rng(3)
    long = bytes(rng.integers(97, 123, 2_300_000, dtype=np.uint8)).decode()
    docs = [(1, long), (2, "q" * 50 + long[1_040_000:1_050_000] + "r" * 20)]
    got = {r.doc_id: r.n_removed for r in suffix.passage_digests(
        spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: 10_000, 2: 10_000}


def test_query_against_all_windows(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((tuple(r) for r in QUERIES["op6_suffix_dedup"](spark, folder).collect()), key=repr)
    assert got == digest_rows([tuple(r) for r in rows], 400)


@pytest.mark.parametrize("options", OPTIONS, ids=str)
def test_first_copy_of_words_stays(spark, options):
    least, rng = suffix.LEAST_WORDS, random.Random(4)
    prose = lambda n: [rng.choice("abcdefgh") + rng.choice("ijk") * rng.randrange(3) for _ in range(n)]
    passages = [prose(n) for n in (50, 51, 52, 54, 60, 75, 200)]
    texts = []
    for i in range(50):
        parts = prose(rng.randrange(0, 40))
        for _ in range(rng.randrange(0, 3)):
            parts = parts + rng.choice(passages) + prose(rng.randrange(0, 30))
        texts.append(parts)
    texts += [["a"] * 120, ["a", "b"] * 60, ["x"] * 50, passages[3], passages[3]]
    docs = [(i, "  ".join(t) if i % 2 else " \n".join(t)) for i, t in enumerate(texts)] + [(60, None), (61, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text for r in suffix.drop_passages(frame, least, suffix.WORDS, **options).collect()}
    seen, removed = set(), 0
    for i, words in enumerate(texts):
        gone = np.zeros(len(words), bool)
        for a in range(len(words) - least + 1):
            window = tuple(words[a:a + least])
            gone[a:a + least] |= window in seen
            seen.add(window)
        want = [w for w, out in zip(words, gone) if not out]
        removed += int(gone.sum())
        assert got.get(i, "").split() == want and (bool(want) or not words or i not in got)
    assert removed > 500 and got[60] is None and got[61] == ""


def test_pipeline_takes_out_short_passages_of_over_fifty_words(spark):
    import corpus_pipeline

    words = [f"w{i}" for i in range(60)]
    assert len(" ".join(words)) < 400
    long = "".join(random.Random(9).choices("abcdefgh", k=450))  # one word, but 400 bytes and more
    docs = spark.createDataFrame([
        (1, "one " + " ".join(words) + " two", 7), (2, "three " + "\n".join(words) + " four", 7),
        (3, f"five {long} six", 7), (4, f"seven {long} eight", 7), (5, " ".join(words[:50]), 7)],
        "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in corpus_pipeline.passage_dedup(spark, docs, "").collect()}
    assert got[1].text.split() == ["one", *words, "two"] and got[2].text.split() == ["three", "four"]
    assert got[2].n_chars == len(got[2].text)
    assert long in got[3].text and long not in got[4].text
    assert got[5].text.split() == words[:50]
