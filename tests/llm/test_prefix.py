"""Prefix hashes against plain string work."""

import hashlib
import random

from ledgerspark.llm import prefix
from ledgerspark.llm.queries import QUERIES


def plain_like(a, b):
    if not a and not b:
        return 1.0
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) and a[len(a) - 1 - end] == b[len(b) - 1 - end]:
        end += 1
    return min(start + end, len(a), len(b)) / max(len(a), len(b))


def plain(docs):
    """Rows of the contract, fingerprints left out, from (doc_id, text) in order."""
    out = {}
    for at, (doc_id, text) in enumerate(docs):
        after = docs[(at + 1) % len(docs)][1] or ""
        text = text or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        out[doc_id] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), plain_like(text, edited),
                       plain_like(text, after), text, edited)
    return out


def check(got, docs):
    want, by_text, by_print = plain(docs), {}, {}
    assert len(got) == len(docs)
    for r in got:
        n, sha, near_edited, near_next, text, edited = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256, r.near_edited, r.near_next) == (n, sha, near_edited, near_next)
        for t, f in ((text, r.fingerprint), (edited, r.edited_fingerprint)):
            assert by_text.setdefault(t, f) == f
            assert by_print.setdefault(f, t) == t


def test_query_against_plain_strings(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    check(QUERIES["op1_prefix_fingerprints"](spark, folder).collect(), [(r.doc_id, r.text) for r in rows])


def test_tasks_without_rows_and_odd_texts(spark):
    texts = [None, "", "a", "ab", "𝄞x𝄞", "same", "same", "é" * 999, "x" * 400_000, "", None, "end"]
    docs = [(i * 7, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs],
                                  "doc_id long, text string, fingerprint string, task int").repartition(3)
    check(prefix.fingerprint_documents(frame, task_chars=1000).collect(), docs)
    assert prefix.fingerprint_documents(frame.limit(0)).collect() == []
    one = prefix.fingerprint_documents(frame.where("doc_id = 21")).collect()
    assert (one[0].edited_sha256, one[0].near_next) == (hashlib.sha256(b"aa").hexdigest(), 1.0)


def test_repeated_rows_and_null_ids(spark):
    rows = [(None, "b"), (None, "b"), (None, "a"), (3, "z"), (3, "z")]
    got = prefix.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.n_chars) for r in got) == [(-1, 1)] * 3 + [(3, 1)] * 2


def test_spans_and_extensions():
    rng = random.Random(3)
    for _ in range(60):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 60)))
        b = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 60)))
        x, y = prefix.Prefix(a), prefix.Prefix(b)
        i, j = rng.randrange(len(a)), rng.randrange(len(b))
        size = rng.randrange(0, min(len(a) - i, len(b) - j) + 1)
        assert prefix.equal_spans(x, i, y, j, size) == (a[i:i + size] == b[j:j + size])
        k = prefix.common_extension(x, i, y, j)
        assert a[i:i + k] == b[j:j + k] and (a[i + k:i + k + 1] != b[j + k:j + k + 1] or i + k == len(a)
                                             or j + k == len(b))
        keep, take = rng.randrange(len(a) + 1), rng.randrange(len(b) + 1)
        made, direct = prefix.Spliced(x, keep, y, take), prefix.Prefix(a[:keep] + b[:take])
        assert prefix.digest(made) == prefix.digest(direct) and prefix.likeness(made, direct) == 1.0
