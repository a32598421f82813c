"""Document fingerprints from prefix polynomial hashes.

The hash of the first i code points is sum((c_j + 1) * B**j) modulo two primes, kept
for every i. Any span of a text is then compared with any span of another in constant
time, and the longest common extension of two positions is found by binary search. A
text's fingerprint is its length and its full hashes; the likeness of two texts is the
share of the longer one that their common start and common end cover, both read from
the prefix arrays. A text put together from two others needs no new pass: its prefix
hashes follow from theirs.

Documents are compared with the next one in ascending order of doc_id, equal ids by a
hash of their text, null ids first. They are dealt by ranges of that order and sorted
within a task, which holds two texts at a time; only the last document of a task meets
the first of the next one in a second, small step. Null texts are empty; two empty
texts are alike (1.0). Repeated rows follow each other. Other columns do not matter. An empty
table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.common import parts_for
from ledgerspark.sources.scratch import stable

PRIMES = (2**31 - 1, 2**31 - 19)
BASES = (1_000_003, 998_244_353 % (2**31 - 19))
CHUNK = 1 << 18
#: Code points of text a task should get, before compression.
TASK_CHARS = 32 << 20

_powers = [np.ones(1, np.uint32), np.ones(1, np.uint32)]


def powers(which: int, count: int) -> np.ndarray:
    """B**0 .. B**(count-1), kept for the longest text a worker has seen."""
    held = _powers[which]
    while len(held) < count:
        factor = np.uint64(pow(BASES[which], len(held), PRIMES[which]))
        held = np.concatenate([held, (held * factor % np.uint64(PRIMES[which])).astype(np.uint32)])
    _powers[which] = held
    return held


class Prefix:
    """Prefix hashes of one text."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.length = len(codes)
        self.sums = []
        for which, prime in enumerate(PRIMES):
            base, p = powers(which, self.length), np.uint64(prime)
            sums = np.zeros(self.length + 1, np.uint32)
            for at in range(0, self.length, CHUNK):
                part = codes[at:at + CHUNK].astype(np.uint64) + np.uint64(1)
                part = np.cumsum(part * base[at:at + len(part)] % p, dtype=np.uint64) + np.uint64(sums[at])
                sums[at + 1:at + 1 + len(part)] = part % p
            self.sums.append(sums)

    def upto(self, which: int, i: int) -> int:
        return int(self.sums[which][i])


class Spliced:
    """Prefix hashes of the first ``keep`` code points of one text and the first ``take`` of another."""

    def __init__(self, head: Prefix, keep: int, tail: Prefix, take: int):
        self.head, self.keep, self.tail = head, keep, tail
        self.length = keep + take
        self.shift = [pow(b, keep, p) for b, p in zip(BASES, PRIMES)]

    def upto(self, which: int, i: int) -> int:
        if i <= self.keep:
            return self.head.upto(which, i)
        return (self.head.upto(which, self.keep)
                + self.shift[which] * self.tail.upto(which, i - self.keep)) % PRIMES[which]


def equal_spans(a, i: int, b, j: int, size: int) -> bool:
    """Whether a[i:i+size] and b[j:j+size] have equal hashes."""
    for which, (base, p) in enumerate(zip(BASES, PRIMES)):
        left = a.upto(which, i + size) - a.upto(which, i)
        right = b.upto(which, j + size) - b.upto(which, j)
        low = min(i, j)
        if (left * pow(base, j - low, p) - right * pow(base, i - low, p)) % p:
            return False
    return True


def common_extension(a, i: int, b, j: int) -> int:
    """Longest k with a[i:i+k] == b[j:j+k]."""
    good, bad = 0, min(a.length - i, b.length - j) + 1
    while bad - good > 1:
        middle = (good + bad) // 2
        good, bad = (middle, bad) if equal_spans(a, i, b, j, middle) else (good, middle)
    return good


def common_end(a, b) -> int:
    """Longest k with a[-k:] == b[-k:]."""
    good, bad = 0, min(a.length, b.length) + 1
    while bad - good > 1:
        middle = (good + bad) // 2
        same = equal_spans(a, a.length - middle, b, b.length - middle, middle)
        good, bad = (middle, bad) if same else (good, middle)
    return good


def likeness(a, b) -> float:
    longer = max(a.length, b.length)
    if not longer:
        return 1.0
    shorter = min(a.length, b.length)
    start = common_extension(a, 0, b, 0)
    return min(shorter, start + (common_end(a, b) if start < shorter else 0)) / longer


def digest(a) -> str:
    first, second = (a.upto(which, a.length) for which in range(len(PRIMES)))
    return f"{a.length:x}-{first:08x}{second:08x}"


def compared(text: str, hashes: Prefix, following: str, next_hashes: Prefix) -> dict:
    """The contract's columns for a text and the one after it."""
    half = len(text) // 2
    spliced = Spliced(hashes, len(text) - half, next_hashes, min(half, len(following)))
    edited = text[:len(text) - half] + following[:half]
    return {
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        "fingerprint": digest(hashes),
        "edited_fingerprint": digest(spliced),
        "near_edited": likeness(hashes, spliced),
        "near_next": likeness(hashes, next_hashes),
    }


OUT = T.StructType([
    T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
    T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType()),
])


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def fingerprint_documents(docs: DataFrame, task_chars: int = TASK_CHARS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per row.

    The edited text is the text with its last half replaced by as many first code
    points of the next document (or all of them); after the last comes the first.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = parts_for(docs, chars, task_chars)
    tie = F.xxhash64("text")
    dealt = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), tie, "text")
    keys = [docs.schema["doc_id"]]
    edge = [T.StructField("task", T.IntegerType()), T.StructField("edge", T.StringType()),
            T.StructField("text", T.StringType())]
    schema = T.StructType([*keys, *OUT.fields, *edge])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = TaskContext.get().partitionId(), None
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                doc_id, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                hashes = Prefix(text)
                if held is None:
                    out.append({"doc_id": doc_id, "task": task, "edge": "first", "text": text})
                else:
                    out.append({"doc_id": held[0]} | compared(held[1], held[2], text, hashes))
                held = (doc_id, text, hashes)
            yield _batch(out, arrow)
        if held is not None:
            yield _batch([{"doc_id": held[0], "task": task, "edge": "last", "text": held[1]}], arrow)

    done = stable(dealt.mapInArrow(run, schema))
    # tasks are few: which one follows which is one small sorted list without texts
    tasks = done.where(F.col("edge") == "first").select("task")
    order = tasks.select("task", F.coalesce(
        F.lead("task").over(Window.orderBy("task")),
        F.min("task").over(Window.partitionBy())).alias("following"))
    last = done.where(F.col("edge") == "last").select("task", "doc_id", "text")
    first = done.where(F.col("edge") == "first").select(F.col("task").alias("following"),
                                                        F.col("text").alias("next_text"))
    met = last.join(order, "task").join(first, "following").select("doc_id", "text", "next_text")
    edge_schema = T.StructType([*keys, *OUT.fields])
    edge_arrow = to_arrow_schema(edge_schema)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch([{"doc_id": r["doc_id"]} | compared(r["text"], Prefix(r["text"]), r["next_text"],
                                                             Prefix(r["next_text"]))
                          for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()], edge_arrow)

    names = ["doc_id", *OUT.names]
    return done.where(F.col("edge").isNull()).select(*names).unionByName(met.mapInArrow(meet, edge_schema))
