"""Removal of repeated passages by longest-previous-factor arrays.

A byte goes if a string of ``least`` bytes that covers it also starts somewhere else.
Every such window picks an anchor by its content alone: the smallest hash among its
``GRAM``-byte grams. Equal windows therefore have equal anchors, at equal places, and
only windows of one anchor value need to be compared. Neighbouring windows with one
anchor form a run; a row is shuffled for each run, about one for 150 bytes.

Runs with equal context (all bytes their windows cover) are one class, so thousands of
copies are one row. Where an anchor value has several classes, the context of one run
of each is cut out of its document, and a suffix array over them is built by prefix
doubling; in suffix order, the previous and next smaller positions give each position's
longest earlier factor, the larger ones its longest later factor. A window is repeated
when such a factor reaches ``least``. Contexts are laid down in document order, so
earlier in the array is earlier in the corpus, and the first copy can be kept.

An anchor value with more than ``dense`` classes is not put into an array: its windows
are compared by their hashes, place by place in one task up to ``huge`` classes, and as
rows of a count beyond. All three ways find the same windows.

The unit is a byte, or a word (``WORDS``): then texts are arrays of the hashes of their
words, whatever white space is between them, ``least`` counts words, and spans are put
back to bytes at the end. All of the above holds for words as it does for bytes.

Texts are taken as UTF-8; nulls are empty; matches never cross documents. Documents are
in order of doc_id (nulls first), then a hash of the text, and rows that repeat both are
copies of each other. Texts under ``least`` bytes stay whole. Other columns do not matter. An empty
table gives no row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.common import map_batches, words_of
from ledgerspark.sources.scratch import stable

LEAST = 400
GRAM = 100
#: The shortest passage of more than 50 words.
LEAST_WORDS = 51
GRAM_WORDS = 12
DENSE = 4096
HUGE = 50_000
#: Bytes of text in one suffix array.
ARRAY_BYTES = 1 << 20
STRETCH = (1 << 20) - 4096
BASE = 0x9E3779B97F4A7C15
PLACE = np.uint64((1 << 20) - 1)

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


@dataclass(frozen=True)
class Unit:
    """What texts are arrays of, and how many of them make a gram."""

    dtype: str
    gram: int

    def of(self, text: str) -> np.ndarray:
        data = text.encode("utf-8", "surrogatepass")
        if self.dtype == "uint8":
            return np.frombuffer(data, np.uint8)
        return np.fromiter(map(xxhash.xxh64_intdigest, data.split()), np.uint64)

    def read(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, self.dtype)

    def to_bytes(self, data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Byte spans of ``data`` for spans of units; a word goes with the white space after it."""
        if self.dtype == "uint8" or not spans:
            return spans
        starts = [m.start() for m in WORD.finditer(data)] + [len(data)]
        return [(starts[a], starts[b]) for a, b in spans]


BYTES, WORDS = Unit("uint8", GRAM), Unit("uint64", GRAM_WORDS)

_tables: list[np.ndarray] = []


def tables() -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _tables:
        size = STRETCH + 8192
        with np.errstate(over="ignore"):
            for factor in (BASE, pow(BASE, -1, 1 << 64)):
                _tables.append(np.concatenate(([np.uint64(1)], np.cumprod(
                    np.full(size, factor, np.uint64), dtype=np.uint64))))
    return _tables


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Sums:
    """Prefix sums of c * B**i, from which the hash of any span follows."""

    def __init__(self, data: np.ndarray):
        powers, self.inverse = tables()
        with np.errstate(over="ignore"):
            terms = (data.astype(np.uint64) + np.uint64(1)) * powers[:len(data)]
            self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        count = len(self.sums) - size
        with np.errstate(over="ignore"):
            return mixed((self.sums[size:] - self.sums[:count]) * self.inverse[:count])


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    reach, low = 1, values
    while reach * 2 <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(low[:-rest], low[rest:]) if rest else low


def runs_of(data: np.ndarray, least: int, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """(key, context hash, first window, number of windows, place of the anchor) of the runs of a text."""
    for start in range(0, len(data) - least + 1, STRETCH):
        part = data[start:start + STRETCH + least - 1]
        sums = Sums(part)
        grams = sums.grams(gram)
        packed = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)
        anchor = (smallest(packed, least - gram + 1) & PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        count = np.diff(np.concatenate((first, [len(anchor)])))
        at = anchor[first]
        context = sums.spans(first, first + count - 1 + least)
        yield grams[at], context, first + start, count, at - first


# suffix arrays


def doubled_ranks(data: np.ndarray, reach: int) -> dict[int, np.ndarray]:
    """Ranks of all suffixes by their first 7, 14, ... bytes (1, 2, ... words), up to the largest below
    ``reach``, and by their first ``reach`` ones."""
    size = len(data)
    if data.dtype != np.uint8:
        return _doubled({1: _dense(data)}, 1, reach, size)
    padded = np.concatenate((data.astype(np.uint64) + np.uint64(1), np.zeros(8, np.uint64)))
    head = np.zeros(size, np.uint64)
    for i in range(7):  # nine bits a byte, so that the end sorts before byte 0
        head = (head << np.uint64(9)) | padded[i:i + size]
    return _doubled({7: _dense(head)}, 7, reach, size)


def _doubled(ranks: dict[int, np.ndarray], known: int, reach: int, size: int) -> dict[int, np.ndarray]:
    while known < reach:
        step = min(known, reach - known)
        later = np.zeros(size, np.int64)
        if size > step:
            later[:size - step] = ranks[known][step:] + 1
        ranks[known + step] = _dense(ranks[known].astype(np.int64) * (size + 2) + later)
        known += step
    return ranks


def _dense(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    number = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1]))) if len(keys) else np.zeros(0)
    out = np.empty(len(keys), np.int32)
    out[order] = number
    return out


def smaller_before(values: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value to the left of each, -1 where there is none."""
    found = np.arange(-1, len(values) - 1)
    active = np.flatnonzero((found >= 0) & (values[found] > values))
    while len(active):
        found[active] = found[found[active]]
        at = found[active]
        active = active[(at >= 0) & (values[at] > values[active])]
    return found


def common_prefix(ranks: dict[int, np.ndarray], a: np.ndarray, b: np.ndarray, cap: int, size: int) -> np.ndarray:
    """Length of the common prefix of suffixes a and b, to a multiple of seven below ``cap`` or ``cap``."""
    length = np.where(ranks[cap][a] == ranks[cap][b], cap, 0)
    open_ = np.flatnonzero(length == 0)
    a, b, reached = a[open_], b[open_], np.zeros(len(open_), np.int64)
    for step in sorted(ranks, reverse=True):
        x, y = a + reached, b + reached
        fits = (x < size) & (y < size) & (reached + step <= cap)
        equal = np.zeros(len(x), bool)
        equal[fits] = ranks[step][x[fits]] == ranks[step][y[fits]]
        reached += np.where(equal, step, 0)
    length[open_] = reached
    return length


def longest_factors(data: np.ndarray, cap: int, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each position the longest string that also starts at an earlier one, and at a later one.

    Only positions in ``starts`` count, all by default. Lengths are told up to ``cap``,
    below it rounded down to what the ranks tell (a multiple of seven).
    """
    size = len(data)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ranks = doubled_ranks(data, cap)
    starts = np.arange(size) if starts is None else starts
    order = starts[np.argsort(ranks[cap][starts], kind="stable")]
    found = []
    for keys in (order, -order):
        out = np.zeros(size, np.int64)
        before = smaller_before(keys)
        after = len(order) - 1 - smaller_before(keys[::-1])[::-1]
        after[after == len(order)] = -1
        for near in (before, after):
            has = np.flatnonzero(near >= 0)
            out[order[has]] = np.maximum(
                out[order[has]], common_prefix(ranks, order[has], order[near[has]], cap, size))
        found.append(out)
    return found[0], found[1]


# comparing the classes of an anchor value


def by_arrays(contexts: list[np.ndarray], least: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each context, in document order: which windows also start earlier, and which later."""
    data = np.concatenate(contexts)
    sizes = np.array([len(c) for c in contexts])
    first = np.cumsum(sizes) - sizes
    # a string that runs into the next context is in no document
    within = np.arange(len(data)) - np.repeat(first, sizes) <= np.repeat(sizes - least, sizes)
    earlier, later = (f >= least for f in longest_factors(data, least, np.flatnonzero(within)))
    return [(earlier[a:a + n], later[a:a + n]) for a, n in zip(first, sizes - least + 1)]


def by_places(contexts: list[np.ndarray], places: np.ndarray, least: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The same by hashes of the windows at equal places from the anchor."""
    out, rows = [], []
    for number, (c, place) in enumerate(zip(contexts, places)):
        windows = len(c) - least + 1
        start = np.arange(windows)
        rows.append((np.full(windows, number), place - start, start,
                     Sums(c).spans(start, start + least)))
        out.append((np.zeros(windows, bool), np.zeros(windows, bool)))
    number, place, start, value = (np.concatenate(x) for x in zip(*rows))
    order = np.lexsort((number, value, place))
    number, place, start, value = number[order], place[order], start[order], value[order]
    equal = (place[1:] == place[:-1]) & (value[1:] == value[:-1])
    for i in np.flatnonzero(equal):
        out[number[i + 1]][0][start[i + 1]] = True
        out[number[i]][1][start[i]] = True
    return out


def ranges(flags: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [{"a": int(a), "b": int(b)} for a, b in zip(edge[::2], edge[1::2])]


RANGES = T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))


def runs_frame(docs: DataFrame, least: int, unit: Unit = BYTES) -> DataFrame:
    """(key, context, doc_id, who, tie, starts, windows, place) of all runs of ``docs`` (doc_id, who, tie, text).

    Equal runs of a document are one row with all their starts, so a text that repeats
    itself does not make a class hot.
    """
    schema = T.StructType([
        T.StructField("key", T.LongType()), T.StructField("context", T.LongType()), docs.schema["doc_id"],
        T.StructField("who", T.LongType()), T.StructField("tie", T.LongType()),
        T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("windows", T.IntegerType()),
        T.StructField("place", T.IntegerType())])

    def work(batch: pa.RecordBatch):
        rows, sizes, found = [], [], [[] for _ in range(5)]
        for i in range(batch.num_rows):
            parts = list(runs_of(unit.of(batch.column(3)[i].as_py()), least, unit.gram))
            if not parts:
                continue
            key, context, start, windows, place = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((start, context, key))
            ranked = key[order], context[order]
            change = np.concatenate(([True], (ranked[0][1:] != ranked[0][:-1]) | (ranked[1][1:] != ranked[1][:-1])))
            first = np.flatnonzero(change)
            rows.append(np.full(len(first), i))
            sizes.append(np.diff(np.append(first, len(order))))
            for held, column in zip(found, (key[order[first]], context[order[first]], start[order],
                                            windows[order[first]], place[order[first]])):
                held.append(column)
        if rows:
            at = pa.array(np.concatenate(rows))
            key, context, start, windows, place = (np.concatenate(x) for x in found)
            ends = np.concatenate(([0], np.cumsum(np.concatenate(sizes)))).astype(np.int32)
            yield {"key": key.view(np.int64), "context": context.view(np.int64), "doc_id": batch.column(0).take(at),
                   "who": batch.column(1).take(at), "tie": batch.column(2).take(at),
                   "starts": pa.ListArray.from_arrays(pa.array(ends), pa.array(start.astype(np.int64))),
                   "windows": windows.astype(np.int32), "place": place.astype(np.int32)}

    return map_batches(docs, work, schema)


def cut_contexts(docs: DataFrame, wanted: DataFrame, least: int, unit: Unit = BYTES) -> DataFrame:
    """``wanted`` (key, context, classes, doc_id, who, tie, start, windows, place) with the bytes of each run."""
    names = ("key", "context", "classes", "start", "windows", "place")
    lists = wanted.groupBy("who", "tie").agg(F.collect_list(F.struct(*names)).alias("runs"))
    rows = docs.join(lists, ["who", "tie"]).select("doc_id", "tie", "runs", "text")
    schema = T.StructType([*[wanted.schema[n] for n in ("doc_id", "tie", *names)],
                           T.StructField("bytes", T.BinaryType())])

    def work(batch: pa.RecordBatch):
        for i in range(batch.num_rows):
            data = unit.of(batch.column(3)[i].as_py())
            runs = batch.column(2)[i].as_py()
            yield {"doc_id": pa.repeat(batch.column(0)[i], len(runs)),
                   "tie": pa.repeat(batch.column(1)[i], len(runs))} | {
                n: [r[n] for r in runs] for n in names} | {
                "bytes": [data[r["start"]:r["start"] + r["windows"] - 1 + least].tobytes() for r in runs]}

    return map_batches(rows, work, schema)


def compared(cut: DataFrame, least: int, dense: int, array_bytes: int, unit: Unit = BYTES) -> DataFrame:
    """(key, context, earlier, later): ranges of windows found in earlier and later classes."""
    keys = ["key", "context"]
    schema = T.StructType([*[cut.schema[k] for k in keys], T.StructField("earlier", RANGES),
                           T.StructField("later", RANGES)])

    def result(held: pd.DataFrame, flags: list) -> pd.DataFrame:
        return pd.DataFrame({
            "key": held["key"].to_numpy(), "context": held["context"].to_numpy(),
            "earlier": [ranges(f[0]) for f in flags], "later": [ranges(f[1]) for f in flags]})

    def settle(held: pd.DataFrame) -> pd.DataFrame:
        # rows that repeat a document give its runs again
        held = held.drop_duplicates(keys, ignore_index=True)
        texts = [unit.read(raw) for raw in held["bytes"]]
        if len(held) > dense and held["key"].iloc[0] == held["key"].iloc[-1]:
            return result(held, by_places(texts, held["place"].to_numpy(), least))
        return result(held, by_arrays(texts, least))

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            key = held["key"].to_numpy()
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            upto = np.concatenate(([0], np.cumsum(held["bytes"].str.len().to_numpy())))
            done = 0
            # the last value may go on in the next batch
            for a, b in zip(first[:-1], first[1:]):
                if b - a > dense:
                    if a > done:
                        yield settle(held.iloc[done:a])
                    yield settle(held.iloc[a:b])
                    done = b
                elif upto[b] - upto[done] >= array_bytes:
                    yield settle(held.iloc[done:b])
                    done = b
            held = held.iloc[done:]
        if held is not None and len(held):
            last = int((held["key"].to_numpy() == held["key"].iloc[-1]).sum())
            if last > dense and last < len(held):
                yield settle(held.iloc[:-last])
                held = held.iloc[-last:]
            yield settle(held)

    rows = cut.select(*keys, "place", "bytes", "doc_id", "tie", "start").repartition("key").sortWithinPartitions(
        "key", "doc_id", "tie", "start").select(*keys, "place", "bytes")
    return rows.mapInPandas(work, schema)


def compared_as_rows(cut: DataFrame, least: int, unit: Unit = BYTES) -> DataFrame:
    """The same for anchor values with very many classes: a row for each window, counted by its hash."""
    schema = T.StructType([*[f for f in cut.schema.fields if f.name not in ("bytes", "classes", "windows")],
                           T.StructField("window", T.LongType()), T.StructField("hash", T.LongType())])
    names = [n for n in schema.names if n not in ("window", "hash")]

    def work(batch: pa.RecordBatch):
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            data = unit.read(row["bytes"])
            start = np.arange(len(data) - least + 1)
            hashes = Sums(data).spans(start, start + least).view(np.int64)
            yield {n: [row[n]] * len(start) for n in names} | {"window": start, "hash": hashes}

    windows = map_batches(cut, work, schema).withColumn("from", F.col("place") - F.col("window"))
    order = F.struct("doc_id", "tie", "start")
    ends = windows.groupBy("key", "from", "hash").agg(F.min(order).alias("low"), F.max(order).alias("high"))
    found = windows.join(ends, ["key", "from", "hash"]).select(
        "key", "context", "window", (order > F.col("low")).alias("earlier"), (order < F.col("high")).alias("later"))

    def gathered(flag: str):
        at = F.collect_list(F.when(F.col(flag), F.struct(F.col("window").alias("a"), (F.col("window") + 1).alias("b"))))
        return at.alias(flag)

    return found.groupBy("key", "context").agg(gathered("earlier"), gathered("later"))


def repeated_runs(docs: DataFrame, least: int, keep_first: bool, dense: int = DENSE, huge: int = HUGE,
                  array_bytes: int = ARRAY_BYTES, unit: Unit = BYTES) -> DataFrame:
    """(who, tie, spans): spans of units to remove from each document of ``docs`` (doc_id, who, tie, text)."""
    runs = stable(runs_frame(docs, least, unit))
    start = F.col("starts")[0].alias("start")
    classes = runs.groupBy("key", "context").agg(
        F.sum(F.size("starts")).alias("n"), F.min(F.struct("doc_id", "tie", start, "who")).alias("first"), F.min("windows").alias("windows"),
        F.min("place").alias("place"))
    keys = classes.groupBy("key").agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("total"))
    repeated = stable(classes.join(keys.where("total > 1"), "key"))
    wanted = repeated.where("classes > 1").select(
        "key", "context", "classes", F.col("first.doc_id").alias("doc_id"), F.col("first.who").alias("who"), F.col("first.tie").alias("tie"),
        F.col("first.start").alias("start"), "windows", "place")
    cut = cut_contexts(docs, wanted, least, unit)
    if repeated.where(F.col("classes") > huge).isEmpty():
        flags = compared(cut, least, dense, array_bytes, unit)
    else:
        cut = stable(cut)
        flags = compared(cut.where(F.col("classes") <= huge), least, dense, array_bytes, unit).unionByName(
            compared_as_rows(cut.where(F.col("classes") > huge), least, unit))
    flags = flags.select("key", "context", "earlier", "later")
    none = F.array().cast(RANGES)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("windows").cast("long").alias("b")))
    judged = repeated.join(flags, ["key", "context"], "left").select(
        "key", "context", "n", "first", "windows",
        F.coalesce("earlier", none).alias("earlier"), F.coalesce("later", none).alias("later"))
    if keep_first:
        verdicts = judged.select("key", "context", "first", F.col("earlier").alias("of_first"), whole.alias("of_rest"))
    else:
        both = F.when(F.col("n") > 1, whole).otherwise(F.concat("earlier", "later"))
        verdicts = judged.select("key", "context", "first", both.alias("of_first"), both.alias("of_rest"))
    # written down, so that the join is of two shuffles and Spark can split a class that many documents share
    verdicts = stable(verdicts.where((F.size("of_first") > 0) | (F.size("of_rest") > 0)))
    is_first = ((F.col("first.who") == F.col("who")) & (F.col("first.tie") == F.col("tie"))
                & (F.col("first.start") == F.col("start")))
    spans = runs.join(verdicts, ["key", "context"]).select(
        "who", "tie", "first", "of_first", "of_rest", F.explode("starts").alias("start")).select(
        "who", "tie", "start", F.explode(F.when(is_first, F.col("of_first")).otherwise(F.col("of_rest"))).alias("r"))
    return spans.groupBy("who", "tie").agg(F.sort_array(F.collect_set(F.struct(
        (F.col("start") + F.col("r.a")).alias("a"),
        (F.col("start") + F.col("r.b") - 1 + least).alias("b")))).alias("spans"))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in spans or []:
        if out and s["a"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["b"])
        else:
            out.append([s["a"], s["b"]])
    return [tuple(x) for x in out]


def _with_spans(docs: DataFrame, extra: list[str], least: int, keep_first: bool, **options) -> DataFrame:
    """Rows with spans and ``twin``, their number among rows of equal id and text."""
    docs = docs.withColumn("who", F.xxhash64("doc_id")).withColumn("tie", F.xxhash64("text"))
    spans = repeated_runs(docs.select("doc_id", "who", "tie", "text"), least, keep_first, **options)
    joined = docs.join(spans, ["who", "tie"], "left")
    twin = F.lit(1)
    if keep_first:
        twin = F.row_number().over(Window.partitionBy("who", "tie").orderBy("doc_id"))
    return joined.withColumn("twin", twin).select("doc_id", "text", "spans", "twin", *extra)


def removed_from(data: bytes, spans: list[dict] | None, twin: int, least: int, unit: Unit = BYTES) -> list[tuple[int, int]]:
    """Byte spans that go; a row that repeats another one with its id goes whole."""
    if twin > 1 and (len(data) if unit == BYTES else len(data.split())) >= least:
        return [(0, len(data))]
    return unit.to_bytes(data, merged(spans))


def kept_bytes(data: bytes, gone: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in gone:
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]])


def passage_digests(docs: DataFrame, least: int = LEAST, keep_first: bool = False, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row of ``docs``."""
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(docs["doc_id"].alias("doc_id"), text.alias("text"))
    marked = _with_spans(rows, [], least, keep_first, **options)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                           T.StructField("kept_sha256", T.StringType())])

    def work(batch: pa.RecordBatch):
        out = []
        for i in range(batch.num_rows):
            data = batch.column(1)[i].as_py().encode("utf-8", "surrogatepass")
            gone = removed_from(data, batch.column(2)[i].as_py(), batch.column(3)[i].as_py(), least)
            out.append((len(data), sum(b - a for a, b in gone), len(gone),
                        hashlib.sha256(kept_bytes(data, gone)).hexdigest()))
        yield {"doc_id": batch.column(0)} | {n: [o[k] for o in out] for k, n in enumerate(schema.names[1:])}

    return map_batches(marked, work, schema)


def drop_passages(docs: DataFrame, least: int = LEAST, unit: Unit = BYTES, **options) -> DataFrame:
    """``docs`` with later copies of passages taken out of text, whole characters only; n_chars follows
    where it is there. Passages are of ``least`` units and more. A document of which only white space is left goes. All columns stay."""
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(docs["doc_id"].alias("doc_id"), text.alias("text"),
                       F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("row"),
                       docs["text"].isNull().alias("no_text"))
    marked = _with_spans(rows, ["row", "no_text"], least, True, unit=unit, **options)
    schema = T.StructType([T.StructField("kept", T.StringType()), T.StructField("whole", T.BooleanType()),
                           rows.schema["row"]])

    def work(batch: pa.RecordBatch):
        keep, texts, whole = [], [], []
        for i in range(batch.num_rows):
            text = batch.column(1)[i].as_py()
            data = text.encode("utf-8", "surrogatepass")
            gone = removed_from(data, batch.column(2)[i].as_py(), batch.column(3)[i].as_py(), least, unit)
            if gone:
                text = kept_bytes(data, gone).decode("utf-8", "ignore")
                if not words_of(text):
                    continue
            keep.append(i)
            texts.append(None if batch.column(5)[i].as_py() else text)
            whole.append(not gone)
        at = pa.array(keep, pa.int64())
        yield {"kept": texts, "whole": whole, "row": batch.column(4).take(at)}

    done = map_batches(marked, work, schema)
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("kept").alias("text"))
        elif c == "n_chars":
            columns.append(F.when(F.col("whole"), F.col("row.n_chars")).otherwise(
                F.length("kept")).cast(docs.schema["n_chars"].dataType).alias("n_chars"))
        else:
            columns.append(F.col("row").getField(c).alias(c))
    return done.select(*columns)
