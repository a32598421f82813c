"""SimHash near-duplicates by a generalised pigeonhole with unequal thresholds.

Bits that go together are put into one part, so that values of different parts vary
freely. If two fingerprints differ in at most ``distance`` bits and the thresholds of
m parts add up to ``distance - m + 1``, some part differs in no more bits than its
threshold; -1 leaves a part out. Dynamic programming shares out the thresholds by the
candidates and rows they cost, estimated on a bounded sample of fingerprints. The
sample steers cost only: every allocation finds every link.

Each fingerprint is put into a bucket by the value of each part, and into those of
all values within the part's threshold; links inside a bucket are verified by the
full distance. A bucket gives a spanning forest of its links, never all pairs, and
equal fingerprints are one row throughout. A bucket above ``bucket_rows`` is dealt
again by quarters of its remaining bits, which loses no link either.

Null and empty texts have fingerprint zero and are linked like others. Repeated rows
and ties are in one group. A null doc_id is a member; a group without any id has a
null component. Extra columns do not matter. An empty table gives no row.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.common import map_batches, same
from ledgerspark.llm.components import components
from ledgerspark.sources.scratch import stable

BITS = 64
SEED = 42
SAMPLE = 2048
BUCKET_ROWS = 20_000
#: Shuffled rows cost about this many pair comparisons.
ROW_COST = 50.0
DENSE = 512


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the shingles of the whole text as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    count = len(words) - shingle + 1
    if count <= 1:
        return int(np.uint64(xxhash.xxh64_intdigest(joined, SEED)).astype(np.int64))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:count].tolist()
    ends = ends[shingle - 1:].tolist()
    del words
    h = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, 1 << 15):
        hashes = np.array([h(joined[a:b], SEED) for a, b in zip(starts[at:at + (1 << 15)], ends[at:at + (1 << 15)])],
                          np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, keys: list[str], shingle: int = 3) -> DataFrame:
    schema = T.StructType([docs.schema[k] for k in keys] + [T.StructField("fp", T.LongType())])

    def work(batch: pa.RecordBatch):
        texts = batch.column(len(keys))
        yield {k: batch.column(i) for i, k in enumerate(keys)} | {
            "fp": pa.array([fingerprint(texts[i].as_py(), shingle) for i in range(len(texts))], pa.int64())}

    return map_batches(docs.select(*keys, "text"), work, schema)


def group_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of equal size, each grown around the bits that correlate most."""
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(float)
    spread = bits.std(0)
    centred = (bits - bits.mean(0)) / np.where(spread > 0, spread, 1)
    related = np.abs(centred.T @ centred) / max(1, len(bits))
    np.fill_diagonal(related, 0)
    free, groups = list(range(BITS)), []
    for part in range(parts):
        wanted = BITS // parts + (part < BITS % parts)
        group = [max(free, key=lambda b: (related[b, free].sum(), -b))]
        free.remove(group[0])
        while len(group) < wanted:
            group.append(max(free, key=lambda b: (related[b, group].sum(), -b)))
            free.remove(group[-1])
        groups.append(sorted(group))
    return groups


def mask_of(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def allocate(sample: np.ndarray, groups: list[list[int]], rows: int, distance: int) -> tuple[float, list[int]]:
    """(cost, threshold of each part), the cheapest thresholds that add up to distance - parts + 1."""
    pairs = max(1, len(sample) * (len(sample) - 1) // 2)
    upper = np.triu_indices(len(sample), 1)
    costs = []
    for group in groups:
        part = sample & np.uint64(mask_of(group))
        apart = np.bitwise_count(part[upper[0]] ^ part[upper[1]]) if len(sample) > 1 else np.zeros(0, np.uint8)
        cost = {-1: 0.0}
        for t in range(distance + 1):
            values = sum(comb(len(group), d) for d in range(t + 1))
            share = max(float((apart <= t).sum()) / pairs, values / 2.0 ** len(group))
            cost[t] = ROW_COST * rows * values + share * rows * rows / 2
        costs.append(cost)
    best = {0: (0.0, [])}
    for cost in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for total, (spent, chosen) in best.items():
            for t, extra in cost.items():
                if total + t not in following or spent + extra < following[total + t][0]:
                    following[total + t] = (spent + extra, [*chosen, t])
        best = following
    return best[distance - len(groups) + 1]


def plan(sample: np.ndarray, rows: int, distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the parts to probe, over the number of parts that costs least."""
    if not len(sample):
        return [(list(range(BITS)), 0)]
    options = []
    for parts in range(2, distance + 2):
        groups = group_bits(sample, parts)
        cost, thresholds = allocate(sample, groups, rows, distance)
        options.append((cost, list(zip(groups, thresholds))))
    return [(bits, t) for bits, t in min(options, key=lambda o: o[0])[1] if t >= 0]


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def bucketed(unique: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """(part, key, fp): each fingerprint in the buckets of all values within a part's threshold."""
    probes = []
    for number, (bits, threshold) in enumerate(parts):
        for d in range(threshold + 1):
            for flipped in itertools.combinations(bits, d):
                probes.append((number, signed(mask_of(bits)), signed(mask_of(list(flipped)))))
    probe = F.explode(F.array(*[F.struct(F.lit(n).alias("part"), F.lit(m).cast("long").alias("mask"),
                                         F.lit(x).cast("long").alias("flip")) for n, m, x in probes]))
    return unique.select("fp", probe.alias("p")).select(
        "p.part", F.col("fp").bitwiseAND(F.col("p.mask")).bitwiseXOR(F.col("p.flip")).alias("key"), "fp")


def refined(rows: DataFrame, parts: list[tuple[list[int], int]], distance: int, bucket_rows: int) -> DataFrame:
    """``rows`` with buckets above ``bucket_rows`` dealt again by quarters of the bits not in their part."""
    masks = []
    for bits, _ in parts:
        rest = [b for b in range(BITS) if b not in bits]
        masks.append([signed(mask_of(rest[q::distance + 1])) for q in range(distance + 1)])
    hot = stable(rows.groupBy("part", "key").count().where(F.col("count") > bucket_rows).drop("count"))
    rows = rows.withColumn("sub", F.lit(0).cast("long")).withColumn("subkey", F.lit(0).cast("long"))
    if hot.isEmpty():
        return rows
    by_part = F.element_at(F.array(*[F.array(*[F.lit(m).cast("long") for m in ms]) for ms in masks]),
                           F.col("part") + 1)
    cold = rows.join(hot, ["part", "key"], "left_anti")
    again = rows.join(hot, ["part", "key"], "left_semi").select(
        "part", "key", "fp", F.posexplode(by_part).alias("q", "mask")).select(
        "part", "key", "fp", (F.col("q") + 1).cast("long").alias("sub"),
        F.col("fp").bitwiseAND(F.col("mask")).alias("subkey"))
    return cold.unionByName(again)


def forest_of(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of one large bucket: each step compares one member with those not yet reached."""
    left, a, b = fps, [], []
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = np.bitwise_count(left ^ at) <= distance
            if near.any():
                found = left[near]
                left = left[~near]
                frontier.extend(found)
                a.append(np.full(len(found), at))
                b.append(found)
    none = np.zeros(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def links_in(fps: np.ndarray, group: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of sorted buckets (``group`` numbers them), thinned to a forest of each."""
    sizes = np.bincount(group)
    large = sizes > DENSE
    out_a, out_b = [], []
    if large.any():
        first = np.concatenate(([0], np.cumsum(sizes)))
        for g in np.flatnonzero(large):
            a, b = forest_of(np.unique(fps[first[g]:first[g + 1]]), distance)
            out_a.append(a)
            out_b.append(b)
        small = ~large[group]
        fps, group = fps[small], group[small]
    pairs, shift = [], 1
    rows = np.arange(max(0, len(fps) - 1))
    while len(rows):
        rows = rows[rows + shift < len(fps)]
        rows = rows[group[rows] == group[rows + shift]]
        apart = np.bitwise_count(fps[rows] ^ fps[rows + shift])
        near = rows[(apart <= distance) & (apart > 0)]
        pairs.append(np.stack([near, near + shift]))
        shift += 1
    if pairs:
        i, j = np.concatenate(pairs, axis=1)
        root = np.arange(len(fps))
        while len(i):
            before = root.copy()
            low = np.minimum(root[i], root[j])
            np.minimum.at(root, i, low)
            np.minimum.at(root, j, low)
            if (root == before).all():
                break
        moved = np.flatnonzero(root != np.arange(len(fps)))
        out_a.append(fps[moved])
        out_b.append(fps[root[moved]])
    none = np.zeros(0, np.uint64)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (none, none)


def bucket_links(rows: DataFrame, distance: int) -> DataFrame:
    """(a, b) links of fingerprints inside buckets; a task holds whole buckets, one stretch at a time."""
    keys = ["part", "key", "sub", "subkey"]
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def links(held: pd.DataFrame) -> pd.DataFrame:
            change = (held[keys].to_numpy()[1:] != held[keys].to_numpy()[:-1]).any(1)
            group = np.concatenate(([0], np.cumsum(change)))
            a, b = links_in(held["fp"].to_numpy().view(np.uint64), group, distance)
            return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

        waiting: list[pd.DataFrame] = []
        for frame in frames:
            last = (frame[keys] == frame[keys].iloc[-1]).all(axis=1).to_numpy()
            if not last.all():
                cut = int(np.flatnonzero(~last)[-1]) + 1
                yield links(pd.concat([*waiting, frame.iloc[:cut]]))
                waiting = [frame.iloc[cut:]]
            elif waiting and not (waiting[-1][keys].iloc[-1] == frame[keys].iloc[-1]).all():
                yield links(pd.concat(waiting))
                waiting = [frame]
            else:
                waiting.append(frame)
        if waiting:
            yield links(pd.concat(waiting))

    dealt = rows.select(*keys, "fp").repartition(*keys).sortWithinPartitions(*keys, "fp")
    return dealt.mapInPandas(work, schema)


def near_groups(prints: DataFrame, distance: int = 3, sample: int = SAMPLE,
                bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(fp, root, component_id) for each different fingerprint of ``prints`` (doc_id, fp); root names the group."""
    unique = stable(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    count = unique.count()
    drawn = unique.orderBy(F.xxhash64("fp"), "fp").limit(sample).select("fp").toPandas()["fp"]
    parts = plan(drawn.to_numpy(np.int64).view(np.uint64), count, distance)
    rows = refined(bucketed(unique, parts), parts, distance, bucket_rows)
    links = stable(bucket_links(rows, distance).distinct())
    roots = components(links)
    placed = unique.join(roots, unique["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, **options) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, one row per row of ``docs``."""
    prints = stable(fingerprints(docs, ["doc_id"], shingle))
    return prints.join(near_groups(prints, distance, **options).drop("root"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 3, **options) -> DataFrame:
    """The row with the smallest doc_id of each group, all columns; of rows with the same id the one
    whose hash is smallest, and one of fully equal rows."""
    whole = F.xxhash64(*[docs[c] for c in docs.columns])
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].alias("doc_id"),
                       docs["text"].alias("text"), whole.alias("tie"))
    prints = stable(fingerprints(rows, ["doc_id", "tie"], shingle))
    grouped = prints.join(near_groups(prints, distance, **options).withColumnRenamed("fp", "of"),
                          F.col("fp") == F.col("of"))
    winners = grouped.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")).alias("w")
    ).select(F.col("w.doc_id").alias("id"), F.col("w.tie").alias("hash")).distinct()
    kept = rows.drop("text").join(winners, same(F.col("doc_id"), F.col("id")) & (F.col("tie") == F.col("hash")),
                                  "left_semi")
    first = kept.groupBy("doc_id", "tie").agg(F.first("row").alias("row"))
    return first.select("row.*")
