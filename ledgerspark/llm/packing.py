"""Packing into length buckets whose bounds minimise padding.

The histogram of all lengths decides: dynamic programming over it finds the bounds of
``buckets`` buckets with the least padding when every row is filled up to its bucket's
bound. Every length is counted by itself, so the bounds are the best there are; the
histogram that reaches the driver has a row a different length, of which there are no
more than the longest text has tokens, however many texts there are. The programme takes
time in proportion to them.

Batches are made inside each bucket: as many rows as the token budget holds at the
bucket's bound, one for a longer row. A bucket may hold most rows, so its rows are
numbered by slots: a slot's rows are numbered by a window over a few thousand rows, the
sizes of the slots before it are added. Rows with equal id and length are counted first,
and so cannot fill a slot.

Null and empty texts have one token, the end. Ties are ordered by hash, then id. Only
lengths and ids are shuffled. Other columns do not matter. An empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.common import map_batches
from ledgerspark.llm.pieces import shared_model, model_of
from ledgerspark.sources.scratch import stable

BUCKETS = 8
TOKEN_BUDGET = 65_536
SLOT_ROWS = 4096
#: Copies of one row that are written out by one task.
COPIES = 1_000_000


def token_lengths(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens) with the end token counted."""
    shared = shared_model(docs, path)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_tokens", T.LongType())])

    def work(batch: pa.RecordBatch):
        counts = model_of(shared.value).count_all([t.as_py() or "" for t in batch.column(1)])
        yield {"doc_id": batch.column(0), "n_tokens": [n + 1 for n in counts]}

    return map_batches(docs.select("doc_id", "text"), work, schema)


def best_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least total padding.

    ``lengths`` ascend. The cost of a bucket from i to j is lengths[j] times its rows; what
    the rows hold is the same for all choices. With one more bucket, the best cost up to j is
    the least of the lines best[i] - upto[i] * x at x = lengths[j], plus a number of j alone.
    The slopes fall with i and x grows with j, so a hull of lines is walked along once.
    Whole numbers throughout; of equal costs the lower bound is taken.
    """
    size, upto = [int(x) for x in lengths], [0]
    for n in counts:
        upto.append(upto[-1] + int(n))
    best: list[int | None] = [0, *[None] * len(size)]
    came_from = []
    for _ in range(min(buckets, len(size))):
        now, origin = [0, *[0] * len(size)], [0] * (len(size) + 1)
        hull: list[int] = []
        at = 0
        for j in range(1, len(size) + 1):
            if best[j - 1] is not None:
                at = min(at, _added(hull, j - 1, best, upto))
            x = size[j - 1]
            while at + 1 < len(hull) and best[hull[at + 1]] - upto[hull[at + 1]] * x < best[hull[at]] - upto[hull[at]] * x:
                at += 1
            origin[j] = hull[at]
            now[j] = best[hull[at]] - upto[hull[at]] * x + x * upto[j]
        best = now
        came_from.append(origin)
    bounds, at = [], len(size)
    for origin in reversed(came_from):
        if at == 0:
            break
        bounds.append(size[at - 1])
        at = origin[at]
    return bounds[::-1]


def _added(hull: list[int], line: int, best: list, upto: list[int]) -> int:
    """Put a line on the hull, without those it makes needless; return the last place."""
    while len(hull) > 1:
        a, b = hull[-2], hull[-1]
        # where the new line crosses a, against where b does
        if (best[line] - best[a]) * (upto[b] - upto[a]) < (best[b] - best[a]) * (upto[line] - upto[a]):
            hull.pop()
        else:
            break
    hull.append(line)
    return len(hull) - 1


def plan_bounds(lengths: DataFrame, buckets: int) -> list[int]:
    histogram = lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("n_tokens")
    return best_bounds(histogram["n_tokens"].to_numpy(np.int64), histogram["n"].to_numpy(np.int64), buckets)


def numbered(rows: DataFrame, group: str, keys: list[str], slot_rows: int) -> DataFrame:
    """``rows`` with ``position``, their number in ``group`` from 0; rows with equal keys follow each other."""
    distinct = rows.groupBy(group, *keys).agg(F.count(F.lit(1)).alias("copies"))
    total = rows.count()
    slots = max(1, -(-total // slot_rows))
    order = F.xxhash64(*keys)
    slotted = distinct.withColumn("slot", F.pmod(F.xxhash64(*keys, F.lit(1)), F.lit(slots)))
    sizes = slotted.groupBy(group, "slot").agg(F.sum("copies").alias("held"))
    before = Window.partitionBy(group).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(group, "slot", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(group, "slot").orderBy(order, *keys).rowsBetween(Window.unboundedPreceding, -1)
    placed = slotted.withColumn("inner", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(
        offsets, [group, "slot"])
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES)))
    spread = placed.withColumn("block", block).withColumn("copy", F.explode(F.sequence(
        F.col("block") * COPIES, F.least(F.col("copies"), (F.col("block") + 1) * COPIES) - 1)))
    return spread.select(group, *keys, (F.col("offset") + F.col("inner") + F.col("copy")).alias("position"))


def pack(docs: DataFrame, path: str, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET,
         slot_rows: int = SLOT_ROWS) -> DataFrame:
    """doc_id, n_tokens, bucket, bucket_tokens, batch, place (row in the batch), padding per row of ``docs``."""
    lengths = stable(token_lengths(docs, path))
    bounds = plan_bounds(lengths, buckets)
    limits = F.array(*[F.lit(b).cast("long") for b in bounds or [1]])
    rows = lengths.withColumn("bucket", F.size(F.filter(limits, lambda b: b < F.col("n_tokens"))))
    held = F.element_at(limits, F.col("bucket") + 1)
    rows_each = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(token_budget) / held))
    return numbered(rows, "bucket", ["doc_id", "n_tokens"], slot_rows).select(
        "doc_id", "n_tokens", "bucket", held.alias("bucket_tokens"),
        F.floor(F.col("position") / rows_each).alias("batch"),
        F.pmod("position", rows_each).alias("place"),
        (held - F.col("n_tokens")).alias("padding"),
    )
