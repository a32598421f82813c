"""One publication cycle, as a batch and as a micro-batch of a stream.

There is one writer per store: exclusion between overlapping runs comes from the
claim rows, and two writers claiming at once would need a table format with
atomic commits. Every write replaces a partition named after the run, so a
micro-batch that is run again leaves one copy of its rows.

What a cycle reads does not grow with the log. A run's own rows are read from its
own partition. Orders that moved but are not dispatched are in ``state``, the ids of
dispatched ones in ``dispatched``, a table in buckets of the id and of nothing else: an
order that comes again is found whatever else about it changed, and the history of ids is
read where it lies, only the orders at hand are shuffled to its buckets. Both are brought
up to date when a run ends. A run that did not get there is named in ``open_runs`` and is
finished by the next cycle. The
small tables that change (inbox, waiting items, state, open runs) have two slots: a new version goes
to the older slot, so the newest complete one can always be read.

A run is rolled back only before its publisher was entered. After that its messages
may have gone out: what the publisher reported is stored first and settled from
there, and what it did not report stays PROCESSING for ``orphans`` or for a repeat of
the same run, which sends the same correlation ids.

Items may come as a stream of their own. Orders and items then meet in a join of the
two streams, whatever comes first, and wait there in its state for a bounded time; what
met, and what waited that long alone, goes to the inbox and to the waiting items. An
order is claimed when as many items as it declares are there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerspark.constants import DISPATCHED, PROCESSING
from ledgerspark.session import options
from ledgerspark.sources import files
from ledgerspark.sources.publish import drop_partition, read_or_empty, replace_partition, schema_at
from ledgerspark.sources.scratch import scratch_scope, stable
from ledgerspark.streaming import orders as O

Publisher = Callable[[DataFrame], DataFrame]
Items = DataFrame | Callable[[], DataFrame]
CLAIMS, SETTLED, ROLLED_BACK = "1_claims", "2_settled", "3_rolled_back"

KINDS = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "boolean": T.BooleanType(),
         "timestamp": T.TimestampType()}


def columns(listed: str) -> StructType:
    """Schema of "name type, ..." without a session."""
    return StructType([T.StructField(n, KINDS[k]) for n, k in (c.split() for c in listed.split(","))])


RUN_LOG = columns(f"{O.LOG_SCHEMA}, step string")
DETAILS = columns("order_id string, first_run_ts timestamp")
STATE = columns(f"{O.LOG_SCHEMA}, first_run_ts timestamp")
OPEN_RUNS = columns("run string")
OUTCOMES = columns(f"{O.OUTCOME_SCHEMA}, parts int")
# Of the table of dispatched ids; a store keeps the number it was begun with.
BUCKETS = 16
# Files a bucket of that table before it is written anew.
FILES = 64
# How far the clock may step back between two micro-batches, as on another driver.
CLOCK_STEP = "10 minutes"
# Items come to their groups sorted from the join with the claims and are not sorted again.
SORTED_GROUPS = {"spark.sql.execution.replaceHashWithSortAgg": "true"}


@dataclass(frozen=True)
class Store:
    """Folders of the log, the staging table, the messages, the inbox and the compacted state."""

    path: str

    def __getattr__(self, name: str) -> str:
        if name not in ("log", "staging", "messages", "inbox", "waiting_items", "details", "outcomes", "sending",
                        "open_runs", "state", "dispatched"):
            raise AttributeError(name)
        return f"{self.path}/{name}"


def read_log(spark: SparkSession, store: Store) -> DataFrame:
    """The whole history, for reports."""
    schema = columns(f"{O.LOG_SCHEMA}, run_id string, step string")
    return read_or_empty(spark, store.log, schema)


def append_log(transitions: DataFrame, store: Store, flow: str, run_id: str, step: str) -> None:
    """Write a run's transitions; a replay of the run replaces them."""
    rows = transitions.withColumn("run_id", F.lit(f"{flow}-{run_id}")).withColumn("step", F.lit(step))
    replace_partition(rows, store.log, ["run_id", "step"])


def read_run(spark: SparkSession, store: Store, key: str) -> DataFrame:
    """A run's own transitions; ``key`` is flow and run id."""
    return read_or_empty(spark, f"{store.log}/run_id={key}", RUN_LOG).drop("step")


def write_staging(staged: DataFrame, store: Store, flow: str, run_id: str) -> None:
    """Rows of one flow and run in the shared staging table."""
    rows = staged.withColumn("flow", F.lit(flow)).withColumn("run_id", F.lit(run_id))
    replace_partition(rows, store.staging, ["flow", "run_id"])


def read_staging(spark: SparkSession, store: Store, flow: str, run_id: str) -> DataFrame:
    return spark.read.parquet(f"{store.staging}/flow={flow}/run_id={run_id}")


def has_staging(spark: SparkSession, store: Store, flow: str, run_id: str) -> bool:
    """Whether rows of the run are staged; ``cleanup`` leaves none."""
    there = schema_at(spark, f"{store.staging}/flow={flow}/run_id={run_id}") is not None
    return there and not read_staging(spark, store, flow, run_id).isEmpty()


def cleanup(spark: SparkSession, store: Store, flow: str, run_id: str) -> None:
    """Delete the run's own staging rows; other flows and runs are not touched."""
    drop_partition(spark, store.staging, flow=flow, run_id=run_id)


def to_message_table(store: Store, flow: str, run_id: str) -> Publisher:
    """Publisher that keeps the messages in a table, one partition per run.

    Another sink is another function of the message frame, for example one that
    writes ``order_id`` as key and ``message`` as value with ``format("kafka")``.
    """
    def publish(messages: DataFrame) -> DataFrame:
        rows = messages.withColumn("flow", F.lit(flow)).withColumn("run_id", F.lit(run_id))
        replace_partition(rows, store.messages, ["flow", "run_id"])
        sent = messages.sparkSession.read.parquet(f"{store.messages}/flow={flow}/run_id={run_id}")
        return sent.select("order_id", "part", F.lit(True).alias("ok"), F.lit(None).cast("string").alias("reason"))

    return publish


def _mark(spark: SparkSession, path: str, key: str) -> None:
    spark.range(1).select(F.lit(True).alias("there")).write.mode("overwrite").parquet(f"{path}/run={key}")


def _marked(spark: SparkSession, path: str, key: str) -> bool:
    return not read_or_empty(spark, f"{path}/run={key}", columns("there boolean")).isEmpty()


def _load(spark: SparkSession, path: str, schema: StructType, before: str | None = None) -> tuple[DataFrame, str, int]:
    """Rows of the newest version of a table (below ``before`` if given), its name and its slot."""
    named = StructType([*schema.fields, *columns("_there boolean, _version string, _slot int").fields])
    rows = read_or_empty(spark, path, named)
    known = rows if before is None else rows.where(F.col("_version") < before)
    newest = known.agg(F.max(F.struct("_version", "_slot")).alias("n")).first().n
    if newest is None:
        return spark.createDataFrame([], schema), "", 1
    held = spark.read.schema(StructType(named.fields[:-1])).parquet(f"{path}/_slot={newest['_slot']}")
    return held.where("_there").select(*schema.names), newest["_version"], newest["_slot"]


def _save(df: DataFrame, path: str, version: str, beside: int) -> str:
    """Write a version to the slot that is not ``beside``; one more row names it even if ``df`` is empty."""
    rows = df.withColumn("_there", F.lit(True))
    name = df.sparkSession.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields], F.lit(False).alias("_there"))
    target = f"{path}/_slot={1 - beside}"
    rows.unionByName(name).withColumn("_version", F.lit(version)).write.mode("overwrite").parquet(target)
    return target


def read_state(spark: SparkSession, store: Store) -> DataFrame:
    """Last transition of each order that has one and is not dispatched."""
    return _load(spark, store.state, STATE)[0]


def _generations(spark: SparkSession, store: Store) -> tuple[int, list[int]]:
    """The generation of the table of dispatched ids that holds, and all that have a folder.

    The first is there from the start, a later one from when it is whole.
    """
    numbers = sorted(int(n[2:]) for n in files.names(spark, store.dispatched) if n.startswith("g="))
    whole = [n for n in numbers if n and files.exists(spark, f"{store.dispatched}/g={n}/_SUCCESS")]
    return max([0, *whole]), numbers


def _ids_table(spark: SparkSession, store: Store, number: int) -> str:
    name = f"dispatched_{hashlib.sha256(store.path.encode()).hexdigest()[:24]}_{number}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (order_id STRING) USING parquet CLUSTERED BY (order_id) "
              f"SORTED BY (order_id) INTO {BUCKETS} BUCKETS LOCATION '{store.dispatched}/g={number}'")
    return name


def dispatched_ids(spark: SparkSession, store: Store) -> str:
    """Name of the table of dispatched ids; the catalog learns of it in each session that has not met it."""
    return _ids_table(spark, store, _generations(spark, store)[0])


def compact_dispatched(spark: SparkSession, store: Store, most: int | None = None) -> bool:
    """Write the dispatched ids anew, each once and one file a bucket, if there are more than ``most`` files a bucket.

    The new generation holds from when it is whole, so a failure on the way changes nothing.
    The former one stays for those who still read it, until the next time.
    """
    number, known = _generations(spark, store)
    ids = spark.table(_ids_table(spark, store, number))
    if len(ids.inputFiles()) <= (FILES if most is None else most) * BUCKETS:
        return False
    for old in known:
        if old != number:
            spark.sql(f"DROP TABLE IF EXISTS {_ids_table(spark, store, old)}")
            files.delete(spark, f"{store.dispatched}/g={old}")
    ids.distinct().repartition(BUCKETS, "order_id").write.insertInto(_ids_table(spark, store, number + 1))
    return True


def without_dispatched(orders: DataFrame, store: Store) -> DataFrame:
    """Orders that were not dispatched; the table of ids is read by its buckets and not shuffled."""
    known = orders.sparkSession.table(dispatched_ids(orders.sparkSession, store))
    return orders.join(known, "order_id", "left_anti").select(*orders.columns)


def _open_runs(spark: SparkSession, store: Store, add: str | None = None, drop: str | None = None) -> list[str]:
    """Runs that began and did not end; ``add`` and ``drop`` change the list."""
    rows, version, slot = _load(spark, store.open_runs, OPEN_RUNS)
    runs = [r.run for r in rows.collect()]
    if add or drop:
        now = sorted({*runs, *([add] if add else [])} - {drop})
        _save(spark.createDataFrame([(r,) for r in now], OPEN_RUNS), store.open_runs, _next(version), slot)
    return runs


def _next(version: str) -> str:
    return f"{int(version or 0) + 1:015d}"


def _finish(spark: SparkSession, store: Store, key: str, flow: str, clock: Callable[[], datetime],
            done: bool = False) -> None:
    """Settle what a run's publisher reported, or roll back what was never sent; then compact.

    ``done`` says that the run itself goes through here. Each step may be repeated.
    """
    own = read_run(spark, store, key)
    open_now = O.open_claims(own)
    claim = open_now.select("run_ts").first()
    run_id = key[len(flow) + 1:]
    if claim is not None:
        outcomes = read_or_empty(spark, f"{store.outcomes}/run={key}", OUTCOMES)
        if not outcomes.isEmpty():
            settled = O.settle(outcomes, open_now, flow, claim[0], clock())
            append_log(settled, store, flow, run_id, SETTLED)
        elif not done and not _marked(spark, store.sending, key):
            append_log(O.rollback_run(own, flow, claim[0], clock()), store, flow, run_id, ROLLED_BACK)
    _compact(spark, store, key)
    compact_dispatched(spark, store)
    _open_runs(spark, store, drop=key)


def _compact(spark: SparkSession, store: Store, key: str) -> None:
    """Fold a run's transitions into the state and the dispatched ids."""
    details = read_or_empty(spark, f"{store.details}/run={key}", DETAILS)
    with scratch_scope(spark):
        moved = stable(O.current_status(read_run(spark, store, key)).join(details, "order_id", "left"))
        gone = moved.where(F.col("status") == DISPATCHED).select("order_id")
        # a file a bucket; ids that are added twice by a repeat do no harm
        gone.repartition(BUCKETS, "order_id").write.insertInto(dispatched_ids(spark, store))
        state, version, slot = _load(spark, store.state, STATE)
        kept = state.join(moved.select("order_id"), "order_id", "left_anti")
        still = moved.where(F.col("status") != DISPATCHED).withColumn("seq", F.lit(0).cast("long"))
        _save(kept.select(*STATE.names).unionByName(still.select(*STATE.names)), store.state, _next(version), slot)


def run_cycle(
    orders: DataFrame,
    items: Items,
    store: Store,
    flow: str,
    run_id: str,
    run_ts: datetime,
    eligible: list[str],
    batch_size: int | None,
    publisher: Publisher | None = None,
    replay_safe: bool = True,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    max_items: int = O.MAX_ITEMS,
) -> bool:
    """Claim, stage, publish and settle one batch of orders; False when none was pending.

    An order is claimed when its items are there. The claims are written first and
    read back, because the choice of a bounded batch must not be made twice. A run
    that is repeated goes on where it stopped: it settles stored reports, or publishes
    its claims again with the same ids, as they are staged if its publisher had been entered. With ``replay_safe=False`` (a sink that cannot
    replace what it got before) claims that may have been sent are left to ``orphans``.
    """
    spark, key = orders.sparkSession, f"{flow}-{run_id}"
    items = items() if callable(items) else items
    for other in _open_runs(spark, store):  # runs that broke off, normally none
        if other != key and other.startswith(f"{flow}-"):
            _finish(spark, store, other, flow, clock)

    if not O.has_work(O.open_claims(read_run(spark, store, key))):
        if _marked(spark, store.sending, key):
            return False  # the run was settled before
        state = read_state(spark, store)
        candidates = O.complete(without_dispatched(orders, store), items)
        claims = O.claim(candidates, state, flow, run_ts, clock(), eligible, batch_size)
        _open_runs(spark, store, add=key)
        append_log(claims, store, flow, run_id, CLAIMS)
        claimed = O.open_claims(read_run(spark, store, key)).select("order_id")
        if not O.has_work(claimed):
            _open_runs(spark, store, drop=key)
            return False
        first = state.select("order_id", F.col("first_run_ts").alias("_first"))
        details = orders.join(claimed, "order_id", "left_semi").join(first, "order_id", "left").select(
            "order_id", F.coalesce("_first", F.lit(run_ts).cast("timestamp")).alias("first_run_ts"))
        details.write.mode("overwrite").parquet(f"{store.details}/run={key}")
    elif _marked(spark, store.sending, key) and not replay_safe and read_or_empty(
            spark, f"{store.outcomes}/run={key}", OUTCOMES).isEmpty():
        return False

    claims = O.open_claims(read_run(spark, store, key)).join(
        read_or_empty(spark, f"{store.details}/run={key}", DETAILS).select("order_id", "first_run_ts"),
        "order_id", "left").withColumn("first_run_ts", F.coalesce("first_run_ts", "run_ts"))
    if read_or_empty(spark, f"{store.outcomes}/run={key}", OUTCOMES).isEmpty():
        try:
            # what its publisher was given before goes out again as it was
            if not (_marked(spark, store.sending, key) and has_staging(spark, store, flow, run_id)):
                with scratch_scope(spark), options(spark, SORTED_GROUPS):
                    write_staging(O.stage(claims, orders, items, max_items), store, flow, run_id)
            staged = read_staging(spark, store, flow, run_id)
            messages = O.envelope(staged)
        except Exception:
            undo = O.rollback_run(read_run(spark, store, key), flow, run_ts, clock())
            append_log(undo, store, flow, run_id, ROLLED_BACK)
            _finish(spark, store, key, flow, clock, done=True)
            cleanup(spark, store, flow, run_id)
            raise
        _mark(spark, store.sending, key)
        outcomes = (publisher or to_message_table(store, flow, run_id))(messages)
        if "part" not in outcomes.columns:
            outcomes = outcomes.withColumn("part", F.lit(None).cast("int"))
        parts = staged.groupBy("order_id").agg(F.max("parts").alias("parts"))
        outcomes.select("order_id", "part", "ok", "reason").join(parts, "order_id").write.mode(
            "overwrite").parquet(f"{store.outcomes}/run={key}")
    _finish(spark, store, key, flow, clock, done=True)
    cleanup(spark, store, flow, run_id)
    return True


def _take_in(arrivals: DataFrame, store: Store, path: str, batch: str, key: list[str], version: list[str]) -> DataFrame:
    """The latest arrival of each key among this batch and what waits at ``path``, without dispatched orders."""
    spark = arrivals.sparkSession
    schema = StructType([*arrivals.schema.fields, *columns("arrived string").fields])
    waiting, _, slot = _load(spark, path, schema, batch)
    both = waiting.unionByName(arrivals.withColumn("arrived", F.lit(batch)))
    rest = [c for c in schema.names if c not in key]
    later = F.struct(*version, "arrived", *[c for c in rest if c != "arrived"])
    latest = both.groupBy(*key).agg(F.max_by(F.struct(*rest), later).alias("o")).select(*key, "o.*")
    open_now = without_dispatched(latest.select(*schema.names), store)
    target = _save(open_now, path, batch, slot)
    return spark.read.parquet(target).where("_there").select(*arrivals.columns)


def take_in(arrivals: DataFrame, store: Store, batch: str, version: list[str] | None = None) -> DataFrame:
    """Orders that wait to be published: the latest arrival of each, of this batch and the ones before.

    ``version`` names the columns that tell which of two arrivals is later; without
    them it is the one of the later batch. Rows that agree in that are decided by
    their other columns, so a replay takes the same one. Whether an order was published
    is told by the dispatched ids alone; those leave the inbox.
    """
    return _take_in(arrivals, store, store.inbox, batch, ["order_id"], version or [])


def take_in_items(arrivals: DataFrame, store: Store, batch: str, key: list[str] | None = None) -> DataFrame:
    """Items of orders that are not dispatched: the latest arrival of each.

    ``key`` names the columns that tell the items of an order apart. Without it all do:
    equal rows are one item that came again, rows that differ are two.
    """
    told = [c for c in key or arrivals.columns if c != "order_id"]
    return _take_in(arrivals, store, store.waiting_items, batch, ["order_id", *told], [])


def still_waiting(spark: SparkSession, path: str, schema: StructType, batch: str) -> DataFrame:
    """What waits at ``path`` for a batch that brings nothing, read where it lies.

    Orders dispatched by the batch before are still among it; a cycle does not claim them again, and the
    next arrival leaves them out.
    """
    held = StructType([*schema.fields, *columns("arrived string").fields])
    return _load(spark, path, held, batch)[0].select(*schema.names)


def unmatched_items(spark: SparkSession, store: Store, items: StructType, orders: StructType) -> DataFrame:
    """Waiting items whose order is not in the inbox, for reports; with the schemas of both streams."""
    arrived = columns("arrived string").fields
    waiting = _load(spark, store.waiting_items, StructType([*items.fields, *arrived]))[0]
    inbox = _load(spark, store.inbox, StructType([*orders.fields, *arrived]))[0]
    return waiting.join(inbox.select("order_id"), "order_id", "left_anti")


def meet(orders: DataFrame, items: DataFrame, within: str, clock_step: str = CLOCK_STEP) -> DataFrame:
    """Orders and items of two streams as pairs of structs ``order`` and ``item``, whichever comes first.

    A pair comes out as soon as both are there. What found no partner within that
    time comes out alone, with the other side null, so nothing is lost and the state
    holds no more than that time. Time is that of arrival: no row is late, and the rows'
    own columns, which may be null, do not matter. Rows without an order id come out alone.

    The state is let go by the slower of the two streams; with the session's
    ``spark.sql.streaming.multipleWatermarkPolicy`` set to ``max`` by the faster one, which
    is right here because both go by one clock.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            F.struct("*").alias(name), F.col("order_id").alias(f"_{name}_id"),
            F.current_timestamp().alias(f"_{name}_at")).withWatermark(f"_{name}_at", clock_step)

    wait, ordered = F.expr(f"INTERVAL '{within}'"), F.col("_order_at")
    near = F.col("_item_at").between(ordered - wait, ordered + wait)
    return side(orders, "order").join(
        side(items, "item"), (F.col("_order_id") == F.col("_item_id")) & near, "full_outer").select("order", "item")


def order_stream(
    arrivals: DataFrame,
    items: Items,
    store: Store,
    flow: str,
    eligible: list[str],
    batch_size: int | None,
    checkpoint: str,
    trigger: dict | None = None,
    dedupe_within: str | None = None,
    publisher: Publisher | None = None,
    replay_safe: bool = True,
    version: list[str] | None = None,
    item_key: list[str] | None = None,
    wait: str = "1 day",
    clock_step: str = CLOCK_STEP,
) -> StreamingQuery:
    """Publish a stream of orders, one cycle per micro-batch.

    ``items`` is a function that reads the items as they are when a micro-batch runs,
    a frame when they never change, or a stream: see ``meet``, which holds orders and
    items for ``wait`` until they meet. ``item_key`` tells the items of an order apart, as in
    ``take_in_items``: of one that comes again the later arrival counts, and one that comes
    after its order was dispatched is left out. An order is complete with ``n_items`` items, or with any where it has no such
    column or a null in it. ``trigger`` is passed on to Spark
    (``{"processingTime": "5 minutes"}``); the default works off what is there and
    stops. The source's own rate option, such as ``maxFilesPerTrigger``, bounds what a
    micro-batch takes in. Orders that are not eligible yet, lack items, are left by
    ``batch_size`` or were rolled back stay in the inbox for the next micro-batch.

    ``dedupe_within`` drops arrivals equal in all columns within that time of the first
    one, with state for that time only; it goes by arrival time, so no order is late.
    """
    if dedupe_within is not None:
        names = arrivals.columns
        arrivals = (
            arrivals.withColumn("_arrived", F.current_timestamp())
            .withWatermark("_arrived", dedupe_within)
            .dropDuplicatesWithinWatermark(names)
            .drop("_arrived")
        )

    streamed = isinstance(items, DataFrame) and items.isStreaming
    if streamed:
        arrivals = meet(arrivals, items, wait, clock_step)

    def run(inbox: DataFrame, held: Items, run_id: str) -> None:
        # The run time is part of the message ids: a repeated batch must use the same.
        claimed = read_run(inbox.sparkSession, store, f"{flow}-{run_id}").where(F.col("status") == PROCESSING)
        run_ts = claimed.agg(F.max("run_ts")).first()[0] or datetime.now(timezone.utc)
        run_cycle(
            inbox, held, store, flow, run_id, run_ts, eligible, batch_size, publisher, replay_safe
        )

    def cycle(batch: DataFrame, batch_id: int) -> None:
        run_id = f"b{batch_id:012d}"
        if not streamed:
            run(take_in(batch, store, run_id, version), items, run_id)
            return
        batch.persist()  # the join's state is gone through once
        try:
            # a batch without rows, such as the one that only moves the watermark on, leaves what waits as it is
            if batch.agg(F.count(F.lit(1))).first()[0] == 0:
                spark, sides = batch.sparkSession, batch.schema
                run(still_waiting(spark, store.inbox, sides["order"].dataType, run_id),
                    still_waiting(spark, store.waiting_items, sides["item"].dataType, run_id), run_id)
                return
            # an order came with each of its items
            inbox = take_in(batch.where("order IS NOT NULL").select("order.*").distinct(), store, run_id, version)
            held = take_in_items(batch.where("item IS NOT NULL").select("item.*"), store, run_id, item_key)
        finally:
            batch.unpersist()
        run(inbox, held, run_id)

    writer = (
        arrivals.writeStream.foreachBatch(cycle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    return writer.start()
