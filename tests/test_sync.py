import json
import time
from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ledgerspark.constants import DISPATCHED, FAILED, PENDING, PROCESSING, SUCCEEDED
from ledgerspark.sources.publish import (
    drop_run_tables, drop_versions, publish_table, publish_version, read_current, run_tables, save_run_table,
)
from ledgerspark.sources.run_ledger import LEDGER_SCHEMA, record_run, upstream_asof
from ledgerspark.streaming import cycle, orders as O

T0 = datetime(2024, 1, 1)
ORDERS = "order_id string, created_at timestamp, BusinessStatus string"
ITEMS = "order_id string, line_no int, sku string, qty int, amount decimal(18,2)"


def order_rows(spark, *ids, status="OK"):
    return spark.createDataFrame(
        [(i, T0 + timedelta(minutes=n), status) for n, i in enumerate(ids)], ORDERS)


def item_rows(spark, **counts):
    return spark.createDataFrame(
        [(i, n, f"s{n}", n, D(n)) for i, c in counts.items() for n in range(c)], ITEMS)


def log_rows(spark, *rows):
    return spark.createDataFrame(
        [(i, s, T0, "f", T0 + timedelta(hours=h), q) for i, s, h, q in rows], O.LOG_SCHEMA)


def statuses(spark, store):
    return {r.order_id: r.status for r in O.current_status(cycle.read_log(spark, store)).collect()}


def test_claim_takes_oldest_pending_and_eligible(spark):
    orders = order_rows(spark, "a", "b", "c", "d").unionByName(order_rows(spark, "x", status="NO"))
    log = log_rows(spark, ("a", PROCESSING, 0, 1), ("b", PROCESSING, 0, 1), ("b", PENDING, 0, 3),
                   ("c", DISPATCHED, 1, 2))
    claimed = O.claim(orders, log, "f", T0, T0, ["OK"], None)
    assert sorted(r.order_id for r in claimed.collect()) == ["b", "d"]
    assert [r.order_id for r in O.claim(orders, log, "f", T0, T0, ["OK"], 1).collect()] == ["b"]
    assert not O.has_work(O.claim(orders, log, "f", T0, T0, ["none"], None))
    status = {r.order_id: r.SyncStatus for r in O.with_status(orders, log).collect()}
    assert status == {"a": PROCESSING, "b": PENDING, "c": DISPATCHED, "d": PENDING, "x": PENDING}


def test_stage_and_envelope(spark):
    orders = order_rows(spark, "a", "b")
    claims = O.claim(orders, log_rows(spark).limit(0), "f", T0, T0, ["OK"], None)
    staged = O.stage(claims, orders, item_rows(spark, a=5, z=3), max_items=2)
    messages = {(r.order_id, r.part): json.loads(r.message) for r in O.envelope(staged).collect()}
    assert sorted(messages) == [("a", 0), ("a", 1), ("a", 2), ("b", 0)]
    assert [i["line_no"] for p in range(3) for i in messages["a", p]["data"]["items"]] == [0, 1, 2, 3, 4]
    assert messages["b", 0]["data"]["items"] == [] and messages["b", 0]["headers"]["parts"] == 1
    assert messages["a", 0]["data"]["created_at"] == "2024-01-01T00:00:00.000"
    assert isinstance(messages["a", 0]["data"]["items"][0]["amount"], float)
    assert len({m["headers"]["correlation_id"] for m in messages.values()}) == 4
    hot = O.stage(claims, orders, item_rows(spark, a=5, z=3), max_items=2, hot_rows=2)
    assert sorted(hot.collect()) == sorted(staged.collect())


def test_settle_rollback_orphans(spark, rows):
    orders = order_rows(spark, "a", "b", "c")
    claims = O.claim(orders, log_rows(spark).limit(0), "f", T0, T0, ["OK"], None)
    outcomes = spark.createDataFrame(
        [("a", 0, True, None), ("b", 0, True, None), ("b", 1, False, "full"), ("other", 0, True, None)],
        O.OUTCOME_SCHEMA)
    settled = O.settle(outcomes, claims, "f", T0, T0 + timedelta(minutes=1))
    assert rows(settled.select("order_id", "status")) == [("a", DISPATCHED), ("b", PENDING)]
    parts = spark.createDataFrame([("a", 2), ("b", 2)], "order_id string, parts int")
    assert rows(O.settle(outcomes, claims, "f", T0, T0, parts).select("order_id", "status")) == [("b", PENDING)]
    whole = outcomes.drop("part").where("ok and order_id = 'a'")
    assert rows(O.settle(whole, claims, "f", T0, T0, parts).select("order_id", "status")) == [("a", DISPATCHED)]
    log = claims.unionByName(settled)
    undo = O.rollback_run(log, "f", T0, T0 + timedelta(minutes=2))
    assert rows(undo.select("order_id", "status")) == [("c", PENDING)]
    assert O.rollback_run(log, "g", T0, T0).count() == 0
    assert rows(O.orphans(log, F.lit(T0 + timedelta(hours=1))).select("order_id")) == [("c",)]
    assert O.orphans(log, F.lit(T0)).count() == 0


def test_cycle_publishes_once_and_retries(spark, tmp_path):
    store = cycle.Store(f"{tmp_path}/s")
    orders, items = order_rows(spark, "a", "b", "c"), item_rows(spark, a=1, b=2, c=1)
    seen = []

    def publisher(messages):
        ids = [r.order_id for r in messages.select("order_id").collect()]
        if len(seen) == 1:
            seen.append([])
            raise RuntimeError("broker down")
        seen.append(ids)
        return messages.select("order_id", (F.col("order_id") != "b").alias("ok"), F.lit("x").alias("reason"))

    def run(n, publish=publisher):
        return cycle.run_cycle(orders, items, store, "f", f"r{n}", T0 + timedelta(hours=n), ["OK"], 2, publish)

    assert run(1)
    assert seen == [["a", "b"]] or seen == [["b", "a"]]
    assert statuses(spark, store) == {"a": DISPATCHED, "b": PENDING}
    with pytest.raises(RuntimeError):
        run(2)  # the publisher was entered: nobody knows what went out
    assert statuses(spark, store) == {"a": DISPATCHED, "b": PROCESSING, "c": PROCESSING}
    assert not run(3, None)
    assert run(2, None)
    assert statuses(spark, store) == {"a": DISPATCHED, "b": DISPATCHED, "c": DISPATCHED}
    assert not run(4)
    sent = spark.read.parquet(store.messages).select("order_id").collect()
    assert sorted(r.order_id for r in sent) == ["b", "c"]


def test_replay_goes_on_with_its_claims(spark, tmp_path):
    store = cycle.Store(f"{tmp_path}/s")
    orders, items = order_rows(spark, "a", "b"), item_rows(spark, a=1, b=1)
    claims = O.claim(orders, cycle.read_log(spark, store), "f", T0, T0, ["OK"], 1)
    cycle.append_log(claims, store, "f", "r1", cycle.CLAIMS)
    args = (orders, items, store, "f", "r1", T0, ["OK"], 1)
    cycle._mark(spark, store.sending, "f-r1")
    assert not cycle.run_cycle(*args, replay_safe=False)
    assert statuses(spark, store) == {"a": PROCESSING}
    assert cycle.run_cycle(*args)
    assert statuses(spark, store) == {"a": DISPATCHED}


def test_settling_that_fails_does_not_publish_again(spark, tmp_path):
    store = cycle.Store(f"{tmp_path}/s")
    orders, items = order_rows(spark, "a", "b"), item_rows(spark, a=1, b=1)
    sent, ticks = [], iter([T0])

    def publisher(messages):
        sent.extend(r.correlation_id for r in messages.collect())
        return messages.select("order_id", "part", F.lit(True).alias("ok"), F.lit(None).cast("string").alias("reason"))

    def clock():
        return next(ticks)  # one time for the claim, none for settling

    with pytest.raises(StopIteration):
        cycle.run_cycle(orders, items, store, "f", "r1", T0, ["OK"], None, publisher, False, clock)
    assert len(sent) == 2 and set(statuses(spark, store).values()) == {PROCESSING}
    later = T0 + timedelta(hours=1)
    assert not cycle.run_cycle(orders, items, store, "f", "r2", later, ["OK"], None, publisher, False, lambda: later)
    assert len(sent) == 2 and set(statuses(spark, store).values()) == {DISPATCHED}


def test_failure_before_publishing_is_rolled_back_and_keeps_the_id(spark, tmp_path, monkeypatch):
    store = cycle.Store(f"{tmp_path}/s")
    orders, items = order_rows(spark, "a"), item_rows(spark, a=1)
    ids = []

    def publisher(messages):
        ids.extend(r.correlation_id for r in messages.collect())
        return messages.select("order_id", "part", F.lit(len(ids) > 1).alias("ok"), F.lit("x").alias("reason"))

    def run(n):
        at = T0 + timedelta(hours=n)
        return cycle.run_cycle(orders, items, store, "f", f"r{n}", at, ["OK"], None, publisher, clock=lambda: at)

    with monkeypatch.context() as patched:
        patched.setattr(cycle.O, "stage", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(1)
    assert statuses(spark, store) == {"a": PENDING} and not ids
    assert run(2) and statuses(spark, store) == {"a": PENDING}  # rejected
    assert run(3) and statuses(spark, store) == {"a": DISPATCHED}
    assert len(ids) == 2 and len(set(ids)) == 1
    assert not run(4)


def test_changed_orders_late_items_and_what_a_batch_reads(spark, tmp_path, monkeypatch):
    store, items_at, read = cycle.Store(f"{tmp_path}/s"), f"{tmp_path}/items", []
    source = f"{tmp_path}/in"
    item_rows(spark, a=2).write.parquet(items_at)

    def run():
        arrivals = spark.readStream.schema(order_rows(spark, "a").schema).parquet(source)
        cycle.order_stream(arrivals, lambda: spark.read.parquet(items_at), store, "f", ["OK"], None,
                           f"{tmp_path}/cp").awaitTermination()

    def arrive(*ids, status="OK"):
        order_rows(spark, *ids, status=status).coalesce(1).write.mode("append").parquet(source)

    def messages():
        return {r.order_id: len(json.loads(r.message)["data"]["items"])
                for r in spark.read.parquet(store.messages).collect()}

    arrive("a", "b", status="DRAFT")
    run()
    assert statuses(spark, store) == {}
    arrive("a", "b")
    run()
    assert messages() == {"a": 2}  # b has no items yet
    item_rows(spark, b=3).write.mode("append").parquet(items_at)
    arrive("a")  # published before
    run()
    assert messages() == {"a": 2, "b": 3}
    assert set(statuses(spark, store).values()) == {DISPATCHED}

    plain = cycle.read_or_empty

    def counted(spark, path, schema):
        df = plain(spark, path, schema)
        read.append(df.count() if "dispatched" not in path else 0)
        return df

    monkeypatch.setattr(cycle, "read_or_empty", counted)
    sizes = []
    for n in range(3):
        item_rows(spark, **{f"n{n}": 1}).write.mode("append").parquet(items_at)
        arrive(f"n{n}")
        read.clear()
        run()
        sizes.append(sum(read))
    assert max(sizes) <= sizes[0]


def test_an_order_whose_date_moves_is_sent_once(spark, tmp_path):
    store, items = cycle.Store(f"{tmp_path}/s"), item_rows(spark, a=1, b=1, c=1)
    for n, days in enumerate((0, 40, None, 400)):
        dated = order_rows(spark, "a", "b").withColumn(
            "created_at", F.lit(None).cast("timestamp") if days is None else F.col("created_at") + F.make_dt_interval(days=F.lit(days)))
        sent = cycle.run_cycle(dated, items, store, "f", f"r{n}", T0 + timedelta(hours=n), ["OK"], None)
        assert sent == (n == 0)
    assert spark.read.parquet(store.messages).count() == 2
    # a session whose catalog has not met the store finds the ids too
    spark.sql(f"DROP TABLE {cycle.dispatched_ids(spark, store)}")
    assert [r.order_id for r in cycle.without_dispatched(order_rows(spark, "a", "c"), store).collect()] == ["c"]


def test_dispatched_ids_are_not_shuffled(spark, tmp_path):
    store, ids = cycle.Store(f"{tmp_path}/s"), [f"o{n}" for n in range(300)]
    for part in (ids[:200], ids[100:]):
        spark.createDataFrame([(i,) for i in part], "order_id string").repartition(
            cycle.BUCKETS, "order_id").write.insertInto(cycle.dispatched_ids(spark, store))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = cycle.without_dispatched(order_rows(spark, *ids, "new"), store)
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert [r.order_id for r in left.collect()] == ["new"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the orders' own, to as many partitions as there are buckets
    assert plan.count("Exchange") == 1 and "SelectedBucketsCount: 16 out of 16" in plan and ", 16)" in plan


def test_dispatched_ids_are_compacted(spark, tmp_path, monkeypatch):
    store = cycle.Store(f"{tmp_path}/s")

    def add(*ids):
        spark.createDataFrame([(i,) for i in ids], "order_id string").repartition(
            cycle.BUCKETS, "order_id").write.insertInto(cycle.dispatched_ids(spark, store))

    def known():
        return sorted(r.order_id for r in spark.table(cycle.dispatched_ids(spark, store)).collect())

    ids = [f"o{n:03}" for n in range(200)]
    for _ in range(3):
        add(*ids)
    assert len(known()) == 600 and not cycle.compact_dispatched(spark, store)
    # a generation that broke off does not hold, and is written anew
    spark.createDataFrame([("zz",)], "order_id string").write.parquet(f"{store.dispatched}/g=1")
    (tmp_path / "s/dispatched/g=1/_SUCCESS").unlink()
    assert len(known()) == 600
    assert cycle.compact_dispatched(spark, store, 2) and known() == ids
    assert len(spark.table(cycle.dispatched_ids(spark, store)).inputFiles()) == cycle.BUCKETS
    assert not cycle.compact_dispatched(spark, store, 2)
    add("p1")
    assert cycle.compact_dispatched(spark, store, 1) and known() == [*ids, "p1"]
    assert sorted(p.name for p in (tmp_path / "s/dispatched").iterdir()) == ["g=1", "g=2"]
    # as part of the cycle
    monkeypatch.setattr(cycle, "FILES", 1)
    items = item_rows(spark, a=1, b=1, c=1)
    for n, new in enumerate("abc"):
        orders = order_rows(spark, *"abc"[:n + 1])
        assert cycle.run_cycle(orders, items, store, "f", f"r{n}", T0 + timedelta(hours=n), ["OK"], None)
    assert spark.read.parquet(store.messages).count() == 3 and known() == ["a", "b", "c", *ids, "p1"]


def test_flows_share_staging_without_interference(spark, tmp_path):
    store = cycle.Store(f"{tmp_path}/s")
    orders = order_rows(spark, "a", "b")
    claims = O.claim(orders, log_rows(spark).limit(0), "f", T0, T0, ["OK"], None)
    staged = O.stage(claims, orders, item_rows(spark, a=1))
    for flow in ("f", "g"):
        cycle.write_staging(staged, store, flow, "r1")
        cycle.write_staging(staged, store, flow, "r1")
    assert cycle.read_staging(spark, store, "f", "r1").count() == 2
    cycle.cleanup(spark, store, "f", "r1")
    assert cycle.read_staging(spark, store, "g", "r1").count() == 2
    assert spark.read.parquet(store.staging).count() == 2


@pytest.mark.parametrize("dedupe", [None, "1 hour"])
def test_stream_publishes_each_order_once(spark, tmp_path, dedupe):
    source, store = f"{tmp_path}/in", cycle.Store(f"{tmp_path}/s")
    items = item_rows(spark, a=1, b=1, c=1)

    def run():
        arrivals = spark.readStream.schema(order_rows(spark, "a").schema).option(
            "maxFilesPerTrigger", 1).parquet(source)
        query = cycle.order_stream(arrivals, items, store, "f", ["OK"], 2, f"{tmp_path}/cp", dedupe_within=dedupe)
        query.awaitTermination()

    order_rows(spark, "a", "b").coalesce(1).write.mode("append").parquet(source)
    order_rows(spark, "a", "b").coalesce(1).write.mode("append").parquet(source)  # delivered twice
    run()
    order_rows(spark, "b", "c").coalesce(1).write.mode("append").parquet(source)
    run()  # restarted from the checkpoint
    sent = spark.read.parquet(store.messages).groupBy("order_id").count().collect()
    assert {r.order_id: r["count"] for r in sent} == {"a": 1, "b": 1, "c": 1}
    assert set(statuses(spark, store).values()) == {DISPATCHED}


def test_run_ledger(spark, tmp_path):
    path, now = f"{tmp_path}/ledger", datetime(2024, 1, 10)
    record_run(spark, path, "up", SUCCEEDED, datetime(2024, 1, 2))
    record_run(spark, path, "up", FAILED, datetime(2024, 1, 7))
    record_run(spark, path, "old", SUCCEEDED, datetime(2024, 1, 2))
    ledger = spark.read.parquet(path)
    assert upstream_asof(ledger, F.lit(now), "up").first()[0] == datetime(2024, 1, 7)
    assert upstream_asof(ledger, F.lit(now), "old").first()[0] == datetime(2024, 1, 9)
    empty = spark.createDataFrame([], LEDGER_SCHEMA)
    assert upstream_asof(empty, F.lit(now), "up").first()[0] == datetime(2024, 1, 9)
    with pytest.raises(ValueError):
        record_run(spark, path, "up", "MAYBE", now)


def test_publish_is_idempotent(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "v int, p string")
    for _ in range(2):
        publish_table(df, path, ["p"])
        assert rows(spark.read.parquet(path)) == rows(df)
    publish_table(spark.createDataFrame([(9, "b")], "v int, p string"), path, ["p"], only_new=True)
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "a"), (9, "b")]
    publish_table(df, path)
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(ValueError):
        publish_table(df, path, only_new=True)


def test_a_failed_version_leaves_the_former_one(spark, rows, tmp_path):
    path = f"{tmp_path}/v"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    assert rows(publish_version(df, path, ["p"])) == rows(df)
    broken = df.withColumn("v", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        publish_version(broken, path, ["p"])
    other = spark.newSession()
    assert rows(read_current(other, path)) == rows(df)
    for n in range(3):
        publish_version(df.withColumn("v", F.lit(n)), path)
    drop_versions(spark, path, keep=1)
    assert [r.v for r in read_current(other, path).collect()] == [2, 2]
    assert spark.read.parquet(f"{path}/version=1").count() == 0
    with pytest.raises(ValueError):
        read_current(spark, f"{tmp_path}/none")


def test_run_tables_are_dropped_whatever_happens(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS res")
    df = spark.createDataFrame([(1, "a")], "v int, p string")
    save_run_table(df, "res", "run10", "x")
    with pytest.raises(RuntimeError):
        with run_tables(spark, "res", "run1"):
            save_run_table(df, "res", "run1", "x", ["p"])
            assert save_run_table(df, "res", "run1", "x", ["p"]).count() == 1
            raise RuntimeError("job failed")
    assert spark.sql("SHOW TABLES IN res").where("NOT isTemporary").count() == 1
    assert drop_run_tables(spark, "res", "run10") == ["run10_x"]


DECLARED = f"{ORDERS}, n_items int"


def declared_rows(spark, **counts):
    return spark.createDataFrame([(i, T0, "OK", n) for i, n in counts.items()], DECLARED)


class TwoStreams:
    """Orders and items arriving in two folders, with a stream over both."""

    def __init__(self, spark, path, **options):
        self.spark, self.path, self.options = spark, path, options
        self.store = cycle.Store(f"{path}/s")

    def arrive(self, orders=None, items=None, **options):
        none = {"orders": declared_rows(self.spark, x=1).limit(0), "items": item_rows(self.spark, x=1).limit(0)}
        for name, rows in (("orders", orders), ("items", items)):
            rows = none[name] if rows is None else rows
            rows.coalesce(1).write.mode("append").parquet(f"{self.path}/{name}")
        streams = [self.spark.readStream.schema(none[n].schema).parquet(f"{self.path}/{n}") for n in none]
        cycle.order_stream(*streams, self.store, "f", ["OK"], None, f"{self.path}/cp",
                           **{**self.options, **options}).awaitTermination()

    def sent(self):
        rows = read_messages(self.spark, self.store)
        assert len({r.order_id for r in rows}) == len(rows)
        return {r.order_id: [i["sku"] for i in json.loads(r.message)["data"]["items"]] for r in rows}


def read_messages(spark, store):
    return cycle.read_or_empty(
        spark, store.messages, cycle.columns("order_id string, message string")).collect()


def test_orders_and_items_as_two_streams(spark, tmp_path):
    both, line = TwoStreams(spark, str(tmp_path), item_key=["line_no"]), F.col("line_no")
    items = item_rows(spark, a=2, b=2, c=1, d=2)
    both.arrive(declared_rows(spark, a=2, c=1), items.where("order_id = 'b' or order_id = 'c'"))
    assert both.sent() == {"c": ["s0"]}
    both.arrive(declared_rows(spark, b=2, d=2), items.where((F.col("order_id") != "b") & (line == 0)))
    assert both.sent() == {"c": ["s0"], "b": ["s0", "s1"]}
    # an item comes again, changed; one of a dispatched order comes again
    again = items.where((F.col("order_id") != "d") & (line == 0)).withColumn("sku", F.lit("new"))
    both.arrive(items=items.where("order_id = 'a' and line_no = 1").unionByName(again))
    assert both.sent() == {"c": ["s0"], "b": ["s0", "s1"], "a": ["new", "s1"]}
    both.arrive(declared_rows(spark, d=1))  # a later arrival of the order declares fewer
    assert both.sent()["d"] == ["s0"] and set(statuses(spark, both.store).values()) == {DISPATCHED}


def test_a_batch_without_rows_leaves_what_waits_as_it_is(spark, tmp_path):
    """The batch that only moves the watermark on claims what was left over, and writes neither inbox nor items anew."""
    both = TwoStreams(spark, str(tmp_path))
    parts = {"orders": declared_rows(spark, a=1, b=1, c=2), "items": item_rows(spark, a=1, b=1, c=1)}
    for name, part in parts.items():
        part.coalesce(1).write.parquet(f"{both.path}/{name}")
    cycle.order_stream(*[spark.readStream.schema(p.schema).parquet(f"{both.path}/{n}") for n, p in parts.items()],
                       both.store, "f", ["OK"], 1, f"{both.path}/cp").awaitTermination()
    assert both.sent() == {"a": ["s0"], "b": ["s0"]}
    for path in (both.store.inbox, both.store.waiting_items):
        assert [r[0] for r in spark.read.parquet(path).select("_version").distinct().collect()] == ["b000000000000"]
    both.arrive(items=item_rows(spark, c=2).where("line_no = 1"))
    assert both.sent() == {"a": ["s0"], "b": ["s0"], "c": ["s0", "s1"]}


def test_two_streams_after_the_wait(spark, tmp_path):
    """What waited in vain leaves the state and goes on waiting in the store."""
    both = TwoStreams(spark, str(tmp_path), wait="1 second", clock_step="0 seconds")
    items = item_rows(spark, a=1, b=1)
    both.arrive(declared_rows(spark, a=1), items.where("order_id = 'b'"))
    for _ in range(2):  # both clocks move past the wait
        time.sleep(2)
        both.arrive(declared_rows(spark, y=1), item_rows(spark, z=1))
    left = cycle.unmatched_items(spark, both.store, items.schema, declared_rows(spark, a=1).schema)
    assert "b" in {r.order_id for r in left.collect()} and both.sent() == {}
    both.arrive(declared_rows(spark, b=1), items.where("order_id = 'a'"))
    for _ in range(2):
        time.sleep(2)
        both.arrive(declared_rows(spark, y=1), item_rows(spark, z=1))
    assert both.sent() == {"a": ["s0"], "b": ["s0"]}


def test_two_streams_broken_batch_is_run_again(spark, tmp_path):
    both = TwoStreams(spark, str(tmp_path))

    def broken(messages):
        raise RuntimeError("broker")

    with pytest.raises(StreamingQueryException):
        both.arrive(declared_rows(spark, a=1, b=2), item_rows(spark, a=1, b=1), publisher=broken)
    assert both.sent() == {} and statuses(spark, both.store) == {"a": PROCESSING}
    both.arrive(items=item_rows(spark, b=1))  # comes again, which does not make it two
    assert both.sent() == {"a": ["s0"]}
    both.arrive(items=item_rows(spark, b=1).withColumn("sku", F.lit("other")))  # another item of the same line
    assert both.sent() == {"a": ["s0"], "b": ["other", "s0"]}


def test_two_streams_null_and_undeclared(spark, tmp_path):
    """Rows without an order id wait; an order that declares nothing goes out with the items that are there."""
    both = TwoStreams(spark, str(tmp_path), wait="1 second", clock_step="0 seconds")
    nobody = spark.createDataFrame([(None, 0, "s", 1, D(1))], ITEMS)
    orders = spark.createDataFrame([(None, None, "OK", 1), ("a", None, "OK", None)], DECLARED)
    both.arrive(orders, nobody.unionByName(item_rows(spark, a=1)))
    for _ in range(2):
        time.sleep(2)
        both.arrive(declared_rows(spark, y=1), item_rows(spark, z=1))
    assert both.sent() == {"a": ["s0"]}
    left = cycle.unmatched_items(spark, both.store, nobody.schema, orders.schema)
    assert None in {r.order_id for r in left.collect()}


def test_only_items_of_longer_orders_are_numbered(spark, monkeypatch):
    orders = order_rows(spark, "a", "b", "c")
    claims, numbered, rank = O.claim(orders, log_rows(spark).limit(0), "f", T0, T0, ["OK"], None), [], O.rank_within

    def ranked(df, *args):
        numbered.append({r.order_id for r in df.collect()})
        return rank(df, *args)

    monkeypatch.setattr(O, "rank_within", ranked)
    whole = O.stage(claims, orders, item_rows(spark, a=3, b=2, x=9), max_items=3)
    assert {(r.order_id, r.part, r.parts, len(r["items"])) for r in whole.collect()} == {
        ("a", 0, 1, 3), ("b", 0, 1, 2), ("c", 0, 1, 0)}
    assert numbered == [] and "Window" not in whole._jdf.queryExecution().executedPlan().toString()
    split = O.stage(claims, orders, item_rows(spark, a=3, b=2, x=9), max_items=2)
    assert {(r.order_id, r.part, r.parts, len(r["items"])) for r in split.collect()} == {
        ("a", 0, 2, 2), ("a", 1, 2, 1), ("b", 0, 1, 2), ("c", 0, 1, 0)}
    assert numbered == [{"a"}]


def test_a_repeat_sends_what_was_staged(spark, tmp_path, monkeypatch):
    store, orders, seen, calls = cycle.Store(f"{tmp_path}/s"), order_rows(spark, "a"), [], []
    stage = O.stage
    monkeypatch.setattr(cycle.O, "stage", lambda *a: calls.append(a) or stage(*a))

    def broken(messages):
        seen.append({(r.correlation_id, r.message) for r in messages.collect()})
        if len(seen) == 1:
            raise RuntimeError("broker")
        return messages.select("order_id", "part", F.lit(True).alias("ok"), F.lit(None).cast("string").alias("reason"))

    def run(n):
        return cycle.run_cycle(orders, item_rows(spark, a=n), store, "f", "r", T0, ["OK"], None, broken, clock=lambda: T0)

    with pytest.raises(RuntimeError):
        run(1)
    assert run(2) and seen[0] == seen[1] and len(calls) == 1  # the same id carries the same message
    assert statuses(spark, store) == {"a": DISPATCHED}
