"""One query per operator over the driver's test tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.catalogue import standins as S
from ledgerspark.catalogue.standins import Tables
from ledgerspark.constants import SUCCEEDED
from ledgerspark.functions import calendar
from ledgerspark.operators.matching import join_null_safe, rolling_months_join
from ledgerspark.operators.pick import latest_link
from ledgerspark.operators.rank import HOT_GROUP_ROWS, rank_within
from ledgerspark.params import Params
from ledgerspark.plans import absence, cascade, dims, facts
from ledgerspark.plans import premium as premium_plan
from ledgerspark.plans.allocate import allocate
from ledgerspark.plans.technical_result import run_technical_result
from ledgerspark.sources.publish import publish_table, publish_version, read_asof, read_current
from ledgerspark.sources.run_ledger import record_runs, upstream_asof
from ledgerspark.sources.scratch import scratch_path, scratch_scope
from ledgerspark.sources.snapshots import shifted, snapshot_asof
from ledgerspark.sources.tables import not_deleted, typed_mapping, typed_with_rejects
from ledgerspark.sources.validity import publish_validity, read_validity
from ledgerspark.streaming import cycle, orders

# The test data covers these months.
START, END = date(1995, 1, 1), date(2001, 12, 1)
ERP_CUT = date(1998, 6, 1)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
    return build


def local_time(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


RUN_TS = "2024-02-01 00:00:00"
NOW = "2024-02-03 00:00:00"


@query
def cascade_totals(t: Tables) -> DataFrame:
    totals = cascade.cascade_totals(
        S.premium(t), S.existing_policies(t), S.ranked_products(t), START, END
    )
    amounts = [F.col(c).cast("decimal(38,2)").alias(c) for c in ("mnt_moneda", "mnt_usd")]
    return totals.select(*[c for c in totals.columns if not c.startswith("mnt_")], *amounts)


@query
def cascade_refresh(t: Tables) -> DataFrame:
    """A published cascade after movements of two months came late: only their windows are rebuilt."""
    path, rows = scratch_path(t.spark, "refresh"), S.premium(t)
    late = F.col("periodo").isin(date(1997, 3, 1), date(1999, 11, 1)) & (F.col("id_certificado") > "2")
    publish_table(rows.where(~late), f"{path}/premium", ["periodo"])
    policies, product = S.existing_policies(t), S.ranked_products(t)

    def premium() -> DataFrame:
        return t.spark.read.schema(rows.schema).parquet(f"{path}/premium")

    with scratch_scope(t.spark):
        first = cascade.cascade_totals(premium(), policies, product, START, END, lay_out_by=["periodo"])
        publish_table(first, f"{path}/cascade", ["periodo_trim"], laid_out=True)
    rows.where(late).write.mode("append").partitionBy("periodo").parquet(f"{path}/premium")
    changed = rows.where(late).select("periodo")
    cascade.refresh_cascade(f"{path}/cascade", premium(), policies, product, changed, START, END)
    totals = t.spark.read.schema(first.schema).parquet(f"{path}/cascade")
    amounts = [F.col(c).cast("decimal(38,2)").alias(c) for c in cascade.MEASURES]
    return totals.select(*[c for c in totals.columns if c not in cascade.MEASURES], *amounts)


@query
def cascade_base(t: Tables) -> DataFrame:
    totals = cascade.cascade_totals(
        S.premium(t), S.existing_policies(t), S.ranked_products(t), START, END
    )
    return cascade.cascade_base(totals).select(
        "periodo_trim", *cascade.ROW_KEYS, "nivel_base", "total_base"
    )


def _written_base(t: Tables) -> DataFrame:
    return cascade.written_base(S.premium(t), S.existing_policies(t), START, END)[0]


@query
def cascade_allocate(t: Tables) -> DataFrame:
    """Each amount for itself over the premium rows of its finest group with premium."""
    return allocate(S.amounts(t), _written_base(t), S.ranked_products(t), START, END, each=("id_monto",))


@query
def cascade_allocate_amount(t: Tables) -> DataFrame:
    """Where the largest amount goes among those whose own month, line, product and currency have no premium."""
    base, amounts = _written_base(t), S.amounts(t)
    without = join_null_safe(amounts, base.select(*cascade.GROUP_KEYS).distinct(), cascade.GROUP_KEYS, how="left_anti")
    largest = without.orderBy(F.col("monto").desc(), "id_monto").limit(1)
    return allocate(largest, base, S.ranked_products(t), START, END, each=("id_monto",))


@query
def technical_result(t: Tables) -> DataFrame:
    """Dimensions, direct premium and cascade in one run."""
    products = S.products(t)
    result = cascade.cascade_totals(
        _direct_premium(t), S.order_policies(t), dims.principal_products(products, S.lines(t)), START, END
    )
    return result.select(
        "periodo_trim", *cascade.GROUPINGS, *cascade.ROW_KEYS, *cascade.LEVEL_NAMES
    )


@query
def run_published(t: Tables) -> DataFrame:
    """The published cascade and premium rows of a whole run, after a second run that failed; no run table is left."""
    spark, target = t.spark, scratch_path(t.spark, "run")
    work = "work_" + target[-12:]
    spark.sql(f"CREATE DATABASE {work} LOCATION '{scratch_path(spark, 'work')}'")
    sources = {
        "producto": S.products(t), "ramo": S.lines(t), "poliza": S.certificates(t),
        "bitacora_mc_poliza": S.journal(t), "equivalencia_canal": S.channels(t), "tasa_cambio": S.rates(t),
        "produccion": S.production(t),
    }
    params = Params(START, END, date(1997, 1, 1), ERP_CUT)
    run_technical_result(sources, params, target, work=work)
    broken = sources | {"tasa_cambio": sources["tasa_cambio"].withColumn(
        "val_tasa_cambio", F.raise_error(F.lit("broken")).cast("decimal(18,6)"))}
    with suppress(Exception):
        run_technical_result(broken, params, target, work=work)
    left = spark.sql(f"SHOW TABLES IN {work}").where(~F.col("isTemporary")).count()  # views of the session are listed too
    cascade_rows = read_current(spark, f"{target}/{params.table('distribucion_prima')}")
    premium_rows = read_current(spark, f"{target}/{params.table('prima')}")
    return cascade_rows.groupBy("periodo_trim").agg(
        F.count(F.lit(1)).alias("filas"), F.sum("mnt_usd").cast("decimal(38,2)").alias("mnt_usd"),
    ).unionByName(premium_rows.select(
        F.lit(None).cast("date").alias("periodo_trim"), F.lit(1).alias("_one"), "mnt_usd",
    ).groupBy("periodo_trim").agg(
        F.count("_one").alias("filas"), F.sum("mnt_usd").cast("decimal(38,2)").alias("mnt_usd"),
    )).withColumn("tablas_de_corrida", F.lit(left).cast("long"))


def _direct_premium(t: Tables) -> DataFrame:
    products = S.products(t)
    return premium_plan.direct_premium(
        S.production(t),
        dims.principal_paths(products),
        dims.product_to_ledger(products),
        dims.line_pairs(S.lines(t)),
        S.order_policies(t),
        date(1995, 12, 1),
        END,
        ERP_CUT,
    )


@query
def direct_premium(t: Tables) -> DataFrame:
    rows = _direct_premium(t)
    amounts = {"mnt_moneda": "decimal(38,2)", "mnt_usd": "decimal(38,2)"}
    return rows.withColumns({c: F.col(c).cast(kind) for c, kind in amounts.items()})


def _order_dates(t: Tables) -> DataFrame:
    return t.orders.agg(
        F.min("o_orderdate").cast("date").alias("first"), F.max("o_orderdate").cast("date").alias("last")
    )


@query
def month_spine(t: Tables) -> DataFrame:
    return calendar.month_spine(_order_dates(t), F.col("first"), F.col("last"))


@query
def months_desc(t: Tables) -> DataFrame:
    return calendar.months_desc(_order_dates(t), F.year("first"), F.col("last"))


@query
def rolling_months(t: Tables) -> DataFrame:
    bounds = _order_dates(t)
    spine = calendar.month_spine(bounds, F.trunc("first", "MM"), F.col("last"))
    rows = t.orders.select("o_orderkey", F.trunc("o_orderdate", "MM").alias("mes_orden"))
    return rolling_months_join(rows, spine, "mes_orden").select(
        "o_orderkey", "mes_orden", "fec_inicio", "fec_fin_ant"
    )


@query
def default_periods(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return t.orders.select(day.alias("as_of")).distinct().select(
        "as_of",
        calendar.default_start(F.col("as_of")).alias("periodo_inicio"),
        calendar.default_end(F.col("as_of")).alias("periodo_fin"),
    )


@query
def product_dim(t: Tables) -> DataFrame:
    return dims.product_dim(S.products(t), S.lines(t))


@query
def product_dim_no_line(t: Tables) -> DataFrame:
    return dims.product_dim_no_line(S.products(t))


@query
def ledger_pivot(t: Tables) -> DataFrame:
    return dims.product_to_ledger(S.products(t))


@query
def ledger_reverse(t: Tables) -> DataFrame:
    return dims.ledger_to_product(S.products(t))


@query
def line_map(t: Tables) -> DataFrame:
    return dims.line_technical_to_ledger(S.customer_lines(t))


@query
def line_map_distinct(t: Tables) -> DataFrame:
    return dims.line_ledger_to_technical(S.customer_lines(t))


@query
def current_policies(t: Tables) -> DataFrame:
    product = dims.principal_products(S.products(t), S.lines(t))
    return dims.current_policies(S.certificates(t), product, S.journal(t), S.channels(t), None)


@query
def current_policies_period(t: Tables) -> DataFrame:
    product = dims.principal_products(S.products(t), S.lines(t))
    return dims.current_policies(S.certificates(t), product, S.journal(t), S.channels(t), date(1997, 1, 1))


@query
def fx_rates(t: Tables) -> DataFrame:
    return dims.fx_rates(S.rates(t))


@query
def snapshot(t: Tables) -> DataFrame:
    versions = t.events.select(
        "user_id", "event_id", "event_type", "value", "ts",
        (F.col("event_type") == "error").alias("deleted"),
    )
    return snapshot_asof(
        versions, ["user_id"], "ts", local_time("2024-01-20 05:00:00"), ("event_id",), "deleted"
    )


@query
def upstream_read_time(t: Tables) -> DataFrame:
    return upstream_asof(S.run_outcomes(t), local_time(NOW))


@query
def managed_result(t: Tables) -> DataFrame:
    versions = t.orders.select(
        F.trunc("o_orderdate", "MM").alias("periodo"),
        S.text("o_custkey").alias("id_producto"),
        F.col("o_orderstatus").alias("moneda"),
        S.money("o_totalprice").alias("mnt_ingresado_neto_moneda"),
        F.col("o_orderdate").alias("version_ts"),
        F.col("o_orderkey").alias("version_no"),
    )
    read_time = shifted(local_time("2001-06-30 00:00:00"))
    rows = snapshot_asof(versions, ["id_producto", "periodo"], "version_ts", read_time, ("version_no",))
    return facts.managed_result(
        rows, read_time, START, END, ["periodo", "id_producto", "moneda", "mnt_ingresado_neto_moneda"])


@query
def snapshot_versions(t: Tables) -> DataFrame:
    """The managed result published three times, and read as it stood before the last one; equal rows stay."""
    path, rows = scratch_path(t.spark, "managed"), S.managed_rows(t)
    day = datetime(2024, 1, 10, tzinfo=timezone.utc)
    for later, wanted in enumerate((F.col("estado") == "O", F.col("estado") != "P", F.lit(True))):
        publish_version(rows.where(wanted), path, ["periodo"], at=day + timedelta(days=later))
    read_time = shifted(F.lit(day + timedelta(days=1, hours=1)))
    result = facts.managed_result(read_asof(t.spark, path, read_time), read_time, START, END)
    return result.withColumn("time_travel_rtg", F.col("time_travel_rtg").cast("timestamp_ntz"))


FINANCIAL = [
    "id_dato_financiero", "periodo", "des_riesgo_negocio", "tip_concepto_financiero",
    "tip_distribucion", "id_producto", "id_poliza", "mnt_usd",
]


@query
def financial_filter(t: Tables) -> DataFrame:
    rows = S.financial_versions(t).where(facts.financial_rows(date(1997, 1, 1), date(1999, 12, 1)))
    return rows.select(*FINANCIAL)


@query
def financial_facts(t: Tables) -> DataFrame:
    """As of the last order of status F, read from a run ledger; the row versions are laid out by validity."""
    ledger = t.orders.select(
        F.col("o_orderstatus").alias("recurso"), F.col("o_orderdate").alias("fecha_estado_fin_dag")
    )
    read_time = upstream_asof(ledger, local_time("2001-08-03 00:00:00"), "F").select(shifted(F.col("as_of"))).scalar()
    path = scratch_path(t.spark, "financial")
    publish_validity(
        S.financial_versions(t), ["id_dato_financiero", "periodo"], "version_ts", path, facts.financial_layout(),
        ("loaded_ts", "load_no", "id_producto"),
    )
    rows = read_validity(t.spark, path, read_time)
    return facts.financial_facts_laid_out(rows, date(1997, 1, 1), date(1999, 12, 1))


@query
def typed_columns(t: Tables) -> DataFrame:
    return typed_mapping(t.orders, [
        ("o_orderkey", "long", "order_id", "string"),
        ("o_custkey", "long", "emp_id", "int"),
        ("o_totalprice", "double", "monto", "decimal(18,2)"),
        ("o_orderdate", "timestamp", "fecha", "date"),
        ("o_orderpriority", "string", "prioridad_num", "int"),
    ], bad_values_to_null=True)


@query
def typed_columns_rejects(t: Tables) -> DataFrame:
    """How many values of each column the casts made NULL, counted while the typed table was published."""
    typed, seen = typed_with_rejects(t.orders, [
        ("o_orderkey", "long", "order_id", "tinyint"),
        ("o_custkey", "long", "emp_id", "int"),
        ("o_orderpriority", "string", "prioridad_num", "int"),
        ("o_orderstatus", "string", "estado", "date"),
    ])
    publish_version(typed, scratch_path(t.spark, "typed"))
    return t.spark.createDataFrame(sorted(seen.get.items()), "columna string, rechazados long")


@query
def soft_delete_filter(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    flagged = t.events.select(
        "event_id", "user_id", "event_type", "value",
        F.when(kind == "error", 1).when(kind != "signup", 0).alias("anulado"),
    )
    return not_deleted(flagged).where((F.col("value") != 0) & F.col("user_id").isNotNull())


@query
def latest_order(t: Tables) -> DataFrame:
    columns = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    dated = columns.withColumn(
        "o_orderdate", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    )
    return latest_link(dated, "o_custkey", "o_orderdate", "o_orderkey")


@query
def employee_master(t: Tables) -> DataFrame:
    return absence.employee_master(S.employees(t))


@query
def open_absences(t: Tables) -> DataFrame:
    return absence.open_absences(S.employees(t)["ausentismo"], date(1998, 9, 15))


@query
def absence_calendar(t: Tables) -> DataFrame:
    tables = S.employees(t)
    counts = absence.open_absences(tables["ausentismo"], date(1998, 9, 15))
    return absence.absence_calendar(absence.employee_master(tables), counts)


@query
def run_absence(t: Tables) -> DataFrame:
    """The whole absence job, run twice into the same place."""
    target = scratch_path(t.spark, "absence")
    absence.run_absence(S.employees(t), date(1997, 3, 1), target)
    absence.run_absence(S.employees(t), date(1998, 9, 15), target)
    return read_current(t.spark, f"{target}/cronograma")


@query
def run_params(t: Tables) -> DataFrame:
    """Arguments of a run on the day of the last order."""
    last = t.orders.agg(F.max("o_orderdate").cast("date")).first()[0]
    params = Params.for_day(last, prefix="run")
    return t.spark.createDataFrame(
        [(params.start, params.end, params.current, params.erp_cut, params.table("prima"))],
        "inicio date, fin date, actual date, corte date, tabla string")


@query
def semi_policies(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    kept = t.orders.where(F.col("o_orderstatus") != "P").select("o_orderkey")
    return rows.join(kept, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")


def _ranked_lines(t: Tables, hot_rows: int) -> DataFrame:
    columns = ["l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
               "l_quantity", "l_extendedprice"]
    ranked = rank_within(t.lineitem.select(columns), ["l_returnflag"], columns[1:3], "ord", hot_rows)
    return ranked.select("l_returnflag", "l_shipdate", "l_orderkey", "ord").distinct()


@query
def distinct_after_rank(t: Tables) -> DataFrame:
    return _ranked_lines(t, HOT_GROUP_ROWS)


@query
def rank_hot(t: Tables) -> DataFrame:
    """The same with groups above a hundred rows ranked over many tasks."""
    return _ranked_lines(t, 100)


@query
def sync_current_status(t: Tables) -> DataFrame:
    return orders.current_status(S.sync_log(t)).select("order_id", "status", "flow_type", "ts")


@query
def sync_status_of_orders(t: Tables) -> DataFrame:
    return orders.with_status(S.sync_orders(t), S.sync_log(t))


def _claims(t: Tables, batch_size: int | None) -> DataFrame:
    return orders.claim(
        S.sync_orders(t), S.sync_log(t), "orders", local_time(RUN_TS), local_time(NOW),
        ["F", "O"], batch_size,
    )


@query
def sync_claim(t: Tables) -> DataFrame:
    return _claims(t, 1000)


@query
def sync_claim_all(t: Tables) -> DataFrame:
    return _claims(t, None)


def _staged(t: Tables) -> DataFrame:
    return orders.stage(_claims(t, None), S.sync_orders(t), S.sync_items(t), max_items=5)


@query
def sync_stage(t: Tables) -> DataFrame:
    amount = F.aggregate(
        "items", F.lit(0).cast("decimal(28,2)"),
        lambda total, i: (total + i["amount"]).cast("decimal(28,2)"),
    )
    return _staged(t).select(
        "order_id", "part", "parts", "BusinessStatus",
        F.size("items").alias("n_items"), amount.alias("amount"),
    )


@query
def sync_envelope(t: Tables) -> DataFrame:
    return orders.envelope(_staged(t)).select("order_id", "part", "correlation_id", "message")


@query
def sync_settle(t: Tables) -> DataFrame:
    """Orders of status F are accepted; the others, and all with a large price, rejected."""
    outcomes = t.orders.select(
        S.text("o_orderkey").alias("order_id"),
        ((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 400000)).alias("ok"),
        F.lit(None).cast("string").alias("reason"),
    )
    return orders.settle(
        outcomes, _claims(t, None), "orders", local_time(RUN_TS), local_time(NOW)
    )


@query
def sync_rollback(t: Tables) -> DataFrame:
    return orders.rollback_run(
        S.sync_log(t), "a", local_time("2024-01-30 00:00:00"), local_time(NOW)
    )


@query
def sync_orphans(t: Tables) -> DataFrame:
    older = local_time("2024-01-30 20:00:00")
    return orders.orphans(S.sync_log(t), older).select("order_id", "status", "flow_type", "ts")


@query
def publish_roundtrip(t: Tables) -> DataFrame:
    """The premium table by month, published twice and read back."""
    spark, path = t.spark, scratch_path(t.spark, "premium")
    rows = S.premium(t)
    publish_table(rows, path, ["periodo"])
    publish_table(rows, path, ["periodo"], only_new=True)
    return (
        spark.read.parquet(path)
        .groupBy(F.col("periodo").cast("date").alias("periodo"), "id_moneda")
        .agg(
            F.count(F.lit(1)).alias("filas"),
            F.sum("mnt_usd").cast("decimal(38,2)").alias("mnt_usd"),
        )
    )


@query
def publish_versions(t: Tables) -> DataFrame:
    """The premium table published by version; a write that fails changes nothing."""
    path, rows = scratch_path(t.spark, "versions"), S.premium(t)
    publish_version(rows.limit(0), path, ["periodo"])
    publish_version(rows, path, ["periodo"])
    broken = rows.withColumn("mnt_usd", F.raise_error(F.lit("broken")).cast("decimal(18,2)"))
    with suppress(Exception):
        publish_version(broken, path, ["periodo"])
    return read_current(t.spark, path).groupBy(
        F.col("periodo").cast("date").alias("periodo"), "id_moneda"
    ).agg(F.count(F.lit(1)).alias("filas"), F.sum("mnt_usd").cast("decimal(38,2)").alias("mnt_usd"))


@query
def run_ledger_roundtrip(t: Tables) -> DataFrame:
    """Read times from a ledger of written outcomes: the last one of each resource, then all earlier ones."""
    path = scratch_path(t.spark, "ledger")
    outcomes = S.run_outcomes(t).select(
        "recurso", F.lit(SUCCEEDED).alias("estado"), F.lit("").alias("etiquetas"),
        F.col("fecha_estado_fin_dag").cast("timestamp").alias("fecha_estado_fin_dag"))
    record_runs(outcomes.groupBy("recurso", "estado", "etiquetas").agg(
        F.max("fecha_estado_fin_dag").alias("fecha_estado_fin_dag")), path)
    record_runs(outcomes, path)
    ledger = t.spark.read.parquet(path).withColumn(
        "fecha_estado_fin_dag", F.col("fecha_estado_fin_dag").cast("timestamp_ntz"))
    return upstream_asof(ledger, local_time(NOW))


@query
def stream_sync(t: Tables) -> DataFrame:
    """Orders arriving as a file stream, published once each; the log's final state."""
    spark = t.spark
    store = cycle.Store(scratch_path(spark, "orders"))
    source = (
        spark.readStream.schema(t.orders.schema)
        .option("pathGlobFilter", "orders.parquet")
        .option("maxFilesPerTrigger", 1)
        .parquet(t.folder)
    )
    streamed = Tables(spark, t.folder)
    streamed.__dict__["orders"] = source
    stream = cycle.order_stream(
        S.sync_orders(streamed), S.sync_items(t), store, "orders", ["F", "O"], None,
        f"{store.path}/checkpoint",
    )
    stream.awaitTermination()
    sent = (
        spark.read.parquet(store.messages).groupBy("order_id").agg(F.count(F.lit(1)).alias("messages"))
    )
    status = orders.current_status(cycle.read_log(spark, store)).select("order_id", "status")
    return sent.join(status, "order_id")


def _sent(spark: SparkSession, store: cycle.Store) -> DataFrame:
    """Messages, their different ids and their items by order."""
    n_items = F.get_json_object("message", "$.data.items")
    return spark.read.parquet(store.messages).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("messages"),
        F.countDistinct("correlation_id").alias("ids"),
        F.sum(F.json_array_length(n_items)).cast("long").alias("n_items"),
    )


class Arrivals:
    """Orders that come in a folder, with a stream over them that is run after each arrival."""

    def __init__(self, t: Tables, name: str):
        self.spark, self.path = t.spark, scratch_path(t.spark, name)
        self.store, self.items_at = cycle.Store(f"{self.path}/store"), f"{self.path}/items"
        self.schema, self.items = S.sync_orders(t).schema, S.sync_items(t).schema

    def add_items(self, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.items_at)

    def arrive(self, df: DataFrame) -> None:
        """All files of an arrival are one micro-batch."""
        df.write.mode("append").parquet(f"{self.path}/arrived")
        source = self.spark.readStream.schema(self.schema).parquet(f"{self.path}/arrived")
        cycle.order_stream(
            source, lambda: self.spark.read.schema(self.items).parquet(self.items_at), self.store, "orders",
            ["F", "O"], None, f"{self.path}/checkpoint",
        ).awaitTermination()

    def sent(self) -> DataFrame:
        status = orders.current_status(cycle.read_log(self.spark, self.store)).select("order_id", "status")
        return _sent(self.spark, self.store).join(status, "order_id")


@query
def stream_changes(t: Tables) -> DataFrame:
    """Three arrivals: some orders are ineligible at first, all come again, items come late."""
    rows, items, inbox = S.sync_orders(t), S.sync_items(t), Arrivals(t, "changes")
    late = F.col("order_id").cast("long") % 5 == 0
    draft = F.when(F.col("order_id").cast("long") % 3 == 0, "DRAFT").otherwise(F.col("BusinessStatus"))
    inbox.add_items(items.where(~late))
    inbox.arrive(rows.withColumn("BusinessStatus", draft))
    inbox.arrive(rows)
    inbox.add_items(items.where(late))
    inbox.arrive(rows.where(late))
    return inbox.sent()


@query
def stream_moved_dates(t: Tables) -> DataFrame:
    """All orders come three times, with another month of created_at or none each time; each goes out once."""
    rows, inbox = S.sync_orders(t), Arrivals(t, "moved")
    number = F.col("order_id").cast("long")
    moved = F.col("created_at") + F.make_interval(months=(number % 4).cast("int"))
    inbox.add_items(S.sync_items(t))
    inbox.arrive(rows.withColumn("created_at", F.when(number % 3 != 0, F.col("created_at"))))
    inbox.arrive(rows.withColumn("created_at", moved))
    inbox.arrive(rows.withColumn("created_at", F.when(number % 2 != 0, moved)))
    return inbox.sent()


@query
def stream_items(t: Tables) -> DataFrame:
    """Orders and items as two streams in three arrivals: orders before, between and after their items."""
    spark, path = t.spark, scratch_path(t.spark, "items")
    store, items = cycle.Store(f"{path}/store"), S.sync_items(t)
    counts = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_items"))
    rows = S.sync_orders(t).join(counts, "order_id", "left")
    third = F.col("order_id").cast("long") % 3
    for arrival in range(3):
        rows.where(third == arrival).write.mode("append").parquet(f"{path}/orders")
        items.where(F.col("line_no") % 3 == arrival).write.mode("append").parquet(f"{path}/lines")
        cycle.order_stream(
            spark.readStream.schema(rows.schema).parquet(f"{path}/orders"),
            spark.readStream.schema(items.schema).parquet(f"{path}/lines"),
            store, "orders", ["F", "O"], None, f"{path}/checkpoint",
        ).awaitTermination()
    status = orders.current_status(cycle.read_log(spark, store)).select("order_id", "status")
    return _sent(spark, store).join(status, "order_id")


@query
def sync_retry(t: Tables) -> DataFrame:
    """A publisher that breaks before it sends, then settling that breaks after it sent; each is run again."""
    spark = t.spark
    path = scratch_path(spark, "retry")
    store = cycle.Store(f"{path}/store")
    rows, items = S.sync_orders(t), S.sync_items(t)
    start = datetime(2024, 2, 1, tzinfo=timezone.utc)

    def attempt(publisher, fails_after: int | None) -> None:
        calls = iter(range(99))

        def clock() -> datetime:
            if next(calls) == fails_after:
                raise RuntimeError("clock")
            return start

        with suppress(RuntimeError):
            cycle.run_cycle(
                rows, items, store, "orders", "r1", start, ["F", "O"], None, publisher, clock=clock
            )

    def broken(messages: DataFrame) -> DataFrame:
        raise RuntimeError("broker")

    attempt(broken, None)
    attempt(None, 0)  # sends, then cannot settle
    attempt(None, None)
    status = orders.current_status(cycle.read_log(spark, store)).select("order_id", "status")
    return _sent(spark, store).join(status, "order_id")
