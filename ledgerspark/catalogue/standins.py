"""The jobs' source tables, derived from the driver's test tables.

Each function takes the test tables by name. Repeated columns are built from the
columns of one row, so their arrays have a few elements whatever the data size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark import constants as C
from ledgerspark.plans.facts import FINANCIAL_COLUMNS, MANAGED_RESULT_COLUMNS

AMOUNT = "decimal(18,2)"


class Tables:
    """Test tables of one scale factor, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def text(column: str) -> Column:
    return F.col(column).cast("string")


def money(column: str) -> Column:
    return F.col(column).cast(AMOUNT)


def element(**fields) -> Column:
    return F.struct(*[
        (v if isinstance(v, Column) else F.lit(v)).cast("string").alias(k) for k, v in fields.items()
    ])


def label(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def products(t: Tables) -> DataFrame:
    """Products from ``part``: one to three codes, one or two hierarchies, three ledger codes."""
    key, size = text("p_partkey"), F.col("p_size")
    by_ten, by_five = F.expr("p_size div 10").cast("string"), F.expr("p_size div 5").cast("string")
    other = element(id_origen="BX", cod_producto=F.col("p_brand"))
    own = element(id_origen=C.ORIGIN_AX, cod_producto=label("A", key))
    second = element(id_origen=C.ORIGIN_AX, cod_producto=label("P", key))
    origins = (
        F.when(size == 50, F.array().cast("array<struct<id_origen:string,cod_producto:string>>"))
        .when(size == 49, F.lit(None))
        .when(F.col("p_type") == "PROMO", F.array(own, second, other))
        .otherwise(F.array(own, other))
    )

    def path(risk, n5, line) -> Column:
        return element(
            nom_riesgo=risk, agrupacion_n1=F.col("p_type"), agrupacion_n2=F.col("p_brand"),
            agrupacion_n3=by_ten, agrupacion_n4=by_five, agrupacion_n5=n5, id_ramo_contable=line,
        )

    risk = F.when(F.col("p_brand") == "Brand#1", "SALUD").otherwise(C.RISK_LIFE)
    first = path(risk, F.when(size != 7, size), by_ten)
    paths = F.when(F.col("p_type") == "LARGE", F.array(first, path(risk, "X", by_five))).otherwise(
        F.array(first)
    )
    technical = F.when(F.col("p_type") == "ECONOMY", "NO").otherwise(C.YES)

    def ledger(company, origin, code, accounting, technical) -> Column:
        return element(
            id_companhia=company, id_origen=origin, cod_producto_contable=code,
            ind_contable_principal=accounting, ind_tecnico_principal=technical,
        )

    return t.part.select(
        key.alias("id_producto"),
        F.col("p_name").alias("nom_producto"),
        origins.alias("producto_origen"),
        paths.alias("producto_jerarquia"),
        F.array(
            ledger(C.COMPANY_01, C.ERP_LEGACY, label("L", F.col("p_brand")), C.YES, technical),
            ledger(C.COMPANY_01, C.ERP_NEW, label("N", key), C.YES, C.YES),
            ledger("02", C.ERP_NEW, label("M", F.col("p_brand")), "NO", C.YES),
        ).alias("arr_equivalencia_contable"),
    )


def _equivalence(code, erp, accounting, company, technical_flag, accounting_flag) -> Column:
    return element(
        cod_ramo_contable=code, des_ramo_erp=erp, des_ramo_contable=accounting,
        id_companhia=company, ind_tecnico_principal=technical_flag,
        ind_contable_principal=accounting_flag,
    )


def lines(t: Tables) -> DataFrame:
    """Accounting lines from ``nation``; the lines of region 4 have no ledger code."""
    nation, region = text("n_nationkey"), text("n_regionkey")
    company = F.when(F.col("n_regionkey") == 1, C.COMPANY_01).otherwise("02")
    technical = F.when(F.col("n_regionkey") == 2, "NO").otherwise(C.YES)
    codes = F.array(
        _equivalence(label("S", nation), label("E", nation), label("D", region),
                     C.COMPANY_01, technical, C.YES),
        _equivalence(label("T", region), label("E", nation), label("D", region),
                     company, C.YES, C.YES),
    )
    return t.nation.select(
        nation.alias("id_ramo"),
        F.col("n_name").alias("des_ramo"),
        region.alias("id_ramo_contable"),
        label("R", region).alias("des_ramo_contable"),
        F.when(F.col("n_regionkey") != 4, codes).alias("arr_equivalencia_contable"),
    )


def customer_lines(t: Tables) -> DataFrame:
    """A large line table from ``customer``, with ledger codes shared by many lines."""
    nation, segment = text("c_nationkey"), F.col("c_mktsegment")
    technical = F.when(F.col("c_acctbal") > 0, C.YES).otherwise("NO")
    accounting = F.when(segment == "FURNITURE", "NO").otherwise(C.YES)
    return t.customer.select(
        text("c_custkey").alias("id_ramo"),
        F.col("c_name").alias("des_ramo"),
        nation.alias("id_ramo_contable"),
        F.array(
            _equivalence(label("S", nation), label("E", nation), label("D", segment),
                         C.COMPANY_01, technical, accounting),
            _equivalence(label("T", nation), label("E", nation), label("D", segment),
                         "02", C.YES, C.YES),
        ).alias("arr_equivalencia_contable"),
    )


def certificates(t: Tables) -> DataFrame:
    """Policies and certificates from ``lineitem``, in yearly periods."""
    order, line, status = text("l_orderkey"), text("l_linenumber"), F.col("l_linestatus")
    start = F.col("l_shipdate").cast("date")
    end = F.add_months(start, 12)
    none = F.lit(None)
    return t.lineitem.select(
        F.trunc("l_shipdate", "YEAR").alias("periodo"),
        order.alias("id_poliza"),
        label("O", order).alias("id_poliza_origen"),
        text("l_suppkey").alias("id_contratante"),
        line.alias("id_certificado"),
        F.when(F.col("l_quantity") > 2, text("l_suppkey")).alias("id_titular"),
        label("N", order).alias("num_poliza"),
        status.alias("id_est_poliza"),
        F.col("l_returnflag").alias("id_est_certificado"),
        F.lit(C.ORIGIN_AX).alias("id_origen"),
        text("l_partkey").alias("id_producto"),
        text("l_suppkey").alias("id_intermediario"),
        status.alias("id_canal"),
        label("C", status).alias("des_canal"),
        start.alias("fec_inicio_vigencia"),
        end.alias("fec_fin_vigencia"),
        start.alias("fec_inicio_vigencia_certificado"),
        end.alias("fec_fin_vigencia_certificado"),
        none.cast("date").alias("fec_anulacion"),
        none.cast("date").alias("fec_exclusion_certificado"),
        F.lit("NO").alias("ind_fronting"),
        status.alias("id_moneda"),
        F.col("l_returnflag").alias("id_subcanal"),
        label("T", F.col("l_returnflag")).alias("des_subtipocanal"),
    )


def journal(t: Tables) -> DataFrame:
    return t.orders.select(
        F.date_format(F.trunc("o_orderdate", "YEAR"), "yyyyMM").alias("dsc_periodo"),
        text("o_orderkey").alias("id_poliza"),
        F.col("o_custkey").alias("id_equivalencia_canal"),
    )


def channels(t: Tables) -> DataFrame:
    segment, nation = F.col("c_mktsegment"), text("c_nationkey")
    subchannel = F.when(segment == "BUILDING", C.PARTNER_SUBCHANNEL).otherwise(nation)
    return t.customer.select(
        text("c_custkey").alias("id_equivalencia_canal"),
        label("EC", nation).alias("id_estructura_comercial"),
        nation.alias("id_canal_equivalente"),
        label("CE", nation).alias("des_canal_equivalente"),
        subchannel.alias("id_subcanal_equivalente"),
        label("SE", nation).alias("des_subcanal_equivalente"),
        F.substring(segment, 1, 1).alias("id_segmentacion_01"),
        segment.alias("des_segmentacion_01"),
        F.substring(segment, 1, 2).alias("id_segmentacion_02"),
        F.lower(segment).alias("des_segmentacion_02"),
        nation.alias("cod_agrupacion_canal"),
        label("AG", nation).alias("des_agrupacion_canal"),
    )


def rates(t: Tables) -> DataFrame:
    """Exchange rates from ``events``: purchases SOL to USD, views and clicks USD to SOL."""
    kind = F.col("event_type")
    return t.events.select(
        F.col("ts").cast("date").alias("fec_tasa"),
        F.when(kind == "purchase", C.CURRENCY_SOL).when(kind == "error", "EUR")
        .otherwise(C.CURRENCY_USD).alias("id_moneda_origen"),
        F.when(kind == "purchase", C.CURRENCY_USD).otherwise(C.CURRENCY_SOL).alias("id_moneda_fin"),
        F.when(kind == "signup", "D").otherwise(C.RATE_TYPE_MONTHLY).alias("tip_tasa_cambio"),
        F.col("value").cast("decimal(18,6)").alias("val_tasa_cambio"),
    )


def production(t: Tables) -> DataFrame:
    """Premium movements from ``lineitem``; the technical line is the supplier's nation."""
    joined = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    number = F.col("l_linenumber")
    return joined.select(
        F.trunc("l_shipdate", "MM").alias("periodo"),
        F.date_add(F.col("l_shipdate").cast("date"), number * 5).alias("fec_procesamiento"),
        text("s_nationkey").alias("ram_id_ramo_tecnico"),
        text("l_partkey").alias("id_producto"),
        label("P", text("l_partkey")).alias("cod_producto_origen"),
        text("l_orderkey").alias("pol_id_poliza"),
        F.when(number != 7, number.cast("string")).alias("cer_id_certificado"),
        F.when(number == 1, C.MANUAL_ENTRIES).otherwise("EMISION").alias("tip_registro_primas"),
        F.when(F.col("l_linestatus") == "F", C.CURRENCY_SOL).otherwise(C.CURRENCY_USD)
        .alias("pol_id_moneda_origen"),
        F.when(F.col("l_quantity") > 5, C.PRODUCTION_FLAG).otherwise("OTRO").alias("ind_acumulado"),
        (1 + F.col("l_tax").cast("decimal(18,6)")).cast("decimal(18,6)").alias("tc_a_sol"),
        money("l_extendedprice").alias("mnt_prima_np_usd"),
        (F.col("l_discount").cast(AMOUNT) * 100).cast(AMOUNT).alias("mnt_derecho_emision_usd"),
    )


def order_policies(t: Tables) -> DataFrame:
    """One certificate per order; urgent orders have no contracting party."""
    order, status = text("o_orderkey"), F.col("o_orderstatus")
    return t.orders.select(
        F.trunc("o_orderdate", "MM").alias("periodo"),
        order.alias("id_poliza"),
        F.when(status == "F", "1").when(status == "O", "2").alias("id_certificado"),
        label("O", order).alias("id_poliza_origen"),
        F.when(F.col("o_orderpriority") != "1-URGENT", text("o_custkey")).alias("id_contratante"),
        text("o_custkey").alias("id_titular"),
    )


def premium(t: Tables) -> DataFrame:
    """Premium rows for the cascade, straight from ``lineitem``."""
    price = money("l_extendedprice")
    local = F.round(price * (1 + F.col("l_tax").cast("decimal(4,2)")), 2)
    return t.lineitem.select(
        F.trunc("l_shipdate", "MM").alias("periodo"),
        F.lit(C.GROUP_PREMIUM).alias("des_cuenta_agrupador_1"),
        F.lit(C.GROUP_PREMIUM).alias("des_cuenta_agrupador_2"),
        F.lit(C.CONCEPT_DIRECT).alias("des_concepto_cuenta"),
        F.lit(C.CONCEPT_DIRECT).alias("id_origen"),
        F.col("l_returnflag").alias("id_ramo_contable"),
        text("l_partkey").alias("id_producto"),
        text("l_orderkey").alias("id_poliza"),
        text("l_linenumber").alias("id_certificado"),
        F.col("l_linestatus").alias("id_moneda"),
        F.when(F.col("l_linestatus") == "F", local).otherwise(price).cast(AMOUNT).alias("mnt_moneda"),
        price.alias("mnt_usd"),
    )


def existing_policies(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_orderstatus") != "P").select(text("o_orderkey").alias("id_poliza"))


def ranked_products(t: Tables) -> DataFrame:
    """Product hierarchy for the cascade, one principal row per part; n5 may be NULL."""
    return t.part.select(
        text("p_partkey").alias("id_producto"),
        F.col("p_type").alias("agrupacion_n1"),
        F.col("p_brand").alias("agrupacion_n2"),
        F.expr("p_size div 10").cast("string").alias("agrupacion_n3"),
        F.expr("p_size div 5").cast("string").alias("agrupacion_n4"),
        F.when(F.col("p_size") != 7, text("p_size")).alias("agrupacion_n5"),
        F.lit(1).alias("ord"),
    )


def amounts(t: Tables) -> DataFrame:
    """Amounts to allocate: tax per month, product, line and currency."""
    part = ranked_products(t).drop("ord")
    tax = (money("l_extendedprice") * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(22,4)")
    keys = ["periodo", "id_ramo_contable", "id_producto", "id_moneda"]
    return (
        t.lineitem.select(
            F.trunc("l_shipdate", "MM").alias("periodo"),
            F.col("l_returnflag").alias("id_ramo_contable"),
            text("l_partkey").alias("id_producto"),
            F.col("l_linestatus").alias("id_moneda"),
            tax.alias("tax"),
        )
        .groupBy(*keys)
        .agg(F.sum("tax").cast(AMOUNT).alias("monto"))
        .join(part, "id_producto")
        .withColumn("periodo_trim", F.col("periodo"))
        .withColumn("id_monto", F.concat_ws("|", F.col("periodo").cast("string"), *keys[1:]))
    )


def financial_versions(t: Tables) -> DataFrame:
    """Financial rows from ``lineitem`` with the order date as version time; other texts name their column."""
    flag = F.col("l_returnflag")
    risk = F.when(flag == "R", "Vida").when(flag == "A", "vida-ajuste").otherwise("Salud")
    concept = F.when(F.col("l_linestatus") == "F", "Siniestros sin recuperos").otherwise("Primas")
    adjusted = F.when(F.col("l_quantity") < 10, " sin ajuste ").otherwise("con ajuste")
    orders = t.orders.select("o_orderkey", "o_orderdate")
    own = {
        "id_dato_financiero": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "periodo": F.trunc("l_shipdate", "MM"),
        "des_riesgo_negocio": risk,
        "tip_concepto_financiero": concept,
        "tip_distribucion": adjusted,
        "id_producto": text("l_partkey"),
        "id_poliza": text("l_orderkey"),
        "mnt_ajuste_reserva_usd": money("l_discount"),
        "mnt_usd": money("l_extendedprice"),
    }
    return t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *[own.get(c, label(f"{c}-", flag)).alias(c) for c in FINANCIAL_COLUMNS],
        F.col("o_orderdate").alias("version_ts"),
        F.col("l_shipdate").alias("loaded_ts"),
        F.col("l_suppkey").alias("load_no"),
    )


def managed_rows(t: Tables) -> DataFrame:
    """Managed result from ``orders``: many rows a product and month, and some of them equal."""
    status = F.col("o_orderstatus")
    own = {
        "periodo": F.trunc("o_orderdate", "MM"),
        "id_periodo": F.date_format("o_orderdate", "yyyyMM"),
        "id_producto": (F.col("o_custkey") % 10).cast("string"),
        "moneda": F.when(status == "F", C.CURRENCY_SOL).otherwise(C.CURRENCY_USD),
        "des_cuenta_contable": F.col("o_orderpriority"),
    }
    return t.orders.select(
        *[own.get(c, F.month("o_orderdate").cast(AMOUNT) if c.startswith(("mnt_", "tip_cambio"))
                  else label(f"{c}-", status)).alias(c) for c in MANAGED_RESULT_COLUMNS],
        status.alias("estado"),
    )


def run_outcomes(t: Tables) -> DataFrame:
    """Run ledger from ``events``; the runs of type ``error`` ended ten days earlier."""
    earlier = F.col("ts") - F.make_dt_interval(days=F.lit(10))
    return t.events.select(
        F.col("event_type").alias("recurso"),
        F.when(F.col("event_type") == "error", earlier).otherwise(F.col("ts"))
        .alias("fecha_estado_fin_dag"),
    )


def employees(t: Tables) -> dict[str, DataFrame]:
    """HR tables: employees from ``customer``, links and absences from ``orders``."""
    emp = F.col("c_custkey").alias("emp_id")
    deleted = F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)
    started = F.col("o_orderdate")
    links = t.orders.withColumn("emp_id", F.col("o_custkey"))
    none = F.lit(None).cast("timestamp_ntz")
    ids = F.when(
        F.col("c_mktsegment") == "HOUSEHOLD",
        F.array(F.col("c_custkey") + 500000, F.col("c_custkey") + 900000),
    ).otherwise(F.array(F.col("c_custkey") + 500000))
    return {
        "empleado": t.customer.select(
            emp, F.col("c_name").alias("emp_apellido"),
            F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment")).alias("emp_nombre"),
            (F.col("c_custkey") + 1000000).alias("emp_num_documento"),
        ),
        "empleado_cuenta": links.select(
            "emp_id", F.month(started).alias("cue_id"), F.dayofmonth(started).alias("car_id"),
            started.alias("ecu_fechadesde"), none.alias("ecu_fechahasta"),
            deleted.alias("anulado"), F.quarter(started).alias("sar_id"),
        ),
        "cuenta": t.nation.select(
            F.col("n_nationkey").alias("cue_id"), F.col("n_name").alias("cue_nombre"),
            F.when(F.col("n_regionkey") == 3, 1).otherwise(0).alias("anulado"),
        ),
        "subarea": t.region.select(
            F.col("r_regionkey").alias("sar_id"), F.col("r_name").alias("sar_nombre"),
            F.lit(0).alias("anulado"),
        ),
        "empleado_erp": t.customer.select(
            emp, F.explode(ids).alias("id_personal_erp"),
            F.when(F.col("c_acctbal") < 0, F.lit("2000-01-01").cast("timestamp_ntz"))
            .alias("eis_fechaHasta"),
            F.when(F.col("c_mktsegment") == "MACHINERY", 1).otherwise(0).alias("eis_anulado"),
        ),
        "empleado_servicio": links.select(
            "emp_id", F.dayofmonth(started).alias("srv_id"), started.alias("empsrv_fechadesde"),
            F.when(F.col("o_orderpriority") == "5-LOW", 1).otherwise(0).alias("anulado"),
        ),
        "servicios": t.nation.select(
            F.col("n_nationkey").alias("srv_id"), label("S-", F.col("n_name")).alias("srv_nombre"),
            F.lit(0).alias("anulado"),
        ),
        "cargo": t.supplier.select(
            F.col("s_suppkey").alias("car_id"), F.col("s_name").alias("car_nombre"),
            F.when(F.col("s_acctbal") < 0, 1).otherwise(0).alias("anulado"),
        ),
        "ausentismo": links.select(
            "emp_id", started.alias("aus_fechadesde"),
            F.when(F.col("o_orderstatus") == "F", started).alias("aus_fechacontrol"),
            F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("anulado"),
        ),
    }


def sync_orders(t: Tables) -> DataFrame:
    return t.orders.select(
        text("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderstatus").alias("BusinessStatus"),
    )


def sync_items(t: Tables) -> DataFrame:
    return t.lineitem.select(
        text("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("int").alias("line_no"),
        text("l_partkey").alias("sku"),
        F.col("l_quantity").cast("int").alias("qty"),
        money("l_extendedprice").alias("amount"),
    )


def sync_log(t: Tables) -> DataFrame:
    """Transition log from ``events``: the user is the order, the event type the status."""
    kind = F.col("event_type")
    status = (
        F.when(kind.isin("view", "error"), C.PENDING)
        .when(kind == "purchase", C.DISPATCHED)
        .otherwise(C.PROCESSING)
    )
    return t.events.select(
        text("user_id").alias("order_id"),
        status.alias("status"),
        F.date_trunc("DAY", "ts").cast("timestamp_ntz").alias("run_ts"),
        F.when(kind == "click", "b").otherwise("a").alias("flow_type"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
    )
