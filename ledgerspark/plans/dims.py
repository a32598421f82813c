"""Product, ledger, line, policy and currency dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark import constants as C
from ledgerspark.functions.calendar import month_code
from ledgerspark.functions.values import or_missing
from ledgerspark.operators.flatten import explode_left, explode_where
from ledgerspark.operators.matching import match_any_key
from ledgerspark.operators.pick import first_per_key
from ledgerspark.operators.rank import HOT_GROUP_ROWS, rank_order, rank_within

GROUPINGS = [f"agrupacion_n{i}" for i in range(1, 6)]


PRODUCT_ORDER = ["id_ramo_contable", "id_ramo"]
LINE_KEYS = ["own_key", "ledger_key"]


def _product_paths(products: DataFrame, origin: str, risk: str) -> DataFrame:
    """One row per product, code in the ``origin`` system and hierarchy of ``risk``."""
    by_origin = explode_where(
        products, "producto_origen", "por", lambda e: e["id_origen"] == origin
    )
    return explode_where(
        by_origin, "producto_jerarquia", "pj", lambda e: e["nom_riesgo"] == risk
    )


def product_dim(
    products: DataFrame,
    lines: DataFrame,
    origin: str = C.ORIGIN_AX,
    risk: str = C.RISK_LIFE,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Products with code, hierarchy and every matching accounting line.

    A line matches by its own accounting id or by one of its ledger codes, which
    carry the prefix already. ``ord`` ranks a product's rows, ``ord1`` the rows of
    one hierarchy path. Equal rows are kept: each one has its own rank, in the
    same order in both.
    """
    matched = product_lines(products, lines, origin, risk)
    by_product = rank_within(matched, ["id_producto"], PRODUCT_ORDER, "ord", hot_rows)
    return rank_within(by_product, GROUPINGS, ["id_ramo_contable", "id_producto"], "ord1", hot_rows)


def product_lines(
    products: DataFrame, lines: DataFrame, origin: str = C.ORIGIN_AX, risk: str = C.RISK_LIFE
) -> DataFrame:
    """Rows of ``product_dim`` before they are ranked."""
    return _with_lines(_product_paths(products, origin, risk), _line_codes(lines), LINE_KEYS)


def _line_codes(lines: DataFrame) -> DataFrame:
    return explode_left(lines, "arr_equivalencia_contable", "er").select(
        "id_ramo",
        "des_ramo",
        F.col("id_ramo_contable").alias("r_id_ramo_contable"),
        F.col("des_ramo_contable").alias("r_des_ramo_contable"),
        F.concat(F.lit(C.LINE_PREFIX), F.col("id_ramo_contable")).alias("own_key"),
        or_missing(F.col("er.cod_ramo_contable")).alias("ledger_key"),
    )


def _with_lines(paths: DataFrame, line_codes: DataFrame, keys: list[str]) -> DataFrame:
    return match_any_key(
        paths,
        F.concat(F.lit(C.LINE_PREFIX), F.col("pj.id_ramo_contable")),
        line_codes,
        [F.col(k) for k in keys],
    ).select(
        "pj.nom_riesgo",
        "id_producto",
        "nom_producto",
        "por.cod_producto",
        *[f"pj.{n}" for n in GROUPINGS],
        "pj.id_ramo_contable",
        F.col("r_des_ramo_contable").alias("des_ramo_contable"),
        "id_ramo",
        "des_ramo",
    )


def principal_products(products: DataFrame, lines: DataFrame) -> DataFrame:
    """The rows of ``product_dim`` with ``ord`` 1, without ranking the others or running a job.

    Of the lines a path matches only the first can win, so it is chosen among the lines, and
    what is sorted by product has a row per path, not one per path and line.
    """
    keyed = _line_codes(lines).withColumn("line_key", F.explode(F.array_distinct(F.array(*LINE_KEYS))))
    first = first_per_key(
        keyed, ["line_key"], [F.col(c).asc_nulls_first() for c in ("id_ramo", "r_des_ramo_contable", "des_ramo")])
    matched = _with_lines(_product_paths(products, C.ORIGIN_AX, C.RISK_LIFE), first, ["line_key"])
    return first_per_key(matched, ["id_producto"], rank_order(matched, ["id_producto"], PRODUCT_ORDER))


def product_dim_no_line(
    products: DataFrame,
    origin: str = C.ORIGIN_AX,
    risk: str = C.RISK_LIFE,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Products with code and hierarchy, whether or not an accounting line matches."""
    paths = product_paths(products, origin, risk)
    return rank_within(paths, ["id_producto"], ["id_ramo_contable"], "ord", hot_rows)


def product_paths(products: DataFrame, origin: str = C.ORIGIN_AX, risk: str = C.RISK_LIFE) -> DataFrame:
    """Rows of ``product_dim_no_line`` before they are ranked."""
    return _product_paths(products, origin, risk).select(
        "pj.nom_riesgo",
        "id_producto",
        "nom_producto",
        "por.cod_producto",
        *[f"pj.{n}" for n in GROUPINGS[:4]],
        "pj.id_ramo_contable",
    )


def principal_paths(products: DataFrame) -> DataFrame:
    """The rows of ``product_dim_no_line`` with ``ord`` 1."""
    paths = product_paths(products)
    return first_per_key(paths, ["id_producto"], rank_order(paths, ["id_producto"], ["id_ramo_contable"]))


def principal(dim: DataFrame) -> DataFrame:
    """The first-ranked row of each product (or line); a table without ranks has no others."""
    return dim.where(F.col("ord") == 1) if "ord" in dim.columns else dim


def product_to_ledger(products: DataFrame) -> DataFrame:
    """Principal ledger code of each product and company in the old and the new ERP."""
    def code_in(origin: str) -> Column:
        return F.max(F.when(F.col("ec.id_origen") == origin, F.col("ec.cod_producto_contable")))

    return (
        explode_where(
            products, "arr_equivalencia_contable", "ec",
            lambda e: e["ind_contable_principal"] == C.YES,
        )
        .groupBy("id_producto", F.col("ec.id_companhia").alias("codcia"))
        .agg(
            code_in(C.ERP_LEGACY).alias("id_producto_cont_erp_legado"),
            code_in(C.ERP_NEW).alias("id_producto_cont_erp_nuevo"),
        )
    )


def ledger_to_product(products: DataFrame) -> DataFrame:
    """Products of each ledger code, by the principal technical equivalence."""
    return (
        explode_where(
            products, "arr_equivalencia_contable", "ec",
            lambda e: e["ind_tecnico_principal"] == C.YES,
        )
        .select("ec.cod_producto_contable", "id_producto", F.col("ec.id_companhia").alias("codcia"))
        .distinct()
    )


def line_map(
    lines: DataFrame,
    flag: str,
    with_rank: bool,
    company: str = C.COMPANY_01,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Ledger lines and technical lines of ``company`` linked by elements marked ``flag``.

    Without rank: distinct pairs (ledger to technical). With rank: every pair,
    with its position within the ledger code (``ord``) and within the ledger
    description (``ord2``), for the way from technical to ledger.
    """
    pairs = line_pairs(lines, flag, company)
    if not with_rank:
        return pairs.distinct()
    by_code = rank_within(pairs, ["id_ramo_contable"], ["id_ramo"], "ord", hot_rows)
    return rank_within(by_code, ["des_ramo_contable"], ["id_ramo"], "ord2", hot_rows)


def line_pairs(lines: DataFrame, flag: str = "ind_contable_principal", company: str = C.COMPANY_01) -> DataFrame:
    """Every pair of a ledger line and a technical line, repeats included."""
    marked = explode_left(lines, "arr_equivalencia_contable", "h", lambda e: e[flag] == C.YES)
    return marked.where(F.col("h.id_companhia") == company).select(
        F.col("h.cod_ramo_contable").alias("id_ramo_contable"),
        "id_ramo",
        "des_ramo",
        F.col("h.des_ramo_erp").alias("des_ramo_erp"),
        F.col("h.des_ramo_contable").alias("des_ramo_contable"),
        F.col("h.id_companhia").alias("codcia"),
    )


def line_ledger_to_technical(lines: DataFrame) -> DataFrame:
    return line_map(lines, "ind_tecnico_principal", with_rank=False)


def line_technical_to_ledger(lines: DataFrame, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    return line_map(lines, "ind_contable_principal", with_rank=True, hot_rows=hot_rows)


POLICY_COLUMNS = [
    "periodo", "id_poliza", "id_poliza_origen", "id_contratante", "id_certificado",
    "id_titular", "num_poliza", "id_est_poliza", "id_est_certificado", "id_origen",
    "id_producto", "id_intermediario", "id_canal", "des_canal", "fec_inicio_vigencia",
    "fec_fin_vigencia", "fec_inicio_vigencia_certificado", "fec_fin_vigencia_certificado",
    "fec_anulacion", "fec_exclusion_certificado", "ind_fronting", "id_moneda",
    "id_subcanal", "des_subtipocanal",
]
CHANNEL_COLUMNS = [
    "id_estructura_comercial", "id_canal_equivalente", "des_canal_equivalente",
    "id_subcanal_equivalente", "des_subcanal_equivalente", "id_segmentacion_01",
    "des_segmentacion_01", "id_segmentacion_02", "des_segmentacion_02",
    "cod_agrupacion_canal", "des_agrupacion_canal",
]


def current_policies(
    policies: DataFrame,
    product: DataFrame,
    journal: DataFrame,
    channel: DataFrame,
    period: date | None,
) -> DataFrame:
    """Policies of ``period`` (of every period when None) with product code and sales channel.

    One row per period, policy and certificate: the one with the lowest holder id,
    a missing holder first; further ties go by product, origin, status and channel.
    The journal takes its channels first: policies without a journal row have no channel to
    look for, and in a join of theirs all of them would meet in one task.

    All rows of a policy and period meet the same journal rows, so the first policy row and the first
    journal row are chosen apart. A policy's certificates are dealt by month and policy once: they are
    ranked there, and what is left meets the journal there and is not shuffled or sorted again.
    """
    wanted = policies.where(or_missing(F.col("id_poliza")) != C.MISSING_ID)
    if period is not None:
        wanted = wanted.where(F.col("periodo") == F.lit(period))
    pr = principal(product).select(F.col("id_producto").alias("_product"), "cod_producto")
    known = wanted.select(*POLICY_COLUMNS).join(pr, F.col("id_producto") == F.col("_product")).drop("_product")
    order = ["id_titular", "id_producto", "id_poliza_origen", "id_contratante", "num_poliza",
             "id_est_poliza", "id_est_certificado", "id_origen", "fec_inicio_vigencia_certificado", "id_moneda"]
    of_policy = ["_month", "id_poliza"]
    po = first_per_key(
        known.withColumn("_month", month_code(F.col("periodo"))).repartition(*of_policy),
        [*of_policy, "periodo", "id_certificado"],
        [F.col(c).asc_nulls_first() for c in order],
    ).alias("po")
    entries = journal.select("dsc_periodo", "id_poliza", "id_equivalencia_canal").where(
        F.col("dsc_periodo").isNotNull() & F.col("id_poliza").isNotNull())
    if period is not None:
        entries = entries.where(F.col("dsc_periodo") == month_code(F.lit(period)))
    te = channel.select(F.col("id_equivalencia_canal").alias("_channel"), *CHANNEL_COLUMNS)
    channelled = entries.join(te, F.col("id_equivalencia_canal").cast("string") == F.col("_channel"), "left")
    bi = first_per_key(
        channelled, ["dsc_periodo", "id_poliza"], [F.col("id_equivalencia_canal").asc_nulls_first()]).alias("bi")
    joined = po.join(
        bi, (F.col("po._month") == F.col("bi.dsc_periodo")) & (F.col("po.id_poliza") == F.col("bi.id_poliza")), "left")
    segment = F.when(
        F.col("bi.id_subcanal_equivalente") == C.PARTNER_SUBCHANNEL, F.col("po.des_subtipocanal")
    ).otherwise(F.col("bi.des_segmentacion_01"))
    return joined.select(
        *[f"po.{c}" for c in POLICY_COLUMNS],
        "po.cod_producto",
        "bi.id_equivalencia_canal",
        *[
            segment.alias(c) if c == "des_segmentacion_01" else F.col(f"bi.{c}")
            for c in CHANNEL_COLUMNS
        ],
    )


def fx_rates(rates: DataFrame) -> DataFrame:
    """Monthly-type rates SOL to USD and USD to SOL per day; 0 when a direction is missing."""
    source, target = F.col("id_moneda_origen"), F.col("id_moneda_fin")
    to_usd = (source == C.CURRENCY_SOL) & (target == C.CURRENCY_USD)
    to_sol = (source == C.CURRENCY_USD) & (target == C.CURRENCY_SOL)

    def rate_from(currency: str) -> Column:
        return F.max(F.when(source == currency, F.col("val_tasa_cambio")).otherwise(F.lit(0)))

    return (
        rates.where((F.col("tip_tasa_cambio") == C.RATE_TYPE_MONTHLY) & (to_usd | to_sol))
        .groupBy("fec_tasa")
        .agg(
            rate_from(C.CURRENCY_SOL).alias("tc_a_usd"),
            rate_from(C.CURRENCY_USD).alias("tc_a_sol"),
        )
    )
