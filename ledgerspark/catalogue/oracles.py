"""SQL with the results the queries must have, for DuckDB on the same tables."""

from __future__ import annotations

FIRST, LAST = "DATE '1995-01-01'", "DATE '2001-12-01'"


def month(column: str) -> str:
    return f"CAST(date_trunc('month', {column}) AS DATE)"


def txt(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


def money(column: str) -> str:
    return f"CAST({column} AS DECIMAL(18,2))"


N = [f"agrupacion_n{i}" for i in range(1, 6)]
KEYS = [*N, "id_ramo_contable", "id_producto", "id_moneda"]
ROW_KEYS = ["periodo", "id_ramo_contable", "id_producto", "id_poliza", "id_certificado", "id_moneda"]


def level_keys(level: int) -> list[str]:
    return KEYS[: 8 - (level - 1) // 2]


SPINE = f"""spine AS (
  SELECT CAST(range AS DATE) AS periodo_trim
  FROM range({FIRST}, {LAST} + INTERVAL 1 MONTH, INTERVAL 1 MONTH))"""

PREMIUM = f"""premium AS (
  SELECT {month('l_shipdate')} AS periodo, l_returnflag AS id_ramo_contable,
         {txt('l_partkey')} AS id_producto, {txt('l_orderkey')} AS id_poliza,
         {txt('l_linenumber')} AS id_certificado, l_linestatus AS id_moneda,
         CAST(CASE WHEN l_linestatus = 'F'
              THEN round({money('l_extendedprice')} * (1 + CAST(l_tax AS DECIMAL(4,2))), 2)
              ELSE {money('l_extendedprice')} END AS DECIMAL(18,2)) AS mnt_moneda,
         {money('l_extendedprice')} AS mnt_usd
  FROM lineitem)"""

HIERARCHY = f"""product AS (
  SELECT {txt('p_partkey')} AS id_producto, p_type AS agrupacion_n1, p_brand AS agrupacion_n2,
         {txt('p_size // 10')} AS agrupacion_n3, {txt('p_size // 5')} AS agrupacion_n4,
         CASE WHEN p_size <> 7 THEN {txt('p_size')} END AS agrupacion_n5
  FROM part)"""

EXISTING = f"existing AS (SELECT {txt('o_orderkey')} AS id_poliza FROM orders WHERE o_orderstatus <> 'P')"


def cascade_cte() -> str:
    """``casc`` from the relations premium, existing, product and spine."""
    totals = []
    for level in range(1, 15):
        keys = ["periodo_trim", *(["periodo"] if level % 2 else []), *level_keys(level)]
        measure = "mnt_moneda" if level <= 2 else "mnt_usd"
        totals.append(
            f"CAST(sum({measure}) OVER (PARTITION BY {', '.join(keys)}) AS DECIMAL(38,2)) AS porc_nivel_{level}"
        )
    return f"""base AS (
  SELECT periodo, id_ramo_contable, id_producto, id_poliza, id_certificado, id_moneda,
         CAST(sum(mnt_moneda) AS DECIMAL(38,2)) AS mnt_moneda,
         CAST(sum(mnt_usd) AS DECIMAL(38,2)) AS mnt_usd
  FROM premium
  WHERE mnt_moneda <> 0 AND id_poliza IN (SELECT id_poliza FROM existing)
  GROUP BY ALL),
windowed AS (
  SELECT s.periodo_trim, b.*, {', '.join('p.' + n for n in N)}
  FROM base b
  JOIN spine s ON b.periodo BETWEEN s.periodo_trim - INTERVAL 2 MONTH AND s.periodo_trim
  JOIN product p ON p.id_producto = b.id_producto),
casc AS (SELECT *, {', '.join(totals)} FROM windowed)"""


CASCADE = f"WITH {SPINE}, {PREMIUM}, {HIERARCHY}, {EXISTING}, {cascade_cte()}"
LEVEL_NAMES = ", ".join(f"porc_nivel_{k}" for k in range(1, 15))

PRODUCTS = f"""producto AS (
  SELECT {txt('p_partkey')} AS id_producto, p_name AS nom_producto, p_type, p_brand, p_size,
         CASE WHEN p_size IN (49, 50) THEN []
              WHEN p_type = 'PROMO' THEN ['A' || p_partkey, 'P' || p_partkey]
              ELSE ['A' || p_partkey] END AS codes,
         CASE WHEN p_type = 'LARGE' THEN [1, 2] ELSE [1] END AS paths
  FROM part),
camino AS (
  SELECT 'VIDA' AS nom_riesgo, id_producto, nom_producto, cod_producto,
         p_type AS agrupacion_n1, p_brand AS agrupacion_n2, {txt('p_size // 10')} AS agrupacion_n3,
         {txt('p_size // 5')} AS agrupacion_n4,
         CASE WHEN path = 2 THEN 'X' WHEN p_size <> 7 THEN {txt('p_size')} END AS agrupacion_n5,
         CASE WHEN path = 2 THEN {txt('p_size // 5')} ELSE {txt('p_size // 10')} END AS id_ramo_contable
  FROM (SELECT *, unnest(paths) AS path
        FROM (SELECT *, unnest(codes) AS cod_producto FROM producto))
  WHERE p_brand <> 'Brand#1')"""

LINES = f"""ramo AS (
  SELECT {txt('n_nationkey')} AS id_ramo, n_name AS des_ramo, {txt('n_regionkey')} AS linea,
         'R' || n_regionkey AS des_ramo_contable, n_regionkey, n_nationkey FROM nation),
ramo_codigo AS (
  SELECT *, 'S' || n_nationkey AS cod, '01' AS companhia FROM ramo WHERE n_regionkey <> 4
  UNION ALL
  SELECT *, 'T' || n_regionkey, CASE WHEN n_regionkey = 1 THEN '01' ELSE '02' END
  FROM ramo WHERE n_regionkey <> 4
  UNION ALL
  SELECT *, NULL, NULL FROM ramo WHERE n_regionkey = 4)"""

PRODUCT_DIM = f"""dim AS (
  SELECT c.nom_riesgo, c.id_producto, c.nom_producto, c.cod_producto, {', '.join('c.' + n for n in N)},
         c.id_ramo_contable, r.des_ramo_contable, r.id_ramo, r.des_ramo
  FROM camino c JOIN ramo_codigo r
    ON 'S' || c.id_ramo_contable IN ('S' || r.linea, coalesce(r.cod, '0'))),
by_product AS (
  SELECT *, row_number() OVER (PARTITION BY id_producto ORDER BY id_ramo_contable NULLS FIRST,
      id_ramo NULLS FIRST, nom_riesgo, nom_producto, cod_producto, agrupacion_n1, agrupacion_n2,
      agrupacion_n3, agrupacion_n4, agrupacion_n5 NULLS FIRST, des_ramo_contable, des_ramo) AS ord
  FROM dim),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(N)} ORDER BY id_ramo_contable NULLS FIRST,
      id_producto, nom_riesgo, nom_producto, cod_producto, des_ramo_contable, id_ramo, des_ramo, ord) AS ord1
  FROM by_product)"""

DIRECT = f"""no_line AS (
  SELECT nom_riesgo, id_producto, nom_producto, cod_producto, agrupacion_n1, agrupacion_n2,
         agrupacion_n3, agrupacion_n4, id_ramo_contable,
         row_number() OVER (PARTITION BY id_producto ORDER BY id_ramo_contable NULLS FIRST,
           nom_riesgo, nom_producto, cod_producto, agrupacion_n1, agrupacion_n2, agrupacion_n3,
           agrupacion_n4) AS ord
  FROM camino),
production AS (
  SELECT {month('l_shipdate')} AS periodo,
         CAST(l_shipdate AS DATE) + CAST(l_linenumber * 5 AS INTEGER) AS procesado,
         {txt('s_nationkey')} AS id_ramo, {txt('l_partkey')} AS id_producto,
         'P' || l_partkey AS cod_producto, {txt('l_orderkey')} AS id_poliza,
         CASE WHEN l_linenumber <> 7 THEN {txt('l_linenumber')} END AS certificado,
         CASE WHEN l_linestatus = 'F' THEN 'SOL' ELSE 'USD' END AS id_moneda,
         CAST(1 + CAST(l_tax AS DECIMAL(18,6)) AS DECIMAL(18,6)) AS tasa,
         {money('l_extendedprice')} + CAST({money('l_discount')} * 100 AS DECIMAL(18,2)) AS usd,
         p_brand
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  WHERE l_linenumber <> 1 AND l_quantity > 5),
policy AS (
  SELECT {txt('o_orderkey')} AS id_poliza,
         CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' END AS id_certificado,
         'O' || o_orderkey AS id_poliza_origen,
         CASE WHEN o_orderpriority <> '1-URGENT' THEN {txt('o_custkey')} END AS id_contratante,
         {txt('o_custkey')} AS id_titular
  FROM orders),
joined AS (
  SELECT r.periodo, r.procesado, l.cod AS id_ramo_contable, r.id_ramo, r.id_producto,
         CASE WHEN r.periodo < DATE '1998-06-01' THEN 'L' || r.p_brand
              ELSE 'N' || r.id_producto END AS id_producto_erp,
         r.id_poliza, coalesce(r.certificado, '0') AS id_certificado,
         coalesce(p.id_contratante, '0') AS id_contratante, coalesce(p.id_titular, '0') AS id_titular,
         r.cod_producto AS id_producto_origen, coalesce(p.id_poliza_origen, '0') AS num_poliza_origen,
         r.id_moneda, r.usd,
         CASE WHEN r.id_moneda = 'SOL' THEN round(r.tasa * r.usd, 2) ELSE r.usd END AS moneda
  FROM production r
  JOIN no_line n ON n.id_producto = r.id_producto AND n.ord = 1
  LEFT JOIN (SELECT * FROM ramo_codigo WHERE companhia = '01') l ON l.id_ramo = r.id_ramo
  LEFT JOIN policy p ON p.id_poliza = r.id_poliza AND p.id_certificado = r.certificado),
direct AS (
  SELECT {txt(month('procesado'))} || 'PrimasPrimasDirecto' || id_ramo || id_producto || 'Directo'
           || id_producto_origen || id_poliza || id_certificado || num_poliza_origen || 'EMISION'
           || id_moneda AS id_primas,
         periodo, id_ramo_contable, id_ramo, id_producto, id_producto_erp, id_poliza, id_certificado,
         id_contratante, id_titular, id_producto_origen, num_poliza_origen, id_moneda,
         CAST(sum(moneda) AS DECIMAL(38,2)) AS mnt_moneda, CAST(sum(usd) AS DECIMAL(38,2)) AS mnt_usd
  FROM joined GROUP BY ALL)"""

HR = f"""cuenta_link AS (
  SELECT * FROM (
    SELECT o_custkey AS emp_id, month(o_orderdate) AS cue_id, day(o_orderdate) AS car_id,
           quarter(o_orderdate) AS sar_id,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC,
             month(o_orderdate) DESC, day(o_orderdate) DESC, quarter(o_orderdate) DESC) AS rn
    FROM orders WHERE o_orderstatus <> 'P') WHERE rn = 1),
servicio_link AS (
  SELECT * FROM (
    SELECT o_custkey AS emp_id, day(o_orderdate) AS srv_id,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS rn
    FROM orders WHERE o_orderpriority <> '5-LOW') WHERE rn = 1),
erp AS (
  SELECT c_custkey AS emp_id,
         unnest(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN [c_custkey + 500000, c_custkey + 900000]
                     ELSE [c_custkey + 500000] END) AS id_personal_erp
  FROM customer WHERE c_mktsegment <> 'MACHINERY' AND c_acctbal >= 0),
master AS (
  SELECT CAST(erp.id_personal_erp AS INTEGER) AS id_personal_erp, CAST(c.c_custkey AS INTEGER) AS emp_id,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN c_name ELSE c_name || ' ' || c_mktsegment END AS nombre_completo,
         CAST(c.c_custkey + 1000000 AS INTEGER) AS emp_num_documento,
         cu.n_name AS "Cuenta", r.r_name AS "Sub_Cuenta", 'S-' || sv.n_name AS "Servicio",
         su.s_name AS "Cargo"
  FROM customer c JOIN erp ON erp.emp_id = c.c_custkey
  LEFT JOIN cuenta_link cl ON cl.emp_id = c.c_custkey
  LEFT JOIN servicio_link sl ON sl.emp_id = c.c_custkey
  LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 3) cu ON cu.n_nationkey = cl.cue_id
  LEFT JOIN region r ON r.r_regionkey = cl.sar_id
  LEFT JOIN nation sv ON sv.n_nationkey = sl.srv_id
  LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) su ON su.s_suppkey = cl.car_id),
absences AS (
  SELECT CAST(o_custkey AS INTEGER) AS emp_id, CAST(year(o_orderdate) AS INTEGER) AS "Anio",
         CAST(month(o_orderdate) AS INTEGER) AS "Mes", count(*) AS cuenta_ausentismo
  FROM orders
  WHERE o_orderstatus <> 'F' AND o_orderpriority <> '1-URGENT' AND year(o_orderdate) = 1998
  GROUP BY ALL)"""

LOG = f"""log AS (
  SELECT {txt('user_id')} AS order_id,
         CASE WHEN event_type IN ('view', 'error') THEN 'PENDING'
              WHEN event_type = 'purchase' THEN 'DISPATCHED' ELSE 'PROCESSING' END AS status,
         date_trunc('day', ts) AS run_ts,
         CASE WHEN event_type = 'click' THEN 'b' ELSE 'a' END AS flow_type, ts, event_id AS seq
  FROM events),
status AS (
  SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY ts DESC, seq DESC) = 1),
claims AS (
  SELECT {txt('o_orderkey')} AS order_id, o_orderdate AS created_at, o_orderstatus AS business
  FROM orders
  WHERE o_orderstatus IN ('F', 'O')
    AND {txt('o_orderkey')} NOT IN (SELECT order_id FROM status WHERE status <> 'PENDING'))"""

TRANSITION = """TIMESTAMP '2024-02-01 00:00:00' AS run_ts, 'orders' AS flow_type,
         TIMESTAMP '2024-02-03 00:00:00' AS ts"""

STAGED = f"""items AS (
  SELECT {txt('l_orderkey')} AS order_id, l_linenumber AS line_no, {txt('l_partkey')} AS sku,
         CAST(l_quantity AS INTEGER) AS qty, {money('l_extendedprice')} AS amount,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, {txt('l_partkey')},
           CAST(l_quantity AS INTEGER), {money('l_extendedprice')}) AS n,
         count(*) OVER (PARTITION BY l_orderkey) AS total
  FROM lineitem),
staged AS (
  SELECT c.order_id, coalesce(CAST((i.n - 1) // 5 AS INTEGER), 0) AS part,
         coalesce(CAST((max(i.total) + 4) // 5 AS INTEGER), 1) AS parts, c.created_at, c.business,
         count(i.n) AS n_items, coalesce(sum(i.amount), 0) AS amount,
         coalesce(string_agg('{{"line_no":' || line_no || ',"sku":"' || sku || '","qty":' || qty
           || ',"amount":' || amount || '}}', ',' ORDER BY n), '') AS items
  FROM claims c LEFT JOIN items i ON i.order_id = c.order_id
  GROUP BY c.order_id, (i.n - 1) // 5, c.created_at, c.business)"""

# Columns of the financial table that only name themselves in the stand-in.
FINANCIAL_TEXTS = [
    "cod_periodo", "cta_agrupador_n2", "des_agrupacion_n1", "des_agrupacion_n2", "des_agrupacion_n3",
    "des_agrupacion_n4", "des_agrupacion_n5", "id_ramo_contable", "des_ramo_contable", "id_canal", "des_canal",
    "des_segmento_empresa_persona", "id_intermediario", "des_intermediario", "cod_producto_origen", "des_producto",
    "id_subcanal", "des_subcanal", "des_subtipocanal", "id_contratante", "des_contratante", "ind_fronting",
    "segmento_empresa", "tip_gasto",
]
FINANCIAL = f"""financial AS (
  SELECT l_orderkey || '-' || l_linenumber AS id_dato_financiero, {month('l_shipdate')} AS periodo,
         CASE l_returnflag WHEN 'R' THEN 'Vida' WHEN 'A' THEN 'vida-ajuste' ELSE 'Salud' END AS des_riesgo_negocio,
         CASE WHEN l_linestatus = 'F' THEN 'Siniestros sin recuperos' ELSE 'Primas' END AS tip_concepto_financiero,
         CASE WHEN l_quantity < 10 THEN ' sin ajuste ' ELSE 'con ajuste' END AS tip_distribucion,
         {txt('l_partkey')} AS id_producto, {txt('l_orderkey')} AS id_poliza,
         {money('l_discount')} AS mnt_ajuste_reserva_usd, {money('l_extendedprice')} AS mnt_usd,
         {', '.join(f"'{c}-' || l_returnflag AS {c}" for c in FINANCIAL_TEXTS)}, o_orderdate, l_shipdate, l_suppkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
MANAGED_TEXTS = [
    "id_ramo_contable", "des_ramo_riesgo", "des_ramo_contable", "des_cuenta_agrupador_1", "des_cuenta_agrupador_2",
    "des_agrup_origen_asiento", "des_categoria", "des_lineas", "des_glosa", "ind_rtg",
]
MANAGED_AMOUNTS = [
    "mnt_contabilizado_neto_usd", "mnt_ingresado_neto_moneda", "tip_cambio_sol_usd", "mnt_ajuste_descalce_usd",
    "mnt_ajuste_otro_usd", "mnt_ajuste_tecnico_usd", "mnt_ajuste_inflacion_usd",
]
FINANCIAL_COLUMNS = """id_dato_financiero, periodo, des_riesgo_negocio, tip_concepto_financiero,
  tip_distribucion, id_producto, id_poliza, mnt_usd"""
FINANCIAL_ROWS = """(periodo BETWEEN DATE '1997-01-01' AND DATE '1999-12-01'
     AND upper(des_riesgo_negocio) IN ('VIDA', 'VIDA-AJUSTE'))
   OR (upper(des_riesgo_negocio) = 'VIDA'
     AND upper(tip_concepto_financiero) = 'SINIESTROS SIN RECUPEROS'
     AND trim(upper(tip_distribucion)) = 'SIN AJUSTE')"""


def allocate_sql(one: bool = False) -> str:
    """Each amount over the premium rows; ``one``: only the largest without premium of its own."""
    joins, levels, totals = [], [], []
    for k in range(1, 15):
        keys = [*(["periodo"] if k % 2 else []), *level_keys(k)]
        on = " AND ".join(f"a.{c} IS NOT DISTINCT FROM l{k}.{c}" for c in keys)
        joins.append(
            f"""LEFT JOIN (SELECT DISTINCT periodo_trim, {', '.join(keys)}, porc_nivel_{k} AS t
       FROM casc WHERE porc_nivel_{k} <> 0) l{k} ON a.periodo_trim = l{k}.periodo_trim AND {on}"""
        )
        levels.append(f"WHEN l{k}.t IS NOT NULL THEN {k}")
        totals.append(f"l{k}.t")
    # Below these levels the row has to agree with the amounts in the column.
    limits = {"agrupacion_n3": 13, "agrupacion_n4": 11, "agrupacion_n5": 9,
              "id_ramo_contable": 7, "id_producto": 5, "id_moneda": 3}
    same = " AND ".join(f"(a.nivel >= {n} OR a.{c} IS NOT DISTINCT FROM c.{c})" for c, n in limits.items())
    shared = ", ".join(f"CASE WHEN nivel < {n} THEN {c} END AS {c}" for c, n in limits.items())
    path = " || ".join(f"coalesce(length(c.{k}) || ':' || c.{k}, '-')" for k in KEYS)
    chosen = """WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.periodo = t.periodo AND b.id_producto = t.id_producto
    AND b.id_ramo_contable IS NOT DISTINCT FROM t.id_ramo_contable AND b.id_moneda IS NOT DISTINCT FROM t.id_moneda)
  ORDER BY monto DESC, id_monto LIMIT 1""" if one else ""

    def part(upto: str) -> str:
        return f"(abs(m * ({upto})) * 2 + abs(t)) // (abs(t) * 2) * sign(m * ({upto})) * sign(t)"

    return f"""{CASCADE},
tax AS (
  SELECT {month('l_shipdate')} AS periodo, l_returnflag AS id_ramo_contable,
         {txt('l_partkey')} AS id_producto, l_linestatus AS id_moneda,
         CAST(sum(CAST({money('l_extendedprice')} * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(22,4)))
           AS DECIMAL(18,2)) AS monto
  FROM lineitem GROUP BY ALL),
amounts AS (
  SELECT t.*, t.periodo AS periodo_trim, {', '.join('p.' + n for n in N)},
         t.periodo || '|' || t.id_ramo_contable || '|' || t.id_producto || '|' || t.id_moneda AS id_monto
  FROM tax t JOIN product p ON p.id_producto = t.id_producto {chosen}),
levelled AS (
  SELECT a.*, CASE {' '.join(levels)} END AS nivel, coalesce({', '.join(totals)}) AS total
  FROM amounts a {' '.join(joins)}),
summed AS (
  SELECT row_number() OVER () AS g, * FROM (
    SELECT periodo_trim, nivel, id_monto, CASE WHEN nivel % 2 = 1 THEN periodo END AS mes, agrupacion_n1, agrupacion_n2,
           {shared}, sum(monto) AS monto, any_value(total) AS total
    FROM levelled WHERE nivel IS NOT NULL GROUP BY ALL)),
pairs AS (
  SELECT a.g, a.periodo_trim, a.nivel, a.id_monto, {', '.join('c.' + k for k in ROW_KEYS)}, {path} AS path,
         CAST(a.monto * 100 AS HUGEINT) AS m, CAST(a.total * 100 AS HUGEINT) AS t,
         CAST((CASE WHEN a.nivel <= 2 THEN c.mnt_moneda ELSE c.mnt_usd END) * 100 AS HUGEINT) AS r
  FROM summed a JOIN casc c
    ON a.periodo_trim = c.periodo_trim AND a.agrupacion_n1 = c.agrupacion_n1
   AND a.agrupacion_n2 = c.agrupacion_n2 AND (a.mes IS NULL OR a.mes = c.periodo) AND {same}),
shares AS (
  SELECT *, CAST(sum(r) OVER (PARTITION BY g ORDER BY periodo, path, id_poliza, id_certificado
    ROWS UNBOUNDED PRECEDING) AS HUGEINT) AS upto FROM pairs)
SELECT periodo_trim, nivel, id_monto, {', '.join(ROW_KEYS)},
       CAST(CAST({part('upto')} - {part('upto - r')} AS DECIMAL(20,0)) * 0.01 AS DECIMAL(18,2)) AS asignado
FROM shares
UNION ALL
SELECT periodo_trim, NULL, id_monto, periodo, id_ramo_contable, id_producto, NULL, NULL, id_moneda, monto
FROM levelled WHERE nivel IS NULL"""


ORDER_BOUNDS = """bounds AS (
  SELECT CAST(min(o_orderdate) AS DATE) AS first, CAST(max(o_orderdate) AS DATE) AS last FROM orders)"""


def spine_sql(start: str) -> str:
    return f"""{ORDER_BOUNDS},
days AS (SELECT CAST(unnest(generate_series({start}, last, INTERVAL 1 MONTH)) AS DATE) AS d FROM bounds)"""


CUSTOMER_LINES = f"""linea AS (
  SELECT {txt('c_custkey')} AS id_ramo, c_name AS des_ramo, 'S' || c_nationkey AS id_ramo_contable,
         'E' || c_nationkey AS des_ramo_erp, 'D' || c_mktsegment AS des_ramo_contable, '01' AS codcia,
         c_acctbal, c_mktsegment FROM customer)"""

RANKED_LINES = """SELECT DISTINCT l_returnflag, l_shipdate, l_orderkey,
       row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber,
         l_partkey, l_suppkey, l_quantity, l_extendedprice) AS ord
FROM lineitem"""

# One complete message for each eligible order, whatever came between.
SENT_ONCE = f"""SELECT {txt('o_orderkey')} AS order_id, CAST(1 AS BIGINT) AS messages, CAST(1 AS BIGINT) AS ids,
       count(*) AS n_items, 'DISPATCHED' AS status
FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus IN ('F', 'O') GROUP BY o_orderkey"""

ORACLES: dict[str, str] = {
    "cascade_totals": f"""{CASCADE}
SELECT periodo_trim, periodo, {', '.join(KEYS)}, id_poliza, id_certificado, mnt_moneda, mnt_usd, {LEVEL_NAMES}
FROM casc""",
    "cascade_base": f"""{CASCADE}
SELECT periodo_trim, {', '.join(ROW_KEYS)},
       CASE {' '.join(f'WHEN porc_nivel_{k} <> 0 THEN {k}' for k in range(1, 15))} END AS nivel_base,
       coalesce({', '.join(f'nullif(porc_nivel_{k}, 0)' for k in range(1, 15))}) AS total_base
FROM casc""",
    "cascade_allocate": allocate_sql(),
    "cascade_allocate_amount": allocate_sql(one=True),
    "technical_result": f"""WITH {SPINE}, {PRODUCTS}, {LINES}, {PRODUCT_DIM}, {DIRECT},
premium AS (SELECT * FROM direct),
existing AS (SELECT id_poliza FROM policy),
product AS (SELECT * FROM ranked WHERE ord = 1),
{cascade_cte()}
SELECT periodo_trim, {', '.join(N)}, {', '.join(ROW_KEYS)}, {LEVEL_NAMES} FROM casc""",
    "direct_premium": f"""WITH {PRODUCTS}, {LINES}, {DIRECT}
SELECT *, 'Primas' AS des_cuenta_agrupador_1, 'Primas' AS des_cuenta_agrupador_2,
       'Directo' AS des_concepto_cuenta, 'Directo' AS id_origen, 'EMISION' AS tip_registro_primas,
       {', '.join(f'CAST(NULL AS VARCHAR) AS {n}' for n in N)},
       'PRIMAS' AS des_componente, 'DIRECTO' AS des_sub_componente, 'DIRECTO' AS des_origen_data
FROM direct""",
    "month_spine": f"""WITH {spine_sql('first')}
SELECT DISTINCT strftime(d, '%Y%m') AS periodo, strftime(d - INTERVAL 2 MONTH, '%Y%m') AS periodo_ant,
       year(d) AS anio, month(d) AS mes, {month('d')} AS fec_inicio, last_day(d) AS fec_fin,
       {month('d - INTERVAL 2 MONTH')} AS fec_inicio_ant,
       last_day(CAST(d - INTERVAL 2 MONTH AS DATE)) AS fec_fin_ant
FROM days""",
    "months_desc": f"""WITH {ORDER_BOUNDS},
m AS (SELECT CAST(unnest(generate_series(date_trunc('year', first), date_trunc('month', last), INTERVAL 1 MONTH)) AS DATE) AS periodo
      FROM bounds)
SELECT CAST(row_number() OVER (ORDER BY periodo DESC) AS INTEGER) AS posicion, periodo FROM m""",
    "rolling_months": f"""WITH {spine_sql("date_trunc('month', first)")}
SELECT o_orderkey, {month('o_orderdate')} AS mes_orden, d AS fec_inicio,
       last_day(CAST(d - INTERVAL 2 MONTH AS DATE)) AS fec_fin_ant
FROM orders JOIN days ON {month('o_orderdate')} BETWEEN d - INTERVAL 2 MONTH AND last_day(d)""",
    "default_periods": f"""SELECT DISTINCT CAST(o_orderdate AS DATE) AS as_of,
       CASE WHEN month(o_orderdate) <= 6 THEN make_date(year(o_orderdate) - 1, 1, 1)
            ELSE make_date(year(o_orderdate), 1, 1) END AS periodo_inicio,
       {month('o_orderdate')} AS periodo_fin
FROM orders""",
    "product_dim": f"WITH {PRODUCTS}, {LINES}, {PRODUCT_DIM} SELECT * FROM ranked",
    "product_dim_no_line": f"WITH {PRODUCTS}, {LINES}, {DIRECT} SELECT * FROM no_line",
    "ledger_pivot": f"""SELECT {txt('p_partkey')} AS id_producto, '01' AS codcia,
       'L' || p_brand AS id_producto_cont_erp_legado, 'N' || p_partkey AS id_producto_cont_erp_nuevo
FROM part""",
    "ledger_reverse": f"""SELECT 'L' || p_brand AS cod_producto_contable, {txt('p_partkey')} AS id_producto, '01' AS codcia
FROM part WHERE p_type <> 'ECONOMY'
UNION SELECT 'N' || p_partkey, {txt('p_partkey')}, '01' FROM part
UNION SELECT 'M' || p_brand, {txt('p_partkey')}, '02' FROM part""",
    "line_map": f"""WITH {CUSTOMER_LINES}
SELECT id_ramo, des_ramo, id_ramo_contable, des_ramo_erp, des_ramo_contable, codcia,
       row_number() OVER (PARTITION BY id_ramo_contable ORDER BY id_ramo) AS ord,
       row_number() OVER (PARTITION BY des_ramo_contable ORDER BY id_ramo) AS ord2
FROM linea WHERE c_mktsegment <> 'FURNITURE'""",
    "line_map_distinct": f"""WITH {CUSTOMER_LINES}
SELECT DISTINCT id_ramo, des_ramo, id_ramo_contable, des_ramo_erp, des_ramo_contable, codcia
FROM linea WHERE c_acctbal > 0""",
    "current_policies": f"""WITH {PRODUCTS}, {LINES}, {PRODUCT_DIM},
po AS (
  SELECT CAST(date_trunc('year', l_shipdate) AS DATE) AS periodo, {txt('l_orderkey')} AS id_poliza,
         {txt('l_linenumber')} AS id_certificado, {txt('l_suppkey')} AS id_contratante,
         CASE WHEN l_quantity > 2 THEN {txt('l_suppkey')} END AS id_titular,
         {txt('l_partkey')} AS id_producto, l_linestatus, l_returnflag, CAST(l_shipdate AS DATE) AS inicio
  FROM lineitem WHERE l_orderkey <> 0),
joined AS (
  SELECT po.*, pr.cod_producto, o.o_custkey, c.c_nationkey, c.c_mktsegment
  FROM po JOIN ranked pr ON pr.id_producto = po.id_producto AND pr.ord = 1
  LEFT JOIN orders o ON {txt('o.o_orderkey')} = po.id_poliza AND year(o.o_orderdate) = year(po.periodo)
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  QUALIFY row_number() OVER (PARTITION BY po.periodo, po.id_poliza, po.id_certificado
    ORDER BY po.id_titular NULLS FIRST, po.id_producto, po.id_contratante, po.l_linestatus,
      po.l_returnflag, po.inicio) = 1)
SELECT periodo, id_poliza, 'O' || id_poliza AS id_poliza_origen, id_contratante, id_certificado,
       cod_producto, id_titular, 'N' || id_poliza AS num_poliza, l_linestatus AS id_est_poliza,
       l_returnflag AS id_est_certificado, 'AX' AS id_origen, id_producto,
       id_contratante AS id_intermediario, l_linestatus AS id_canal, 'C' || l_linestatus AS des_canal,
       inicio AS fec_inicio_vigencia, CAST(inicio + INTERVAL 12 MONTH AS DATE) AS fec_fin_vigencia,
       inicio AS fec_inicio_vigencia_certificado,
       CAST(inicio + INTERVAL 12 MONTH AS DATE) AS fec_fin_vigencia_certificado,
       CAST(NULL AS DATE) AS fec_anulacion, CAST(NULL AS DATE) AS fec_exclusion_certificado,
       'NO' AS ind_fronting, l_linestatus AS id_moneda, l_returnflag AS id_subcanal,
       'T' || l_returnflag AS des_subtipocanal, o_custkey AS id_equivalencia_canal,
       'EC' || c_nationkey AS id_estructura_comercial, {txt('c_nationkey')} AS id_canal_equivalente,
       'CE' || c_nationkey AS des_canal_equivalente,
       CASE WHEN c_mktsegment = 'BUILDING' THEN '301' ELSE {txt('c_nationkey')} END AS id_subcanal_equivalente,
       'SE' || c_nationkey AS des_subcanal_equivalente, c_mktsegment[1:1] AS id_segmentacion_01,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'T' || l_returnflag ELSE c_mktsegment END AS des_segmentacion_01,
       c_mktsegment[1:2] AS id_segmentacion_02, lower(c_mktsegment) AS des_segmentacion_02,
       {txt('c_nationkey')} AS cod_agrupacion_canal, 'AG' || c_nationkey AS des_agrupacion_canal
FROM joined""",
    "fx_rates": """SELECT CAST(ts AS DATE) AS fec_tasa,
       CAST(max(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,6)) ELSE 0 END) AS DECIMAL(18,6)) AS tc_a_usd,
       CAST(max(CASE WHEN event_type <> 'purchase' THEN CAST(value AS DECIMAL(18,6)) ELSE 0 END) AS DECIMAL(18,6)) AS tc_a_sol
FROM events WHERE event_type IN ('purchase', 'view', 'click') GROUP BY 1""",
    "snapshot": """SELECT user_id, event_id, event_type, value, ts FROM (
  SELECT * FROM events WHERE ts <= TIMESTAMP '2024-01-20 05:00:00'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
WHERE event_type <> 'error'""",
    "upstream_read_time": """SELECT recurso,
       CASE WHEN TIMESTAMP '2024-02-03 00:00:00' - INTERVAL 7 DAY < max(f) THEN max(f)
            ELSE TIMESTAMP '2024-02-03 00:00:00' - INTERVAL 1 DAY END AS as_of
FROM (SELECT event_type AS recurso, CASE WHEN event_type = 'error' THEN ts - INTERVAL 10 DAY ELSE ts END AS f
      FROM events) GROUP BY 1""",
    "managed_result": f"""SELECT {month('o_orderdate')} AS periodo, {txt('o_custkey')} AS id_producto,
       o_orderstatus AS moneda, {money('o_totalprice')} AS mnt_ingresado_neto_moneda,
       TIMESTAMP '2001-06-30 05:00:00' AS time_travel_rtg
FROM orders WHERE o_orderdate <= TIMESTAMP '2001-06-30 05:00:00'
QUALIFY row_number() OVER (PARTITION BY o_custkey, {month('o_orderdate')}
  ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "financial_filter": f"WITH {FINANCIAL} SELECT {FINANCIAL_COLUMNS} FROM financial WHERE {FINANCIAL_ROWS}",
    "financial_facts": f"""WITH {FINANCIAL},
latest AS (SELECT max(o_orderdate) AS f FROM orders WHERE o_orderstatus = 'F'),
as_of AS (SELECT CASE WHEN TIMESTAMP '2001-08-03' - INTERVAL 7 DAY < f THEN f
                      ELSE TIMESTAMP '2001-08-03' - INTERVAL 1 DAY END AS t FROM latest),
current AS (
  SELECT * FROM financial WHERE o_orderdate <= (SELECT t + INTERVAL 5 HOUR FROM as_of)
  QUALIFY row_number() OVER (PARTITION BY id_dato_financiero, periodo
    ORDER BY o_orderdate DESC, l_shipdate DESC, l_suppkey DESC, id_producto DESC) = 1)
SELECT * EXCLUDE (o_orderdate, l_shipdate, l_suppkey) FROM current WHERE {FINANCIAL_ROWS}""",
    "snapshot_versions": f"""SELECT {month('o_orderdate')} AS periodo, strftime(o_orderdate, '%Y%m') AS id_periodo,
       {txt('o_custkey % 10')} AS id_producto, CASE WHEN o_orderstatus = 'F' THEN 'SOL' ELSE 'USD' END AS moneda,
       o_orderpriority AS des_cuenta_contable, {', '.join(f"'{c}-' || o_orderstatus AS {c}" for c in MANAGED_TEXTS)},
       {', '.join(f"CAST(month(o_orderdate) AS DECIMAL(18,2)) AS {c}" for c in MANAGED_AMOUNTS)},
       TIMESTAMP '2024-01-11 06:00:00' AS time_travel_rtg
FROM orders WHERE o_orderstatus <> 'P' AND {month('o_orderdate')} BETWEEN {FIRST} AND {LAST}""",
    "run_params": f"""SELECT CASE WHEN month(d) <= 6 THEN make_date(year(d) - 1, 1, 1) ELSE make_date(year(d), 1, 1) END AS inicio,
       {month('d')} AS fin, {month('d')} AS actual, DATE '2024-04-01' AS corte, 'run_prima' AS tabla
FROM (SELECT max(o_orderdate) AS d FROM orders)""",
    "typed_columns": f"""SELECT {txt('o_orderkey')} AS order_id, CAST(o_custkey AS INTEGER) AS emp_id,
       {money('o_totalprice')} AS monto, CAST(o_orderdate AS DATE) AS fecha,
       TRY_CAST(o_orderpriority AS INTEGER) AS prioridad_num FROM orders""",
    "soft_delete_filter": """SELECT event_id, user_id, event_type, value, 0 AS anulado FROM events
WHERE event_type NOT IN ('error', 'signup') AND value <> 0 AND user_id IS NOT NULL""",
    "latest_order": """SELECT o_custkey, o_orderkey, d AS o_orderdate, o_orderstatus
FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS d FROM orders)
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY d DESC NULLS LAST, o_orderkey DESC) = 1""",
    "employee_master": f"WITH {HR} SELECT * FROM master",
    "open_absences": f"WITH {HR} SELECT * FROM absences",
    "absence_calendar": f"""WITH {HR}
SELECT m.*, a."Anio", a."Mes", a.cuenta_ausentismo FROM master m JOIN absences a ON a.emp_id = m.emp_id""",
    "semi_policies": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')""",
    "distinct_after_rank": RANKED_LINES,
    "rank_hot": RANKED_LINES,
    "sync_current_status": f"WITH {LOG} SELECT order_id, status, flow_type, ts FROM status",
    "sync_status_of_orders": f"""WITH {LOG}
SELECT {txt('o_orderkey')} AS order_id, o_orderdate AS created_at, o_orderstatus AS "BusinessStatus",
       coalesce(s.status, 'PENDING') AS "SyncStatus"
FROM orders LEFT JOIN status s ON s.order_id = {txt('o_orderkey')}""",
    "sync_claim": f"""WITH {LOG}
SELECT order_id, 'PROCESSING' AS status, {TRANSITION}, CAST(1 AS BIGINT) AS seq
FROM claims ORDER BY created_at, order_id LIMIT 1000""",
    "sync_claim_all": f"""WITH {LOG}
SELECT order_id, 'PROCESSING' AS status, {TRANSITION}, CAST(1 AS BIGINT) AS seq FROM claims""",
    "sync_stage": f"""WITH {LOG}, {STAGED}
SELECT order_id, part, parts, business AS "BusinessStatus", CAST(n_items AS INTEGER) AS n_items,
       CAST(amount AS DECIMAL(28,2)) AS amount FROM staged""",
    "sync_envelope": f"""WITH {LOG}, {STAGED},
identified AS (
  SELECT *, sha256(order_id || '|2024-02-01T00:00:00.000|orders|' || part) AS correlation_id FROM staged)
SELECT order_id, part, correlation_id,
       '{{"headers":{{"correlation_id":"' || correlation_id || '","flow_type":"orders",'
       || '"run_timestamp":"2024-02-01T00:00:00.000","part":' || part || ',"parts":' || parts
       || '}},"data":{{"order_id":"' || order_id || '","created_at":"'
       || strftime(created_at, '%Y-%m-%dT%H:%M:%S.%g') || '","business_status":"' || business
       || '","items":[' || items || ']}}}}' AS message
FROM identified""",
    "sync_settle": f"""WITH {LOG}
SELECT c.order_id, CASE WHEN c.business = 'F' AND o_totalprice < 400000 THEN 'DISPATCHED' ELSE 'PENDING' END AS status,
       {TRANSITION}, CAST(2 AS BIGINT) AS seq
FROM claims c JOIN orders ON {txt('o_orderkey')} = c.order_id""",
    "sync_rollback": f"""WITH {LOG}
SELECT order_id, 'PENDING' AS status, TIMESTAMP '2024-01-30 00:00:00' AS run_ts, 'a' AS flow_type,
       TIMESTAMP '2024-02-03 00:00:00' AS ts, CAST(3 AS BIGINT) AS seq
FROM status WHERE status = 'PROCESSING' AND flow_type = 'a' AND run_ts = TIMESTAMP '2024-01-30 00:00:00'""",
    "sync_orphans": f"""WITH {LOG}
SELECT order_id, status, flow_type, ts FROM status
WHERE status = 'PROCESSING' AND ts < TIMESTAMP '2024-01-30 20:00:00'""",
    "publish_roundtrip": f"""WITH {PREMIUM}
SELECT periodo, id_moneda, count(*) AS filas, CAST(sum(mnt_usd) AS DECIMAL(38,2)) AS mnt_usd
FROM premium GROUP BY ALL""",
    "stream_sync": f"""SELECT {txt('o_orderkey')} AS order_id, CAST(1 AS BIGINT) AS messages, 'DISPATCHED' AS status
FROM orders WHERE o_orderstatus IN ('F', 'O') AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "stream_changes": SENT_ONCE,
    "stream_moved_dates": SENT_ONCE,
    "stream_items": SENT_ONCE,
    "sync_retry": SENT_ONCE,
}
ORACLES["publish_versions"] = ORACLES["publish_roundtrip"]
ORACLES["run_ledger_roundtrip"] = ORACLES["upstream_read_time"]
ORACLES["cascade_refresh"] = ORACLES["cascade_totals"]
ORACLES["run_absence"] = ORACLES["absence_calendar"]
ORACLES["current_policies_period"] = f"""SELECT * FROM ({ORACLES["current_policies"]}) WHERE periodo = DATE '1997-01-01'"""
ORACLES["typed_columns_rejects"] = """SELECT 'order_id' AS columna, count(*) FILTER (TRY_CAST(o_orderkey AS TINYINT) IS NULL) AS rechazados FROM orders
UNION ALL SELECT 'emp_id', count(*) FILTER (TRY_CAST(o_custkey AS INTEGER) IS NULL) FROM orders
UNION ALL SELECT 'prioridad_num', count(*) FILTER (TRY_CAST(o_orderpriority AS INTEGER) IS NULL) FROM orders
UNION ALL SELECT 'estado', count(*) FILTER (TRY_CAST(o_orderstatus AS DATE) IS NULL) FROM orders"""
# The run takes the policies of its own period instead of all orders.
OWN_POLICIES = f"""policy AS (
  SELECT id_poliza, id_certificado, id_poliza_origen, id_contratante, id_titular
  FROM ({ORACLES["current_policies_period"]})),
"""
RUN_DIRECT = DIRECT[:DIRECT.index("policy AS (")] + OWN_POLICIES + DIRECT[DIRECT.index("joined AS ("):]
ORACLES["run_published"] = f"""WITH {SPINE}, {PRODUCTS}, {LINES}, {PRODUCT_DIM}, {RUN_DIRECT},
premium AS (SELECT * FROM direct),
existing AS (SELECT id_poliza FROM policy),
product AS (SELECT * FROM ranked WHERE ord = 1),
{cascade_cte()}
SELECT periodo_trim, count(*) AS filas, CAST(sum(mnt_usd) AS DECIMAL(38,2)) AS mnt_usd, CAST(0 AS BIGINT) AS tablas_de_corrida
FROM casc GROUP BY periodo_trim
UNION ALL SELECT NULL, count(*), CAST(sum(mnt_usd) AS DECIMAL(38,2)), CAST(0 AS BIGINT) FROM direct"""
