"""Portable SQL for every checkable query, over the order tables."""

_FEEDS = """
WITH cliente AS (
  SELECT c_custkey * 2 AS cliente_id, c_name AS nombre_fiscal FROM customer
  UNION ALL
  SELECT s_suppkey * 2 + 1, s_name FROM supplier),
titular AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN -1 - o_custkey ELSE o_custkey * 2 END AS cliente_id,
         o_orderdate, o_orderpriority, o_orderstatus
  FROM orders),
linea AS (
  SELECT l_orderkey, l_orderkey * 10 + l_linenumber AS factura_id, l_returnflag, l_tax,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS cant_comision,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS cant_descuento,
         CAST(ROUND(l_discount * 100) AS INT) AS tasa_descuento,
         CAST(FLOOR(l_quantity * 5 / 2) AS INT) + CAST(ROUND(l_discount * 100) AS INT) - 5 AS dias_pago
  FROM lineitem),
factura AS (
  SELECT factura_id, cliente_id, CONCAT('Cliente ', cliente_id) AS nombre_fiscal, cant_comision, tasa_descuento, dias_pago
  FROM linea JOIN titular ON l_orderkey = o_orderkey),
partida AS (
  SELECT l_orderkey, cant_comision, dias_pago FROM linea WHERE l_returnflag <> 'R'
  UNION ALL
  SELECT l_orderkey, cant_descuento, dias_pago - 30 FROM linea WHERE l_returnflag = 'A'),
item AS (
  SELECT l_orderkey AS anexo_id, cant_comision, dias_pago,
         CASE WHEN dias_pago > 0 AND dias_pago <= 30 THEN '0-30' WHEN dias_pago BETWEEN 31 AND 45 THEN '31-45'
              WHEN dias_pago BETWEEN 46 AND 89 THEN '46-89' WHEN dias_pago = 90 THEN '90'
              WHEN dias_pago > 90 THEN '>90' END AS dias
  FROM partida),
item_cliente AS (
  SELECT item.*, cliente_id FROM item JOIN titular ON anexo_id = o_orderkey),
anexo AS (
  SELECT o_orderkey AS anexo_id, cliente_id, o_orderpriority AS estatus,
         CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 9 WHEN '2-HIGH' THEN 10 WHEN '3-MEDIUM' THEN 4
                                   WHEN '4-NOT SPECIFIED' THEN 5 ELSE 1 END AS INT) AS estatus_id,
         CAST(o_orderdate AS DATE) AS created_on
  FROM titular),
tramo AS (
  SELECT dias FROM (VALUES ('0-30'), ('31-45'), ('46-89'), ('90'), ('>90')) v(dias)),
usuario AS (
  SELECT CONCAT('U-', c_custkey) AS id, LOWER(c_name) AS email, c_mktsegment AS status,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN CONCAT('PL', c_custkey) END AS license_plates
  FROM customer
  UNION ALL
  SELECT CONCAT('P-', s_suppkey), LOWER(s_name), NULL, CONCAT('PS', s_suppkey) FROM supplier
  UNION ALL
  SELECT CONCAT('U-', n_nationkey), LOWER(n_name), NULL, NULL FROM nation),
usuario_destino AS (
  SELECT p_partkey * 2 AS id, CONCAT('U-', p_partkey) AS id_user_sb, p_name AS email, p_brand AS status, p_type AS license_plates
  FROM part
  UNION ALL
  SELECT s_suppkey * 2 + 1, CONCAT('U-', s_suppkey), s_name, 'OLD', NULL FROM supplier),
origen AS (
  SELECT id, COUNT(*) AS veces, MIN(email) AS email, MIN(status) AS status, MIN(license_plates) AS license_plates
  FROM usuario GROUP BY id),
destino AS (
  SELECT d.*, ROW_NUMBER() OVER (PARTITION BY id_user_sb ORDER BY id) AS rn FROM usuario_destino d),
cruce AS (
  SELECT COALESCE(o.id, d.id_user_sb) AS id, d.id AS target_id,
         CASE WHEN d.rn > 1 THEN 'delete' WHEN o.veces > 1 THEN 'keep' WHEN o.id IS NULL THEN 'delete'
              WHEN d.id IS NULL THEN 'insert' ELSE 'update' END AS action,
         o.email, o.status, o.license_plates,
         d.email AS email_antes, d.status AS status_antes, d.license_plates AS plates_antes
  FROM origen o FULL OUTER JOIN destino d ON o.id = d.id_user_sb
  WHERE o.veces IS NULL OR o.veces = 1 OR d.id IS NOT NULL),
dias_antes AS (
  SELECT c_custkey * 4 AS id, CONCAT('CLIENTE-', c_custkey * 2) AS id_analisis, UPPER(c_name) AS cliente,
         CAST(-1 AS DOUBLE) AS dias_promedio,
         CAST(CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN '2001-08-01 09:00:00' ELSE '2001-07-31 09:00:00' END AS TIMESTAMP) AS created_at
  FROM customer
  UNION ALL
  SELECT c_custkey * 4 + 1, CONCAT('CLIENTE-', c_custkey * 2), UPPER(c_name), CAST(-2 AS DOUBLE),
         CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN '2001-08-01 10:00:00' ELSE '2001-08-02 00:00:00' END AS TIMESTAMP)
  FROM customer
  UNION ALL
  SELECT s_suppkey * 4 + 2 + copia, CONCAT('CLIENTE-', s_suppkey * 2 + 1), s_name, CAST(-3 AS DOUBLE), TIMESTAMP '2001-08-01 00:00:00'
  FROM supplier CROSS JOIN (VALUES (0), (1)) v(copia)),
dias_hoy AS (
  SELECT p.*, ROW_NUMBER() OVER (PARTITION BY id_analisis ORDER BY id) AS rn FROM dias_antes p
  WHERE created_at >= TIMESTAMP '2001-08-01 00:00:00' AND created_at < TIMESTAMP '2001-08-02 00:00:00'),
dias_nuevo AS (
  SELECT CONCAT('CLIENTE-', c.cliente_id) AS id_analisis, MIN(c.nombre_fiscal) AS cliente, AVG(dias_pago) AS dias_promedio
  FROM factura f JOIN cliente c ON f.cliente_id = c.cliente_id GROUP BY c.cliente_id),
dias_cruce AS (
  SELECT h.id, COALESCE(n.id_analisis, h.id_analisis) AS id_analisis, n.cliente, n.dias_promedio,
         h.cliente AS cliente_antes, h.dias_promedio AS dias_antes, h.created_at,
         CASE WHEN h.id IS NULL THEN 'insert' WHEN n.id_analisis IS NULL THEN 'keep' WHEN h.rn = 1 THEN 'update' ELSE 'delete' END AS action
  FROM dias_nuevo n FULL OUTER JOIN dias_hoy h ON h.id_analisis = n.id_analisis),
grafica_hoy AS (
  SELECT o_orderkey AS id, CONCAT('CLIENTE-', cliente_id) AS id_analisis,
         CASE o_orderpriority WHEN '1-URGENT' THEN '0-30' WHEN '2-HIGH' THEN '31-45' WHEN '3-MEDIUM' THEN '46-89'
                              WHEN '4-NOT SPECIFIED' THEN '90' ELSE '>90' END AS dias
  FROM titular WHERE o_orderstatus <> 'O'),
grafica_nuevo AS (
  SELECT CONCAT('CLIENTE-', c.cliente_id) AS id_analisis, MIN(c.nombre_fiscal) AS cliente, t.dias,
         CAST(COALESCE(SUM(cant_comision), 0) AS DECIMAL(28,4)) AS total_facturado
  FROM cliente c CROSS JOIN tramo t LEFT JOIN item_cliente i ON i.dias = t.dias AND i.cliente_id = c.cliente_id
  GROUP BY c.cliente_id, t.dias),
pareto_nuevo AS (
  SELECT CONCAT('CLIENTE-', f.cliente_id) AS id_analisis, f.nombre_fiscal AS cliente, f.tasa_descuento AS tasa_cliente,
         CAST(SUM(cant_comision) AS DECIMAL(28,4)) AS importe
  FROM factura f WHERE EXISTS (SELECT 1 FROM cliente c WHERE c.cliente_id = f.cliente_id)
  GROUP BY f.cliente_id, f.nombre_fiscal, f.tasa_descuento),
pareto_hoy AS (
  SELECT c_custkey * 2 AS id, CONCAT('CLIENTE-', c_custkey * 2) AS id_analisis, c_name AS cliente, 3 AS tasa_cliente
  FROM customer
  UNION ALL
  SELECT c_custkey * 2 + 1, CONCAT('CLIENTE-', c_custkey * 2), CONCAT('Cliente ', c_custkey * 2), c_nationkey FROM customer)
"""

# Jobs that are also run through the input contract.
JOBS = ("rate_indicators", "annex_indicators", "credit_days", "billed_by_term", "clients_by_term", "pareto_client_commission")

_RATES = """MIN(tasa_descuento) AS tasa_minima, MAX(tasa_descuento) AS tasa_maxima, AVG(tasa_descuento) AS media"""

_STATUS = """COUNT(CASE WHEN created_on = DATE '2001-08-01' THEN 1 END) AS generados,
  COUNT(CASE WHEN estatus_id IN (9,10) THEN 1 END) AS aceptados,
  COUNT(CASE WHEN estatus_id = 4 THEN 1 END) AS pagados, COUNT(CASE WHEN estatus_id = 5 THEN 1 END) AS cancelados"""

_ALL = "'TODOS' AS id_analisis, 'Todos' AS cliente"
_CLIENT = "CONCAT('CLIENTE-', c.cliente_id) AS id_analisis, c.nombre_fiscal AS cliente"
_BY_CLIENT = "GROUP BY c.cliente_id, c.nombre_fiscal"
_BILLED = "CAST(COALESCE(SUM(cant_comision), 0) AS DECIMAL(28,4)) AS total_facturado"


def _rates_all(lines: str) -> str:
    return f"""SELECT {_ALL}, a.tasa_minima, a.tasa_maxima, a.media, a.media AS promedio, m.moda
FROM (SELECT {_RATES} FROM {lines}) a
CROSS JOIN (SELECT tasa_descuento AS moda FROM {lines} GROUP BY tasa_descuento ORDER BY COUNT(*) DESC, tasa_descuento LIMIT 1) m"""


_QUERIES = {
    "rate_indicators_all": _rates_all("linea"),
    "rate_indicators_by_client": f"""SELECT {_CLIENT}, a.tasa_minima, a.tasa_maxima, a.media, a.media AS promedio, m.moda
FROM cliente c
JOIN (SELECT cliente_id, {_RATES} FROM factura GROUP BY cliente_id) a ON a.cliente_id = c.cliente_id
JOIN (SELECT cliente_id, moda FROM (
        SELECT cliente_id, tasa_descuento AS moda,
               ROW_NUMBER() OVER (PARTITION BY cliente_id ORDER BY COUNT(*) DESC, tasa_descuento) AS rn
        FROM factura GROUP BY cliente_id, tasa_descuento) z WHERE rn = 1) m ON m.cliente_id = c.cliente_id""",
    "annex_indicators_all": f"SELECT {_ALL}, {_STATUS} FROM anexo",
    "annex_indicators_by_client": f"""SELECT {_CLIENT}, {_STATUS}
FROM anexo a JOIN cliente c ON a.cliente_id = c.cliente_id {_BY_CLIENT}""",
    "credit_days_all": f"SELECT {_ALL}, AVG(dias_pago) AS dias_promedio FROM linea",
    "credit_days_by_client": f"""SELECT {_CLIENT}, AVG(dias_pago) AS dias_promedio
FROM factura f JOIN cliente c ON f.cliente_id = c.cliente_id {_BY_CLIENT}""",
    "billed_by_term_all": f"""SELECT {_ALL}, t.dias, {_BILLED}
FROM tramo t LEFT JOIN item i ON i.dias = t.dias GROUP BY t.dias""",
    "billed_by_term_by_client": f"""SELECT {_CLIENT}, t.dias, {_BILLED}
FROM cliente c CROSS JOIN tramo t LEFT JOIN item_cliente i ON i.dias = t.dias AND i.cliente_id = c.cliente_id
{_BY_CLIENT}, t.dias""",
    "clients_by_term_all": f"""SELECT {_ALL}, t.dias, COUNT(DISTINCT i.cliente_id) AS no_clientes
FROM tramo t LEFT JOIN item_cliente i ON i.dias = t.dias GROUP BY t.dias""",
    "clients_by_term_by_client": f"""SELECT {_CLIENT}, t.dias, COUNT(DISTINCT i.cliente_id) AS no_clientes
FROM cliente c CROSS JOIN tramo t LEFT JOIN item_cliente i ON i.dias = t.dias AND i.cliente_id = c.cliente_id
{_BY_CLIENT}, t.dias""",
    "pareto_client_commission": """SELECT CONCAT('CLIENTE-', f.cliente_id) AS id_analisis, f.nombre_fiscal AS cliente,
  f.tasa_descuento AS tasa_cliente, CAST(SUM(cant_comision) AS DECIMAL(28,4)) AS importe
FROM factura f WHERE EXISTS (SELECT 1 FROM cliente c WHERE c.cliente_id = f.cliente_id)
GROUP BY f.cliente_id, f.nombre_fiscal, f.tasa_descuento""",
    "rate_frequencies_by_client": """SELECT cliente_id, tasa_descuento, COUNT(*) AS n FROM factura
GROUP BY cliente_id, tasa_descuento""",
    "invoice_groups": """SELECT cliente_id, nombre_fiscal, tasa_descuento, COUNT(*) AS n, CAST(SUM(dias_pago) AS BIGINT) AS dias,
  COUNT(dias_pago) AS n_dias, CAST(SUM(cant_comision) AS DECIMAL(28,4)) AS importe
FROM factura GROUP BY cliente_id, nombre_fiscal, tasa_descuento""",
    "term_buckets": """SELECT cliente_id, dias, CAST(SUM(cant_comision) AS DECIMAL(28,4)) AS value
FROM item_cliente WHERE dias IS NOT NULL GROUP BY cliente_id, dias""",
    "annex_items_flatten": "SELECT anexo_id, cliente_id, cant_comision AS comision, dias_pago FROM item_cliente",
    "contract_unbucketed": "SELECT COUNT(*) AS n_unbucketed FROM item WHERE dias IS NULL",
    "contract_rejects": """SELECT CASE WHEN l_returnflag = 'R' THEN 'missing tasa_descuento' ELSE 'missing dias_pago' END AS reason,
  COUNT(*) AS n FROM linea WHERE l_returnflag = 'R' OR NOT (l_tax > 0) GROUP BY 1""",
    "contract_rejects_mixed": """SELECT CASE WHEN l_returnflag = 'R' THEN 'wrong type dias_pago' ELSE 'missing dias_pago' END AS reason,
  COUNT(*) AS n FROM linea WHERE NOT (l_tax > 0) GROUP BY 1""",
    "contract_accepted": """SELECT factura_id, cant_comision, tasa_descuento, dias_pago FROM linea
WHERE l_returnflag <> 'R' AND l_tax > 0""",
    "clients_unique": "SELECT cliente_id, MIN(nombre_fiscal) AS cliente FROM cliente GROUP BY cliente_id",
    "users_sync_plan": "SELECT id, target_id, action, "
    + ", ".join(f"CASE WHEN action IN ('insert', 'update') THEN {c} END AS {c}" for c in ("email", "status", "license_plates"))
    + " FROM cruce",
    "users_sync_apply": """SELECT id AS id_user_sb, CASE WHEN action = 'keep' THEN email_antes ELSE email END AS email,
  CASE WHEN action = 'keep' THEN status_antes ELSE status END AS status,
  CASE WHEN action = 'keep' THEN plates_antes ELSE license_plates END AS license_plates
FROM cruce WHERE action <> 'delete'""",
    "users_rejected": "SELECT id, veces AS rows, 'repeated id' AS reason FROM origen WHERE veces > 1",
    "users_target_ids": "SELECT id_user_sb FROM usuario_destino",
    "dashboard_today": "SELECT id, id_analisis, dias_promedio FROM dias_hoy",
    "snapshot_merge_plan": "SELECT id, id_analisis, cliente, dias_promedio, action FROM dias_cruce",
    "snapshot_merge_state": """SELECT id_analisis, CASE WHEN action = 'insert' THEN cliente ELSE cliente_antes END AS cliente,
  CASE WHEN action = 'keep' THEN dias_antes ELSE dias_promedio END AS dias_promedio,
  CAST(COALESCE(created_at, TIMESTAMP '2001-08-01 00:00:00') AS VARCHAR) AS created_at
FROM dias_cruce WHERE action <> 'delete'""",
    "snapshot_merge_plan_pareto": """SELECT h.id, COALESCE(n.id_analisis, h.id_analisis) AS id_analisis,
  COALESCE(n.cliente, h.cliente) AS cliente, COALESCE(n.tasa_cliente, h.tasa_cliente) AS tasa_cliente, n.importe,
  CASE WHEN h.id IS NULL THEN 'insert' WHEN n.id_analisis IS NOT NULL THEN 'update'
       WHEN h.id_analisis IN (SELECT id_analisis FROM pareto_nuevo) THEN 'delete' ELSE 'keep' END AS action
FROM pareto_nuevo n FULL OUTER JOIN pareto_hoy h
ON h.id_analisis = n.id_analisis AND h.cliente = n.cliente AND h.tasa_cliente = n.tasa_cliente""",
    "scan_invoices": """SELECT l_orderkey AS factura_id, l_suppkey AS cliente_id, l_returnflag AS nombre_fiscal,
  CAST(NULL AS DECIMAL(18,4)) AS cant_comision, l_linenumber AS tasa_descuento, CAST(NULL AS INT) AS dias_pago,
  CAST(NULL AS VARCHAR) AS created_at FROM lineitem""",
    "scan_annexes": """SELECT o_orderkey AS anexo_id, o_custkey AS cliente_id, o_orderpriority AS estatus,
  CAST(NULL AS INT) AS estatus_id, o_orderstatus AS created_at, CAST(NULL AS DATE) AS created_on FROM orders""",
    "scan_clients": "SELECT c_custkey AS cliente_id, c_name AS nombre_fiscal FROM customer",
    "scan_users": """SELECT c_name AS id, c_mktsegment AS email, CAST(NULL AS VARCHAR) AS status,
  CAST(NULL AS VARCHAR) AS license_plates FROM customer""",
    "scan_users_target": """SELECT p_partkey AS id, p_name AS id_user_sb, p_brand AS email, p_type AS status,
  CAST(NULL AS VARCHAR) AS license_plates FROM part""",
    "preview_size": "SELECT LEAST(COUNT(*), 10) AS n FROM lineitem",
    "snapshot_merge_plan_terms": """SELECT h.id, COALESCE(n.id_analisis, h.id_analisis) AS id_analisis, COALESCE(n.dias, h.dias) AS dias,
  n.cliente, n.total_facturado,
  CASE WHEN h.id IS NULL THEN 'insert' WHEN n.id_analisis IS NULL THEN 'keep' WHEN h.rn = 1 THEN 'update' ELSE 'delete' END AS action
FROM grafica_nuevo n FULL OUTER JOIN (
  SELECT g.*, ROW_NUMBER() OVER (PARTITION BY id_analisis, dias ORDER BY id) AS rn FROM grafica_hoy g) h
ON h.id_analisis = n.id_analisis AND h.dias = n.dias""",
}

# Items without a field that the chart uses are left out of it; the date is used by none.
_LOOSE_ITEMS = """SELECT dias_pago, cant_comision, l_tax, l_returnflag, tasa_descuento, cliente_id,
  CASE WHEN dias_pago > 0 AND dias_pago <= 30 THEN '0-30' WHEN dias_pago BETWEEN 31 AND 45 THEN '31-45'
       WHEN dias_pago BETWEEN 46 AND 89 THEN '46-89' WHEN dias_pago = 90 THEN '90' WHEN dias_pago > 90 THEN '>90' END AS dias
  FROM linea JOIN titular ON l_orderkey = o_orderkey WHERE tasa_descuento <= 5"""


def _loose_chart(figure: str, items: str) -> str:
    return f"""SELECT {_ALL}, t.dias, {figure} FROM tramo t LEFT JOIN ({items}) i ON i.dias = t.dias GROUP BY t.dias
UNION ALL SELECT {_CLIENT}, t.dias, {figure} FROM cliente c CROSS JOIN tramo t
LEFT JOIN ({items}) i ON i.dias = t.dias AND i.cliente_id = c.cliente_id {_BY_CLIENT}, t.dias"""


_QUERIES |= {
    "job_billed_by_term_loose": _loose_chart(_BILLED, f"{_LOOSE_ITEMS} AND l_tax > 0"),
    "job_clients_by_term_loose": _loose_chart("COUNT(DISTINCT i.cliente_id) AS no_clientes", _LOOSE_ITEMS),
    "billed_by_term_no_facts": f"""SELECT {_ALL}, dias, CAST(0 AS DECIMAL(28,4)) AS total_facturado FROM tramo
UNION ALL SELECT {_CLIENT}, dias, CAST(0 AS DECIMAL(28,4)) FROM cliente c CROSS JOIN tramo {_BY_CLIENT}, dias""",
    "invoice_preview_rows": "SELECT LEAST(COUNT(*), 10) AS n_drawn, LEAST(COUNT(*), 10) AS n_invoices FROM linea",
    "snapshot_versions_state": _QUERIES["snapshot_merge_state"],
    # Target rows of brand 13 have no row id. They stay; a user who has no other row is not inserted.
    "users_sync_plan_unreadable": """SELECT id, target_id, action,
  CASE WHEN action IN ('insert', 'update') THEN email END AS email,
  CASE WHEN action IN ('insert', 'update') THEN status END AS status,
  CASE WHEN action IN ('insert', 'update') THEN license_plates END AS license_plates
FROM (
  SELECT COALESCE(o.id, d.id_user_sb) AS id, d.id AS target_id, o.email, o.status, o.license_plates,
    CASE WHEN d.rn > 1 THEN 'delete' WHEN o.id IS NULL THEN 'delete' WHEN o.veces > 1 OR o.email IS NULL THEN 'keep' ELSE 'update' END AS action
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id_user_sb ORDER BY id) AS rn FROM usuario_destino WHERE status <> 'Brand#13') d
  LEFT JOIN origen o ON o.id = d.id_user_sb
  UNION ALL
  SELECT id, NULL, email, status, license_plates, 'insert' FROM origen
  WHERE veces = 1 AND email IS NOT NULL AND id NOT IN (SELECT id_user_sb FROM usuario_destino)
  UNION ALL
  SELECT id_user_sb, NULL, NULL, NULL, NULL, 'keep' FROM usuario_destino WHERE status = 'Brand#13') p""",
}

# The combined frames are the portfolio rows followed by the client rows, over the invoices that have a client.
_BOTH = {
    "rate_indicators": (_rates_all("factura"), "rate_indicators_by_client"),
    "annex_indicators": (_QUERIES["annex_indicators_all"], "annex_indicators_by_client"),
    "credit_days": (f"SELECT {_ALL}, AVG(dias_pago) AS dias_promedio FROM factura", "credit_days_by_client"),
    "billed_by_term": (
        f"SELECT {_ALL}, t.dias, {_BILLED} FROM tramo t LEFT JOIN item_cliente i ON i.dias = t.dias GROUP BY t.dias",
        "billed_by_term_by_client",
    ),
    "clients_by_term": (_QUERIES["clients_by_term_all"], "clients_by_term_by_client"),
}


# The same figures by way of the shared aggregates.
_SAME = {
    "rate_indicators_of_groups": "rate_indicators",
    "credit_days_of_groups": "credit_days",
    "billed_by_term_of_buckets": "billed_by_term",
    "clients_by_term_of_buckets": "clients_by_term",
}


def all_checks() -> dict[str, str]:
    both = {
        name: f"SELECT * FROM ({whole}) w UNION ALL SELECT * FROM ({_QUERIES[part]}) p"
        for name, (whole, part) in _BOTH.items()
    }
    both |= {name: both[other] for name, other in _SAME.items()}
    both["pareto_of_groups"] = _QUERIES["pareto_client_commission"]
    both |= {f"job_{name}": both.get(name) or _QUERIES[name] for name in JOBS}
    return {name: f"{_FEEDS.strip()}\n{sql}" for name, sql in {**_QUERIES, **both}.items()}

