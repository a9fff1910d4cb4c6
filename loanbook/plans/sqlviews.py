"""The same data model as SQL common table expressions, for the oracle queries."""

import re

CTES = {
    "loans0": """
 SELECT o_orderkey AS legacy_cartera_id, o_custkey AS c_bpartner_id,
  CAST(o_orderkey % 5 AS INTEGER) AS ad_org_id, CAST(o_orderdate AS DATE) AS fecha,
  CASE left(o_orderpriority,1) WHEN '1' THEN 23 WHEN '2' THEN 30 WHEN '3' THEN 50
   WHEN '4' THEN 60 ELSE 90 END AS dias_cre,
  CAST(o_totalprice AS DECIMAL(18,2)) AS monto, CAST(0.15 AS DECIMAL(10,4)) AS tasa,
  CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'N' END AS synced,
  CASE WHEN o_orderkey % 10 = 0 THEN 'N' ELSE 'Y' END AS aprobado,
  CASE WHEN o_orderkey % 97 = 0 THEN 'N' ELSE 'Y' END AS isactive,
  CASE WHEN o_orderkey % 4 = 3 THEN 'migrated' ELSE 'native' END AS origen,
  o_orderkey % 12 AS createdby,
  (o_orderkey % 90)::VARCHAR || '.5|-' || (o_orderkey % 180)::VARCHAR || '.25' AS coords
 FROM orders""",
    "loans1": """
 SELECT *, CAST(round(monto * CAST(0.005 AS DECIMAL(4,3)) * CAST(dias_cre AS DECIMAL(4,0)), 4)
   AS DECIMAL(18,4)) AS valorinteres FROM loans0""",
    "loans2": """
 SELECT *, CAST(round(monto + valorinteres, 2) AS DECIMAL(18,2)) AS montototal FROM loans1""",
    "loans": """
 SELECT *, CAST(((2 * CAST(montototal * 10000 AS HUGEINT) + dias_cre) // (2 * dias_cre))
    AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(4,4)) AS cuota,
  CASE WHEN synced = 'Y' THEN legacy_cartera_id * 10 + 1 END AS local_id,
  CASE WHEN synced = 'Y' THEN legacy_cartera_id * 10 + 2 END AS payment_id
 FROM loans2""",
    "cobros0": """
 SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS legacy_cobro_id
 FROM lineitem""",
    "cobros": """
 SELECT legacy_cobro_id, l_orderkey AS id_cartera,
  CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.60 AS DECIMAL(3,2)), 2)
   AS DECIMAL(18,2)) AS abono,
  CAST(l_shipdate AS DATE) AS operacion, CAST(l_shipdate AS TIMESTAMP) + to_seconds(l_partkey % 86400) AS operacion_ts,
  CASE l_returnflag WHEN 'R' THEN 'Y' WHEN 'A' THEN 'N' END AS synced,
  CASE l_linestatus WHEN 'O' THEN 'native' ELSE 'migrated' END AS origen,
  l_suppkey AS createdby, CAST(l_suppkey % 5 AS INTEGER) AS ad_org_id,
  CASE WHEN l_returnflag = 'R' THEN 'P-' || legacy_cobro_id END AS local_id,
  (l_partkey % 90)::VARCHAR || '.125|-' || (l_suppkey % 180)::VARCHAR || '.75' AS coords
 FROM cobros0""",
    "cobros_own": """
 SELECT c.* EXCLUDE (id_cartera), CASE WHEN c.id_cartera % 50 <> 0 THEN c.id_cartera END AS id_cartera, o_custkey AS c_bpartner_id
 FROM cobros c JOIN orders ON o_orderkey = c.id_cartera""",
    "partners": """
 SELECT c_custkey AS c_bpartner_id, 'C' || c_custkey AS codigo, c_name AS nombre,
  c_nationkey AS cv_ruta_id, c_mktsegment AS rubro,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE
   lpad((c_custkey % 1000)::VARCHAR, 3, '0') || '-' || lpad((c_custkey % 28 + 1)::VARCHAR, 2, '0')
   || lpad((c_custkey % 12 + 1)::VARCHAR, 2, '0') || lpad((c_custkey % 100)::VARCHAR, 2, '0')
   || '-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') || 'K' END AS taxid,
  CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END AS genero,
  CASE c_custkey % 4 WHEN 0 THEN 'U' WHEN 1 THEN 'R' END AS tipo_localizacion,
  CASE c_custkey % 5 WHEN 0 THEN 'S' WHEN 1 THEN 'C' END AS civilstatus,
  substr('ABCDE', (c_custkey % 5 + 1)::INTEGER, 1) AS tipo_riesgo,
  CASE WHEN c_custkey % 2 = 0 THEN DATE '1960-01-01' + (c_custkey % 9000)::INTEGER END AS birthday,
  CAST(c_acctbal AS DECIMAL(18,2)) AS totalopenbalance,
  CAST(c_custkey % 4 AS INTEGER) AS c_greeting_id, c_custkey % 7 <> 0 AS has_location
 FROM customer""",
    "routes": """
 SELECT n_nationkey AS cv_ruta_id, n_name AS ruta, r_regionkey AS ad_org_trx_id, r_name AS sucursal
 FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "pwide": "SELECT * FROM partners JOIN routes USING (cv_ruta_id)",
    "branches": "SELECT r_regionkey AS ad_org_id, r_name AS org_name FROM region",
    "users": """
 SELECT s_suppkey AS ad_user_id, s_name AS usuario, s_nationkey AS user_ruta_id,
  CAST(s_suppkey % 20 AS INTEGER) AS c_bankaccount_id FROM supplier""",
    "owners": """
 SELECT user_ruta_id AS cv_ruta_id, min(ad_user_id) AS owner_id, arg_min(usuario, ad_user_id) AS owner
 FROM users GROUP BY 1""",
    "periods": """
 SELECT CAST(strftime(d, '%Y%m') AS INTEGER) AS c_period_id, strftime(d, '%Y-%m') AS name,
  CAST(d AS DATE) AS startdate, last_day(d) AS enddate
 FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS d)""",
    "caldays": """
 SELECT CAST(unnest(generate_series(DATE '1994-01-01', DATE '2003-12-31', INTERVAL 1 DAY)) AS DATE) AS d""",
    "cal": """
 SELECT d, isodow(d) <> 7 AS open, sum(CASE WHEN isodow(d) <> 7 THEN 1 ELSE 0 END)
   OVER (ORDER BY d ROWS UNBOUNDED PRECEDING) AS idx FROM caldays""",
    "opendays": "SELECT d, idx FROM cal WHERE open",
    "due6": """
 SELECT l.legacy_cartera_id, o.d AS vence6 FROM loans l JOIN cal c ON c.d = l.fecha
 JOIN opendays o ON o.idx = c.idx + l.dias_cre""",
    "pay": """
 SELECT event_id AS c_payment_id, CAST(user_id % 20 AS INTEGER) AS c_bankaccount_id,
  CAST(user_id % 5 AS INTEGER) AS ad_org_id, user_id AS c_bpartner_id,
  CAST(value AS DECIMAL(18,2)) AS payamt, CAST(ts AS DATE) AS dateacct, ts AS created,
  CASE event_type WHEN 'purchase' THEN 1000050 WHEN 'signup' THEN 1000049 WHEN 'view' THEN 1000008
   ELSE 1000009 END AS c_doctype_id,
  CASE WHEN event_type IN ('purchase','view') THEN 'ARR' ELSE 'APP' END AS docbasetype,
  CASE WHEN event_type = 'signup' THEN 1000030 WHEN event_type IN ('view','error') THEN 1000034
   WHEN event_type = 'click' AND event_id % 9 <> 0 THEN CAST(1000040 + user_id % 4 AS INTEGER)
   END AS c_charge_id,
  CASE WHEN event_type = 'purchase' AND user_id % 3 <> 0 THEN event_id * 10 END AS c_invoice_id,
  CASE WHEN event_id % 211 = 0 THEN 'DR' WHEN event_id % 13 = 0 THEN 'VO' ELSE 'CO' END AS docstatus,
  event_type
 FROM events""",
    "boxes": """
 SELECT CAST(i AS INTEGER) AS c_bankaccount_id, 'B' || lpad(i::VARCHAR, 2, '0') AS codcaja,
  'Caja ' || i AS nombrecaja, CASE WHEN i < 5 THEN 'SUCURSAL' ELSE 'COBRADOR' END AS tipocaja,
  CAST(i % 5 AS INTEGER) AS box_org_id FROM range(20) t(i)""",
    "charges": """
 SELECT * FROM (VALUES (1000030,'Desembolso','Cartera','cartera'),
  (1000034,'Transferencia','Cajas','Transferencia entre cajas'),
  (1000040,'Combustible','Operativo','gasto'), (1000041,'Papeleria','Operativo','gasto'),
  (1000042,'Servicios','Administrativo','gasto'), (1000043,'Ajuste','Administrativo','InOut')
 ) t(c_charge_id, cargo, chargetype, chargetype_desc)""",
    "sched0": "SELECT *, unnest(range(1, dias_cre + 1)) AS seq FROM loans",
    "sched": """
 SELECT l.legacy_cartera_id * 100 + l.seq AS legacy_schedule_id, l.legacy_cartera_id,
  l.c_bpartner_id, l.ad_org_id, l.local_id AS c_invoice_id, CAST(l.seq AS INTEGER) AS seq,
  o.d AS duedate,
  CAST(((2 * CAST(l.valorinteres * 10000 AS HUGEINT) + l.dias_cre) // (2 * l.dias_cre))
    AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(4,4)) AS dueamt,
  CASE WHEN l.synced = 'Y' AND l.seq <= 5 + l.legacy_cartera_id % 7 THEN 'Y'
   WHEN l.legacy_cartera_id % 2 = 0 THEN 'N' END AS processed,
  CASE WHEN l.synced = 'Y' AND l.seq <= 5 + l.legacy_cartera_id % 7 AND l.seq % 3 = 0 THEN 'Y'
   ELSE 'N' END AS isvalid, 'Y' AS isactive,
  CASE WHEN l.synced = 'Y' AND l.seq <= 5 + l.legacy_cartera_id % 7
   THEN (l.legacy_cartera_id * 100 + l.seq) * 10 + 3 END AS ref_invoice_id
 FROM sched0 l JOIN cal c ON c.d = l.fecha JOIN opendays o ON o.idx = c.idx + l.seq""",
    "invoices": """
 SELECT local_id AS c_invoice_id, c_bpartner_id, legacy_cartera_id, 1000048 AS c_doctype_id,
  fecha AS dateinvoiced, CAST(monto AS DECIMAL(18,4)) AS grandtotal,
  CASE WHEN legacy_cartera_id % 6 = 0 THEN 'Y' ELSE 'N' END AS ispaid,
  CASE WHEN legacy_cartera_id % 50 = 0 THEN 'DR' ELSE 'CO' END AS docstatus,
  CAST(NULL AS BIGINT) AS legacy_data, ad_org_id, CASE WHEN legacy_cartera_id % 53 = 0 THEN 'N' ELSE 'Y' END AS issotrx
 FROM loans WHERE synced = 'Y'
 UNION ALL
 SELECT ref_invoice_id, c_bpartner_id, legacy_cartera_id, 1000051, duedate,
  CAST(dueamt AS DECIMAL(18,4)),
  CASE WHEN legacy_schedule_id % 4 = 0 THEN 'Y' ELSE 'N' END, 'CO', legacy_schedule_id, ad_org_id,
  CASE WHEN legacy_schedule_id % 41 = 0 THEN 'N' ELSE 'Y' END
 FROM sched WHERE processed = 'Y'
 UNION ALL
 SELECT legacy_schedule_id * 10 + 4, c_bpartner_id, legacy_cartera_id, 1000051, duedate, CAST(dueamt AS DECIMAL(18,4)), 'N', 'CO',
  legacy_schedule_id, ad_org_id, 'Y' FROM sched WHERE processed IS DISTINCT FROM 'Y' AND legacy_schedule_id % 199 = 0""",
    "receipts": """
 SELECT c.local_id AS c_payment_id, l.c_bpartner_id, c.id_cartera, c.abono AS payamt,
  c.operacion AS dateacct, CASE WHEN substr(md5(c.local_id),3,1) < '4' THEN CAST(c.operacion - 1 AS DATE) ELSE c.operacion END AS datetrx,
  1000050 AS c_doctype_id, c.ad_org_id,
  CASE WHEN substr(md5(c.local_id),1,1) = '0' THEN 'DR' ELSE 'CO' END AS docstatus,
  CASE WHEN substr(md5(c.local_id),2,1) = '0' THEN l.local_id END AS c_invoice_id
 FROM cobros c JOIN loans l ON l.legacy_cartera_id = c.id_cartera WHERE c.synced = 'Y'""",
    "alloc0": """
 SELECT *, unnest(CASE WHEN substr(md5(c_payment_id),1,1) = '1' THEN [1,2] ELSE [1] END) AS line
 FROM receipts WHERE substr(md5(c_payment_id),1,1) IN ('1','2','3')""",
    "alloc": """
 SELECT c_payment_id, CASE WHEN substr(md5(c_payment_id),1,1) = '3' THEN (id_cartera * 100 + 1) * 10 + 3
   ELSE id_cartera * 10 + 1 END AS c_invoice_id,
  CAST(round(payamt * CAST(0.5 AS DECIMAL(2,1)), 2) AS DECIMAL(18,2)) AS amount,
  dateacct, 'Y' AS isactive, line, c_payment_id || '/' || line AS c_allocationline_id,
  'H-' || c_payment_id AS c_allocationhdr_id FROM alloc0""",
    "receipts_lost": """
 SELECT * FROM receipts UNION ALL SELECT * REPLACE ('X' || c_payment_id AS c_payment_id) FROM receipts WHERE substr(md5(c_payment_id),4,1) = '0'""",
    "alloc_lost": """
 SELECT * FROM alloc UNION ALL SELECT * REPLACE ('X' || c_payment_id AS c_payment_id, 'X' || c_allocationline_id AS c_allocationline_id,
  'X' || c_allocationhdr_id AS c_allocationhdr_id) FROM alloc WHERE substr(md5(c_payment_id),4,1) = '0'""",
}

ORDER = list(CTES)


def ctes(body: str, recursive: bool = False) -> str:
    """Prefix a query with the views it names, directly or through other views."""
    def names(text):
        return {n for n in ORDER if re.search(rf"\b{n}\b", text)}

    wanted, queue = set(), names(body)
    while queue:
        n = queue.pop()
        if n not in wanted:
            wanted.add(n)
            queue |= names(CTES[n]) - {n}
    parts = [f"{n} AS MATERIALIZED ({CTES[n]})" for n in ORDER if n in wanted]
    body = body.strip()
    word = "WITH RECURSIVE " if recursive else "WITH "
    if body[:5].upper() == "WITH ":
        return word + ",\n".join(parts) + (",\n" if parts else "") + body[5:]
    return (word + ",\n".join(parts) + "\n" + body) if parts else body


def m(expr: str, digits: int = 2) -> str:
    """Money column of a report: rounded and double."""
    return f"CAST(round({expr}, {digits}) AS DOUBLE)"
