"""Bridges over all pending rows."""

from pyspark.sql import functions as F

from loanbook.operators import bridges as B
from loanbook.operators.balances import with_collected
from loanbook.plans.q_interest import INT_CAP, d4, due_sql, div, fold_sql, rate_sql
from loanbook.plans.registry import query
from loanbook.plans.sqlviews import m
from loanbook.sources import tables as T

CUTOFF = "2001-12-31"


def dims(spark, d):
    return T.partners(spark, d), T.users(spark, d), T.branches(spark, d)


def pend_sql(origin="AND origen = 'native'", approved="AND aprobado = 'Y'", box="u.c_bankaccount_id",
             extra_join="LEFT JOIN users u ON u.ad_user_id = l.createdby", usr="u.ad_user_id IS NULL"):
    return f"""
 pend AS MATERIALIZED (SELECT l.*, {box} AS box, CASE WHEN local_id > 0 THEN 'ya tiene documento' WHEN b.ad_org_id IS NULL THEN 'sin sucursal'
   WHEN p.c_bpartner_id IS NULL THEN 'sin tercero' WHEN NOT has_location THEN 'tercero sin direccion' WHEN {usr} THEN 'sin usuario'
   WHEN NOT coalesce({box}, 0) > 0 THEN 'sin caja' WHEN monto IS NULL OR NOT tasa > 0 OR fecha IS NULL OR NOT dias_cre > 0 THEN 'credito incompleto' END AS motivo
  FROM loans l LEFT JOIN partners p ON p.c_bpartner_id = l.c_bpartner_id LEFT JOIN branches b ON b.ad_org_id = l.ad_org_id {extra_join}
  WHERE (l.synced <> 'Y' OR l.synced IS NULL) {origin} {approved})"""


TERM = "CASE dias_cre WHEN 23 THEN 1000001 WHEN 30 THEN 1000002 WHEN 50 THEN 1000003 ELSE 1000000 END AS c_paymentterm_id"


def docs(out):
    """Invoice lines and disbursements in one list."""
    i = out["invoice_lines"].select(
        F.lit("factura").alias("documento"), F.col("c_invoice_id").alias("id"), "legacy_cartera_id", "c_bpartner_id",
        "ad_org_id", "c_doctype_id", "c_charge_id", F.col("dateinvoiced").alias("fecha"), "c_paymentterm_id",
        F.lit(None).cast("int").alias("c_bankaccount_id"), "line", F.col("amount"))
    p = out["payments"].select(
        F.lit("pago").alias("documento"), F.col("c_payment_id").alias("id"), "legacy_cartera_id", "c_bpartner_id",
        "ad_org_id", "c_doctype_id", "c_charge_id", F.col("dateacct").alias("fecha"),
        F.lit(None).cast("int").alias("c_paymentterm_id"), "c_bankaccount_id", F.lit(0).alias("line"),
        F.col("payamt").cast("decimal(18,4)").alias("amount"))
    return i.unionByName(p)


def docs_sql(lines, on="fecha"):
    parts = []
    for number, charge, amount in lines:
        parts.append(f"""SELECT 'factura' AS documento, legacy_cartera_id * 10 + 1 AS id, legacy_cartera_id, c_bpartner_id, ad_org_id,
 1000048 AS c_doctype_id, {charge} AS c_charge_id, {on} AS fecha, {TERM}, CAST(NULL AS INTEGER) AS c_bankaccount_id, {number} AS line,
 {d4(amount)} AS amount FROM pend WHERE motivo IS NULL""")
    parts.append(f"""SELECT 'pago', legacy_cartera_id * 10 + 2, legacy_cartera_id, c_bpartner_id, ad_org_id, 1000049, 1000030, {on},
 NULL, box, 0, {d4('monto')} FROM pend WHERE motivo IS NULL""")
    return " UNION ALL ".join(parts)


def native(spark, d, **kw):
    p, u, b = dims(spark, d)
    return B.bridge_loans(T.loans(spark, d), p, u, b, **kw)


def new_invoice(sql):
    """Instalments of a loan that is billed now belong to its new invoice."""
    return sql.replace("l.local_id AS c_invoice_id", "l.legacy_cartera_id * 10 + 1 AS c_invoice_id")


PRINCIPAL = [(10, 1000028, "monto")]


@query("brg_loans", f"WITH {pend_sql()} {docs_sql(PRINCIPAL)}", digits=4)
def brg_loans(spark, d):
    return docs(native(spark, d))


@query("brg_loans_rejects", f"WITH {pend_sql()} SELECT legacy_cartera_id, c_bpartner_id, motivo FROM pend WHERE motivo IS NOT NULL")
def brg_loans_rejects(spark, d):
    return native(spark, d)["rejects"]


@query("brg_loans_updates", f"""
WITH {pend_sql()} SELECT legacy_cartera_id, 'Y' AS synced, legacy_cartera_id * 10 + 1 AS local_id, legacy_cartera_id * 10 + 2 AS payment_id,
 {d4('valorinteres')} AS valorinteres, {d4('monto + valorinteres')} AS montototal,
 CAST({div('monto + valorinteres', 'dias_cre', 4)} AS DOUBLE) AS cuota FROM pend WHERE motivo IS NULL""", digits=4)
def brg_loans_updates(spark, d):
    return native(spark, d)["updates"]


@query("brg_loans_schedule", f"""
WITH {pend_sql()}, {rate_sql('pend', 'legacy_cartera_id', 'monto', 'valorinteres', 'dias_cre')},
 src AS (SELECT legacy_cartera_id AS k, monto AS principal, rate, CAST({div('monto + valorinteres', 'dias_cre', 4)} AS DECIMAL(18,4)) AS level,
  dias_cre AS n FROM pend JOIN rates ON k = legacy_cartera_id WHERE motivo IS NULL),
 {fold_sql('src', True)}
{new_invoice(due_sql(0, INT_CAP))}""",
       digits=4, recursive=True)
def brg_loans_schedule(spark, d):
    return native(spark, d)["schedule"]


@query("brg_loans_by_branch_schedule", f"""
WITH {pend_sql()}, plan AS (SELECT legacy_cartera_id AS k, unnest(range(1, dias_cre + 1)) AS seq, {div('valorinteres', 'dias_cre', 4)} AS dueamt
  FROM pend WHERE motivo IS NULL AND ad_org_id = 3)
{new_invoice(due_sql(0, f"{d4('dueamt')} AS dueamt"))}""", digits=4)
def brg_loans_by_branch_schedule(spark, d):
    return native(spark, d, org=3, plan="flat", recompute=False)["schedule"]


@query("brg_loans_by_branch", f"WITH {pend_sql()} {docs_sql(PRINCIPAL).replace('motivo IS NULL', 'motivo IS NULL AND ad_org_id = 3')}", digits=4)
def brg_loans_by_branch(spark, d):
    return docs(native(spark, d, org=3, plan="flat", recompute=False))


@query("brg_loans_two_line", f"WITH {pend_sql()} {docs_sql([*PRINCIPAL, (20, 1000029, 'montototal - monto')])}", digits=4)
def brg_loans_two_line(spark, d):
    return docs(native(spark, d, lines="two", recompute=False, plan=None))


OWNER_BOX = """LEFT JOIN (SELECT p2.c_bpartner_id, u2.c_bankaccount_id FROM partners p2 JOIN owners o ON o.cv_ruta_id = p2.cv_ruta_id
  JOIN users u2 ON u2.ad_user_id = o.owner_id) ob ON ob.c_bpartner_id = l.c_bpartner_id"""


@query("brg_loans_migrated", f"""
WITH {pend_sql("AND origen = 'migrated'", '', 'ob.c_bankaccount_id', OWNER_BOX, 'false')}
{docs_sql([*PRINCIPAL, (20, 1000029, 'montototal - monto')], f"DATE '{CUTOFF}'")}""", digits=4)
def brg_loans_migrated(spark, d):
    p, u, b = dims(spark, d)
    boxes = B.route_owner_boxes(p, T.route_owners(spark, d), u)
    return docs(B.bridge_loans(T.loans(spark, d), p, u, b, origin="migrated", approved_only=False, lines="two",
                               box_of=boxes, dated=CUTOFF, recompute=False, plan=None))


@query("brg_loans_legacy", f"""
WITH paid AS (SELECT id_cartera, sum(abono) AS a FROM cobros GROUP BY 1),
 open_loans AS (SELECT l.*, coalesce(a, 0) AS abono FROM loans l LEFT JOIN paid ON id_cartera = legacy_cartera_id
  WHERE montototal - coalesce(a, 0) > 0 AND (synced <> 'Y' OR synced IS NULL)),
 pend AS (SELECT l.*, 1 + l.ad_org_id AS box, CASE WHEN p.c_bpartner_id IS NULL THEN 'sin tercero' WHEN NOT has_location THEN 'x' END AS motivo
  FROM open_loans l LEFT JOIN partners p USING (c_bpartner_id))
{docs_sql([*PRINCIPAL, (20, 1000029, 'valorinteres'), (30, 1000032, '-abono')])}""", digits=4)
def brg_loans_legacy(spark, d):
    p, _, b = dims(spark, d)
    ln = T.loans(spark, d)
    # The branch's own box pays, so the branches stand in for the users.
    ln = with_collected(ln, T.collections(spark, d)).filter(F.col("balance") > 0).withColumn("abono", F.col("paid"))
    # The partner of part of the loans is only known through the legacy client.
    lost = ln.withColumn("id_cliente", F.col("c_bpartner_id")).withColumn(
        "c_bpartner_id", F.when(F.col("legacy_cartera_id") % 2 == 0, F.col("c_bpartner_id")))
    clients = ln.select(F.col("c_bpartner_id").alias("id_cliente"), "ad_org_id", "c_bpartner_id").distinct()
    found = B.legacy_partner(lost, clients)
    out = B.bridge_loans(found.withColumn("createdby", F.col("ad_org_id").cast("bigint")), p,
                         b.select(F.col("ad_org_id").cast("bigint").alias("ad_user_id"),
                                  (F.col("ad_org_id") + 1).alias("c_bankaccount_id")),
                         b, origin=None, approved_only=False, lines="three", recompute=False, plan=None)
    return docs(out)


def owned_collections(spark, d):
    """Collections with the partner of their loan."""
    ln = T.loans(spark, d).select(F.col("legacy_cartera_id").alias("id_cartera"), "c_bpartner_id")
    return T.collections(spark, d).join(ln, "id_cartera", "left")


def cpend(flag):
    return f"""
 cp AS MATERIALIZED (SELECT c.*, l.c_bpartner_id, p.c_bpartner_id AS bp, has_location, u.ad_user_id AS usr, u.c_bankaccount_id AS box,
   l.local_id AS inv_id, i.c_invoice_id AS inv, i.ispaid, l.legacy_cartera_id AS car, l.montototal - coalesce(sp.p, 0) AS saldo_synced
  FROM cobros c LEFT JOIN loans l ON l.legacy_cartera_id = c.id_cartera LEFT JOIN partners p ON p.c_bpartner_id = l.c_bpartner_id
  LEFT JOIN users u ON u.ad_user_id = c.createdby LEFT JOIN invoices i ON i.c_invoice_id = l.local_id
  LEFT JOIN (SELECT id_cartera, sum(abono) AS p FROM cobros WHERE synced = 'Y' GROUP BY 1) sp ON sp.id_cartera = l.legacy_cartera_id
  WHERE {flag} AND c.origen = 'native' AND c.abono > 0)"""


RECEIPT = f"""SELECT 'P-' || legacy_cobro_id AS c_payment_id, legacy_cobro_id, c_bpartner_id, ad_org_id, 1000050 AS c_doctype_id,
 box AS c_bankaccount_id, operacion AS dateacct, {m('abono')} AS payamt"""
PLAIN_REASON = """CASE WHEN local_id IS NOT NULL THEN 'ya tiene recibo' WHEN bp IS NULL THEN 'sin tercero' WHEN usr IS NULL THEN 'sin usuario'
 WHEN NOT coalesce(box, 0) > 0 THEN 'sin caja' END"""
FULL_REASON = """CASE WHEN local_id IS NOT NULL THEN 'ya tiene recibo' WHEN bp IS NULL THEN 'sin tercero' WHEN NOT has_location THEN 'tercero sin direccion'
 WHEN usr IS NULL THEN 'sin usuario' WHEN NOT coalesce(box, 0) > 0 THEN 'sin caja' WHEN car IS NULL THEN 'sin cartera'
 WHEN saldo_synced < 0 THEN 'cartera sobregirada' WHEN inv IS NULL THEN 'sin factura' WHEN ispaid = 'Y' THEN 'factura pagada' END"""
STRICT, LOOSE = "c.synced = 'N'", "(c.synced <> 'Y' OR c.synced IS NULL)"


@query("brg_collections", f"WITH {cpend(STRICT)} {RECEIPT}, CAST(NULL AS BIGINT) AS c_invoice_id FROM cp WHERE {PLAIN_REASON} IS NULL")
def brg_collections(spark, d):
    p, u, _ = dims(spark, d)
    return B.bridge_collections(owned_collections(spark, d), p, u)["payments"]


@query("brg_collections_rejects", f"WITH {cpend(STRICT)} SELECT legacy_cobro_id, id_cartera, {PLAIN_REASON} AS motivo FROM cp WHERE {PLAIN_REASON} IS NOT NULL")
def brg_collections_rejects(spark, d):
    p, u, _ = dims(spark, d)
    return B.bridge_collections(owned_collections(spark, d), p, u)["rejects"]


def _checked(spark, d, **kw):
    p, u, _ = dims(spark, d)
    return B.bridge_collections(owned_collections(spark, d), p, u, strict=False, checked=True, loans=T.loans(spark, d),
                                invoices=T.invoices(spark, d), all_collections=T.collections(spark, d), **kw)


@query("brg_collections_checked", f"WITH {cpend(LOOSE)} {RECEIPT}, inv AS c_invoice_id FROM cp WHERE {FULL_REASON} IS NULL")
def brg_collections_checked(spark, d):
    return _checked(spark, d)["payments"]


@query("brg_collections_checked_rejects", f"WITH {cpend(LOOSE)} SELECT legacy_cobro_id, id_cartera, {FULL_REASON} AS motivo FROM cp WHERE {FULL_REASON} IS NOT NULL")
def brg_collections_checked_rejects(spark, d):
    return _checked(spark, d)["rejects"]


@query("brg_collections_by_branch", f"WITH {cpend(LOOSE)} {RECEIPT}, inv AS c_invoice_id FROM cp WHERE {FULL_REASON} IS NULL AND ad_org_id = 2")
def brg_collections_by_branch(spark, d):
    return _checked(spark, d, org=2)["payments"]


@query("brg_collections_legacy", f"""
WITH open_loans AS (SELECT l.* FROM loans l LEFT JOIN (SELECT id_cartera, sum(abono) AS p FROM cobros GROUP BY 1) ON id_cartera = legacy_cartera_id
  WHERE montototal - coalesce(p, 0) > 0 AND local_id > 0)
SELECT legacy_cobro_id, legacy_cartera_id AS id_cartera, c.id_cartera AS old_cartera, l.c_bpartner_id, l.local_id AS local_invoice_id, 'Y' AS synced
FROM cobros c JOIN open_loans l ON l.legacy_cartera_id = c.id_cartera AND l.ad_org_id = c.ad_org_id WHERE c.synced = 'N' AND c.abono > 0""")
def brg_collections_legacy(spark, d):
    ln = T.loans(spark, d).withColumn("id_cartera_legacy", F.col("legacy_cartera_id"))
    c = T.collections(spark, d)
    return B.bridge_collections_legacy(c, ln, c, 1)["updates"]


@query("brg_expenses", f"""
WITH e AS (SELECT c_payment_id, c_bpartner_id, ad_org_id, c_charge_id, dateacct, payamt, u.c_bankaccount_id AS box, event_type AS concepto, bp
 FROM pay LEFT JOIN (SELECT c_bpartner_id AS bp FROM partners) ON bp = pay.c_bpartner_id LEFT JOIN users u ON u.ad_user_id = pay.c_bpartner_id % 10
 WHERE event_type = 'click' AND docstatus <> 'CO')
SELECT c_payment_id, c_bpartner_id, ad_org_id, 1000009 AS c_doctype_id, c_charge_id, box AS c_bankaccount_id, dateacct, {m('payamt')} AS payamt,
 'Gasto en Ruta | ' || concepto AS description FROM e WHERE bp IS NOT NULL AND coalesce(box, 0) > 0""")
def brg_expenses(spark, d):
    p, u, _ = dims(spark, d)
    e = T.cash_payments(spark, d).filter(F.col("event_type") == "click").select(
        F.col("c_payment_id").alias("legacy_gasto_id"), "c_bpartner_id", "ad_org_id", "c_charge_id",
        F.col("dateacct").alias("fecha"), F.col("payamt").alias("monto"), F.col("event_type").alias("concepto"),
        F.when(F.col("docstatus") == "CO", "Y").alias("synced"), F.lit("native").alias("origen"),
        (F.col("c_bpartner_id") % 10).alias("createdby"), F.lit(None).cast("bigint").alias("local_id"))
    return B.bridge_expenses(e, p, u)["payments"]


@query("brg_complete_docs", """
WITH docs AS (SELECT 'pago' AS tipo, c_payment_id::VARCHAR AS id, ad_org_id, dateacct AS fecha, docstatus FROM receipts
 UNION ALL SELECT 'factura', c_invoice_id::VARCHAR, ad_org_id, dateinvoiced, docstatus FROM invoices),
 x AS (SELECT *, docstatus = 'DR' AND EXISTS (SELECT 1 FROM periods WHERE c_period_id >= 199801 AND fecha BETWEEN startdate AND enddate) AS hit FROM docs)
SELECT tipo, id, ad_org_id, fecha, CASE WHEN hit THEN 'CO' ELSE docstatus END AS docstatus, hit AS completado FROM x""")
def brg_complete_docs(spark, d):
    open_periods = T.periods(spark).filter("c_period_id >= 199801")
    r = T.receipts(spark, d).select(F.lit("pago").alias("tipo"), F.col("c_payment_id").alias("id"), "ad_org_id",
                                    F.col("dateacct").alias("fecha"), "docstatus")
    i = T.invoices(spark, d).select(F.lit("factura").alias("tipo"), F.col("c_invoice_id").cast("string").alias("id"),
                                    "ad_org_id", F.col("dateinvoiced").alias("fecha"), "docstatus")
    return B.complete_documents(r.unionByName(i), open_periods, "fecha")


@query("brg_relink_paid", """
WITH f AS (SELECT c_bpartner_id, c_invoice_id AS nueva FROM (SELECT *, row_number() OVER (PARTITION BY c_bpartner_id ORDER BY dateinvoiced, c_invoice_id) AS rn
 FROM invoices WHERE ispaid = 'N') WHERE rn = 1)
SELECT p.c_payment_id, p.c_bpartner_id, p.c_invoice_id AS factura_pagada, nueva, CASE WHEN nueva IS NULL THEN 'sin factura' ELSE 'asociado' END AS resultado
FROM receipts p JOIN invoices i ON i.c_invoice_id = p.c_invoice_id LEFT JOIN f ON f.c_bpartner_id = p.c_bpartner_id
WHERE i.ispaid = 'Y' AND p.docstatus = 'DR'""")
def brg_relink_paid(spark, d):
    return B.relink_paid(T.receipts(spark, d), T.invoices(spark, d))

