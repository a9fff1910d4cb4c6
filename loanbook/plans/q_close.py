"""Month-end tables of one period over the whole loan book."""

from pyspark.sql import functions as F

from loanbook import config
from loanbook.operators import close as C
from loanbook.plans.q_functions import BIRTH
from loanbook.plans.q_payments import SPLIT
from loanbook.plans.registry import PERIOD, query
from loanbook.plans.sqlviews import m
from loanbook.session import work_folder
from loanbook.sources import tables as T

PID = 199806
START, END = PERIOD


def lists(spark):
    """Reference lists (fixed values)."""
    rows = [("riesgo", c, str(i + 1)) for i, c in enumerate("ABCDE")]
    rows += [("zona", "U", "1"), ("zona", "R", "2"), ("estadocivil", "S", "1"),
             ("estadocivil", "C", "2"), ("genero", "F", "1"), ("genero", "M", "2")]
    return T.fixed_rows(spark, rows, "lista string, kname string, kdesc string")


def groups(spark, d):
    """Partner groups with the activity code of their loans."""
    seg = T.read(spark, d, "customer").select(F.col("c_mktsegment").alias("rubro")).distinct()
    return seg.select("rubro", F.when(F.col("rubro") != "BUILDING", F.concat(
        F.lit("70261"), F.lpad(F.length("rubro").cast("string"), 2, "0"))).alias("grupo_desc"))


def route_codes(spark, d):
    return T.routes(spark, d).select(
        "cv_ruta_id", (F.col("cv_ruta_id") + 100).cast("string").alias("id_municipio"))


def people(spark, d):
    return C.enriched_partners(T.partners(spark, d), groups(spark, d), route_codes(spark, d), lists(spark))


def staff(spark, d):
    return C.analysts(T.route_owners(spark, d), T.partners(spark, d), lists(spark))


def active(spark, d):
    return C.active_loans(T.loans(spark, d), T.collections(spark, d), START, END)


ACT = f"""
 act AS MATERIALIZED (SELECT l.*, coalesce(p.p, 0) AS paid, p.u AS last_payment, coalesce(p.n, 0) AS n_pay, coalesce(p.np, 0) AS n_pos,
   montototal - coalesce(p.p, 0) AS balance, fecha + dias_cre AS vence
  FROM loans l LEFT JOIN (SELECT id_cartera, CAST(sum(abono) AS DECIMAL(18,2)) AS p, max(operacion) AS u, count(*) AS n,
    count(*) FILTER (abono > 0) AS np FROM cobros WHERE operacion <= DATE '{END}' GROUP BY 1) p ON p.id_cartera = l.legacy_cartera_id
  WHERE fecha <= DATE '{END}' AND (montototal - coalesce(p.p, 0) > 0 OR fecha >= DATE '{START}' OR p.u >= DATE '{START}'))"""
DAYS = f"""
 dys AS MATERIALIZED (SELECT a.*, least(e.idx - b.idx, a.dias_cre) AS dd, e.idx - s.idx AS dp,
   CAST(monto * 100 AS HUGEINT) AS mc, CAST(paid * 100 AS HUGEINT) AS pc, coalesce(pp.ppc, 0) AS ppc
  FROM act a JOIN cal b ON b.d = a.fecha - 1 JOIN cal e ON e.d = DATE '{END}' JOIN cal s ON s.d = greatest(a.fecha, DATE '{START}') - 1
  LEFT JOIN (SELECT id_cartera, CAST(sum(abono) * 100 AS HUGEINT) AS ppc FROM cobros
   WHERE operacion BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY 1) pp ON pp.id_cartera = a.legacy_cartera_id)"""
PRINC = "greatest(0, monto - paid * CAST(0.85 AS DECIMAL(3,2)))"


def cents(num, den):
    return f"greatest(0, CAST((2 * ({num}) + ({den})) // (2 * ({den})) AS DOUBLE) / 100)"


LOOP_INT = "greatest(0, CASE WHEN balance > 0 AND dd = 0 THEN 0 ELSE monto * CAST(0.15 AS DECIMAL(3,2)) END - paid * CAST(0.15 AS DECIMAL(3,2)))"
SALDO_INT = {
    "loop": f"CAST(round({LOOP_INT}, 2) AS DOUBLE)",
    "setbased": cents("greatest(mc * 15 * dd - pc * 15 * dias_cre, 0)", "100 * dias_cre"),
    "period": m("paid * CAST(0.15 AS DECIMAL(3,2))"),
}
CORRIENTE = {
    "loop": "si", "setbased": "si",
    "period": cents("greatest(mc * 15 * dp * 115 - ppc * 15 * 36525, 0)", "36525 * 115"),
}
ACCRUED_POSITIVE = {"loop": f"{LOOP_INT} = 0", "setbased": "mc * 15 * dd - pc * 15 * dias_cre <= 0", "period": "paid = 0"}


def bal(variant):
    return f"""
 bal AS MATERIALIZED (SELECT *, {m(PRINC)} AS sp, {SALDO_INT[variant]} AS si, {PRINC} = 0 AND {ACCRUED_POSITIVE[variant]} AS nada,
   {CORRIENTE[variant] if variant == 'period' else '0'} AS ic,
   CAST(vence - DATE '{END}' AS INTEGER) AS left_days, CAST(DATE '{END}' - vence AS INTEGER) AS late FROM dys)"""


def buckets(prefix, days, amount, bounds, cond="true", first="true"):
    out, low = [], None
    for high in [*bounds, None]:
        if low is None:
            c, name = f"{days} <= {high} AND {first}", f"{prefix}_{high:03d}"
        elif high is None:
            c, name = f"{days} > {low}", f"{prefix}_mas_{low}"
        else:
            c, name = f"{days} > {low} AND {days} <= {high}", f"{prefix}_{high:03d}"
        out.append(f"CASE WHEN {cond} AND {c} THEN {amount} ELSE 0.0::DOUBLE END AS {name}")
        low = high
    return ", ".join(out)


TO_MATURE_INT = buckets("mto_intereses_por_vencer", "left_days", "si", config.TO_MATURE_BOUNDS,
                        "late > 0", "left_days >= 0")
TO_MATURE = buckets("mto_por_vencer", "left_days", "sp", config.TO_MATURE_BOUNDS)
OVERDUE = buckets("mto_vencido", "late", "sp", config.OVERDUE_BOUNDS)

PEOPLE = """
 ppl AS MATERIALIZED (SELECT *, CAST(coalesce(CASE WHEN rubro <> 'BUILDING' THEN '70261' || lpad(length(rubro)::VARCHAR, 2, '0') END, '7026101') AS INTEGER) AS id_destino,
  (cv_ruta_id + 100)::VARCHAR AS municipio, CAST(strpos('ABCDE', tipo_riesgo) AS INTEGER) AS id_clasif,
  CASE tipo_localizacion WHEN 'U' THEN 1 WHEN 'R' THEN 2 END AS id_zona, CASE civilstatus WHEN 'S' THEN 1 WHEN 'C' THEN 2 END AS id_civil,
  CASE genero WHEN 'F' THEN 1 WHEN 'M' THEN 2 END AS id_gen FROM partners)"""
STAFF = f"""
 staff AS MATERIALIZED (SELECT o.cv_ruta_id, coalesce(p.taxid, '-') AS id_analista, p.nombre AS nombre_analista, p.id_gen AS genero_analista
  FROM owners o LEFT JOIN ppl p ON p.c_bpartner_id = o.owner_id)"""

CONST_SQL = ", ".join(f"'{v}' AS {k}" if isinstance(v, str) else f"{v} AS {k}"
                      for k, v in C.CREDIT_CONSTANTS.items())
ZERO_SQL = ", ".join(f"0.0::DOUBLE AS {k}" for k in C.CREDIT_ZEROS)
NULL_SQL = ", ".join(f"CAST(NULL AS VARCHAR) AS {k}" for k in C.CREDIT_NULLS)


def credit_sql(variant):
    payments = "n_pos" if variant == "loop" else "n_pay"
    arrears = "0" if variant == "loop" else "CASE WHEN late > 0 THEN dias_cre - n_pay ELSE 0 END"
    current = "ic" if variant == "period" else "si"
    return f"""
WITH {ACT}, {DAYS}, {bal(variant)}, {PEOPLE}, {STAFF}
SELECT legacy_cartera_id, {PID} AS c_period_id, CAST({payments} AS BIGINT) AS cantidad_cuotas, CAST({arrears} AS BIGINT) AS cuotas_vencidas,
 fecha AS fecha_otorgamiento, vence AS fecha_vencimiento_credito, id_clasif AS id_clasificacion_credito, legacy_cartera_id AS id_credito,
 id_destino AS id_destino_credito, CAST(municipio AS INTEGER) AS id_municipio, {current} AS interes_corriente,
 CASE WHEN late > 0 THEN si ELSE 0.0::DOUBLE END AS interes_vencidos, {m('monto')} AS mto_original,
 {TO_MATURE_INT}, {TO_MATURE}, {OVERDUE}, sp AS saldo, {m('tasa')} AS tasa, {m('tasa')} AS tasa_costo_efectiva, {m('tasa')} AS tasa_contrato,
 id_zona AS id_tipo_zona, CASE WHEN nada THEN 7 ELSE 6 END AS id_estado_credito, id_analista, {CONST_SQL}, {ZERO_SQL}, {NULL_SQL}
FROM bal JOIN ppl USING (c_bpartner_id) LEFT JOIN staff USING (cv_ruta_id)"""


def _credit(spark, d, variant):
    return C.credit_rows(active(spark, d), T.collections(spark, d), people(spark, d), staff(spark, d),
                         PID, START, END, variant)


@query("icc_credit", credit_sql("loop"))
def icc_credit(spark, d):
    return _credit(spark, d, "loop")


@query("icc_credit_setbased", credit_sql("setbased"))
def icc_credit_setbased(spark, d):
    return _credit(spark, d, "setbased")


@query("icc_credit_period_interest", credit_sql("period"))
def icc_credit_period_interest(spark, d):
    return _credit(spark, d, "period")


@query("icc_active_loans", f"""
WITH {ACT}
SELECT legacy_cartera_id, c_bpartner_id, fecha, vence AS fecha_vencimiento, {m('balance')} AS balance, last_payment FROM act""")
def icc_active_loans(spark, d):
    return active(spark, d).select("legacy_cartera_id", "c_bpartner_id", "fecha", "fecha_vencimiento",
                                   "balance", "last_payment")


def balances(spark, d):
    return C.with_balances(active(spark, d), START, END)


@query("icc_balances", f"""
WITH {ACT}, {DAYS}, {bal('loop')}
SELECT legacy_cartera_id, {m('CASE WHEN balance > 0 AND dd = 0 THEN 0 ELSE monto * tasa END')} AS interes_devengado,
 sp AS saldo_principal, si AS saldo_interes FROM bal""")
def icc_balances(spark, d):
    return balances(spark, d).select("legacy_cartera_id", "interes_devengado", "saldo_principal", "saldo_interes")


@query("icc_ageing_to_mature", f"""
WITH {ACT}, {DAYS}, {bal('loop')} SELECT legacy_cartera_id, {TO_MATURE_INT}, {TO_MATURE} FROM bal""")
def icc_ageing_to_mature(spark, d):
    b = balances(spark, d)
    cols = [c for c in C.ageing_columns(END)][:14]
    return b.select("legacy_cartera_id", *cols)


@query("icc_ageing_overdue", f"""
WITH {ACT}, {DAYS}, {bal('loop')} SELECT legacy_cartera_id, {OVERDUE} FROM bal""")
def icc_ageing_overdue(spark, d):
    return balances(spark, d).select("legacy_cartera_id", *C.ageing_columns(END)[14:])


@query("icc_ageing_disjoint", f"""
WITH {ACT}, {DAYS}, {bal('loop')} SELECT legacy_cartera_id,
 {buckets('por_vencer', 'left_days', 'sp', config.TO_MATURE_BOUNDS, 'left_days >= 0')},
 {buckets('vencido', 'late', 'sp', config.OVERDUE_BOUNDS, 'late > 0')} FROM bal""")
def icc_ageing_disjoint(spark, d):
    return balances(spark, d).select("legacy_cartera_id", *C.disjoint_ageing(END))


@query("icc_persons", f"""
WITH {ACT}, {PEOPLE}
SELECT {PID} AS c_period_id, c_bpartner_id, birthday AS fecha_nacimiento, id_destino AS id_actividad_economica, id_civil AS id_estado_civil,
 id_gen AS id_genero, municipio AS id_municipio, taxid AS id_persona, nombre, 158 AS id_pais, 0 AS pep, 0 AS id_tipo_persona_juridica,
 1 AS id_tipo_persona, 1 AS id_tipo_documento, 2 AS id_tipo_grupo FROM ppl WHERE c_bpartner_id IN (SELECT c_bpartner_id FROM act)""")
def icc_persons(spark, d):
    return C.person_rows(active(spark, d), people(spark, d), PID)


@query("icc_credit_person", f"""
WITH {ACT}, {PEOPLE}
SELECT {PID} AS c_period_id, legacy_cartera_id::VARCHAR AS id_credito, taxid AS id_persona, 1 AS id_tipo_documento, 2 AS id_moneda
FROM act JOIN ppl USING (c_bpartner_id)""")
def icc_credit_person(spark, d):
    return C.credit_person_rows(active(spark, d), people(spark, d), PID)


@query("icc_analysts", f"""
WITH {ACT}, {PEOPLE}, {STAFF}
SELECT {PID} AS c_period_id, id_analista, nombre_analista AS nombre, genero_analista AS id_genero FROM (
 SELECT *, row_number() OVER (PARTITION BY id_analista ORDER BY cv_ruta_id) AS rn FROM staff
 WHERE cv_ruta_id IN (SELECT cv_ruta_id FROM act JOIN ppl USING (c_bpartner_id))) WHERE rn = 1""")
def icc_analysts(spark, d):
    return C.analyst_rows(active(spark, d), people(spark, d), staff(spark, d), PID)


PLACEMENTS = f"""
SELECT {PID} AS c_period_id, count(*) AS cantidad_creditos, {m('sum(montototal)')} AS mto_prestamo_cor, 0.0::DOUBLE AS mto_prestamos_dol,
 {m('sum(monto)')} AS mto_desembolsado_cor, 0.0::DOUBLE AS mto_desembolsado_dol, 1 AS id_tipo_fondo, '' AS otro_fondo, 1 AS id_forma_entrega,
 2 AS id_tipo_lugar FROM loans WHERE fecha BETWEEN DATE '{START}' AND DATE '{END}'"""


@query("icc_placements", PLACEMENTS)
def icc_placements(spark, d):
    return C.placement_rows(T.loans(spark, d), PID, START, END)


@query("icc_recoveries", f"""
SELECT {PID} AS c_period_id, count(*) AS cantidad_pagos, {m('coalesce(sum(ap), 0)')} AS mto_principal_cor,
 {m('coalesce(sum(abono - ap), 0)')} AS mto_interes_cor, 0.0::DOUBLE AS mto_principal_dol, 0.0::DOUBLE AS mto_interes_dol,
 1 AS id_forma_pago, 2 AS id_lugar_pago, 1 AS id_tipo_cartera
FROM ({SPLIT}) WHERE operacion BETWEEN DATE '{START}' AND DATE '{END}'""")
def icc_recoveries(spark, d):
    return C.recovery_rows(T.loans(spark, d), T.collections(spark, d), PID, START, END)


CLOSE_COUNTS = " UNION ALL ".join([
    f"SELECT 'credito' AS tabla, count(*) AS filas, {m('sum(sp + si)')} AS control FROM bal JOIN ppl USING (c_bpartner_id)",
    f"SELECT 'persona', count(*), 0.0::DOUBLE FROM ppl WHERE c_bpartner_id IN (SELECT c_bpartner_id FROM act)",
    "SELECT 'credito_persona', count(*), 0.0::DOUBLE FROM act JOIN ppl USING (c_bpartner_id)",
    "SELECT 'analista', count(DISTINCT id_analista), 0.0::DOUBLE FROM staff WHERE cv_ruta_id IN (SELECT cv_ruta_id FROM act JOIN ppl USING (c_bpartner_id))",
    f"SELECT 'colocaciones', 1, {m('sum(montototal)')} FROM loans WHERE fecha BETWEEN DATE '{START}' AND DATE '{END}'",
    f"SELECT 'recuperaciones', 1, {m('sum(abono)')} FROM cobros JOIN loans ON legacy_cartera_id = id_cartera WHERE operacion BETWEEN DATE '{START}' AND DATE '{END}'",
])


def close_frames(spark, d):
    return C.close_tables(T.loans(spark, d), T.collections(spark, d), T.partners(spark, d), groups(spark, d),
                          route_codes(spark, d), lists(spark), T.route_owners(spark, d), PID, START, END,
                          write_once=True)


CLOSE = f"WITH {ACT}, {DAYS}, {bal('loop')}, {PEOPLE}, {STAFF} {CLOSE_COUNTS}"


def close_figures(t):
    """Rows and control figure of every table of a close."""
    control = {
        "credito": F.round(F.sum(F.round("saldo", 2) + F.round("interes_corriente", 2)), 2),
        "colocaciones": F.sum("mto_prestamo_cor"),
        "recuperaciones": F.sum(F.col("mto_principal_cor") + F.col("mto_interes_cor")),
    }
    return T.union_all([
        df.agg(F.count(F.lit(1)).alias("filas"),
               control.get(n, F.lit("0").cast("decimal(18,2)")).cast("decimal(28,2)").alias("control"))
        .select(F.lit(n).alias("tabla"), "filas", "control") for n, df in t.items()])


@query("icc_close", CLOSE)
def icc_close(spark, d):
    """Control figures; the rows of each table are the results of the other icc_ queries."""
    return close_figures(close_frames(spark, d))


@query("icc_close_written", CLOSE)
def icc_close_written(spark, d):
    """All tables of a close, written twice and read back."""
    path = work_folder(spark, "close")
    tables = close_frames(spark, d)
    for _ in range(2):
        C.period_close(tables, path, PID)
    return close_figures({n: spark.read.parquet(f"{path}/{n}") for n in tables})


@query("icc_ref_lookup", f"""
WITH {PEOPLE}
SELECT c_bpartner_id, id_clasif AS id_clasificacion_credito, id_zona AS id_tipo_zona, id_civil AS id_estado_civil, id_gen AS id_genero FROM ppl""")
def icc_ref_lookup(spark, d):
    return people(spark, d).select("c_bpartner_id", "id_clasificacion_credito", "id_tipo_zona",
                                   "id_estado_civil", "id_genero")


@query("icc_fill_birthdays", f"SELECT c_bpartner_id, coalesce(birthday, {BIRTH}) AS birthday FROM partners")
def icc_fill_birthdays(spark, d):
    return C.fill_birthdays(T.partners(spark, d)).select("c_bpartner_id", "birthday")

