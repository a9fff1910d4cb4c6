"""Scalar functions applied to whole tables."""

from pyspark.sql import functions as F

from loanbook.functions import dates as D
from loanbook.functions import scalars as S
from loanbook.plans.registry import AS_OF, query
from loanbook.plans.sqlviews import m
from loanbook.sources import tables as T


@query("fn_effective_days", f"""
SELECT l.legacy_cartera_id, CAST(CASE WHEN l.fecha > DATE '{AS_OF}' THEN 0
   ELSE e.idx - p.idx END AS INTEGER) AS dias_efectivos
FROM loans l JOIN cal p ON p.d = l.fecha - 1 JOIN cal e ON e.d = DATE '{AS_OF}'
""")
def fn_effective_days(spark, d):
    return T.loans(spark, d).select(
        "legacy_cartera_id",
        D.effective_days(F.col("fecha"), F.lit(AS_OF).cast("date")).alias("dias_efectivos"))


@query("fn_add_six_day", "SELECT legacy_cartera_id, vence6 AS vence FROM due6")
def fn_add_six_day(spark, d):
    return T.loans(spark, d).select(
        "legacy_cartera_id", D.add_six_day(F.col("fecha"), F.col("dias_cre")).alias("vence"))


@query("fn_maturity_calendar", "SELECT legacy_cartera_id, fecha + dias_cre AS vence FROM loans")
def fn_maturity_calendar(spark, d):
    return T.loans(spark, d).select(
        "legacy_cartera_id", D.maturity(F.col("fecha"), F.col("dias_cre"), "calendar").alias("vence"))


@query("fn_is_sunday", """
SELECT isodow(operacion) = 7 AS domingo, count(*) AS n, CAST(round(sum(abono),2) AS DOUBLE) AS abono
FROM cobros GROUP BY 1""")
def fn_is_sunday(spark, d):
    return T.collections(spark, d).groupBy(D.is_sunday(F.col("operacion")).alias("domingo")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("abono").alias("abono"))


@query("fn_days_between", f"""
SELECT legacy_cartera_id, CAST(DATE '{AS_OF}' - (fecha + dias_cre) AS INTEGER) AS dias FROM loans""")
def fn_days_between(spark, d):
    due = D.maturity(F.col("fecha"), F.col("dias_cre"), "calendar")
    return T.loans(spark, d).select(
        "legacy_cartera_id", D.days_between(F.lit(AS_OF).cast("date"), due).alias("dias"))


@query("fn_iif", f"""
SELECT legacy_cobro_id, CASE WHEN synced = 'Y' THEN {m('abono')} ELSE 0.0::DOUBLE END AS sincronizado
FROM cobros""")
def fn_iif(spark, d):
    return T.collections(spark, d).select(
        "legacy_cobro_id",
        S.iif(F.col("synced") == "Y", F.col("abono"), S.dec("0.00")).alias("sincronizado"))


@query("fn_clamp", f"""
SELECT legacy_cartera_id, {m('greatest(0, monto - 200000)')} AS exceso,
 {m('least(monto, 200000)')} AS topado FROM loans""")
def fn_clamp(spark, d):
    limit = S.dec("200000")
    return T.loans(spark, d).select(
        "legacy_cartera_id", S.clamp(F.col("monto") - limit, low=S.dec("0")).alias("exceso"),
        S.clamp(F.col("monto"), high=limit).alias("topado"))


BIRTH = """CASE WHEN length(regexp_replace(taxid, '[^A-Za-z0-9]', '', 'g')) = 14 THEN
  TRY_CAST((CASE WHEN CAST(substr(regexp_replace(taxid, '[^A-Za-z0-9]', '', 'g'), 8, 2) AS INT) >= 70
    THEN '19' ELSE '20' END) || substr(regexp_replace(taxid, '[^A-Za-z0-9]', '', 'g'), 8, 2)
   || '-' || substr(regexp_replace(taxid, '[^A-Za-z0-9]', '', 'g'), 6, 2)
   || '-' || substr(regexp_replace(taxid, '[^A-Za-z0-9]', '', 'g'), 4, 2) AS DATE) END"""


@query("fn_birthdate_from_id", f"SELECT c_bpartner_id, {BIRTH} AS nacimiento FROM partners")
def fn_birthdate_from_id(spark, d):
    return T.partners(spark, d).select(
        "c_bpartner_id", S.birthdate(F.col("taxid")).alias("nacimiento"))


@query("fn_split_coords", """
SELECT legacy_cobro_id, split_part(coords, '|', 1) AS latitud, split_part(coords, '|', 2) AS longitud
FROM cobros""")
def fn_split_coords(spark, d):
    lat, lon = S.split_coords(F.col("coords"))
    return T.collections(spark, d).select(
        "legacy_cobro_id", lat.alias("latitud"), lon.alias("longitud"))


@query("fn_map_link", """
SELECT legacy_cobro_id, 'https://maps.google.com/?q=' || replace(coords, '|', ',') AS enlace
FROM cobros""")
def fn_map_link(spark, d):
    return T.collections(spark, d).select(
        "legacy_cobro_id", S.map_link(F.col("coords")).alias("enlace"))


@query("fn_json_config", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def fn_json_config(spark, d):
    return T.read(spark, d, "events").select("event_id", *S.json_fields(F.col("props"), ["k"]))


@query("fn_regex_match", """
SELECT legacy, count(*) AS n, CAST(sum(CASE WHEN cartera THEN 1 ELSE 0 END) AS BIGINT) AS con_cartera FROM (
 SELECT chargetype ILIKE 'OPER%' AS legacy, regexp_matches(chargetype_desc, 'CARTERA|transfer', 'i') AS cartera
 FROM pay JOIN charges USING (c_charge_id)) GROUP BY 1""")
def fn_regex_match(spark, d):
    j = T.cash_payments(spark, d).join(T.charges(spark), "c_charge_id")
    return j.groupBy(F.col("chargetype").ilike("OPER%").alias("legacy")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(S.regex_match(F.col("chargetype_desc"), "CARTERA|transfer"), 1))
        .alias("con_cartera"))


@query("fn_period_key", """
SELECT periodo, periodo_menos4, count(*) AS n FROM (
 SELECT CAST(strftime(operacion, '%Y%m') AS INTEGER) AS periodo,
  CAST(strftime(operacion - INTERVAL 4 MONTH, '%Y%m') AS INTEGER) AS periodo_menos4 FROM cobros)
GROUP BY ALL""")
def fn_period_key(spark, d):
    c = F.col("operacion")
    return T.collections(spark, d).groupBy(
        D.period_key(c).alias("periodo"), D.period_key(c, 4).alias("periodo_menos4")).agg(
        F.count(F.lit(1)).alias("n"))


@query("fn_date_parts", f"""
SELECT CAST(year(fecha) AS INTEGER) AS yy_fecha, CAST(month(fecha) AS INTEGER) AS mm_fecha,
 count(*) AS n, {m('sum(monto)')} AS monto FROM loans GROUP BY 1, 2""")
def fn_date_parts(spark, d):
    return T.loans(spark, d).groupBy(
        F.year("fecha").alias("yy_fecha"), F.month("fecha").alias("mm_fecha")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("monto").alias("monto"))


@query("fn_label_codes", """
SELECT c_bpartner_id,
 CASE genero WHEN 'F' THEN 'Femenino' WHEN 'M' THEN 'Masculino' ELSE 'Pendiente' END AS genero,
 CASE tipo_localizacion WHEN 'U' THEN 'Urbano' WHEN 'R' THEN 'Rural' ELSE 'Pendiente' END AS tipo_localizacion
FROM partners""")
def fn_label_codes(spark, d):
    return T.partners(spark, d).select(
        "c_bpartner_id", S.gender_label(F.col("genero")).alias("genero"),
        S.zone_label(F.col("tipo_localizacion")).alias("tipo_localizacion"))


@query("fn_clean_id", "SELECT c_bpartner_id, replace(replace(taxid, '-', ''), ' ', '') AS cedula FROM partners")
def fn_clean_id(spark, d):
    return T.partners(spark, d).select("c_bpartner_id", S.clean_id(F.col("taxid")).alias("cedula"))


@query("fn_round_money", f"""
SELECT legacy_cobro_id, {m('abono * CAST(0.15 AS DECIMAL(3,2))')} AS r2,
 CAST(round(abono * CAST(0.12345 AS DECIMAL(6,5)), 4) AS DOUBLE) AS r4 FROM cobros""", digits=4)
def fn_round_money(spark, d):
    a = F.col("abono")
    return T.collections(spark, d).select(
        "legacy_cobro_id", S.round_money(a * S.dec("0.15", "decimal(3,2)")).alias("r2"),
        S.round_money(a * S.dec("0.12345", "decimal(6,5)"), 4).alias("r4"))


@query("fn_fx_fixed", """
SELECT c_payment_id, CAST(((2 * CAST(payamt * 100 AS BIGINT) + 35) // 70) AS DOUBLE) / 100 AS usd FROM pay""")
def fn_fx_fixed(spark, d):
    return T.cash_payments(spark, d).select("c_payment_id", S.fixed_fx(F.col("payamt")).alias("usd"))


@query("fn_payment_term", """
SELECT dias_cre, CASE dias_cre WHEN 23 THEN 1000001 WHEN 30 THEN 1000002 WHEN 50 THEN 1000003
  ELSE 1000000 END AS plazo_codigo, count(*) AS n FROM loans GROUP BY 1, 2""")
def fn_payment_term(spark, d):
    return T.loans(spark, d).groupBy(
        "dias_cre", S.payment_term(F.col("dias_cre")).alias("plazo_codigo")).agg(
        F.count(F.lit(1)).alias("n"))


@query("fn_audit_append", """
SELECT legacy_cartera_id, coalesce(synced, '') || chr(10) || 'revisado ' || strftime(fecha, '%Y-%m-%d') AS minilog
FROM loans""")
def fn_audit_append(spark, d):
    line = F.concat(F.lit("revisado "), F.date_format("fecha", "yyyy-MM-dd"))
    return T.loans(spark, d).select(
        "legacy_cartera_id", S.audit_append(F.col("synced"), line).alias("minilog"))
