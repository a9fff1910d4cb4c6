"""Migration and master data over tables derived from the test set."""

from pyspark.sql import functions as F

from loanbook.operators import migration as M
from loanbook.plans.registry import query
from loanbook.plans.sqlviews import m
from loanbook.sources import readers as R
from loanbook.sources import tables as T

FIRST = M.FIRST_ID


def legacy_collections(spark, d):
    """Source rows from events; those of type purchase are in the target already."""
    p = T.cash_payments(spark, d)
    src = p.select(F.col("c_payment_id").alias("id_cobro"), "ad_org_id", F.col("payamt").alias("abono"))
    tgt = p.filter(F.col("event_type") == "purchase").select(
        (F.col("c_payment_id") + FIRST).alias("legacy_cobro_id"), F.col("c_payment_id").alias("id_cobro"), "ad_org_id")
    return src, tgt


MAXC = f"(SELECT coalesce(max(c_payment_id + {FIRST}), {FIRST}) FROM pay WHERE event_type = 'purchase')"


@query("mig_collections", f"""
SELECT {MAXC} + row_number() OVER (ORDER BY c_payment_id) AS legacy_cobro_id, c_payment_id AS id_cobro, ad_org_id, {m('payamt')} AS abono,
 'migrated' AS origen, 'N' AS synced FROM pay WHERE payamt > 0 AND event_type <> 'purchase'""")
def mig_collections(spark, d):
    return M.migrate_collections(*legacy_collections(spark, d))["inserts"]


@query("mig_collections_updates", f"""
SELECT c_payment_id + {FIRST} AS legacy_cobro_id, c_payment_id AS id_cobro, ad_org_id, {m('payamt')} AS abono, 'migrated' AS origen
FROM pay WHERE payamt > 0 AND event_type = 'purchase'""")
def mig_collections_updates(spark, d):
    return M.migrate_collections(*legacy_collections(spark, d))["updates"]


@query("mig_loans", f"""
SELECT (SELECT coalesce(max(legacy_cartera_id + {FIRST}), {FIRST}) FROM loans WHERE synced = 'Y') + row_number() OVER (ORDER BY legacy_cartera_id) AS legacy_cartera_id,
 legacy_cartera_id AS id_cartera, ad_org_id, fecha, {m('monto')} AS monto, 'migrated' AS origen, 'Y' AS aprobado FROM loans WHERE synced IS DISTINCT FROM 'Y'""")
def mig_loans(spark, d):
    ln = T.loans(spark, d)
    src = ln.select(F.col("legacy_cartera_id").alias("id_cartera"), "ad_org_id", "fecha", "monto")
    tgt = ln.filter(F.col("synced") == "Y").select(
        (F.col("legacy_cartera_id") + FIRST).alias("legacy_cartera_id"),
        F.col("legacy_cartera_id").alias("id_cartera"), "ad_org_id")
    return M.migrate_loans(src, tgt)


@query("mig_partners", f"""
WITH act AS (SELECT DISTINCT rubro AS id_actividad, lower(rubro) AS actividad FROM partners WHERE rubro <> 'MACHINERY')
SELECT (SELECT coalesce(max(c_bpartner_id + {FIRST}), {FIRST}) FROM partners WHERE rubro = 'BUILDING') + row_number() OVER (ORDER BY c_bpartner_id) AS legacy_cliente_id,
 c_bpartner_id AS id_cliente, c_greeting_id AS ad_org_id, rubro AS id_actividad, actividad, nombre, 'migrated' AS origen
FROM partners LEFT JOIN act ON id_actividad = rubro WHERE rubro <> 'BUILDING'""")
def mig_partners(spark, d):
    p = T.partners(spark, d)
    src = p.select(F.col("c_bpartner_id").alias("id_cliente"), F.col("c_greeting_id").alias("ad_org_id"),
                   F.col("rubro").alias("id_actividad"), "nombre")
    tgt = p.filter(F.col("rubro") == "BUILDING").select(
        (F.col("c_bpartner_id") + FIRST).alias("legacy_cliente_id"), F.col("c_bpartner_id").alias("id_cliente"),
        F.col("c_greeting_id").alias("ad_org_id"))
    act = p.filter(F.col("rubro") != "MACHINERY").select(
        F.col("rubro").alias("id_actividad"), F.lower("rubro").alias("actividad")).distinct()
    return M.migrate_partners(src, act, tgt)


def territories(spark, d):
    return T.routes(spark, d).select(
        F.col("cv_ruta_id").cast("bigint").alias("id_territorio"), F.col("ad_org_trx_id").alias("ad_org_id"),
        F.col("ruta").alias("zona"), F.concat(F.lit("T"), F.col("cv_ruta_id").cast("string")).alias("codigo"))


@query("mig_territories", f"""
SELECT (SELECT coalesce(max(cv_ruta_id + {FIRST}), {FIRST}) FROM routes WHERE ad_org_trx_id < 2) + row_number() OVER (ORDER BY cv_ruta_id) AS legacy_territorio_id,
 CAST(cv_ruta_id AS BIGINT) AS id_territorio, ad_org_trx_id AS ad_org_id, ruta AS zona, 'T' || cv_ruta_id AS codigo, 'migrated' AS origen
FROM routes WHERE ad_org_trx_id >= 2""")
def mig_territories(spark, d):
    src = territories(spark, d)
    tgt = src.filter("ad_org_id < 2").select(
        (F.col("id_territorio") + FIRST).alias("legacy_territorio_id"), "id_territorio", "ad_org_id")
    return M.migrate_territories(src, tgt)


@query("mig_routes", """
SELECT CAST(cv_ruta_id AS BIGINT) AS id_territorio, ad_org_trx_id AS ad_org_id,
 CASE WHEN ad_org_trx_id < 2 THEN cv_ruta_id END AS cv_ruta_id, CASE WHEN ad_org_trx_id >= 2 THEN ruta END AS name FROM routes""")
def mig_routes(spark, d):
    known = T.routes(spark, d).filter("ad_org_trx_id < 2").select(
        F.col("cv_ruta_id").cast("bigint").alias("id_territorio"), F.col("ad_org_trx_id").alias("ad_org_id"), "cv_ruta_id")
    out = M.territories_to_routes(territories(spark, d), known)
    return out["linked"].withColumn("name", F.lit(None).cast("string")).unionByName(
        out["created"].select("id_territorio", "ad_org_id", F.lit(None).cast("int").alias("cv_ruta_id"), "name"))


# One opening balance line per loan; part of the names carry a typing error or are unknown.
def balance_lines(spark, d):
    ln, p = T.loans(spark, d), T.partners(spark, d).select("c_bpartner_id", "nombre")
    k = F.col("legacy_cartera_id")
    name = (F.when(k % 5 == 0, F.concat(F.col("nombre"), F.lit("x")))
            .when(k % 5 == 1, F.regexp_replace("nombre", "Customer", "Cstomer"))
            .when(k % 5 == 2, F.concat(F.lit("Tercero desconocido "), F.col("nombre"))).otherwise(F.col("nombre")))
    date = F.when(k % 50 == 7, F.lit("sin fecha")).otherwise(F.date_format("fecha", "yyyy-MM-dd"))
    return ln.join(p, "c_bpartner_id").select(k.alias("row_id"), F.concat_ws(
        ";", k.cast("string"), name, date, F.col("monto").cast("string"), F.col("montototal").cast("string"), F.lit("x"),
        F.round(F.col("montototal") * F.lit("0.5").cast("decimal(2,1)"), 2).cast("decimal(18,2)").cast("string"),
        F.date_format(F.date_add("fecha", F.col("dias_cre")), "yyyy-MM-dd")).alias("value"))


BALANCE = f"""
 bl AS MATERIALIZED (SELECT legacy_cartera_id AS row_id, legacy_cartera_id::VARCHAR AS tarjeta,
  CASE legacy_cartera_id % 5 WHEN 0 THEN nombre || 'x' WHEN 1 THEN replace(nombre, 'Customer', 'Cstomer') WHEN 2 THEN 'Tercero desconocido ' || nombre ELSE nombre END AS name,
  CASE WHEN legacy_cartera_id % 50 <> 7 THEN fecha END AS fecha, monto, montototal, CAST(round(montototal * CAST(0.5 AS DECIMAL(2,1)), 2) AS DECIMAL(18,2)) AS saldo,
  CAST(fecha + dias_cre AS DATE) AS vencimiento FROM loans JOIN partners USING (c_bpartner_id))"""


@query("src_balance_csv", f"""
WITH {BALANCE} SELECT row_id, tarjeta, name, fecha, {m('monto')} AS monto, {m('montototal')} AS montototal, {m('saldo')} AS saldo, vencimiento,
 fecha IS NULL AS no_valida FROM bl""")
def src_balance_csv(spark, d):
    return R.parse_opening_balances(balance_lines(spark, d)).withColumn(
        "no_valida", F.col("corrupt").isNotNull()).drop("corrupt")


NEAR = """
 near AS MATERIALIZED (SELECT name, c_bpartner_id, dist FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY dist, c_bpartner_id) AS rn FROM (
  SELECT n.name, p.c_bpartner_id, levenshtein(n.name, p.nombre) AS dist FROM (SELECT DISTINCT name FROM bl) n, partners p)) WHERE rn = 1)"""


def _names(spark, d):
    rows = R.parse_opening_balances(balance_lines(spark, d))
    return rows, M.nearest_partner(rows.select("row_id", "name"), T.partners(spark, d))


@query("mig_nearest_partner", f"""
WITH {BALANCE}, {NEAR} SELECT row_id, bl.name, c_bpartner_id, CAST(dist AS INTEGER) AS distancia FROM bl LEFT JOIN near USING (name)""")
def mig_nearest_partner(spark, d):
    return _names(spark, d)[1]


OPENING = f"""
 ol AS MATERIALIZED (SELECT bl.*, n.c_bpartner_id, min(row_id) FILTER (fecha IS NOT NULL) OVER (PARTITION BY n.c_bpartner_id) AS first_row,
   n.c_bpartner_id IN (SELECT c_bpartner_id FROM loans WHERE origen = 'migrated' AND synced = 'Y') AS taken
  FROM bl LEFT JOIN near n USING (name))"""


def _opening(spark, d):
    rows, match = _names(spark, d)
    migrated = T.loans(spark, d).filter("origen = 'migrated' AND synced = 'Y'")
    return M.opening_loans(rows, match, T.partners_wide(spark, d), migrated)


@query("mig_opening_loans", f"""
WITH {BALANCE}, {NEAR}, {OPENING}
SELECT row_id, c_bpartner_id, ad_org_trx_id AS ad_org_id, fecha, 'Migrado from tarjeta: ' || tarjeta AS concepto,
 CAST(greatest(30, vencimiento - fecha) AS INTEGER) AS dias_cre, CAST((2 * CAST(montototal * 100 AS HUGEINT) + 30) // 60 AS DOUBLE) / 100 AS cuota,
 {m('monto')} AS monto, {m('montototal - monto')} AS valorinteres, {m('montototal')} AS montototal, {m('montototal - saldo')} AS abono, {m('saldo')} AS saldo,
 CAST((2 * CAST((montototal - monto) * 10000 AS HUGEINT) + CAST(monto * 100 AS HUGEINT)) // (2 * CAST(monto * 100 AS HUGEINT)) AS DOUBLE) / 100 AS tasa,
 'N' AS synced, 'migrado' AS origen, 'Y' AS aprobado
FROM ol JOIN pwide USING (c_bpartner_id) WHERE fecha IS NOT NULL AND NOT taken AND row_id = first_row""")
def mig_opening_loans(spark, d):
    return _opening(spark, d)["loans"]


@query("mig_opening_loans_rejects", f"""
WITH {BALANCE}, {NEAR}, {OPENING}
SELECT row_id, c_bpartner_id, CASE WHEN fecha IS NULL THEN 'linea no valida' WHEN c_bpartner_id IS NULL THEN 'tercero no encontrado'
 ELSE 'tercero con prestamo migrado' END AS motivo
FROM ol WHERE fecha IS NULL OR c_bpartner_id IS NULL OR taken OR row_id <> first_row""")
def mig_opening_loans_rejects(spark, d):
    return _opening(spark, d)["rejects"]


@query("mig_opening_payments", f"""
SELECT legacy_cartera_id AS id_cartera, c_bpartner_id, ad_org_id, {m('coalesce(p, 0)')} AS abono, {m('cuota')} AS cuota, DATE '2001-12-31' AS operacion,
 'Y' AS synced, 'migrado' AS origen, 'valido' AS cobrostatus
FROM loans LEFT JOIN (SELECT id_cartera, sum(abono) AS p FROM cobros GROUP BY 1) x ON x.id_cartera = legacy_cartera_id
WHERE loans.origen = 'migrated' AND montototal - coalesce(p, 0) > 0""")
def mig_opening_payments(spark, d):
    return M.opening_payments(T.loans(spark, d), T.collections(spark, d), "2001-12-31")


@query("mig_partner_match", f"""
WITH cli AS (SELECT c_bpartner_id + {FIRST} AS legacy_cliente_id, CASE WHEN c_bpartner_id % 3 = 0 THEN 'sin cedula' ELSE coalesce(taxid, '-') END AS cedula,
  CASE WHEN c_bpartner_id % 2 = 0 THEN 'C' ELSE 'Z' END || '-' || c_bpartner_id AS codigo, cv_ruta_id % 7 AS ad_org_id, cv_ruta_id AS vend FROM partners),
 byid AS (SELECT taxid, min(c_bpartner_id) AS i FROM partners WHERE taxid IS NOT NULL GROUP BY 1),
 bycode AS (SELECT 'C-' || c_bpartner_id AS cc, c_bpartner_id AS c FROM partners)
SELECT legacy_cliente_id, cedula, codigo, r.cv_ruta_id, coalesce(i, c) AS c_bpartner_id,
 CASE WHEN r.cv_ruta_id IS NULL THEN 'ruta no valida' WHEN i IS NOT NULL THEN 'por cedula' WHEN c IS NOT NULL THEN 'por codigo' ELSE 'crear' END AS accion
FROM cli LEFT JOIN byid ON taxid = cedula LEFT JOIN bycode ON cc = codigo LEFT JOIN routes r ON r.ad_org_trx_id = cli.ad_org_id AND r.cv_ruta_id = vend""")
def mig_partner_match(spark, d):
    p = T.partners(spark, d)
    k = F.col("c_bpartner_id")
    cli = p.select(
        (k + FIRST).alias("legacy_cliente_id"),
        F.when(k % 3 == 0, "sin cedula").otherwise(F.coalesce("taxid", F.lit("-"))).alias("cedula"),
        F.when(k % 2 == 0, "C").otherwise("Z").alias("org_key"), k.cast("string").alias("codigo"),
        (F.col("cv_ruta_id") % 7).alias("ad_org_id"), F.col("cv_ruta_id").alias("id_vendedor"))
    routes = T.routes(spark, d).select(F.col("ad_org_trx_id").alias("ad_org_id"),
                                       F.col("cv_ruta_id").alias("id_territorio"), "cv_ruta_id")
    coded = p.withColumn("codigo", F.concat(F.lit("C-"), k.cast("string")))
    return M.match_partners(cli, coded, routes)


def cities(spark, d):
    """City of each branch; the last branch has none."""
    return T.branches(spark, d).filter("ad_org_id < 4").select(
        F.col("ad_org_id").alias("ad_org_trx_id"), (F.col("ad_org_id") + 500).alias("c_city_id"),
        F.concat(F.lit("Ciudad "), F.col("org_name")).alias("city"))


def partner_lines(spark, d):
    k = F.col("s_suppkey")
    s = T.read(spark, d, "supplier")
    new_id = F.concat(F.lit("N-"), (k % 40).cast("string"))
    old_id = F.concat(F.lpad((k % 1000).cast("string"), 3, "0"), F.lit("-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"),
                      F.lpad((k % 12 + 1).cast("string"), 2, "0"), F.lpad((k % 100).cast("string"), 2, "0"), F.lit("-"),
                      F.lpad((k % 10000).cast("string"), 4, "0"), F.lit("K"))
    return s.select(k.alias("row_id"), F.concat_ws(
        ";", F.lit("a"), F.lit("b"), F.when(k % 4 == 0, old_id).otherwise(new_id), F.col("s_name"),
        F.concat(F.lit("Calle "), k.cast("string")), F.lit("555"), F.lit("c"),
        F.when(k % 9 == 0, "x").otherwise(F.col("s_nationkey").cast("string")), F.lit("d"), F.lit("e"),
        (k % 5).cast("string")).alias("value"))


PLINES = """
 pl AS MATERIALIZED (SELECT s_suppkey AS row_id, CASE WHEN s_suppkey % 4 = 0 THEN lpad((s_suppkey % 1000)::VARCHAR, 3, '0') || '-' || lpad((s_suppkey % 28 + 1)::VARCHAR, 2, '0')
   || lpad((s_suppkey % 12 + 1)::VARCHAR, 2, '0') || lpad((s_suppkey % 100)::VARCHAR, 2, '0') || '-' || lpad((s_suppkey % 10000)::VARCHAR, 4, '0') || 'K'
   ELSE 'N-' || (s_suppkey % 40) END AS cedula, s_name AS nombre, 'Calle ' || s_suppkey AS direccion, '555' AS telefono,
  CASE WHEN s_suppkey % 9 <> 0 THEN s_nationkey END AS cv_ruta_id, CAST(s_suppkey % 5 AS INTEGER) AS c_bp_group_id FROM supplier)"""


@query("src_partner_csv", f"WITH {PLINES} SELECT *, cv_ruta_id IS NULL AS no_valida FROM pl")
def src_partner_csv(spark, d):
    return R.parse_partners(partner_lines(spark, d)).withColumn("no_valida", F.col("corrupt").isNotNull()).drop("corrupt")


PNEW = f"""
 {PLINES}, x AS MATERIALIZED (SELECT pl.*, r.ad_org_trx_id, CASE WHEN r.ad_org_trx_id < 4 THEN r.ad_org_trx_id + 500 END AS c_city_id,
  CASE WHEN pl.cv_ruta_id IS NULL THEN 'fila no valida' WHEN r.ad_org_trx_id IS NULL THEN 'ruta no encontrada' WHEN r.ad_org_trx_id >= 4 THEN 'ciudad no encontrada'
   WHEN cedula IN (SELECT taxid FROM partners WHERE taxid IS NOT NULL) OR row_id <> min(row_id) OVER (PARTITION BY cedula) THEN 'cedula ya registrada' END AS motivo
  FROM pl LEFT JOIN routes r USING (cv_ruta_id))"""


def _partners_csv(spark, d):
    routes = T.routes(spark, d).select("cv_ruta_id", "ad_org_trx_id")
    return M.partners_from_csv(R.parse_partners(partner_lines(spark, d)), T.partners(spark, d), routes, cities(spark, d))


@query("mig_partners_csv", f"""
WITH {PNEW} SELECT row_id, cedula, nombre, direccion, telefono, cv_ruta_id, c_bp_group_id, ad_org_trx_id, c_city_id FROM x WHERE motivo IS NULL""")
def mig_partners_csv(spark, d):
    return _partners_csv(spark, d)["partners"]


@query("mig_partners_csv_rejects", f"WITH {PNEW} SELECT row_id, cedula, motivo FROM x WHERE motivo IS NOT NULL")
def mig_partners_csv_rejects(spark, d):
    return _partners_csv(spark, d)["rejects"]


def applications(spark, d):
    """Applications of all partners: some with a known id, some already processed, some twice."""
    k = F.col("c_bpartner_id")
    p = T.partners(spark, d)
    cedula = F.when(k % 3 == 0, F.col("taxid")).otherwise(F.concat(F.lit("A-"), (k % 900).cast("string"), F.lit(" 1")))
    return p.select(
        k.alias("solicitud_id"), cedula.alias("cedula"), "nombre", (k % 6).cast("int").alias("ad_org_id"),
        F.col("cv_ruta_id").alias("idruta"), F.col("rubro").alias("idrubro"), F.col("totalopenbalance").alias("monto"),
        F.when(k % 10 == 0, "Y").alias("synced"), "genero", "tipo_localizacion",
        F.concat(F.lit("Calle "), k.cast("string")).alias("direccion"), F.lit("555").alias("telefono"))


APPS = """
 ap0 AS (SELECT *, c_bpartner_id AS solicitud_id, CASE WHEN c_bpartner_id % 3 = 0 THEN taxid ELSE 'A-' || (c_bpartner_id % 900) || ' 1' END AS cedula,
  CAST(c_bpartner_id % 6 AS INTEGER) AS org, CASE WHEN c_bpartner_id % 10 = 0 THEN 'Y' END AS synced FROM partners),
 ap1 AS (SELECT *, replace(replace(cedula, '-', ''), ' ', '') AS clean FROM ap0),
 ap AS MATERIALIZED (SELECT *, CASE WHEN org > 4 THEN 'organizacion no valida' WHEN org = 4 THEN 'sin ciudad'
   WHEN cedula IN (SELECT taxid FROM partners WHERE taxid IS NOT NULL) THEN 'cedula ya registrada' WHEN synced = 'Y' THEN 'ya procesada'
   WHEN solicitud_id <> min(CASE WHEN synced IS DISTINCT FROM 'Y' THEN solicitud_id END) OVER (PARTITION BY clean) AND clean IS NOT NULL THEN 'cedula repetida' END AS motivo FROM ap1)"""


def _apps(spark, d):
    return M.approve_applications(applications(spark, d), T.partners(spark, d), T.branches(spark, d), cities(spark, d))


@query("mig_applications", f"""
WITH {APPS} SELECT solicitud_id, nombre, clean AS taxid, org AS ad_org_trx_id, cv_ruta_id, rubro AS c_bp_group_id, {m('totalopenbalance')} AS so_creditlimit,
 genero, tipo_localizacion FROM ap WHERE motivo IS NULL""")
def mig_applications(spark, d):
    return _apps(spark, d)["partners"]


@query("mig_applications_locations", f"""
WITH {APPS} SELECT solicitud_id, org + 500 AS c_city_id, 'Ciudad ' || org_name AS name, 'Calle ' || solicitud_id AS address1, '555' AS phone
FROM ap JOIN branches ON ad_org_id = org WHERE motivo IS NULL""")
def mig_applications_locations(spark, d):
    return _apps(spark, d)["locations"]


@query("mig_applications_rejects", f"WITH {APPS} SELECT solicitud_id, motivo FROM ap WHERE motivo IS NOT NULL")
def mig_applications_rejects(spark, d):
    return _apps(spark, d)["rejects"]


@query("mig_locations", """
SELECT c_bpartner_id, ad_org_trx_id + 500 AS c_city_id, 'Ciudad ' || sucursal AS name, 'Calle ' || c_bpartner_id AS address1, '555' AS phone
FROM pwide WHERE NOT has_location AND c_bpartner_id % 5 <> 0 AND ad_org_trx_id < 4""")
def mig_locations(spark, d):
    k = F.col("c_bpartner_id")
    p = T.partners_wide(spark, d).withColumn("quickaddress", F.when(
        k % 5 != 0, F.concat(F.lit("Calle "), k.cast("string"))).otherwise("")).withColumn("quickphone", F.lit("555"))
    have = T.partners(spark, d).filter("has_location").select("c_bpartner_id")
    return M.missing_locations(p, have, cities(spark, d))


@query("mig_clone_rows", "SELECT cv_ruta_id AS child, CAST(9 AS INTEGER) AS parent, ruta FROM routes WHERE ad_org_trx_id = 2")
def mig_clone_rows(spark, d):
    children = T.routes(spark, d).select(F.col("cv_ruta_id").alias("child"), F.col("ad_org_trx_id").alias("parent"), "ruta")
    return M.clone_rows(children, "parent", 2, 9)
