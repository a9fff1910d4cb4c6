"""Sources, sinks and the incremental jobs."""

from pyspark.sql import functions as F

from loanbook.operators import balances as B
from loanbook.plans.q_balances import PARTNER_BALANCE
from loanbook.plans.q_bridges import PLAIN_REASON, RECEIPT, STRICT, cpend
from loanbook.plans.registry import query
from loanbook.plans.sqlviews import m
from loanbook.session import work_folder
from loanbook.sources import readers as R
from loanbook.sources import sinks as S
from loanbook.sources import tables as T
from loanbook.streaming import jobs as J


def _written(df, name, schema):
    """A frame as a file of the source's layout: columns of the schema, missing ones null."""
    path = work_folder(df.sparkSession, name)
    df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schema]).write.parquet(path)
    return path


@query("src_loans", f"""
SELECT legacy_cartera_id, c_bpartner_id, fecha, dias_cre, {m('monto')} AS monto, {m('montototal')} AS montototal, synced, aprobado,
 synced IS DISTINCT FROM 'Y' AS pendiente, aprobado = 'Y' AS aprobada FROM loans""")
def src_loans(spark, d):
    """Loans written as source files and read by the typed reader; their day loses its time."""
    stamped = T.loans(spark, d).withColumn("fecha", F.col("fecha").cast("timestamp_ntz") + F.expr("INTERVAL 15 HOUR"))
    return R.read_loans(spark, _written(stamped, "loans", R.LOAN_SCHEMA)).select(
        "legacy_cartera_id", "c_bpartner_id", "fecha", "dias_cre", "monto", "montototal", "synced", "aprobado",
        "pendiente", "aprobada")


@query("src_collections", f"""
SELECT id_cartera, c_bpartner_id, {m('abono')} AS abono, operacion, operacion_ts, synced, origen FROM cobros_own WHERE abono > 0""")
def src_collections(spark, d):
    """Collections with their time of day, partner and, for a part, no loan, read by the typed reader."""
    stamped = T.partner_collections(spark, d).drop("operacion", "legacy_cobro_id", "local_id").withColumnRenamed("operacion_ts", "operacion")
    return R.read_collections(spark, _written(stamped, "collections", R.COLLECTION_SCHEMA)).select(
        "id_cartera", "c_bpartner_id", "abono", "operacion", "operacion_ts", "synced", "origen")


def _catalogs(spark, d):
    def codes(table, code, value=None):
        return T.read(spark, d, table).select(F.col(code).alias("code"), F.col(value or code).alias("value"))

    seg = codes("customer", "c_mktsegment").distinct()
    # The priority code is its first character.
    prio = T.read(spark, d, "orders").select(
        F.substring("o_orderpriority", 1, 1).alias("code"), F.col("o_orderpriority").alias("value")).distinct()
    return R.catalogs({"rubro": seg, "plazo": prio, "ruta": codes("nation", "n_nationkey", "n_name"),
                       "sucursal": codes("region", "r_regionkey", "r_name"),
                       "zona": codes("nation", "n_regionkey", "n_name")})


CATS = """
 cat AS (SELECT DISTINCT 'rubro' AS catalogo, c_mktsegment AS codigo, c_mktsegment AS valor FROM customer
 UNION ALL SELECT DISTINCT 'plazo', left(o_orderpriority, 1), o_orderpriority FROM orders
 UNION ALL SELECT 'ruta', n_nationkey::VARCHAR, n_name FROM nation UNION ALL SELECT 'sucursal', r_regionkey::VARCHAR, r_name FROM region
 UNION ALL SELECT 'zona', n_regionkey::VARCHAR, n_name FROM nation)"""


@query("src_catalogs", f"WITH {CATS} SELECT 1000000 AS tenant, catalogo, codigo, valor FROM cat")
def src_catalogs(spark, d):
    return _catalogs(spark, d)


@query("src_catalogs_duplicates", f"WITH {CATS} SELECT 1000000 AS tenant, catalogo, codigo, count(*) AS n FROM cat GROUP BY ALL HAVING count(*) > 1")
def src_catalogs_duplicates(spark, d):
    return R.catalog_duplicates(_catalogs(spark, d))


@query("snk_period_partition", f"""
SELECT CAST(strftime(fecha, '%Y%m') AS INTEGER) AS c_period_id, count(*) AS filas, {m('sum(montototal)')} AS total FROM loans GROUP BY 1""")
def snk_period_partition(spark, d):
    """Loans by period; one period is written again, and one that held old rows is replaced by nothing."""
    path = work_folder(spark, "periods")
    rows = T.loans(spark, d).select(
        F.date_format("fecha", "yyyyMM").cast("int").alias("c_period_id"), "legacy_cartera_id", "montototal")
    stale = rows.limit(5).withColumn("c_period_id", F.lit(190001))
    S.write_period(rows.unionByName(stale).repartition("c_period_id"), path)
    S.write_period(rows.filter("c_period_id IN (199806, 190001)"), path, periods=[199806, 190001])
    return spark.read.parquet(path).groupBy("c_period_id").agg(
        F.count(F.lit(1)).alias("filas"), F.sum("montototal").alias("total"))


@query("snk_upsert", f"""
SELECT c_bpartner_id, nombre, {m("CASE WHEN saldo IS NOT NULL THEN saldo ELSE totalopenbalance END")} AS totalopenbalance
FROM (SELECT * FROM partners WHERE genero IS NOT NULL) p FULL JOIN ({PARTNER_BALANCE}) USING (c_bpartner_id)""")
def snk_upsert(spark, d):
    target = T.partners(spark, d).filter(F.col("genero").isNotNull()).select("c_bpartner_id", "nombre", "totalopenbalance")
    target = target.withColumn("totalopenbalance", F.col("totalopenbalance").cast("decimal(28,2)"))
    updates = B.partner_balance(T.loans(spark, d), T.collections(spark, d)).withColumnRenamed("saldo", "totalopenbalance")
    return S.upsert(target, updates, ["c_bpartner_id"])


@query("str_collections", f"WITH {cpend(STRICT)} {RECEIPT}, CAST(NULL AS BIGINT) AS c_invoice_id FROM cp WHERE {PLAIN_REASON} IS NULL")
def str_collections(spark, d):
    """Three deliveries of many files, one batch each: dates in no order, every delivery repeats a part of the one before.

    The stream is started after each delivery; the last start finds nothing new.
    """
    inbox, out, mark = (work_folder(spark, x) for x in ("inbox", "receipts", "marks"))
    rows = T.read(spark, d, "lineitem").withColumn("_n", F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey"), F.lit(3)))
    for n in (0, 1, 2, None):
        if n is not None:
            again = (F.col("_n") == n - 1) & (F.col("l_linenumber") <= 2)
            rows.filter((F.col("_n") == n) | again).drop("_n").write.mode("append").parquet(inbox)
        raw = J.file_stream(spark, inbox, rows.drop("_n").schema, "*.parquet")
        J.bridge_collections_stream(T.map_collections(raw), T.loans(spark, d), T.partners(spark, d), T.users(spark, d), out, mark)
    return spark.read.parquet(f"{out}/payments").drop("batch")


@query("str_invoice_open", f"""
SELECT o_orderkey * 10 + 1 AS c_invoice_id, o_custkey AS c_bpartner_id, CAST(o_orderdate AS DATE) AS dateinvoiced,
 {m('CAST(o_totalprice AS DECIMAL(18,4)) - coalesce(a, 0)')} AS saldo
FROM orders LEFT JOIN (SELECT c_invoice_id, sum(amount) AS a FROM alloc GROUP BY 1) ON c_invoice_id = o_orderkey * 10 + 1
WHERE o_orderstatus <> 'P' AND o_custkey > 0""")
def str_invoice_open(spark, d):
    """Two changes per customer invoice, of which the later one has the right amount."""
    out, mark = work_folder(spark, "open"), work_folder(spark, "marks")
    raw = J.file_stream(spark, d, T.read(spark, d, "orders").schema, "orders.parquet")
    total = F.col("o_totalprice").cast("decimal(18,4)")
    stream = raw.select(
        (F.col("o_orderkey") * 10 + 1).alias("c_invoice_id"), F.col("o_custkey").alias("c_bpartner_id"),
        F.col("o_orderdate").cast("date").alias("dateinvoiced"),
        F.when(F.col("o_orderstatus") == "P", "N").otherwise("Y").alias("issotrx"),
        F.explode(F.array(F.struct(F.lit(1).alias("version"), (total / 2).cast("decimal(18,4)").alias("grandtotal")),
                          F.struct(F.lit(2).alias("version"), total.alias("grandtotal")))).alias("v"))
    stream = stream.select("c_invoice_id", "c_bpartner_id", "dateinvoiced", "issotrx", "v.version", "v.grandtotal")
    J.invoice_open_stream(stream, T.allocations(spark, d), out, mark)
    return J.open_snapshot(spark, out)
