"""The lending data model over the Parquet tables of the test set.

Loans come from ``orders``, collections from ``lineitem`` (one narrow projection,
no join, so date filters reach the scan), partners from ``customer``, routes and
branches from ``nation`` and ``region``, users from ``supplier`` and cash payments
from ``events``. Each function is a lazy projection; nothing is cached or collected.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook import config
from loanbook.functions.dates import add_six_day
from loanbook.functions.scalars import dec


# Columns of the tables; with them, reading starts no job to look into the files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


#: Instalments of a loan by the first character of its priority, and of all other loans.
TERMS, TERM_OTHERWISE = {"1": 23, "2": 30, "3": 50, "4": 60}, 90


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _interest_total(monto, tasa, n):
    return F.round(monto * tasa * n.cast("decimal(6,0)") * dec("12", "decimal(2,0)")
                   / dec("360", "decimal(3,0)"), 4).cast("decimal(18,4)")


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    days = F.lit(TERM_OTHERWISE)
    for first, term in TERMS.items():
        days = F.when(F.substring("o_orderpriority", 1, 1) == first, term).otherwise(days)
    base = o.select(
        key.alias("legacy_cartera_id"),
        F.col("o_custkey").alias("c_bpartner_id"),
        (key % 5).cast("int").alias("ad_org_id"),
        F.col("o_orderdate").cast("date").alias("fecha"),
        days.cast("int").alias("dias_cre"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("monto"),
        dec("0.15", "decimal(10,4)").alias("tasa"),
        F.when(F.col("o_orderstatus") == "F", "Y").when(F.col("o_orderstatus") == "O", "N")
        .alias("synced"),
        F.when(key % 10 == 0, "N").otherwise("Y").alias("aprobado"),
        F.when(key % 97 == 0, "N").otherwise("Y").alias("isactive"),
        F.when(key % 4 == 3, "migrated").otherwise("native").alias("origen"),
        (key % 12).alias("createdby"),
        F.concat((key % 90).cast("string"), F.lit(".5|-"), (key % 180).cast("string"),
                 F.lit(".25")).alias("coords"),
    )
    n = F.col("dias_cre")
    return (
        base.withColumn("valorinteres", _interest_total(F.col("monto"), F.col("tasa"), n))
        .withColumn("montototal",
                    F.round(F.col("monto") + F.col("valorinteres"), 2).cast("decimal(18,2)"))
        .withColumn("cuota", F.round(F.col("montototal") / n.cast("decimal(6,0)"), 4)
                    .cast("decimal(18,4)"))
        .withColumn("local_id", F.when(F.col("synced") == "Y", F.col("legacy_cartera_id") * 10 + 1))
        .withColumn("payment_id", F.when(F.col("synced") == "Y", F.col("legacy_cartera_id") * 10 + 2))
    )


def collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per collection; the key is (order, line, part, supplier)."""
    return map_collections(read(spark, sf_dir, "lineitem"))


def map_collections(li: DataFrame) -> DataFrame:
    """Collections from line items, in a batch or in a stream."""
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return li.select(
        key.alias("legacy_cobro_id"),
        F.col("l_orderkey").alias("id_cartera"),
        F.round(F.col("l_extendedprice").cast("decimal(18,2)") * dec("0.60", "decimal(3,2)"), 2)
        .cast("decimal(18,2)").alias("abono"),
        F.col("l_shipdate").cast("date").alias("operacion"),
        (F.col("l_shipdate").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("l_partkey") % 86400)).alias("operacion_ts"),
        F.when(F.col("l_returnflag") == "R", "Y").when(F.col("l_returnflag") == "A", "N")
        .alias("synced"),
        F.when(F.col("l_linestatus") == "O", "native").otherwise("migrated").alias("origen"),
        F.col("l_suppkey").alias("createdby"),
        (F.col("l_suppkey") % 5).cast("int").alias("ad_org_id"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("P-"), key)).alias("local_id"),
        F.concat((F.col("l_partkey") % 90).cast("string"), F.lit(".125|-"),
                 (F.col("l_suppkey") % 180).cast("string"), F.lit(".75")).alias("coords"),
    )


def partner_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collections that carry their own partner; those of every 50th order have no loan."""
    owner = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id_cartera"), F.col("o_custkey").alias("c_bpartner_id"))
    return collections(spark, sf_dir).join(owner, "id_cartera").withColumn(
        "id_cartera", F.when(F.col("id_cartera") % 50 != 0, F.col("id_cartera")))


def partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    ddmmyy = F.concat(F.lpad((k % 28 + 1).cast("string"), 2, "0"),
                      F.lpad((k % 12 + 1).cast("string"), 2, "0"),
                      F.lpad((k % 100).cast("string"), 2, "0"))
    taxid = F.concat(F.lpad((k % 1000).cast("string"), 3, "0"), F.lit("-"), ddmmyy, F.lit("-"),
                     F.lpad((k % 10000).cast("string"), 4, "0"), F.lit("K"))
    return c.select(
        k.alias("c_bpartner_id"),
        F.concat(F.lit("C"), k.cast("string")).alias("codigo"),
        F.col("c_name").alias("nombre"),
        F.col("c_nationkey").alias("cv_ruta_id"),
        F.col("c_mktsegment").alias("rubro"),
        F.when(k % 17 == 0, F.lit(None)).otherwise(taxid).alias("taxid"),
        F.when(k % 3 == 0, "F").when(k % 3 == 1, "M").alias("genero"),
        F.when(k % 4 == 0, "U").when(k % 4 == 1, "R").alias("tipo_localizacion"),
        F.when(k % 5 == 0, "S").when(k % 5 == 1, "C").alias("civilstatus"),
        F.substring(F.lit("ABCDE"), (k % 5 + 1).cast("int"), F.lit(1)).alias("tipo_riesgo"),
        F.when(k % 2 == 0, F.date_add(F.lit("1960-01-01").cast("date"), (k % 9000).cast("int")))
        .alias("birthday"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("totalopenbalance"),
        (k % 4).cast("int").alias("c_greeting_id"),
        (k % 7 != 0).alias("has_location"),
    )


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes with their branch. Fixed size: one row per nation."""
    n, r = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("cv_ruta_id"),
        F.col("n_name").alias("ruta"),
        F.col("r_regionkey").alias("ad_org_trx_id"),
        F.col("r_name").alias("sucursal"),
    )


def branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("ad_org_id"), F.col("r_name").alias("org_name"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and their cash box; box 0 means that the user has none."""
    s = read(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("ad_user_id"),
        F.col("s_name").alias("usuario"),
        F.col("s_nationkey").alias("user_ruta_id"),
        (F.col("s_suppkey") % 20).cast("int").alias("c_bankaccount_id"),
    )


def route_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owner of a route: its user with the lowest id. At most one row per route."""
    u = users(spark, sf_dir)
    return u.groupBy(F.col("user_ruta_id").alias("cv_ruta_id")).agg(
        F.min("ad_user_id").alias("owner_id"), F.min_by("usuario", "ad_user_id").alias("owner"))


def partners_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partners with route and branch names (fixed-size dimension, broadcast)."""
    return partners(spark, sf_dir).join(routes(spark, sf_dir), "cv_ruta_id")


def periods(spark: SparkSession, first: str = "1995-01-01", months: int = 84) -> DataFrame:
    """Accounting months with id YYYYMM; its size is the number of months."""
    start = F.add_months(F.lit(first).cast("date"), F.col("id").cast("int"))
    return spark.range(months).select(
        F.date_format(start, "yyyyMM").cast("int").alias("c_period_id"),
        F.date_format(start, "yyyy-MM").alias("name"),
        start.alias("startdate"),
        F.last_day(start).alias("enddate"),
    )


def cash_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    kind, user, eid = F.col("event_type"), F.col("user_id"), F.col("event_id")
    doctype = (
        F.when(kind == "purchase", config.DOC_RECEIPT)
        .when(kind == "signup", config.DOC_DISBURSEMENT)
        .when(kind == "view", config.DOC_TRANSFER_IN)
        .otherwise(config.DOC_EXPENSE)
    )
    charge = (
        F.when(kind == "signup", config.CHARGE_DISBURSEMENT)
        .when(kind.isin("view", "error"), config.CHARGE_TRANSFER)
        .when((kind == "click") & (eid % 9 != 0), (1000040 + user % 4).cast("int"))
    )
    return e.select(
        eid.alias("c_payment_id"),
        (user % 20).cast("int").alias("c_bankaccount_id"),
        (user % 5).cast("int").alias("ad_org_id"),
        user.alias("c_bpartner_id"),
        F.col("value").cast("decimal(18,2)").alias("payamt"),
        F.col("ts").cast("date").alias("dateacct"),
        F.col("ts").alias("created"),
        doctype.cast("int").alias("c_doctype_id"),
        F.when(kind.isin("purchase", "view"), "ARR").otherwise("APP").alias("docbasetype"),
        charge.cast("int").alias("c_charge_id"),
        F.when((kind == "purchase") & (user % 3 != 0), eid * 10).alias("c_invoice_id"),
        F.when(eid % 211 == 0, "DR").when(eid % 13 == 0, "VO").otherwise("CO").alias("docstatus"),
        kind.alias("event_type"),
    )


def fixed_rows(spark: SparkSession, values: list[tuple], schema: str) -> DataFrame:
    """A dimension of literals, kept in the plan. ``schema``: 'name type, name type'."""
    fields = [f.split() for f in schema.split(", ")]
    rows = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, fields)]) for row in values]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))


def boxes(spark: SparkSession) -> DataFrame:
    """Cash boxes: ids 0-4 are the central boxes of the branches, the rest collectors'."""
    i = F.col("id").cast("int")
    return spark.range(20).select(
        i.alias("c_bankaccount_id"),
        F.concat(F.lit("B"), F.lpad(i.cast("string"), 2, "0")).alias("codcaja"),
        F.concat(F.lit("Caja "), i.cast("string")).alias("nombrecaja"),
        F.when(i < 5, "SUCURSAL").otherwise("COBRADOR").alias("tipocaja"),
        (i % 5).cast("int").alias("box_org_id"),
    )


def charges(spark: SparkSession) -> DataFrame:
    """Charges with the name and description of their type (fixed values)."""
    return fixed_rows(spark, [
        (config.CHARGE_DISBURSEMENT, "Desembolso", "Cartera", "cartera"),
        (config.CHARGE_TRANSFER, "Transferencia", "Cajas", "Transferencia entre cajas"),
        (1000040, "Combustible", "Operativo", "gasto"),
        (1000041, "Papeleria", "Operativo", "gasto"),
        (1000042, "Servicios", "Administrativo", "gasto"),
        (1000043, "Ajuste", "Administrativo", "InOut"),
    ], "c_charge_id int, cargo string, chargetype string, chargetype_desc string")


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored schedule: equal interest per instalment, the first ones of synced loans billed.

    The instalments come from a join with their numbers: Spark takes exploded rows for as few as the loans, and
    would broadcast them.
    """
    numbers = spark.range(1, max(TERM_OTHERWISE, *TERMS.values()) + 1, 1, 1).select(F.col("id").cast("int").alias("seq"))
    rows = loans(spark, sf_dir).withColumnRenamed("local_id", "c_invoice_id").join(
        numbers, F.col("seq") <= F.col("dias_cre"))
    lid = F.col("legacy_cartera_id")
    billed = (F.col("synced") == "Y") & (F.col("seq") <= 5 + lid % 7)
    sid = lid * 100 + F.col("seq")
    return rows.select(
        sid.alias("legacy_schedule_id"), "legacy_cartera_id", "c_bpartner_id", "ad_org_id",
        "c_invoice_id", "seq",
        add_six_day(F.col("fecha"), F.col("seq")).alias("duedate"),
        F.round(F.col("valorinteres") / F.col("dias_cre").cast("decimal(6,0)"), 4)
        .cast("decimal(18,4)").alias("dueamt"),
        F.when(billed, "Y").when(lid % 2 == 0, "N").alias("processed"),
        F.when(billed & (F.col("seq") % 3 == 0), "Y").otherwise("N").alias("isvalid"),
        F.lit("Y").alias("isactive"),
        F.when(billed, sid * 10 + 3).alias("ref_invoice_id"),
    )


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capital invoices of synced loans, interest invoices of billed instalments and of a few not marked as billed."""
    ln = loans(spark, sf_dir).filter(F.col("synced") == "Y")
    capital = ln.select(
        F.col("local_id").alias("c_invoice_id"), "c_bpartner_id", "legacy_cartera_id",
        F.lit(config.DOC_CAPITAL).alias("c_doctype_id"),
        F.col("fecha").alias("dateinvoiced"), F.col("monto").cast("decimal(18,4)").alias("grandtotal"),
        F.when(F.col("legacy_cartera_id") % 6 == 0, "Y").otherwise("N").alias("ispaid"),
        F.when(F.col("legacy_cartera_id") % 50 == 0, "DR").otherwise("CO").alias("docstatus"),
        F.lit(None).cast("bigint").alias("legacy_data"), "ad_org_id",
        F.when(F.col("legacy_cartera_id") % 53 == 0, "N").otherwise("Y").alias("issotrx"),
    )
    sch = schedule(spark, sf_dir).filter(F.col("processed") == "Y")
    interest = sch.select(
        F.col("ref_invoice_id").alias("c_invoice_id"), "c_bpartner_id", "legacy_cartera_id",
        F.lit(config.DOC_INTEREST).alias("c_doctype_id"),
        F.col("duedate").alias("dateinvoiced"), F.col("dueamt").alias("grandtotal"),
        F.when(F.col("legacy_schedule_id") % 4 == 0, "Y").otherwise("N").alias("ispaid"),
        F.lit("CO").alias("docstatus"),
        F.col("legacy_schedule_id").alias("legacy_data"), "ad_org_id",
        F.when(F.col("legacy_schedule_id") % 41 == 0, "N").otherwise("Y").alias("issotrx"),
    )
    unmarked = schedule(spark, sf_dir).filter(
        ~F.col("processed").eqNullSafe(F.lit("Y")) & (F.col("legacy_schedule_id") % 199 == 0)).select(
        (F.col("legacy_schedule_id") * 10 + 4).alias("c_invoice_id"), "c_bpartner_id", "legacy_cartera_id",
        F.lit(config.DOC_INTEREST).alias("c_doctype_id"),
        F.col("duedate").alias("dateinvoiced"), F.col("dueamt").alias("grandtotal"),
        F.lit("N").alias("ispaid"), F.lit("CO").alias("docstatus"),
        F.col("legacy_schedule_id").alias("legacy_data"), "ad_org_id", F.lit("Y").alias("issotrx"),
    )
    return capital.unionByName(interest).unionByName(unmarked)


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer receipts: one per synced collection, plus the partner of its loan."""
    col = collections(spark, sf_dir).filter(F.col("synced") == "Y")
    ln = loans(spark, sf_dir).select(
        F.col("legacy_cartera_id").alias("id_cartera"), "c_bpartner_id",
        F.col("local_id").alias("invoice_of_loan"))
    return col.join(ln, "id_cartera").select(
        F.col("local_id").alias("c_payment_id"), "c_bpartner_id", "id_cartera",
        F.col("abono").alias("payamt"), F.col("operacion").alias("dateacct"),
        F.when(F.substring(F.md5("local_id"), 3, 1) < "4", F.date_sub("operacion", 1)).otherwise(F.col("operacion"))
        .alias("datetrx"),
        F.lit(config.DOC_RECEIPT).alias("c_doctype_id"), "ad_org_id",
        F.when(F.substring(F.md5("local_id"), 1, 1) == "0", "DR").otherwise("CO").alias("docstatus"),
        F.when(F.substring(F.md5("local_id"), 2, 1) == "0", F.col("invoice_of_loan"))
        .alias("c_invoice_id"),
    )


def with_lost(documents: DataFrame) -> DataFrame:
    """Documents of receipts, and for one receipt in 16 a second one whose collection does not exist."""
    lost = documents.filter(F.substring(F.md5("c_payment_id"), 4, 1) == "0")
    return documents.unionByName(lost.withColumns({
        c: F.concat(F.lit("X"), c) for c in ("c_payment_id", "c_allocationline_id", "c_allocationhdr_id") if c in documents.columns}))


def allocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allocation lines already stored, one header per receipt.

    Receipts whose digest starts with 1 or 2 pay their loan's capital (1 carries the line
    twice); those with 3 pay the interest invoice of its first instalment.
    """
    rc = receipts(spark, sf_dir)
    digest = F.substring(F.md5("c_payment_id"), 1, 1)
    copies = F.when(digest == "1", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rc.filter(digest.isin("1", "2", "3")).select(
        "c_payment_id", F.when(digest == "3", (F.col("id_cartera") * 100 + 1) * 10 + 3)
        .otherwise(F.col("id_cartera") * 10 + 1).alias("c_invoice_id"),
        F.round(F.col("payamt") * dec("0.5", "decimal(2,1)"), 2).cast("decimal(18,2)").alias("amount"),
        F.col("dateacct"), F.lit("Y").alias("isactive"), F.explode(copies).alias("line"),
    ).withColumn("c_allocationline_id",
                 F.concat(F.col("c_payment_id"), F.lit("/"), F.col("line").cast("string"))
                 ).withColumn("c_allocationhdr_id", F.concat(F.lit("H-"), F.col("c_payment_id")))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
