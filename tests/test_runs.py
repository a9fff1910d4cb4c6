"""Packed runs of rows and the queries that shuffle them."""

import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from loanbook.operators import interest, reports, runs

DAY = datetime.date(1998, 1, 30)


def _same(a, b):
    assert sorted(map(str, a.select(b.columns).collect())) == sorted(map(str, b.collect()))


def test_rows_come_back(spark):
    """Nulls in keys and values, repeated rows, rows out of order, and numbers with no room below."""
    rows = []
    for k, t in [(1, "a"), (2, "a"), (None, None), (1, "a"), (None, "b")]:
        rows += [(k, t, None if i == 3 else (k or 0) * 100 + i, None if i == 2 else DAY + datetime.timedelta(i),
                  None if i == 4 else Decimal(i) / 4, None if i == 5 else f"x{i}") for i in (0, 1, 2, 3, 4, 5, 9, 8, 8)]
    schema = "k long, t string, n long, d date, m decimal(18,4), s string"
    columns = ["n", "d", "m", "s"]
    for data in (rows, [(1, "a", v, DAY, None, None) for v in (-2**63, 5, 2**63 - 1, -2**63)], []):
        df = spark.createDataFrame(data, schema)
        made = runs.packed(df.coalesce(1), ["k", "t"])
        _same(runs.unpacked(made, df, columns), df)
        assert runs.unpacked(made, df, columns).select(df.columns).dtypes == df.dtypes
    assert runs.packed(spark.createDataFrame(rows, schema).coalesce(1), ["k", "t"]).count() == 5


def test_payment_plan_shuffles_runs(spark):
    """Instalments reach their loans packed, and nothing is joined to them row by row."""
    loans = spark.createDataFrame([(k, k % 3, k % 2, DAY, 10, Decimal(k), Decimal(1), Decimal(2), Decimal(k + 2), Decimal("0.15")) for k in range(30)],
                                  "legacy_cartera_id long, c_bpartner_id long, ad_org_id int, fecha date, dias_cre int, monto decimal(18,2), cuota decimal(18,4), "
                                  "valorinteres decimal(18,4), montototal decimal(18,2), tasa decimal(10,4)")
    schedule = loans.crossJoin(spark.range(1, 11).select(F.col("id").cast("int").alias("seq"))).select(
        "legacy_cartera_id", "seq", F.date_add("fecha", F.col("seq")).alias("duedate"), F.col("seq").cast("decimal(18,4)").alias("dueamt"))
    partners = spark.createDataFrame([(k, f"C{k}", f"n{k}") for k in range(2)], "c_bpartner_id long, codigo string, nombre string")
    branches = spark.createDataFrame([(0, "norte"), (1, "sur")], "ad_org_id int, org_name string")
    out = reports.payment_plan(schedule, loans, partners, branches)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join") < plan.index("MapInArrow")
    want = schedule.join(loans, "legacy_cartera_id").join(partners, "c_bpartner_id").join(branches, "ad_org_id").select(
        "nombre", "org_name", "legacy_cartera_id", "seq", "duedate", (F.col("cuota") - F.col("dueamt")))
    _same(out.select(F.col("bpartner_name").alias("nombre"), F.col("nombre_organizacion").alias("org_name"), "legacy_cartera_id", "seq", "duedate",
                     F.col("cuota_principal").alias(want.columns[-1])), want)
    assert out.count() == 200


def test_billed_instalments(spark):
    """Repeated ids, several invoices of one id, ids without row or without value; as plain joins give it."""
    schedule = spark.createDataFrame(
        [(1, 10, "N"), (2, 10, None), (2, 10, None), (3, 10, "Y"), (3, 11, "N"), (None, 11, "N"), (5000, 11, "N"), (-7, None, "N"), (9, 12, "N")],
        "legacy_schedule_id long, legacy_cartera_id long, processed string").withColumn("dueamt", F.lit(5).cast("decimal(18,4)"))
    invoices = spark.createDataFrame(
        [(90, 1, "CO", "N", 4), (91, 2, "CO", "Y", 4), (92, 2, "CO", "N", 7), (93, 3, "CL", "N", 4), (94, 5000, "DR", "N", 4), (95, None, "CO", "N", 4),
         (96, -7, "CO", "N", 4), (97, 8, "CO", "N", 4), (98, 3, "CO", "N", 6)],
        "c_invoice_id long, legacy_data long, docstatus string, ispaid string, grandtotal int").withColumns(
        {"grandtotal": F.col("grandtotal").cast("decimal(18,4)"), "legacy_cartera_id": F.lit(77).cast("long")})
    paid = spark.createDataFrame([(92, 1, "Y"), (98, 2, "N")], "c_invoice_id long, amount int, isactive string").withColumn(
        "amount", F.col("amount").cast("decimal(18,2)"))
    got = interest.billed_instalments(schedule, invoices, paid)
    open_ = {90: 4, 92: 6, 96: 4, 98: 6}
    want = [(s.legacy_schedule_id, s.legacy_cartera_id, s.processed != "Y", open_.get(i.c_invoice_id)) for s in schedule.collect() for i in invoices.collect()
            if s.legacy_schedule_id == i.legacy_data and i.docstatus in ("CO", "CL") and i.legacy_data is not None]
    assert sorted(map(str, want)) == sorted(str(tuple(None if x is None else int(x) if not isinstance(x, bool) else x for x in r[:4])) for r in got.collect())
    assert got.filter("first").count() == 6  # instalments 1, 2, 2, 3, 3, -7
    debt = {r.legacy_cartera_id: (r.futuro, r.facturado) for r in interest.debt_total(schedule, invoices, paid).collect()}
    assert debt[10] == (15, 4 + 6 + 6 + 6) and debt[11] == (15, 6) and debt[12] == (5, 0)


def test_prepaid_instalments_move_in_runs(spark):
    """One loan is billed until its collections are covered, but for what has an invoice; instalments meet their loan packed."""
    schedule = spark.createDataFrame([(k, 1 + k // 100, 4, 0, "N", DAY + datetime.timedelta(k), Decimal(3)) for k in [*range(10), *range(100, 104)]],
                                     "legacy_schedule_id long, legacy_cartera_id long, c_bpartner_id long, ad_org_id int, processed string, duedate date, dueamt decimal(18,4)")
    invoices = spark.createDataFrame([(50, 1, "CO", "N", Decimal(3))], "c_invoice_id long, legacy_data long, docstatus string, ispaid string, grandtotal decimal(18,4)").withColumn(
        "legacy_cartera_id", F.lit(1).cast("long"))
    none = spark.createDataFrame([], "c_invoice_id long, amount decimal(18,2), isactive string")
    collections = spark.createDataFrame([(1, "N", Decimal(7)), (2, None, Decimal(50))], "id_cartera long, synced string, abono decimal(18,2)")
    made, rejected, accepted = interest.bill_prepaid(schedule, invoices, none, collections, "1998-06-30")
    assert sorted(r.legacy_schedule_id for r in made.collect()) == [0, 2, 3]
    assert [r.legacy_cartera_id for r in rejected.collect()] == [2] and [r.legacy_cartera_id for r in accepted.collect()] == [1]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("Generate") < plan.index("Join") < plan.index("MapInArrow")
