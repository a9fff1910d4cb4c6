import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loanbook.operators import balances, close, migration, quality
from loanbook.operators import ordered as O
from loanbook.session import work_folder
from loanbook.sources import readers, sinks
from loanbook.streaming import jobs
from test_allocation import tie

COBRO = ("legacy_cobro_id string, id_cartera long, abono decimal(18,2), operacion date, synced string, "
         "origen string")
CARTERA = "legacy_cartera_id long, c_bpartner_id long, fecha date, montototal decimal(18,2)"


def first_fit_sample(seed, partners, loans, cobros):
    rnd = random.Random(seed)
    d0 = date(2025, 1, 1)
    ln = [(i, rnd.randrange(partners), d0 + timedelta(days=rnd.randrange(30)), Decimal(rnd.randrange(100, 6000)))
          for i in range(loans)]
    cb = []
    for i in range(cobros):
        flag = rnd.choice(["Y", "N", None])
        cb.append((f"c{i}", rnd.randrange(loans), Decimal(rnd.randrange(1, 900)), d0 + timedelta(days=rnd.randrange(40)),
                   flag, rnd.choice(["native", "native", "migrated"])))
    return ln, cb


def first_fit_walk(ln, cb):
    paid = defaultdict(Decimal)
    for c in cb:
        if c[4] == "Y":
            paid[c[1]] += c[2]
    saldo = {x[0]: x[3] - paid[x[0]] for x in ln}
    owner = {x[0]: x[1] for x in ln}
    pend = [c for c in cb if c[4] != "Y" and c[5] == "native"]
    problem = {owner[c[1]] for c in pend if saldo[c[1]] < 0}
    out = {}
    for p in problem:
        bins = [[x[0], saldo[x[0]]] for x in sorted(ln, key=lambda x: (x[2], tie(x[0]))) if x[1] == p and saldo[x[0]] > 0]
        for c in sorted((c for c in pend if owner[c[1]] == p), key=lambda c: (c[3], tie(c[0]), c[0])):
            for b in bins:
                if b[1] > c[2]:
                    b[1] -= c[2]
                    out[c[0]] = b[0]
                    break
    return out


@pytest.mark.parametrize("seed,partners,loans,rows", [(1, 8, 14, 90), (2, 6, 14, 90), (3, 2, 14, 90), (4, 1, 33, 400), (5, 3, 1, 20)])
def test_first_fit(spark, seed, partners, loans, rows):
    ln, cb = first_fit_sample(seed, partners, loans, rows)
    got = quality.reassign_first_fit(spark.createDataFrame(cb, COBRO), spark.createDataFrame(ln, CARTERA))
    assert {r.legacy_cobro_id: r.id_cartera for r in got.collect()} == first_fit_walk(ln, cb)


@pytest.mark.parametrize("seed,partners,loans,rows,at_once", [(4, 1, 33, 400, 7), (6, 3, 30, 300, 20), (7, 5, 40, 300, 60), (8, 2, 3, 60, 5)])
def test_first_fit_in_parts(spark, seed, partners, loans, rows, at_once, monkeypatch):
    """Partners with many items, walked part by part: as the plain loop does, in several rounds."""
    rounds = []
    folder = quality.work_folder
    monkeypatch.setattr(quality, "work_folder", lambda s, name: rounds.append(folder(s, name)) or rounds[-1])
    ln, cb = first_fit_sample(seed, partners, loans, rows)
    # One partner has a third of all rows.
    cb += [(f"h{i}", 0, Decimal(1 + i % 700), date(2025, 1, 1) + timedelta(days=i % 50), "N", "native") for i in range(rows // 2)]
    got = quality.reassign_first_fit(spark.createDataFrame(cb, COBRO), spark.createDataFrame(ln, CARTERA), items_at_once=at_once)
    assert {r.legacy_cobro_id: r.id_cartera for r in got.collect()} == first_fit_walk(ln, cb)
    if seed == 4:
        done = {r["round"] for r in spark.read.parquet(rounds[0]).select("round").distinct().collect()}
        assert len(done) > 3


def test_collection_without_loan_is_placed(spark):
    """The collection's own partner counts, not that of a loan."""
    ln = spark.createDataFrame([(1, 7, date(2025, 1, 1), Decimal("100"))], CARTERA)
    cb = spark.createDataFrame([("a", None, 7, Decimal("60"), date(2025, 1, 2), "N", "native"),
                                ("b", None, 7, Decimal("60"), date(2025, 1, 3), "N", "native"),
                                ("c", None, 8, Decimal("5"), date(2025, 1, 3), "N", "native")],
                               "legacy_cobro_id string, id_cartera long, c_bpartner_id long, abono decimal(18,2), operacion date, synced string, origen string")
    assert [(r.legacy_cobro_id, r.old_cartera, r.id_cartera) for r in quality.reassign_first_fit(cb, ln).collect()] == [("a", None, 1)]
    moves = quality.reassign_oldest(spark.createDataFrame([(7,)], "c_bpartner_id long"), cb, ln)["moves"]
    assert sorted(r.legacy_cobro_id for r in moves.collect()) == ["a", "b"]


def test_nearest_partner(spark):
    p = spark.createDataFrame([(1, "ana lopez"), (2, "ana lopes"), (3, "juan"), (9, "juan")], "c_bpartner_id long, nombre string")
    r = spark.createDataFrame([(1, "ana lopez"), (2, "ana lope"), (3, "jvan"), (4, "pedro paramo"), (5, "an lopess")],
                              "row_id long, name string")
    got = {x.row_id: (x.c_bpartner_id, x.distancia) for x in migration.nearest_partner(r, p).collect()}
    assert got == {1: (1, 0), 2: (1, 1), 3: (3, 1), 4: (1, 11), 5: (2, 2)}


def test_every_name_gets_its_nearest_partner(spark):
    rnd = random.Random(4)
    names = ["".join(rnd.choice("abcd") for _ in range(rnd.randrange(1, 12))) for _ in range(80)]
    p = spark.createDataFrame(list(enumerate(names[:40])), "c_bpartner_id long, nombre string")
    r = spark.createDataFrame([*enumerate(names[40:]), (90, "JUAN ANTONIO PEREZ LOPEZ"), (91, None)], "row_id long, name string")
    got = {x.row_id: (x.distancia, x.c_bpartner_id) for x in migration.nearest_partner(r, p).collect()}
    best = r.crossJoin(p).groupBy("row_id").agg(F.min(F.struct(F.levenshtein("name", "nombre").alias("d"), "c_bpartner_id")).alias("m"))
    want = {x.row_id: (x.m.d, x.m.c_bpartner_id) for x in best.collect() if x.row_id != 91}
    assert got.pop(91) == (None, None) and got == want


def test_numbers_of_null_and_equal_ids(spark):
    src = spark.createDataFrame([(None, 1), (None, 2), (5, 2), (5, 1), (700_000, 1), (-3, None)], "id_cartera long, ad_org_id int")
    none = spark.createDataFrame([], "id_cartera long, ad_org_id int, legacy_cartera_id long")
    once = migration.migrate_loans(src.repartition(3), none)
    got = [(r.id_cartera, r.ad_org_id) for r in once.orderBy("legacy_cartera_id").collect()]
    assert got == [(None, 1), (None, 2), (-3, None), (5, 1), (5, 2), (700_000, 1)]
    assert sorted(r.legacy_cartera_id for r in once.collect()) == [migration.FIRST_ID + k for k in range(1, 7)]
    assert migration.migrate_loans(src, once.select("id_cartera", "ad_org_id", "legacy_cartera_id")).isEmpty()


def test_days_of_stamped_rows(spark, tmp_path):
    """The afternoon of the cut-off day counts, and the day filter reaches the scan."""
    rows = [(1, datetime(2025, 1, 10, 15, 30), Decimal("30")), (1, datetime(2025, 1, 9), Decimal("5")), (1, datetime(2025, 1, 11), Decimal("7"))]
    raw = spark.createDataFrame(rows, "id_cartera long, operacion timestamp_ntz, abono decimal(18,2)")
    full = raw.select(*[(F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in readers.COLLECTION_SCHEMA])
    full.write.parquet(str(tmp_path / "c"))
    cob = readers.read_collections(spark, str(tmp_path / "c"))
    loan = spark.createDataFrame([(1, Decimal("100"))], "legacy_cartera_id long, montototal decimal(18,2)")
    assert balances.paid_to_date(loan, cob, "2025-01-10").first().abonos == 35
    plan = cob.filter(F.col("operacion") <= F.lit("2025-01-10").cast("date"))._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(operacion" in plan


def test_stream_without_loss(spark, tmp_path):
    """Late, repeated and future-dated rows over several batches; a replayed batch changes nothing."""
    kind = "legacy_cobro_id string, id_cartera long, c_bpartner_id long, abono decimal(18,2), operacion date, synced string, origen string, " \
           "createdby long, ad_org_id int, local_id string"

    def row(i, day):
        return (i, 1, 1, Decimal("10"), day, "N", "native", 1, 0, None)

    batches = [[row("a", date(2025, 3, 1)), row("a", date(2025, 3, 1))], [row("b", date(2025, 1, 15)), row("c", date(2199, 1, 1))],
               [row("d", date(2024, 1, 1)), row("a", date(2025, 3, 1)), row("e", date(2025, 3, 2))]]
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    loans = spark.createDataFrame([(1, 1)], "legacy_cartera_id long, c_bpartner_id long")
    partners = spark.createDataFrame([(1, True)], "c_bpartner_id long, has_location boolean")
    users = spark.createDataFrame([(1, 5)], "ad_user_id long, c_bankaccount_id int")
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(inbox)
        for mark in ("m", f"again{n}") if n == 2 else ("m",):
            raw = jobs.file_stream(spark, inbox, spark.read.parquet(inbox).schema, "*.parquet", files=1)
            jobs.bridge_collections_stream(raw, loans, partners, users, out, str(tmp_path / mark))
        found = spark.read.parquet(f"{out}/payments")
        assert found.count() == found.select("legacy_cobro_id").distinct().count()
    assert {r.legacy_cobro_id for r in found.collect()} == set("abcde")


def test_stream_of_many_files_reads_its_own_keys(spark, tmp_path):
    """Three deliveries of many files with late and repeated rows; the state grows, and no batch reads what another wrote."""
    inbox, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    frames = [spark.range(a, b, 1, 6).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), (F.col("id") % 7).alias("v")) for a, b in ((0, 300), (200, 500), (0, 600))]
    seen = []
    for df in frames:
        df.unionByName(df.where("v = 0").withColumn("v", F.lit(-5).cast("long"))).write.mode("append").parquet(inbox)
        for _ in range(2):
            raw = jobs.file_stream(spark, inbox, df.schema, "*.parquet")
            jobs._run(jobs.first_seen(raw, "key"), lambda b, n: b.where("new").drop("new").write.mode("overwrite").parquet(f"{out}/batch={n}"), mark, "update")
        seen.append(spark.read.parquet(out).count())
    assert seen == [300, 500, 600]
    found = spark.read.parquet(out)
    assert found.select("key").distinct().count() == 600
    assert found.where("v = -5").count() == sum(k % 7 == 0 for k in range(600))


def test_balances_at_many_days(spark):
    """120 month ends: equal to a sum for each, from a plan that does not grow with them."""
    days = [str(date(2015 + k // 12, k % 12 + 1, 28)) for k in range(120)]
    rnd = random.Random(3)
    ln = [(i, date(2015, 1, 1) + timedelta(days=rnd.randrange(3000)), Decimal(5000)) for i in range(20)]
    cb = [(rnd.randrange(22), date(2014, 12, 1) + timedelta(days=rnd.randrange(4000)), Decimal(rnd.randrange(1, 50))) for _ in range(900)]
    loans = spark.createDataFrame(ln, "legacy_cartera_id long, fecha date, montototal decimal(18,2)")
    cobros = spark.createDataFrame(cb, "id_cartera long, operacion date, abono decimal(18,2)")
    shuffled = [*days[60:], *days[:60], days[5]]
    got = {(r.legacy_cartera_id, str(r.corte)): (r.abonos, r.saldo) for r in balances.balances_at(loans, cobros, shuffled).collect()}
    want = {}
    for i, start, total in ln:
        for d in days:
            if str(start) <= d:
                paid = sum((a for k, o, a in cb if k == i and str(o) <= d), Decimal("0.00"))
                want[i, d] = (paid, total - paid)
    assert got == want


def test_parse_files(spark, tmp_path):
    f = tmp_path / "s.csv"
    f.write_text("7;Ana Lopez;2024-01-05;1000;1150.50;x;575;2024-02-04\n8;Bad;nope;1;2;3;4;2024-01-01\n9;Short\n")
    rows = {r.tarjeta: r for r in readers.read_opening_balances(spark, str(f)).collect()}
    assert rows["7"].corrupt is None and rows["7"].saldo == Decimal("575.00")
    assert rows["8"].corrupt and rows["9"].corrupt.startswith("9;")
    g = tmp_path / "p.csv"
    g.write_text("a;b;001;Ana;Calle;555;c;12;d;e;4\na;b;002;Eva;Calle;555;c;x;d;e;4\n")
    people = {r.cedula: r for r in readers.read_partners(spark, str(g)).collect()}
    assert people["001"].cv_ruta_id == 12 and people["001"].c_bp_group_id == 4
    assert people["002"].corrupt is not None


def test_typed_loans_from_csv(spark, tmp_path):
    names = [f.name for f in readers.LOAN_SCHEMA.fields]
    row = {"legacy_cartera_id": "1", "monto": "10.50", "synced": "N", "aprobado": "Y", "fecha": "2024-01-05 10:00:00"}
    f = tmp_path / "l.csv"
    f.write_text(",".join(names) + "\n" + ",".join(row.get(n, "") for n in names) + "\n")
    r = readers.read_loans(spark, str(f), "csv").first()
    assert r.monto == Decimal("10.50") and r.pendiente and r.aprobada


def test_jdbc_options(monkeypatch):
    monkeypatch.setenv("SOURCE_DB_USER", "u")
    o = readers.jdbc_options("jdbc:x", "t", "id", 0, 100, 4)
    assert o["numPartitions"] == "4" and o["user"] == "u" and o["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "t", "id", 5, 5, 4)


def test_upsert_null_key_is_one_row(spark):
    t = spark.createDataFrame([(1, "a", 10), (None, "b", 20)], "k int, v string, keep int")
    u = spark.createDataFrame([(1, "A"), (None, "B"), (3, "C")], "k int, v string")
    got = sorted((r.k or 0, r.v, r.keep) for r in sinks.upsert(t, u, ["k"]).collect())
    assert got == [(0, "B", 20), (1, "A", 10), (3, "C", None)]


def test_write_period_replaces_only_its_period(spark):
    path = work_folder(spark, "t")
    sinks.write_period(spark.createDataFrame([(1, "a"), (2, "b")], "c_period_id int, v string"), path)
    for _ in range(2):
        sinks.write_period(spark.createDataFrame([(2, "c")], "c_period_id int, v string"), path)
    assert sorted((r.c_period_id, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "c")]


def test_write_period_empties_a_listed_period(spark):
    path = work_folder(spark, "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "c_period_id int, v string")
    sinks.write_period(rows, path)
    sinks.write_period(rows.filter("false"), path, periods=[2])
    assert [(r.c_period_id, r.v) for r in spark.read.parquet(path).collect()] == [(1, "a")]


def test_close_example_and_bucket_overlap(spark):
    loans = spark.createDataFrame(
        [(1, 1, date(2025, 6, 2), 30, Decimal("6000"), Decimal("0.15"), Decimal("6900"), Decimal("230")),
         (2, 1, date(2025, 6, 2), 30, Decimal("6000"), Decimal("0.15"), Decimal("6900"), Decimal("230"))],
        "legacy_cartera_id long, c_bpartner_id long, fecha date, dias_cre int, monto decimal(18,2), tasa decimal(10,4), "
        "montototal decimal(18,2), cuota decimal(18,4)")
    cobros = spark.createDataFrame([("x", 1, Decimal("6900"), date(2025, 7, 10))],
                                   "legacy_cobro_id string, id_cartera long, abono decimal(18,2), operacion date")
    act = close.active_loans(loans, cobros, "2025-07-01", "2025-07-31")
    b = close.with_balances(act, "2025-07-01", "2025-07-31").select("*", *close.ageing_columns("2025-07-31"))
    rows = {r.legacy_cartera_id: r for r in b.collect()}
    # Fully paid: 15 % of 6900 exceeds the interest and 85 % leaves principal.
    assert rows[1].saldo_interes == 0 and rows[1].saldo_principal == Decimal("135")
    # Overdue by 29 days: in the overdue scale and also in the first to-mature bucket.
    assert rows[2].mto_vencido_030 == 6000 and rows[2].mto_por_vencer_030 == 6000
    assert rows[2].mto_intereses_por_vencer_030 == 0


def test_close_needs_a_period(spark):
    with pytest.raises(ValueError):
        close.close_tables(None, None, None, None, None, None, None, 0, None, None)


def test_hot_rows_default_is_high():
    assert O.HOT_ROWS >= 100_000


def test_close_shares_its_joins(spark):
    """Four tables are read from rows that are joined once; all six need few exchanges."""
    from loanbook.plans import q_close
    tables = q_close.close_frames(spark, "/root/testdata/sf0.001")
    plan = q_close.close_figures(tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") < 20
    assert all(tables[n]._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0 for n in ("credito", "credito_persona"))
