import random
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from loanbook.functions import dates as D
from loanbook.functions import scalars as S


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def d(text):
    return F.lit(text).cast("date")


def test_effective_days_examples(spark):
    r = one(spark, a=D.effective_days(d("2025-08-11"), d("2025-08-17")),
            b=D.effective_days(d("2025-07-01"), d("2025-07-31")),
            c=D.effective_days(d("2025-07-02"), d("2025-07-01")))
    assert (r.a, r.b, r.c) == (6, 27, 0)


def test_day_arithmetic_against_enumeration(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(400):
        start = date(1965, 1, 1) + timedelta(days=rnd.randrange(25000))
        rows.append((start, start + timedelta(days=rnd.randrange(-3, 120)), rnd.randrange(1, 95)))
    df = spark.createDataFrame(rows, "a date, b date, n int").select(
        "a", "b", "n", D.effective_days(F.col("a"), F.col("b")).alias("e"),
        D.add_six_day(F.col("a"), F.col("n")).alias("m"))
    for r in df.collect():
        span = (r.b - r.a).days
        days = [r.a + timedelta(days=i) for i in range(span + 1)] if span >= 0 else []
        assert r.e == sum(x.weekday() != 6 for x in days)
        cur, left = r.a, r.n
        while left:
            cur += timedelta(days=1)
            left -= cur.weekday() != 6
        assert r.m == cur


def test_birthdate(spark):
    ids = ["001-310175-0001A", "001 010203 0001B", "001-320175-0001A", "123", None, "001-310299-0001A"]
    df = spark.createDataFrame([(x,) for x in ids], "x string").select(S.birthdate(F.col("x")).alias("b"))
    assert [r.b for r in df.collect()] == [date(1975, 1, 31), date(2003, 2, 1), None, None, None, None]


def test_pending_keeps_null_flags(spark):
    df = spark.createDataFrame([("Y",), ("N",), (None,)], "s string")
    assert [r[0] for r in df.select(S.pending(F.col("s"))).collect()] == [False, True, True]
    assert df.filter(S.pending(F.col("s"), strict=True)).count() == 1


def test_rounding_is_half_up(spark):
    r = one(spark, a=S.round_money(F.lit("2.345").cast("decimal(10,3)")),
            b=S.fixed_fx(F.lit("100").cast("decimal(18,2)")),
            c=S.audit_append(F.lit(None).cast("string"), F.lit("x")))
    assert (r.a, r.b, r.c) == (Decimal("2.35"), Decimal("2.86"), "\nx")


def test_risk_class_edges(spark):
    df = spark.createDataFrame([(x,) for x in (0, 15, 16, 30, 31, 60, 61, 90, 91)], "n int")
    got = [r[0] for r in df.select(S.risk_class(F.col("n"), "code")).collect()]
    assert got == ["A", "A", "B", "B", "C", "C", "D", "D", "E"]
