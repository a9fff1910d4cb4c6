import random
from datetime import date
from decimal import localcontext, ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from loanbook.functions import plans
from loanbook.operators import interest as I

LOAN = ("legacy_cartera_id long, ad_org_id int, local_id long, fecha date, monto decimal(18,2), tasa decimal(10,4), "
        "dias_cre int, valorinteres decimal(18,4), montototal decimal(18,2)")


def loans(spark, rows):
    return spark.createDataFrame(
        [(i, 1, None, date(2025, 11, 3), Decimal(m), Decimal(t), n, Decimal(v), Decimal(m) + Decimal(v))
         for i, m, t, n, v in rows], LOAN)


def test_total_example(spark):
    r = I.total_360(loans(spark, [(1, "10000", "0.15", 23, "0")])).first()
    assert r.valorinteres == Decimal("1150.0000")
    assert r.montototal == Decimal("11150.0000")
    assert round(r.cuota, 2) == Decimal("484.78")


def test_hidden_rate_examples(spark):
    df = I.with_hidden_rate(loans(spark, [
        (1, "10000", "0.15", 23, "1150"), (2, "1000", "0.15", 23, "600"), (3, "1000", "0.15", 30, "5")]))
    got = {r.legacy_cartera_id: (r.tasa_oculta, r.rate_clamped) for r in df.collect()}
    assert got[1] == (Decimal("0.0092699368"), False)
    assert got[2] == (Decimal("0.0200000000"), True)
    assert got[3] == (Decimal("0.0010000001"), True)


def bisection(monto, interest, n):
    """The search one trial and one instalment at a time, in decimals without rounding."""
    with localcontext() as c:
        c.prec = 5000
        level = ((monto + interest) / n).quantize(Decimal("1e-10"), ROUND_HALF_UP)
        low, high = Decimal("0.001"), Decimal("0.020")
        for _ in range(45):
            rate = ((low + high) / 2).quantize(Decimal("1e-10"), ROUND_HALF_UP)
            balance, total = monto, Decimal(0)
            for k in range(n):
                own = balance * rate
                total += own
                balance -= level - own
            if abs(total - interest) < Decimal("0.0001"):
                return rate
            low, high = (rate, high) if total < interest else (low, rate)
        return rate


def test_hidden_rate_equals_decimal_search(spark):
    """Amounts to 10^12 and terms to 360, where doubles cannot tell the tolerance."""
    rnd = random.Random(12)
    rows = []
    for i in range(36):
        m = Decimal(rnd.randrange(10 ** rnd.choice([6, 9, 12, 14]) // 2, 10 ** rnd.choice([14]))) / 100 if i % 3 else Decimal(10 ** 12) - i
        n = rnd.choice([1, 2, 23, 60, 120, 360] if i % 6 == 0 else [1, 5, 23, 40])
        rows.append((i, str(m), "0.15", n, str((m * n * rnd.randrange(5, 90) / 10_000).quantize(Decimal("0.01")))))
    for r in I.with_hidden_rate(loans(spark, rows)).collect():
        assert r.tasa_oculta == bisection(r.monto, r.montototal - r.monto, r.dias_cre), r


def test_exact_miss_is_the_plain_sum():
    rnd = random.Random(4)
    with localcontext() as c:
        c.prec = 3000
        for _ in range(200):
            p, q = Decimal(rnd.randrange(1, 10 ** 9)) / 100, Decimal(rnd.randrange(1, 10 ** 15)) / 10 ** 10
            n, rate = rnd.randrange(1, 40), rnd.randrange(plans.RATE_LOW, plans.RATE_HIGH)
            balance, total = p, Decimal(0)
            for _ in range(n):
                own = balance * rate / 10 ** 10
                total, balance = total + own, balance - (q - own)
            for shift in ("0", "0.0001", "0.00009", "-0.0001", "-0.00011"):
                want = (total + Decimal(shift)).quantize(Decimal("1e-10"))
                miss = total - want
                assert plans.exact_miss(p, q, want, n, rate) == (0 if abs(miss) < Decimal("0.0001") else -1 if miss < 0 else 1)


def test_declining_example(spark):
    rows = I.schedule_declining(loans(spark, [(1, "10000", "0.15", 23, "1150")])).orderBy("seq").collect()
    interest = [r.interes for r in rows]
    assert [float(x) for x in interest[:5]] == [92.6994, 89.0648, 85.3965, 81.6942, 77.9576]
    assert interest[-1] == Decimal("4.4526")
    assert sum(interest) == Decimal("1150.0000")
    assert sum(r.capital for r in rows) == Decimal("10000")
    assert all(r.duedate.weekday() != 6 for r in rows)


def walk(monto, rate, total, n):
    """The plan one instalment at a time, in decimals."""
    q4 = Decimal("0.0001")
    level = (total / n).quantize(q4, ROUND_HALF_UP)
    balance, out = monto, []
    for i in range(n):
        interest = max((balance * rate).quantize(q4, ROUND_HALF_UP), Decimal(0))
        capital = level - interest
        if capital < 0:
            interest, capital = level, Decimal(0)
        if i == n - 1:
            interest, capital = (balance * rate).quantize(q4, ROUND_HALF_UP), balance
        else:
            capital = min(capital, balance)
        balance = max(balance - capital, Decimal(0))
        out.append((interest, capital))
    return out


def test_declining_matches_decimal_walk(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(60):
        m = Decimal(rnd.randrange(50000, 90_000_000_000)) / 100
        n = rnd.choice([1, 2, 23, 30, 50, 60, 90])
        rows.append((i, str(m), "0.15", n, str((m * n / 200).quantize(Decimal("0.01")))))
    df = I.with_hidden_rate(loans(spark, rows))
    plan = {}
    for r in I.schedule_declining(df).collect():
        plan.setdefault(r.legacy_cartera_id, {})[r.seq] = (r.interes, r.capital)
    for r in df.collect():
        got = [plan[r.legacy_cartera_id][k] for k in sorted(plan[r.legacy_cartera_id])]
        want = walk(r.monto, r.tasa_oculta, r.montototal, r.dias_cre)
        assert got == want
        assert sum(c for _, c in got) == r.monto
        assert min(x for x, _ in got) >= 0


def test_very_large_amounts_use_exact_integers():
    import numpy as np

    bal = np.array([10 ** 17], dtype=np.int64)
    got = plans.plan_rows(bal, np.array([150_000_000]), np.array([10 ** 16]), np.array([2]))
    want = (10 ** 17 * 150_000_000 + 5 * 10 ** 9) // 10 ** 10
    assert int(got[0][0, 0]) == want


def test_rate30_ends_negative_without_floor(spark):
    # The instalment here is far above capital over n, so the balance is overpaid at the end.
    df = loans(spark, [(1, "10000", "0.15", 23, "1150")])
    plain = I.schedule_rate30(df, F.lit("500").cast("decimal(18,4)")).orderBy("seq").collect()
    floored = I.schedule_rate30(df, F.lit("500").cast("decimal(18,4)"), floor=True).orderBy("seq").collect()
    assert plain[0].interes == Decimal("50.0000")
    assert plain[-1].interes < 0
    assert floored[-1].interes == 0


def test_pmt(spark):
    df = spark.createDataFrame([(Decimal("0.01"), 12, Decimal("1000")), (Decimal("0"), 3, Decimal("100"))],
                               "r decimal(12,10), n int, p decimal(18,2)")
    got = [r[0] for r in df.select(I.pmt(F.col("r"), F.col("n"), F.col("p"))).collect()]
    assert got[0] == Decimal("88.85") and round(got[1], 6) == Decimal("33.333333")


def test_linear_accrual_example(spark):
    df = spark.createDataFrame([(1, date(2025, 7, 1), 30, Decimal("3000"), Decimal("0.15"))],
                               "legacy_cartera_id long, fecha date, dias_cre int, monto decimal(18,2), tasa decimal(10,4)")
    assert I.accrual_linear(df, "2025-07-31").first().interes == Decimal("405")
