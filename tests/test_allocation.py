"""Allocation against a plain walk, on few and on split partners."""

import hashlib
import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

from loanbook import config
from loanbook.operators import payments as P

PAY = "c_payment_id string, c_bpartner_id long, dateacct date, payamt decimal(18,2)"
DEBT = "c_invoice_id long, c_bpartner_id long, c_doctype_id int, dateinvoiced date, open decimal(18,4)"


def tie(x):
    return hashlib.md5(str(x).encode()).hexdigest()


def walk(pays, debts):
    lines = {}
    left = {d[0]: d[4] for d in debts}
    by_partner = defaultdict(list)
    for d in sorted(debts, key=lambda d: (d[3], tie(d[0]))):
        by_partner[d[1]].append(d)
    for pid, partner, on, amount in sorted(pays, key=lambda p: (p[2], tie(p[0]), p[0])):
        rest = amount
        mine = by_partner[partner]
        order = [d for d in mine if d[2] == config.DOC_INTEREST and d[3] <= on]
        order += [d for d in mine if d[2] == config.DOC_CAPITAL]
        for d in order:
            used = min(rest, left[d[0]])
            if used > 0:
                lines[(pid, d[0])] = used
                left[d[0]] -= used
                rest -= used
    return lines


def sample(rnd, partners, size):
    day0 = date(2025, 1, 1)
    pays, debts = [], []
    for i in range(size):
        pays.append((f"P{i}", rnd.randrange(partners), day0 + timedelta(days=rnd.randrange(12)),
                     Decimal(rnd.randrange(1, 50000)) / 100))
    for i in range(size):
        kind = config.DOC_INTEREST if rnd.random() < 0.7 else config.DOC_CAPITAL
        debts.append((i, rnd.randrange(partners), kind, day0 + timedelta(days=rnd.randrange(12)),
                      Decimal(rnd.randrange(1, 4_000_000)) / 10000))
    return pays, debts


def check(spark, pays, debts, hot_rows):
    got = {}
    for r in P.allocate(spark.createDataFrame(pays, PAY), spark.createDataFrame(debts, DEBT), hot_rows).collect():
        assert (r.c_payment_id, r.c_invoice_id) not in got
        got[(r.c_payment_id, r.c_invoice_id)] = r.amount
    assert got == walk(pays, debts)


def test_many_partners(spark):
    check(spark, *sample(random.Random(1), 60, 600), None)


def test_one_partner_split_into_buckets(spark):
    check(spark, *sample(random.Random(2), 2, 300), 5)


def test_documented_cases(spark):
    d0 = date(2025, 5, 1)
    debts = [(1, 1, config.DOC_INTEREST, d0, Decimal("10")), (2, 1, config.DOC_INTEREST, d0 + timedelta(days=5), Decimal("10")),
             (3, 1, config.DOC_CAPITAL, d0, Decimal("100"))]
    # Interest first, later interest left alone, the rest to capital.
    check(spark, [("A", 1, d0 + timedelta(days=1), Decimal("30"))], debts, None)
    # Nothing but interest; more than everything; a partner without debts.
    check(spark, [("A", 1, d0, Decimal("4")), ("B", 1, d0 + timedelta(days=9), Decimal("500")),
                  ("C", 2, d0, Decimal("7"))], debts, None)


def test_split_principal_first_same_day(spark):
    loans = spark.createDataFrame([(1, Decimal("100"))], "legacy_cartera_id long, monto decimal(18,2)")
    cobros = spark.createDataFrame(
        [("a", 1, Decimal("60"), date(2025, 1, 1)), ("b", 1, Decimal("60"), date(2025, 1, 1)),
         ("c", 1, Decimal("50"), date(2025, 1, 2))],
        "legacy_cobro_id string, id_cartera long, abono decimal(18,2), operacion date")
    got = {r.legacy_cobro_id: (int(r.abono_principal), int(r.abono_interes))
           for r in P.split_principal_first(loans, cobros).collect()}
    # The two payments of one day count each other.
    assert got == {"a": (40, 20), "b": (40, 20), "c": (0, 50)}
