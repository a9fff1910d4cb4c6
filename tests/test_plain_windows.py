"""Steps that split hot keys take one plain window where no key is hot."""

import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from loanbook import config
from loanbook.operators import ordered, payments, statements

DAY = datetime.date(1998, 1, 30)


def test_any_hot(spark, monkeypatch):
    monkeypatch.setattr(ordered, "KEY_PARTS", 2)  # many keys share a part
    df = spark.createDataFrame([(k % 7 or None,) for k in range(70)], "k long")
    assert not ordered.any_hot([df], "k", 10) and ordered.any_hot([df], "k", 9)
    assert ordered.any_hot([df, df], "k", 19) and not ordered.any_hot([df, df], "k", 20)


def test_allocation_without_hot_partners(spark):
    """No quantiles for buckets, one shuffle for each step, and the lines of the split path."""
    pays = spark.createDataFrame([(f"p{k}", k % 4 or None, DAY + datetime.timedelta(k % 5), Decimal(k % 9 + 1)) for k in range(60)],
                                 "c_payment_id string, c_bpartner_id long, dateacct date, payamt decimal(18,2)")
    debts = spark.createDataFrame([(k, k % 4 or None, config.DOC_INTEREST if k % 3 else config.DOC_CAPITAL, DAY + datetime.timedelta(k % 6), Decimal(k % 5 + 1))
                                   for k in range(80)], "c_invoice_id long, c_bpartner_id long, c_doctype_id int, dateinvoiced date, open decimal(18,4)")
    plain, split = payments.allocate(pays, debts), payments.allocate(pays, debts, 5)
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert "percentile_approx" not in plan and plan.count("Exchange") <= 6
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))
    assert plain.schema == split.schema and plain.agg(F.count("*")).first()[0] > 50


def test_loan_statement_without_hot_loans(spark):
    """Movements pass one shuffle by loan, nothing is joined to payments; rows are those of the split path and of plain sums.

    A loan occurs twice, payments share an id or have none, and loan, day or allocated payment may be missing.
    """
    loans = spark.createDataFrame([(1, 11, DAY, Decimal(100)), (2, None, DAY, Decimal(50)), (3, 31, DAY, Decimal(10)), (3, 31, DAY, Decimal(10)), (None, 41, DAY, Decimal(9))],
                                  "legacy_cartera_id long, local_id long, fecha date, montototal decimal(18,2)")
    schedule = spark.createDataFrame([(1, 13, "Y"), (1, 14, "N"), (1, None, "Y"), (2, 23, "Y"), (9, 13, "Y")], "legacy_cartera_id long, ref_invoice_id long, processed string")
    interest, capital = config.DOC_INTEREST, config.DOC_CAPITAL
    later = DAY + datetime.timedelta(3)
    invoices = spark.createDataFrame([(11, DAY, Decimal(90), capital), (13, later, Decimal(5), interest), (14, later, Decimal(6), interest), (23, later, Decimal(7), capital)],
                                     "c_invoice_id long, dateinvoiced date, grandtotal decimal(18,4), c_doctype_id int")
    allocations = spark.createDataFrame([("a", 11, Decimal(3), "Y"), ("a", 13, Decimal(2), "Y"), (None, 11, Decimal(8), "Y"), ("b", 11, Decimal(1), "N"), ("z", 11, Decimal(1), "Y")],
                                        "c_payment_id string, c_invoice_id long, amount decimal(18,2), isactive string")
    collections = spark.createDataFrame(
        [("c1", "a", 1, DAY, Decimal(10)), ("c2", "a", 1, later, Decimal(20)), ("c3", None, 1, later, Decimal(5)), ("c4", "b", 1, None, Decimal(4)), ("c5", "a", 2, DAY, Decimal(1)),
         ("c6", None, 8, DAY, Decimal(1)), ("c7", None, None, DAY, Decimal(1)), ("c8", None, 3, DAY, Decimal(-1))],
        "legacy_cobro_id string, local_id string, id_cartera long, operacion date, abono decimal(18,2)")
    args = (loans, collections, schedule, invoices, allocations)
    plain, split = statements.loan_statement(*args), statements.loan_statement(*args, hot_rows=1)
    assert plain.dtypes == split.dtypes
    rows = sorted(map(str, plain.collect()))
    assert rows == sorted(map(str, split.collect())) and len(rows) == 10
    one = {r.documento: (r.debito, r.credito, r.asignado_interes, r.asignado_principal, r.saldo, r.saldo_capital, r.saldo_interes)
           for r in plain.filter("legacy_cartera_id = 1 AND fecha_movimiento > '1998-01-30'").collect()}
    saldo = 90 + 5 - 10 - 20 - 5 - 4  # what has no day counts from the start
    assert one == {"13": (5, 0, 0, 0, saldo, 84, 1), "a": (0, 20, 2, 3, saldo, 84, 1), "COBRO-c3": (0, 5, 0, 0, saldo, 84, 1)}
    plan = plain._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan[:plan.index("Union")] and plan[:plan.index("Union")].count("RepartitionByExpression") == 1
