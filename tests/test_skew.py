"""Operators with a split path: forcing the split must not change any row.

Every loan of the odd partners is moved to one partner, so a third or more of all rows
share a key.
"""

import pytest
from pyspark.sql import functions as F

from loanbook.operators import balances, payments, statements
from loanbook.sources import tables as T

SF = "/root/testdata/sf0.001"


def skewed(df):
    return df.withColumn("c_bpartner_id", F.when(F.col("c_bpartner_id") % 2 == 1, F.lit(1)).otherwise(F.col("c_bpartner_id")))


@pytest.fixture(scope="module")
def loans(spark):
    return skewed(T.loans(spark, SF))


def same(a, b):
    cols = sorted(a.columns)
    x, y = a.select(cols), b.select(cols)
    assert x.count() == y.count()
    assert x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()


@pytest.mark.parametrize("classify", [balances.loan_renewal, balances.loan_renewal_strict])
def test_renewal(loans, classify):
    share = loans.filter("c_bpartner_id = 1").count() / loans.count()
    assert share > 1 / 3
    same(classify(loans), classify(loans, 20))


def test_debt_order(spark):
    debts = skewed(payments.open_debts(T.invoices(spark, SF)))
    same(payments.debt_order(debts), payments.debt_order(debts, 20))


def test_partner_history(spark, loans):
    args = (loans, T.collections(spark, SF), T.branches(spark, SF))
    same(statements.partner_history(*args), statements.partner_history(*args, hot_rows=20))


def test_cash_statement(spark):
    p = T.cash_payments(spark, SF).withColumn("c_bankaccount_id", F.lit(3))
    args = (p, "2024-01-08", "2024-01-21")
    same(statements.cash_statement(*args), statements.cash_statement(*args, hot_rows=20))


def test_allocation(spark):
    pays = skewed(T.receipts(spark, SF).filter("docstatus = 'CO'"))
    debts = skewed(payments.open_debts(T.invoices(spark, SF)))
    plain = payments.allocate(pays, debts)
    same(plain, payments.allocate(pays, debts, 20))
    over = plain.groupBy("c_invoice_id").agg(F.sum("amount").alias("a")).join(debts, "c_invoice_id")
    assert over.filter("a > open").isEmpty()
    spent = plain.groupBy("c_payment_id").agg(F.sum("amount").alias("a")).join(pays, "c_payment_id")
    assert spent.filter("a > payamt").isEmpty()
