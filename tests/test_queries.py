"""Registered queries against their SQL on DuckDB (sf0.001).

A part of them runs by default; LOANBOOK_ALL=1 runs all.
"""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, connect

SF = "/root/testdata/sf0.001"
CORE = """asof_balance asof_multi loan_view loan_metadata invoice_open fn_effective_days fn_add_six_day
fn_birthdate_from_id int_hidden_rate int_schedule_declining int_recalc_schedule int_bill_prepaid int_accrual_daily
pay_split_principal_first pay_allocate pay_candidate_totals pay_unallocated brg_loans brg_collections_checked
icc_credit icc_recoveries icc_analysts rpt_portfolio_risk rpt_portfolio_global rpt_promotion rpt_collections_branch
stm_partner stm_loan stm_cash_account cash_global cash_close_period cash_daily_box_means tax_voucher tax_list
dq_reassign_first_fit dq_zero_duplicates dq_allocation_cleanup mig_collections mig_nearest_partner mig_applications
src_balance_csv src_loans src_collections snk_export snk_period_partition snk_upsert str_collections str_invoice_open
int_bill_daily_updates int_bill_prepaid_updates int_reprice_batch_payments dq_void_loans dq_reassign_first_fit_owned stm_partner_owned
pay_unallocated_day icc_close_written mig_opening_loans_rejects dq_orphan_receipts""".split()

QUERIES, SQL = entry.queries(), entry.oracle_sql()
NAMES = list(SQL) if os.environ.get("LOANBOOK_ALL") else CORE


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    message, ok = compare(spark, con, SF, QUERIES[name], SQL.get(name))
    assert ok, message


def test_every_query_has_an_oracle():
    assert {n for n in QUERIES if not n.startswith("op") and n != "pipeline"} <= set(SQL)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_filters_reach_the_scan(spark):
    """The as-of filter and the two needed columns are all the scan of collections reads."""
    df = QUERIES["asof_balance"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" in plan and "PushedFilters: [" in plan
    scan = [x for x in plan.splitlines() if "l_extendedprice" in x and "ReadSchema" in x]
    assert scan and "l_discount" not in scan[0] and "l_suppkey" not in scan[0].split("ReadSchema")[1]
