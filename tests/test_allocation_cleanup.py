"""The clean-up of allocations against plain loops, and how many rows one of its tasks gets."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from loanbook.operators import quality as Q


def _frames(spark, invoices):
    """Ids that come twice and null ones in every table; targets that are no invoice."""
    ids = [k for k in range(invoices) for _ in range(1 + (k % 7 == 0))] + [None, None]
    target = [k for k in range(0, invoices + 30, 3) for _ in range(1 + k % 2)] + [None]
    lines = [(f"L{k}", None if k % 11 == 0 else f"H{k // 2}", None if k % 13 == 0 else k % 40, None if k % 17 == 0 else f"P{k // 3}")
             for k in range(120)] + [("L1", "H0", 1, "P0")]
    pays = [f"P{k}" for k in range(50)] + ["P1", None]
    return ids, target, lines, pays, [
        spark.createDataFrame([(k,) for k in target], "c_invoice_id long"),
        spark.createDataFrame(lines, "c_allocationline_id string, c_allocationhdr_id string, c_invoice_id long, c_payment_id string"),
        spark.createDataFrame([(p,) for p in pays], "c_payment_id string"), spark.createDataFrame([(k,) for k in ids], "c_invoice_id long")]


def _values(df, column):
    return Counter(r[0] for r in df.select(column).collect())


@pytest.mark.parametrize("at_once", [10, 1_000_000])
def test_cleanup_of_repeated_and_null_keys(spark, at_once, monkeypatch):
    monkeypatch.setattr(Q, "INVOICES_AT_ONCE", at_once, raising=False)
    ids, target, lines, pays, frames = _frames(spark, 60)
    out = Q.allocation_cleanup(*frames)
    hit = [x for x in lines if x[2] is not None and x[2] in target]
    heads, paid = {x[1] for x in hit}, {x[3] for x in hit}
    dropped = [x for x in lines if x[1] is not None and x[1] in heads]
    assert None in heads and None in paid
    assert _values(out["drop_headers"], "c_allocationhdr_id") == Counter(heads)
    assert _values(out["drop_lines"], "c_allocationline_id") == Counter(x[0] for x in dropped)
    assert _values(out["keep_lines"], "c_allocationline_id") == Counter(x[0] for x in lines) - Counter(x[0] for x in dropped)
    assert _values(out["reopen_payments"], "c_payment_id") == Counter(p for p in pays if p is not None and p in paid)
    assert _values(out["reopen_invoices"], "c_invoice_id") == Counter(k for k in ids if k is not None and k in target)


def test_tasks_of_the_invoices_do_not_grow_with_them(spark, monkeypatch):
    """Spark merges what looks small in bytes into one task; the counted rows must spread it."""
    monkeypatch.setattr(Q, "INVOICES_AT_ONCE", 100, raising=False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        *_, frames = _frames(spark, 3000)
        reopened = Q.allocation_cleanup(*frames)["reopen_invoices"]
        tasks = reopened.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(t[1] for t in tasks) == 1143 and max(t[1] for t in tasks) <= 100
