"""Rules, quarantine, clean split and gate on small tables."""

from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.quality import (
    QualityGateBreached,
    exclude,
    gate_report,
    quality_gate,
)
from tallyhouse.plans import model
from tallyhouse.plans.samples import Samples

ORDERS = "order_id string, customer_id string, order_date timestamp_ntz, order_total decimal(10,2), ingested_at timestamp_ntz"
PAYMENTS = "payment_id string, order_id string, payment_status string, payment_amount decimal(10,2)"


def orders(spark, rows):
    text = spark.createDataFrame(
        [(o, c, "2024-01-01 10:00:00", t, at) for o, c, t, at in rows], "a string, b string, c string, d string, e string"
    )
    return text.selectExpr(
        "a AS order_id",
        "b AS customer_id",
        "CAST(c AS timestamp_ntz) AS order_date",
        "CAST(d AS decimal(10,2)) AS order_total",
        "CAST(e AS timestamp_ntz) AS ingested_at",
    )


T1, T2 = "2024-01-02 00:00:00", "2024-01-03 00:00:00"


def reasons(df, key):
    return Counter((r[key], r["reason"]) for r in df.collect())


def test_one_row_per_violated_rule(spark):
    df = orders(spark, [("A", "", "-1", T1), ("B", None, "5", T1), ("C", "c", None, T1), ("D", "d", "1", T1)])
    assert reasons(model.quarantined_orders(df), "order_id") == {
        ("A", "missing customer_id"): 1,
        ("A", "negative order_total"): 1,
        ("B", "missing customer_id"): 1,
    }


def test_duplicates_drop_every_copy_by_default_and_keep_first_on_request(spark):
    df = orders(spark, [("A", "late", "1", T2), ("A", "early", "1", T1), ("B", "b", "1", T1)])
    bad = model.quarantined_orders(df)
    assert [(r.order_id, r.customer_id) for r in bad.collect()] == [("A", "late")]
    assert [r.order_id for r in model.clean_orders(df).collect()] == ["B"]
    kept = model.clean_orders(df, "keep_first").collect()
    assert {(r.order_id, r.customer_id) for r in kept} == {("A", "early"), ("B", "b")}
    with pytest.raises(ValueError):
        model.clean_orders(df, "keep_last")


@pytest.mark.parametrize("same_moment", [False, True])
def test_keep_first_keeps_no_row_that_is_quarantined(spark, same_moment):
    """The earliest copy is kept if it passes; a later one never is, as it is quarantined."""
    rows = [("A", None, "1", T1), ("A", "late", "1", T2), ("B", "b1", "1", T1), ("B", "b2", "-1", T2), ("C", "c", "1", T1), ("D", "", "1", T1)]
    if same_moment:
        rows = [(o, c, t, T1) for o, c, t, _ in rows]
    df = orders(spark, rows)
    kept = Counter((r.order_id, r.customer_id) for r in model.clean_orders(df, "keep_first").collect())
    bad = Counter((r.order_id, r.customer_id) for r in model.quarantined_orders(df).collect())
    assert not set(kept) & set(bad)
    assert set(kept) | set(bad) == {(o, c) for o, c, _, _ in rows}
    assert ("C", "c") in kept and ("B", "b1") in kept and (same_moment or not any(o == "A" for o, _ in kept))


def test_keep_first_on_the_sample_tables_shares_no_row_with_the_quarantine(spark):
    s = Samples(spark, "/root/testdata/sf0.001")
    columns = ["order_id", "customer_id", "order_date", "order_total", "ingested_at"]
    kept = model.clean_orders(s.raw_orders, "keep_first", s.repeated).select(columns)
    from tallyhouse.operators.quality import quarantine

    bad = quarantine(s.raw_orders, model.order_rules(s.raw_orders, s.repeated)).select(columns)
    assert kept.intersect(bad).isEmpty() and kept.count() > 0


def test_equal_copies_are_quarantined_but_one(spark):
    df = orders(spark, [("A", "a", "1", T1)] * 4)
    assert reasons(model.quarantined_orders(df), "order_id") == {("A", "duplicate order_id"): 3}


def test_rows_with_a_null_key_are_quarantined_and_still_kept(spark):
    df = orders(spark, [(None, "a", "1", T1), (None, "b", "-1", T2), ("C", "c", "1", T1)])
    bad = model.quarantined_orders(df)
    assert reasons(bad, "order_id") == {(None, "duplicate order_id"): 1, (None, "negative order_total"): 1}
    assert model.clean_orders(df).count() == 3
    assert exclude(df, bad, "order_id").count() == 3


def test_payment_is_quarantined_once_per_mismatching_order_copy(spark):
    raw = orders(
        spark,
        [("A", "a", "10", T1), ("A", "a", "10", T1), ("A", "a", "12", T2), ("A", "a", None, T2), ("B", "b", "5", T1)],
    )
    payments = spark.createDataFrame(
        [
            ("p1", "A", "paid", Decimal("12")),
            ("p2", "A", "paid", Decimal("11")),
            ("p3", "A", "failed", Decimal("0")),
            ("p4", "B", "paid", Decimal("5")),
            ("p5", "B", "paid", None),
            ("p6", "", "paid", Decimal("1")),
            ("p7", None, "pending", Decimal("1")),
            ("p8", "unknown", "paid", Decimal("1")),
        ],
        PAYMENTS,
    )
    bad = model.quarantined_payments(payments, raw)
    assert reasons(bad, "payment_id") == {
        ("p1", "paid amount != order_total"): 2,
        ("p2", "paid amount != order_total"): 3,
        ("p6", "missing order_id"): 1,
        ("p7", "missing order_id"): 1,
    }
    assert {r.payment_id for r in model.clean_payments(payments, bad).collect()} == {"p3", "p4", "p5", "p8"}


def test_short_way_to_clean_orders_equals_excluding_the_quarantine(spark):
    s = Samples(spark, "/root/testdata/sf0.001")
    short = model.clean_orders(s.raw_orders)
    long = exclude(s.raw_orders, s.quarantine_orders, "order_id")
    assert Counter(short.collect()) == Counter(long.collect())
    clean, bad = short.select("order_id"), s.quarantine_orders.select("order_id")
    assert clean.join(bad, "order_id").isEmpty()


def test_gate_is_strict_and_looks_at_each_table(spark):
    five, six = spark.range(5), spark.range(6)
    quality_gate({"orders": five, "payments": five}, 5)
    with pytest.raises(QualityGateBreached, match="payments=6"):
        quality_gate({"orders": five, "payments": six}, 5)
    row = gate_report({"orders": five, "payments": six}, 5).first()
    assert (row.orders, row.payments, row.max_errors, row.breached) == (5, 6, 5, True)


def test_quarantined_at_is_one_moment(spark):
    from datetime import datetime

    at = datetime(2024, 5, 1, 12, 30, 0, 250000)
    df = orders(spark, [("A", "", "1", T1), ("B", "", "1", T1)])
    assert {r.quarantined_at for r in model.quarantined_orders(df, at=at).collect()} == {at}


def test_payment_rule_shuffles_orders_once(spark):
    s = Samples(spark, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = model.paid_mismatch(s.raw_orders).violations(s.raw_payments)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2


def test_row_rules_share_one_scan(spark):
    s = Samples(spark, "/root/testdata/sf0.001")
    table = s.table("orders").withColumnsRenamed({"o_orderpriority": "customer_id"}).withColumn(
        "order_total", F.col("o_totalprice")
    )
    from tallyhouse.operators.quality import quarantine

    plan = quarantine(table, model.order_row_rules())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
