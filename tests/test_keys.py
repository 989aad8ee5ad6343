"""Keys, duplicates and joins with keys that hold a large part of the rows, against brute force."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import keys as keys_module
from tallyhouse.operators.keys import (
    KeyViolation,
    assert_key,
    duplicates,
    first_per_key,
    key_violations,
    repeated_keys,
    require_key,
)
from tallyhouse.plans import model


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def skewed_rows():
    """A third of the rows has key 'hot', half of those are equal copies; some keys are NULL."""
    rows = []
    for i in range(400):
        rows.append(("hot", 7 if i % 2 else i, "x"))
    for i in range(700):
        rows.append((f"k{i % 500}", i % 3, "y"))
    rows += [(None, i % 2, "z") for i in range(100)]
    return rows


@pytest.fixture(scope="module")
def skewed(spark, skewed_rows):
    return spark.createDataFrame(skewed_rows, "k string, v int, t string").repartition(5)


def brute_duplicates(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    out = Counter()
    for group in groups.values():
        out.update(sorted(group, key=lambda r: r[1:])[1:])
    return out


@pytest.mark.parametrize("rows_per_slice", [100_000, 3])
def test_duplicates_of_hot_key_copies_and_null_keys(monkeypatch, skewed, skewed_rows, rows_per_slice):
    monkeypatch.setattr(keys_module, "ROWS_PER_SLICE", rows_per_slice)
    expected = brute_duplicates(skewed_rows)
    assert bag(duplicates(skewed, ["k"], ["v"])) == expected
    assert bag(duplicates(skewed, ["k"], ["v"], repeated_keys(skewed, ["k"]))) == expected


def test_a_shuffled_input_is_ranked_once(monkeypatch, spark, skewed_rows):
    """A hot key in an input out of a shuffle, cut into many slices: every row but the first once, from one evaluation."""
    monkeypatch.setattr(keys_module, "ROWS_PER_SLICE", 3)
    counts = [(k, n) for k, n in Counter(r[0] for r in skewed_rows).items() if n > 1]
    shuffled = spark.createDataFrame(skewed_rows, "k string, v int, t string").repartition(13)
    found = duplicates(shuffled, ["k"], ["v"], spark.createDataFrame(counts, "k string, copies long"))
    assert bag(found) == brute_duplicates(skewed_rows)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Repartition") == 1


def test_every_key_is_sliced_by_its_count(monkeypatch, spark):
    """No list of hot keys: each of 400 equal ones is cut up."""
    monkeypatch.setattr(keys_module, "ROWS_PER_SLICE", 5)
    df = spark.range(400 * 20).select((F.col("id") % 400).alias("k"), F.col("id").alias("v"))
    assert bag(duplicates(df, ["k"], ["v"])) == Counter((i % 400, i) for i in range(400, 8000))


def test_duplicates_on_two_columns(spark):
    rows = [("a", 1, i) for i in range(50)] + [("a", 2, 0), (None, 1, 0), (None, 1, 1), (None, None, 5)]
    df = spark.createDataFrame(rows, "k string, n int, v int")
    assert bag(duplicates(df, ["k", "n"], ["v"])) == Counter([("a", 1, i) for i in range(1, 50)] + [(None, 1, 1)])


def test_duplicates_leave_what_first_per_key_takes(skewed):
    together = duplicates(skewed, ["k"], ["v"]).unionByName(first_per_key(skewed, ["k"], ["v"]))
    assert bag(together) == bag(skewed)


def test_equal_order_values_are_decided_by_the_other_columns(spark):
    df = spark.createDataFrame([("a", 1, "second"), ("a", 1, "first")], "k string, at int, t string")
    assert first_per_key(df, ["k"], ["at"]).first()["t"] == "first"
    assert [r["t"] for r in duplicates(df, ["k"], ["at"]).collect()] == ["second"]


def test_key_violations_and_assertions(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert {(r["k"], r["row_count"]) for r in key_violations(df, ["k"]).collect()} == {("a", 2), (None, 1)}
    with pytest.raises(KeyViolation, match="orders breaks its key .k. 2 times"):
        assert_key(df, ["k"], "orders")
    assert_key(df.filter("k = 'b'"), ["k"])
    assert require_key(df.filter("k = 'b'"), ["k"]).count() == 1
    with pytest.raises(Exception, match="2 violations of the key"):
        require_key(df, ["k"]).collect()


def test_first_per_key_is_limited_before_the_shuffle(spark, skewed):
    plan = first_per_key(skewed.withColumn("x", F.lit(1)), ["k"], ["v"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
}


def test_hot_order_is_cut_up_in_the_joins(spark):
    """The fact's left join and the payment rule's join split the partition of an order with a third of the rows."""
    old = {key: spark.conf.get(key, None) for key in SKEW}
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    try:
        pad = F.repeat(F.lit("x"), F.lit(50))
        hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        many = spark.range(0, 30000, 1, 8).select(
            hot.alias("order_id"), F.concat(F.col("id").cast("string"), pad).alias("customer_id"),
            F.lit(None).cast("date").alias("order_day"), F.col("id").cast("decimal(10,2)").alias("order_total"),
        )
        payments = spark.createDataFrame([("p", "hot", "paid", 5)], "payment_id string, order_id string, payment_status string, payment_amount int")
        payments = payments.withColumn("payment_amount", F.col("payment_amount").cast("decimal(10,2)"))
        joined = model.with_payments(many, payments)
        assert joined.filter("payment_status = 'paid'").count() == 10000 and joined.count() == 30000
        for df in (joined, model.paid_mismatch(many).violations(payments)):
            df.collect()
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
