"""Trailing statistics of a daily series, and the anomaly rules on top of them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import cutoff, ratio


@dataclass(frozen=True)
class AnomalyRule:
    """Thresholds; they apply to unrounded values."""

    min_orders: int = 15
    min_change: float = 0.30
    above_z: float = 3.0

    def condition(self) -> Column:
        return (
            F.col("z").isNotNull()
            & (F.col("orders") >= self.min_orders)
            & (F.abs("pct_change") >= self.min_change)
            & (F.abs("z") > self.above_z)
        )


def paid_value() -> Column:
    """What an order of the fact brought: its payment if that is paid, else 0."""
    return F.when(F.col("payment_status") == "paid", F.col("payment_amount")).otherwise(F.lit(0).cast("decimal(10,2)"))


def daily_paid_revenue(fact: DataFrame) -> DataFrame:
    """Paid revenue and number of orders of every day."""
    return fact.groupBy("order_day").agg(F.sum(paid_value()).alias("revenue"), F.count("*").alias("orders"))


def daily_series(totals: DataFrame) -> DataFrame:
    """``daily_paid_revenue`` from totals of the days."""
    return totals.select("order_day", F.col("paid").alias("revenue"), "orders")


def trailing_zscore(
    series: DataFrame, order: str, value: str, rows: int = 14, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Add ``avg_prior``, ``std_prior``, ``pct_change`` and ``z`` against the ``rows`` rows before.

    Rows, not days: a gap in the series stretches the frame. The current row is not part of it.
    Without ``partition_by`` the series is ranked in one task, so aggregate it first:
    a daily series has at most one row per calendar day.
    """
    ordered = Window.partitionBy(*partition_by).orderBy(F.col(order).asc_nulls_last()).rowsBetween(-rows, -1)
    number = F.col(value).cast("double")
    change = F.col("_value") - F.col("avg_prior")
    return (
        series.withColumn("_value", number)
        .withColumn("avg_prior", F.avg("_value").over(ordered))
        .withColumn("std_prior", F.stddev_samp("_value").over(ordered))
        .withColumn("pct_change", ratio(change, F.col("avg_prior")))
        .withColumn("z", ratio(change, F.col("std_prior")))
        .drop("_value")
    )


def scored_days(fact: DataFrame, rows: int = 14) -> DataFrame:
    return scored_series(daily_paid_revenue(fact), rows)


def scored_series(series: DataFrame, rows: int = 14) -> DataFrame:
    return trailing_zscore(series, "order_day", "revenue", rows)


def recent_history(fact: DataFrame, as_of: date, days: int, rows: int = 14) -> DataFrame:
    """The part of ``fact`` that scoring the window's days needs: the window and the ``rows`` data days before it.

    The day column of all history is read first; a warehouse scores its lists of daily totals instead.
    """
    start = cutoff(as_of, days)
    prior = fact.filter(F.col("order_day") < F.lit(start)).select("order_day").distinct()
    first = prior.orderBy(F.desc("order_day")).limit(rows).agg(F.min("order_day")).scalar()
    return fact.filter(F.col("order_day") >= F.coalesce(first, F.lit(start)))


def anomalies_in_window(
    fact: DataFrame,
    as_of: date,
    days: int,
    rule: AnomalyRule = AnomalyRule(),
    rows: int = 14,
) -> DataFrame:
    """Anomalous days of the window, with unrounded statistics."""
    return anomalies_of(scored_days(recent_history(fact, as_of, days, rows), rows), as_of, days, rule)


def anomalies_of(scored: DataFrame, as_of: date, days: int, rule: AnomalyRule = AnomalyRule()) -> DataFrame:
    """The anomalous ones of scored days, of the window only."""
    return scored.filter((F.col("order_day") >= F.lit(cutoff(as_of, days))) & rule.condition())


def flagged_days(fact: DataFrame, rule: AnomalyRule = AnomalyRule(), rows: int = 14) -> DataFrame:
    """All days with ``is_anomaly``; a day that cannot be scored is not an anomaly."""
    return flagged(scored_days(fact, rows), rule)


def flagged(scored: DataFrame, rule: AnomalyRule = AnomalyRule()) -> DataFrame:
    return scored.withColumn("is_anomaly", F.coalesce(rule.condition(), F.lit(False)))
