"""Read queries over the published tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.functions import moment, ratio, to_scale
from tallyhouse.operators.trends import AnomalyRule, anomalies_in_window, anomalies_of, daily_series, flagged, flagged_days, scored_series


def kpi_summary(fact: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("order_total"), F.lit(0).cast("decimal(20,2)"))
    return fact.agg(F.count("*").alias("total_orders"), total.alias("total_revenue"))


def daily_revenue(fact: DataFrame) -> DataFrame:
    """Ordered value per day, newest first."""
    return fact.groupBy("order_day").agg(F.sum("order_total").alias("revenue")).orderBy(F.desc_nulls_first("order_day"))


def orders_per_day(fact: DataFrame) -> DataFrame:
    return fact.groupBy("order_day").agg(F.count("*").alias("order_count")).orderBy(F.asc_nulls_last("order_day"))


def payment_status_dist(fact: DataFrame) -> DataFrame:
    status = F.coalesce("payment_status", F.lit("unknown")).alias("payment_status")
    return fact.groupBy(status).agg(F.count("*").alias("count")).orderBy(F.desc("count"), "payment_status")


def top_cities(fact: DataFrame, dim_customer: DataFrame, limit: int = 10) -> DataFrame:
    """Cities with the highest ordered value; a NULL city is one of them, a NULL revenue ranks first.

    Orders are summed per customer before the join, so a customer with very many
    orders is one row in it.
    """
    per_customer = fact.groupBy("customer_id").agg(F.sum("order_total").alias("spent"))
    per_city = (
        per_customer.join(dim_customer.select("customer_id", "city"), "customer_id")
        .groupBy("city")
        .agg(F.round(F.sum("spent"), 2).alias("revenue"))
    )
    return per_city.orderBy(F.desc_nulls_first("revenue"), F.asc_nulls_last("city")).limit(limit)


def _rounded_scores() -> list:
    return [
        to_scale(F.col("revenue"), schemas.WIDE_MONEY).alias("revenue"),
        F.col("orders").cast("int").alias("orders"),
        to_scale(F.col("avg_prior"), schemas.WIDE_MONEY).alias("rev_avg_14d"),
        to_scale(F.col("std_prior"), schemas.WIDE_MONEY).alias("rev_std_14d"),
        to_scale(F.col("pct_change") * 100, schemas.RATE).alias("pct_change_pct"),
        to_scale(F.col("z"), schemas.RATE).alias("z_score"),
    ]


def anomaly_log(
    fact: DataFrame,
    as_of: date,
    days: int,
    run_id: str,
    detected_at: datetime,
    rule: AnomalyRule = AnomalyRule(),
) -> DataFrame:
    """Rows a run adds to the anomaly log: anomalous days of its window."""
    return _logged(anomalies_in_window(fact, as_of, days, rule), run_id, detected_at)


def anomaly_log_of_totals(
    totals: DataFrame, as_of: date, days: int, run_id: str, detected_at: datetime, rule: AnomalyRule = AnomalyRule()
) -> DataFrame:
    """``anomaly_log`` from totals of the days, without the fact."""
    return _logged(anomalies_of(scored_series(daily_series(totals)), as_of, days, rule), run_id, detected_at)


def _logged(anomalies: DataFrame, run_id: str, detected_at: datetime) -> DataFrame:
    stamp = [F.lit(run_id).alias("run_id"), moment(detected_at).alias("detected_at")]
    return anomalies.select(*stamp, "order_day", *_rounded_scores())


def revenue_anomaly_daily(fact: DataFrame, rule: AnomalyRule = AnomalyRule()) -> DataFrame:
    """Every day with its score and whether it is an anomaly."""
    return flagged_days(fact, rule).select("order_day", *_rounded_scores(), "is_anomaly")


def revenue_trend(fact: DataFrame) -> DataFrame:
    return revenue_anomaly_daily(fact).select("order_day", "revenue").orderBy(F.asc_nulls_last("order_day"))


def revenue_anomalies(fact: DataFrame, rule: AnomalyRule = AnomalyRule()) -> DataFrame:
    """Flagged days only, newest first."""
    flagged = revenue_anomaly_daily(fact, rule).filter("is_anomaly")
    return flagged.select("order_day", "revenue", "z_score").orderBy(F.desc_nulls_first("order_day"))


def metrics_trend(metrics: DataFrame) -> DataFrame:
    """Quarantined share of raw rows, in percent, for every run."""

    def percent(quarantined: str, raw: str):
        return F.round(ratio(F.col(quarantined).cast("double") * 100, F.col(raw).cast("double")), 2)

    return metrics.select(
        "run_timestamp",
        percent("quarantined_orders", "raw_orders_count").alias("orders_quarantine_pct"),
        percent("quarantined_payments", "raw_payments_count").alias("payments_quarantine_pct"),
    ).orderBy("run_timestamp")


# The same reports from totals of the days, as a warehouse keeps them for its fact; they read a row per day.


def kpi_of_totals(totals: DataFrame) -> DataFrame:
    orders = F.coalesce(F.sum("orders"), F.lit(0).cast("long"))
    revenue = F.coalesce(F.sum("revenue"), F.lit(0).cast("decimal(20,2)"))
    return totals.agg(orders.alias("total_orders"), revenue.cast("decimal(20,2)").alias("total_revenue"))


def daily_revenue_of_totals(totals: DataFrame) -> DataFrame:
    return totals.select("order_day", "revenue").orderBy(F.desc_nulls_first("order_day"))


def orders_per_day_of_totals(totals: DataFrame) -> DataFrame:
    return totals.select("order_day", F.col("orders").alias("order_count")).orderBy(F.asc_nulls_last("order_day"))


def payment_status_of_totals(totals: DataFrame) -> DataFrame:
    counted = totals.select(F.explode("statuses").alias("payment_status", "orders"))
    summed = counted.groupBy("payment_status").agg(F.sum("orders").alias("count"))
    return summed.orderBy(F.desc("count"), "payment_status")


def revenue_anomaly_of_totals(totals: DataFrame, rule: AnomalyRule = AnomalyRule()) -> DataFrame:
    return flagged(scored_series(daily_series(totals)), rule).select("order_day", *_rounded_scores(), "is_anomaly")
