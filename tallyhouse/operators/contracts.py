"""Contract checks on published tables: each is a DataFrame (check_name, status, failing_rows)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import ratio
from tallyhouse.operators.keys import repeated_keys


class ContractsFailed(RuntimeError):
    """At least one contract check has status FAIL; ``results`` holds all checks that ran."""

    def __init__(self, results: list[tuple[str, str, int]]):
        self.results = results
        failed = [row for row in results if row[1] == "FAIL"]
        super().__init__("; ".join(f"{name}: {count} failing rows" for name, _, count in failed))


def _verdict(df: DataFrame, name: str, passed: Column, failing: Column) -> DataFrame:
    return df.select(
        F.lit(name).alias("check_name"),
        F.when(passed, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        failing.cast("long").alias("failing_rows"),
    )


def _at_most(df: DataFrame, name: str, limit: int) -> DataFrame:
    counted = df.agg(F.count("*").alias("rows"))
    return _verdict(counted, name, F.col("rows") <= limit, F.col("rows"))


def no_duplicate_key(df: DataFrame, key: str, name: str) -> DataFrame:
    return _at_most(repeated_keys(df, [key]), name, 0)


def no_null_key(df: DataFrame, key: str, name: str) -> DataFrame:
    return _at_most(df.filter(F.col(key).isNull()), name, 0)


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """The newest row of the metrics table."""
    return metrics.orderBy(F.desc_nulls_first("run_timestamp")).limit(1)


def quarantine_rate_at_most(metrics: DataFrame, limit: float, name: str) -> DataFrame:
    """Share of quarantined payments in the newest run. No raw rows is a FAIL, no run gives no row."""
    rate = ratio(F.col("quarantined_payments").cast("double"), F.col("raw_payments_count").cast("double"))
    return _verdict(latest_metrics(metrics), name, rate <= limit, F.col("quarantined_payments"))


def anomalies_at_most(anomaly_log: DataFrame, limit: int, name: str) -> DataFrame:
    """Number of logged anomalies, over the whole log."""
    return _at_most(anomaly_log, name, limit)


def warehouse_contracts(fact: DataFrame, metrics: DataFrame, anomaly_log: DataFrame) -> list[DataFrame]:
    return [
        no_duplicate_key(fact, "order_id", "fact_orders_duplicate_order_id"),
        no_null_key(fact, "order_id", "fact_orders_null_order_id"),
        quarantine_rate_at_most(metrics, 0.05, "payments_quarantine_rate"),
        anomalies_at_most(anomaly_log, 5, "recent_anomalies_count"),
    ]


COLUMNS = ["check_name", "status", "failing_rows"]


def statements(text: str) -> list[str]:
    """The statements of a contract file: each ends with a semicolon at the end of a line; lines that begin with -- are notes."""
    lines = [line for line in text.splitlines() if not line.lstrip().startswith("--")]
    return [part.strip() for part in re.split(r";[ \t]*(?:\n|$)", "\n".join(lines)) if part.strip()]


def file_contracts(spark: SparkSession, path: str, tables: dict[str, DataFrame]) -> list[DataFrame]:
    """The checks of a file of Spark SQL statements, which name tables in braces: SELECT ... FROM {fact_orders}.

    Every statement has to return check_name, status (PASS or FAIL) and failing_rows, one row per check; a statement that
    returns no row checks nothing. Another status fails the run.
    """
    text = "\n".join(row.value for row in spark.read.text(path, wholetext=True).collect())
    found = []
    for statement in statements(text):
        named = {name: df for name, df in tables.items() if f"{{{name}}}" in statement}
        checks = spark.sql(statement, **named)
        if sorted(checks.columns) != sorted(COLUMNS):
            raise ValueError(f"a contract returns {', '.join(COLUMNS)}, not {', '.join(checks.columns)}: {statement}")
        known = F.when(F.col("status").isin("PASS", "FAIL"), F.col("status"))
        status = F.coalesce(known, F.raise_error(F.concat(F.lit("a contract's status is PASS or FAIL, not "), F.coalesce("status", F.lit("NULL")))))
        found.append(checks.select("check_name", status.alias("status"), F.col("failing_rows").cast("long").alias("failing_rows")))
    return found


def run_contracts(checks: Sequence[DataFrame]) -> list[tuple[str, str, int]]:
    """Run all checks in one job, then raise ``ContractsFailed`` if any failed."""
    rows = [tuple(row) for row in reduce(DataFrame.unionByName, checks).collect()] if checks else []
    if any(status == "FAIL" for _, status, _ in rows):
        raise ContractsFailed(rows)
    return rows
