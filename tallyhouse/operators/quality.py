"""Declarative data-quality rules, quarantine, the clean remainder and the quality gate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import is_missing, moment
from tallyhouse.operators.keys import any_null, duplicates, first_per_key, repeated_keys, with_repeated


@dataclass(frozen=True)
class RowRule:
    """A rule that one row alone breaks or keeps. A NULL condition does not break it."""

    reason: str
    condition: Column

    def broken(self) -> Column:
        return F.coalesce(self.condition, F.lit(False))

    def violations(self, df: DataFrame) -> DataFrame:
        return df.filter(self.condition).withColumn("reason", F.lit(self.reason))


@dataclass(frozen=True)
class DuplicateRule:
    """Every row of a key but its earliest breaks the rule."""

    reason: str
    keys: Sequence[str]
    order_by: Sequence[str]
    repeated: DataFrame | None = None

    def violations(self, df: DataFrame) -> DataFrame:
        return duplicates(df, self.keys, self.order_by, self.repeated).withColumn("reason", F.lit(self.reason))


@dataclass(frozen=True)
class MismatchRule:
    """A row breaks the rule once per row of ``other`` with its key and another value.

    Rows without a value on either side, and rows ``when`` does not hold for, are not compared.
    """

    reason: str
    other: DataFrame
    key: str
    value: str
    other_value: str
    when: Column

    def violations(self, df: DataFrame) -> DataFrame:
        expected = self.other.filter(F.col(self.other_value).isNotNull() & F.col(self.key).isNotNull())
        expected = expected.select(self.key, F.col(self.other_value).alias("_expected"))
        compared = df.filter(self.when & F.col(self.value).isNotNull())
        # Either side is shuffled once, by the key alone; a hot key is cut up at run time.
        hits = compared.join(expected, self.key).filter(F.col(self.value) != F.col("_expected"))
        return hits.select(*df.columns).withColumn("reason", F.lit(self.reason))


Rule = RowRule | DuplicateRule | MismatchRule


def missing(column: str, reason: str | None = None) -> RowRule:
    return RowRule(reason or f"missing {column}", is_missing(column))


def below(column: str, bound: float | int, reason: str) -> RowRule:
    return RowRule(reason, F.col(column) < F.lit(bound))


def broken_reasons(rules: Sequence[RowRule]) -> Column:
    """Array of the reasons of all row rules a row breaks."""
    reasons = F.array(*[F.when(rule.broken(), F.lit(rule.reason)) for rule in rules])
    return F.filter(reasons, lambda reason: reason.isNotNull())


def breaks_any(rules: Sequence[RowRule]) -> Column:
    return reduce(lambda a, b: a | b, [rule.broken() for rule in rules], F.lit(False))


def quarantine(df: DataFrame, rules: Sequence[Rule], at: datetime | None = None) -> DataFrame:
    """One row per violation with its reason (and ``quarantined_at`` when a moment is given).

    All row rules share one pass over the table.
    """
    row_rules = [rule for rule in rules if isinstance(rule, RowRule)]
    parts = [rule.violations(df) for rule in rules if not isinstance(rule, RowRule)]
    if row_rules:
        parts.append(
            df.filter(breaks_any(row_rules)).withColumn("reason", F.explode(broken_reasons(row_rules)))
        )
    found = reduce(DataFrame.unionByName, parts)
    return found if at is None else found.withColumn("quarantined_at", moment(at))


def exclude(df: DataFrame, quarantined: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not quarantined. A NULL key matches nothing, so its rows stay."""
    bad = quarantined.select(key).filter(F.col(key).isNotNull())
    return df.join(bad, key, "left_anti").select(*df.columns)


def survivors(df: DataFrame, rules: Sequence[RowRule], key: str, bad_keys: DataFrame) -> DataFrame:
    """Same as ``exclude`` of the full quarantine, at less cost.

    Holds when every key with more than one row is in ``bad_keys``: a row rule can
    then only exclude the row that breaks it. What is joined is the short list of
    ``bad_keys`` instead of the whole quarantine.
    """
    passing = df.filter(any_null([key]) | ~breaks_any(rules))
    bad = bad_keys.select(key).filter(F.col(key).isNotNull())
    return passing.join(bad, key, "left_anti").select(*df.columns)


def clean_split(
    df: DataFrame,
    rules: Sequence[RowRule],
    key: str,
    order_by: Sequence[str],
    on_duplicate: str = "drop_all",
    repeated: DataFrame | None = None,
) -> DataFrame:
    """Rows that pass all row rules, with duplicates of ``key`` dropped.

    ``drop_all`` loses every copy of a repeated key. ``keep_first`` keeps the earliest copy, the one that the duplicate rule
    does not quarantine, if it passes the row rules; no row is then both kept and quarantined. There NULL is a key like any
    other. ``repeated`` may bring the repeated keys as a written table.
    """
    repeated = repeated_keys(df, [key]) if repeated is None else repeated
    if on_duplicate == "drop_all":
        return survivors(df, rules, key, repeated)
    if on_duplicate == "keep_first":
        passing = df.filter(~breaks_any(rules))
        other = repeated.select(F.col(key).alias("_key"))
        once = passing.join(other, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
        first = first_per_key(with_repeated(df, [key], repeated).drop("copies"), [key], order_by)
        return once.unionByName(first.filter(~breaks_any(rules))).select(*df.columns)
    raise ValueError(f"on_duplicate must be 'drop_all' or 'keep_first', not {on_duplicate!r}")


class QualityGateBreached(RuntimeError):
    """More rows were quarantined than a run may have."""


def gate_report(quarantined: dict[str, DataFrame], max_errors: int) -> DataFrame:
    """One row: the count of every quarantine table, and whether one is above ``max_errors``."""
    counts = {name: df.agg(F.count("*")).scalar() for name, df in quarantined.items()}
    spark = next(iter(quarantined.values())).sparkSession
    report = spark.range(1).select(*[count.alias(name) for name, count in counts.items()])
    breached = reduce(lambda a, b: a | b, [F.col(name) > max_errors for name in counts])
    return report.withColumn("max_errors", F.lit(max_errors).cast("long")).withColumn("breached", breached)


def check_gate(counts: dict[str, int], max_errors: int) -> None:
    """Raise ``QualityGateBreached`` when a quarantine table holds more than ``max_errors`` rows."""
    if max(counts.values()) > max_errors:
        shown = ", ".join(f"{name}={count}" for name, count in counts.items())
        raise QualityGateBreached(f"quality gate breached (more than {max_errors} rows): {shown}")


def quality_gate(quarantined: dict[str, DataFrame], max_errors: int) -> None:
    """``check_gate`` of tables yet to be counted."""
    row = gate_report(quarantined, max_errors).first()
    check_gate({name: row[name] for name in quarantined}, max_errors)
