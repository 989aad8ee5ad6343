"""Incremental changes of a table: insert-or-ignore, upsert, rebuild of a window of days."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import cutoff
from tallyhouse.operators.keys import any_null, first_per_key, require_key
from tallyhouse.session import Keep, staged


def _without_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself, failing when it is run if a key is NULL."""
    refuse = F.raise_error(F.lit(f"NULL in key ({', '.join(keys)})")).cast("boolean")
    return df.filter(F.when(any_null(keys), refuse).otherwise(F.lit(True)))


def new_rows(
    target: DataFrame | Callable[[DataFrame], DataFrame],
    batch: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    keep: Keep = staged,
) -> DataFrame:
    """Rows of ``batch`` to append to ``target``: unknown keys only, first row per key.

    The batch, reduced to one row per key, is written once with ``keep``, which runs a job. Spark then knows how small it is,
    sends it to the target's keys, and reads the target once. ``target`` may be a function from the reduced batch to the part
    of the target that can hold its keys.
    """
    keys = list(keys)
    first = keep(first_per_key(_without_null_keys(batch, keys), keys, order_by), "batch")
    target = target if isinstance(target, DataFrame) else target(first)
    known = target.select(*keys).join(first.select(*keys), keys, "left_semi").distinct()
    return first.join(known, keys, "left_anti").select(*batch.columns)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """``target`` after inserting ``batch``: an existing row wins, then the first in the batch."""
    return target.unionByName(new_rows(target, batch, keys, order_by), allowMissingColumns=True)


def upsert(existing: DataFrame, source: DataFrame, keys: Sequence[str], checked: bool = False) -> DataFrame:
    """``existing`` with the rows of ``source`` inserted, or put in place of those with the same key.

    A repeated or NULL key in ``source`` fails the query; ``checked`` is for a caller that has seen to that.
    """
    keys = list(keys)
    source = source if checked else require_key(source, keys, "the upsert source")
    kept = existing.join(source.select(*keys), keys, "left_anti").select(*existing.columns)
    return kept.unionByName(source)


def in_window(df: DataFrame, day: str, as_of: date, days: int) -> DataFrame:
    """Rows from ``as_of - days`` on, that day and later ones included."""
    return df.filter(F.col(day) >= F.lit(cutoff(as_of, days)))


def before_window(df: DataFrame, day: str, as_of: date, days: int) -> DataFrame:
    return df.filter((F.col(day) < F.lit(cutoff(as_of, days))) | F.col(day).isNull())


def is_on(day: str, values: Collection[date | None]) -> Column:
    """Whether a row's day is one of ``values``; None stands for a NULL day. Prunes partitions."""
    dated = [value for value in values if value is not None]
    listed = F.col(day).isin(dated) if dated else F.lit(False)
    return listed | F.col(day).isNull() if None in values else F.coalesce(listed, F.lit(False))


def moved_days(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], day: str, as_of: date, days: int
) -> set[date | None]:
    """Days before the window that lose a row to it. Runs a job that reads keys and days only.

    The result has at most one value per calendar day.
    """
    keys = list(keys)
    older = before_window(existing, day, as_of, days).select(*keys, day)
    fresh = in_window(incoming, day, as_of, days).select(*keys)
    return {row[0] for row in older.join(fresh, keys, "left_semi").select(day).distinct().collect()}


def rebuilt_days(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    day: str,
    as_of: date,
    days: int,
    moved: Collection[date | None],
    checked: bool = False,
) -> DataFrame:
    """Rows of the days ``rebuild_window`` changes: those of the window and the ``moved`` ones.

    For a table partitioned by ``day``, all other partitions are neither read nor rewritten.
    """
    affected = before_window(existing, day, as_of, days).filter(is_on(day, moved))
    return upsert(affected, in_window(incoming, day, as_of, days), keys, checked)


def rebuild_window(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], day: str, as_of: date, days: int
) -> DataFrame:
    """The whole table after deleting the window's days and upserting the incoming ones.

    An older row whose key comes back inside the window moves there. Made of the days that change and those that
    do not, as a run publishes it. Runs a job.
    """
    moved = moved_days(existing, incoming, keys, day, as_of, days)
    untouched = before_window(existing, day, as_of, days).filter(~is_on(day, moved))
    return untouched.unionByName(rebuilt_days(existing, incoming, keys, day, as_of, days, moved))
