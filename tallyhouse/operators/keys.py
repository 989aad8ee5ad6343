"""Key constraints, duplicates and first-per-key selection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of one key that are ranked together; more are ranked in slices first.
ROWS_PER_SLICE = 100_000


class KeyViolation(ValueError):
    """A table breaks its declared key."""


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])


def _total_order(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> list[Column]:
    """``order_by``, then all remaining columns, so that ties never depend on row order."""
    rest = [c for c in df.columns if c not in order_by and c not in keys]
    return [F.col(c).asc_nulls_last() for c in [*order_by, *rest]]


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row, and their count. Only key columns are shuffled, after a map-side count."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key that is repeated or has a NULL in it, with its row count."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("row_count"))
    return counted.filter((F.col("row_count") > 1) | any_null(keys))


def assert_key(df: DataFrame, keys: Sequence[str], table: str = "table") -> None:
    """Raise ``KeyViolation`` unless ``keys`` is a primary key, with the number of bad keys and a few of them. Runs a job."""
    bad = key_violations(df, keys)
    examples = bad.limit(5).collect()
    if examples:
        shown = "; ".join(str(row.asDict()) for row in examples)
        raise KeyViolation(f"{table} breaks its key ({', '.join(keys)}) {bad.count()} times, as in {shown}")


def require_key(df: DataFrame, keys: Sequence[str], table: str = "table") -> DataFrame:
    """``df`` itself, failing when it is run if ``keys`` is not a primary key of it."""
    broken = key_violations(df, keys).agg(F.count("*")).scalar()
    message = F.concat(broken.cast("string"), F.lit(f" violations of the key ({', '.join(keys)}) of {table}"))
    return df.filter(F.when(broken == 0, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The earliest row of every key; NULL is a key like any other.

    Spark limits each key to one row per input partition before the shuffle, so a
    hot key sends one row per task.
    """
    ordered = Window.partitionBy(*keys).orderBy(*_total_order(df, keys, order_by))
    return df.withColumn("_rank", F.row_number().over(ordered)).filter(F.col("_rank") == 1).drop("_rank")


def with_repeated(df: DataFrame, keys: Sequence[str], repeated: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key is in ``repeated``, with its ``copies``. NULL keys match NULL keys.

    A written, short ``repeated`` is broadcast by Spark, and the rest of the table is not shuffled.
    """
    other = repeated.select(*[F.col(key).alias(f"_{key}") for key in keys], "copies")
    same = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys])
    return df.join(other, same).drop(*[f"_{key}" for key in keys])


def duplicates(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], repeated: DataFrame | None = None
) -> DataFrame:
    """All rows of every key but its earliest one. Rows with equal NULL keys are duplicates too.

    ``repeated`` may bring the repeated keys as a written table. Only their rows are ranked, in as many slices as
    their count asks for, by the same plan for every key; the first rows of the slices then meet in a second, small ranking.
    """
    keys = list(keys)
    repeated = repeated_keys(df, keys) if repeated is None else repeated
    order = _total_order(df, keys, order_by)
    # Different rows spread by content and equal rows by input partition. The ranking is evaluated once, so it does not matter
    # that another evaluation could spread rows in another way.
    spread = df.withColumn("_spread", F.xxhash64(F.spark_partition_id(), *df.columns))
    rows = with_repeated(spread, keys, repeated)
    slices = F.floor((F.col("copies") - 1) / F.lit(ROWS_PER_SLICE)) + 1
    rows = rows.withColumn("_slice", F.pmod("_spread", slices))
    within = F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(*order))
    # The first rows of a key's slices meet in a slice of their own; only the first of them stays.
    rows = rows.withColumn("_meets", F.when(within == 1, F.lit(-1)).otherwise(F.col("_slice")))
    across = F.row_number().over(Window.partitionBy(*keys, "_meets").orderBy(*order))
    ranked = rows.withColumn("_rank", across).filter((F.col("_meets") >= 0) | (F.col("_rank") > 1))
    return ranked.select(*df.columns)
