"""Run tracking and run metrics."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.functions import moment
from tallyhouse.schemas import conform
from tallyhouse.sources.manifests import Layer, Manifest, RunEntry
from tallyhouse.sources.warehouse import RUNNING, Warehouse


class RunOvertaken(RuntimeError):
    """Another run published meanwhile what rests on more loads than this one has seen."""


@dataclass
class Run:
    """A run that is going: what it builds on, and what it will be listed with."""

    run_id: str
    started_at: datetime
    base: Manifest
    covers: int = 0
    mode: str = ""
    layers: tuple[Layer, ...] = ()
    counts: dict[str, int] = field(default_factory=dict)
    #: Called with the newest run when that is not the one this run builds on.
    rebase: Callable[[RunEntry], None] | None = None


def new_run_id(now: datetime) -> str:
    return f"RUN_{now:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:6]}"


@contextmanager
def tracked_run(warehouse: Warehouse, window_days: int, started_at: datetime | None = None) -> Iterator[Run]:
    """Record a run as running, then list it as successful, or record it as failed with the error as its note.

    The manifest that lists the run is the commit: it is written last, and the run's outputs count from then on. If it cannot be
    written the run has failed like any other. A run that another one was faster than builds on that one's fact instead
    (``rebase``); if the other has seen loads that this one has not, this one fails.
    """
    started_at = started_at or datetime.now()
    run = Run(new_run_id(started_at), started_at, warehouse.manifests.newest())
    warehouse.record((run.run_id, started_at, None, RUNNING, window_days, None))

    def settle(newest: Manifest) -> None:
        last, known = newest.newest_run(), run.base.newest_run()
        if last is None or (known and last.run_id == known.run_id):
            return
        if last.covers > run.covers:
            raise RunOvertaken(f"{last.run_id} has published {last.covers} loads, this run has seen {run.covers}")
        if run.rebase:
            run.rebase(last)
        run.base = newest

    try:
        with warehouse.pinned(run.run_id, run.base.newest_run()):
            yield run
            ended = datetime.now()
            warehouse.commit_run(
                RunEntry(run.run_id, started_at, ended, window_days, run.covers, run.mode, run.layers, run.counts), settle
            )
    except BaseException as error:
        warehouse.record((run.run_id, started_at, datetime.now(), "failed", window_days, str(error)))
        raise


METRICS = (
    "raw_orders_count",
    "quarantined_orders",
    "clean_orders_count",
    "raw_payments_count",
    "quarantined_payments",
    "clean_payments_count",
)


def metrics_row(spark: SparkSession, window_days: int, run_timestamp: datetime, counts: dict[str, int]) -> DataFrame:
    """The metrics of a run from counts taken while its tables were written."""
    row = spark.range(1).select(
        moment(run_timestamp).alias("run_timestamp"),
        F.lit(window_days).alias("window_days"),
        *[F.lit(counts[name]).cast("long").alias(name) for name in METRICS],
    )
    return conform(row, schemas.PIPELINE_METRICS)


def run_metrics(
    window_days: int,
    run_timestamp: datetime,
    raw_orders: DataFrame,
    quarantined_orders: DataFrame,
    clean_orders: DataFrame,
    raw_payments: DataFrame,
    quarantined_payments: DataFrame,
    clean_payments: DataFrame,
) -> DataFrame:
    """One row with the six row counts of a run."""
    tables = (raw_orders, quarantined_orders, clean_orders, raw_payments, quarantined_payments, clean_payments)
    counted = dict(zip(METRICS, tables))
    # All tables are counted in one pass each and one small shuffle together.
    rows = reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("name")) for name, df in counted.items()])
    total = rows.agg(*[F.count_if(F.col("name") == name).alias(name) for name in counted])
    row = total.select(moment(run_timestamp).alias("run_timestamp"), F.lit(window_days).alias("window_days"), *counted)
    return conform(row, schemas.PIPELINE_METRICS)
