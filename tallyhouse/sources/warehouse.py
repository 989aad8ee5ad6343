"""Warehouse tables as Parquet folders: raw, staging and analytics layers.

Nothing is changed in place. A load writes its rows to ``<table>/load_id=<load>`` and a run its outputs to
``<layer>/<table>/run_id=<run>``; they count only once a numbered manifest lists the load, or the run, and that is one small
file, written last. Loads and runs may overlap: who commits second settles with the first. Raw tables are the rows of all loads
listed. Dimensions are read from the newest run, logs from all of them, quarantine and clean tables from the layers that
the newest run lists. The fact is partitioned by run and day: a run writes the days it changes, and a list of all days with
the run that wrote each and totals of the day, so that the newest run's list is the fact.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Collection, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse import schemas
from tallyhouse.functions import moment
from tallyhouse.operators.keys import first_per_key
from tallyhouse.operators.trends import paid_value
from tallyhouse.schemas import conform
from tallyhouse.session import file_system, remove
from tallyhouse.sources.manifests import Layer, LoadEntry, Manifest, Manifests, Part, Range, RunEntry

SUCCESS, RUNNING = "success", "running"
FACT, FACT_DAYS = "analytics.fact_orders", "analytics.fact_days"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
# Tables every run writes anew, so that older copies can go.
REBUILT = (
    "analytics.dim_customer",
    "analytics.dim_product",
    "analytics.dim_date",
    "work.order_days",
    "work.window_orders",
    "work.fact_window",
    FACT_DAYS,
)
# Tables a run adds a layer to, with the key by which later layers replace rows of earlier ones.
LAYERED = {
    "raw.quarantine_orders": "order_id",
    "raw.quarantine_payments": "payment_id",
    "staging.orders_clean": "order_id",
    "staging.payments_clean": "payment_id",
}
# Keys of older rows that a layer decides anew.
TOUCHED = {"order_id": "work.touched_orders", "payment_id": "work.touched_payments"}
# What a run needs while it lasts.
WORK = ("work.repeated_orders", "work.old_orders", "work.old_payments", "work.payment_ids")
# Tables that gain rows with every successful run; what a failed run wrote can go.
LOGS = ("analytics.pipeline_metrics", "analytics.revenue_anomaly_log")
# A run that has not ended after so many seconds is taken for lost.
LOST_AFTER = 3 * 24 * 3600


class FactDay(NamedTuple):
    """A day of the fact, None for rows without one: the run whose folder has it, and totals that can be added up."""

    order_day: date | None
    version: str
    orders: int
    revenue: Decimal | None
    paid: Decimal | None
    lowest: str | None
    highest: str | None
    statuses: dict[str, int]

    @property
    def keys(self) -> Range:
        return None if self.lowest is None else (self.lowest, self.highest)


def by_length(column: str):
    """A text as it is ordered in key ranges: numbers of one prefix then stand in their own order."""
    return F.struct(F.length(column).alias("size"), F.col(column).alias("value"))


def id_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if f.name.endswith("_id") and f.name not in schemas.LINEAGE and f.dataType == schemas.STRING]


def written(df: DataFrame, path: str, ids: Sequence[str] = ()) -> Part:
    """Write ``df`` and tell its rows, and range and NULLs of id columns, as they were counted on the way."""
    seen = Observation()
    counted = [F.count(F.lit(1)).alias("rows")]
    for c in ids:
        counted += [F.min(F.when(F.col(c).isNotNull(), by_length(c))).alias(f"low_{c}")]
        counted += [F.max(F.when(F.col(c).isNotNull(), by_length(c))).alias(f"high_{c}")]
        counted += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}")]
    df.observe(seen, *counted).write.mode("overwrite").parquet(path)
    found = seen.get
    ranges = {c: (found[f"low_{c}"]["value"], found[f"high_{c}"]["value"]) if found[f"low_{c}"] else None for c in ids}
    return Part(path.rsplit("/", 1)[-1], found["rows"], ranges, {c: found[f"nulls_{c}"] for c in ids})


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.manifests = Manifests(spark, f"{self.root}/_manifests")

    def path(self, table: str, run_id: str | None = None) -> str:
        """Folder of ``layer.table``."""
        folder = f"{self.root}/{table.replace('.', '/')}"
        return folder if run_id is None else f"{folder}/run_id={run_id}"

    def exists(self, path: str) -> bool:
        files, target = file_system(self.spark, path)
        return files.exists(target)

    def _folders(self, path: str) -> list[str]:
        """Names of the folders in ``path``."""
        files, target = file_system(self.spark, path)
        return [s.getPath().getName() for s in files.listStatus(target) if s.isDirectory()] if files.exists(target) else []

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        if not self.exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    # --- raw tables -------------------------------------------------------------------

    def loads(self) -> list[str]:
        """The loads done."""
        return [load.load_id for load in self.manifests.newest().loads]

    def read(self, table: str, schema: T.StructType, loads: Sequence[LoadEntry] | None = None) -> DataFrame:
        """A raw table: the rows of all loads done, or of those given."""
        return self.read_parts(table, schema, Manifest().parts(table, self.manifests.newest().loads if loads is None else loads))

    def read_parts(self, table: str, schema: T.StructType, parts: Sequence[Part]) -> DataFrame:
        """The rows of some parts of a raw table; no other folder is looked at."""
        folders = [f"{self.path(table)}/{part.folder}" for part in parts if part.rows]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return conform(self.spark.read.schema(schema).parquet(*folders), schema)

    def read_holding(
        self, table: str, schema: T.StructType, loads: Sequence[LoadEntry], column: str, wanted: Range, with_nulls: bool = False
    ) -> DataFrame:
        """The rows of those loads that may hold a value of the range, or a NULL, in a column; other loads are not opened."""
        parts = [part for part in Manifest().parts(table, loads) if part.may_hold(column, wanted, with_nulls)]
        return self.read_parts(table, schema, parts)

    @contextmanager
    def load(self, run_id: str | None = None) -> Iterator[Load]:
        """A load of one or more raw tables; they grow together when the block ends well, else not at all."""
        load = Load(self, f"LOAD_{uuid.uuid4().hex}", run_id)
        try:
            yield load
            if any(part.rows for part in load.parts.values()):
                self.manifests.commit(load.settled)
            else:
                load.undo()
        except BaseException:
            load.undo()
            raise

    def append(self, df: DataFrame, table: str) -> None:
        """Add rows to one raw table."""
        with self.load() as load:
            load.append(df, table)

    # --- the fact ---------------------------------------------------------------------

    def fact_days(self, run: RunEntry | None = None) -> list[FactDay]:
        """The days of the fact as the newest run, or a given one, left it: at most one row per calendar day."""
        run = run or self.manifests.newest().newest_run()
        return [FactDay(*row) for row in self._read(self.path(FACT_DAYS, run.run_id), schemas.FACT_DAYS).collect()] if run else []

    def write_fact_days(self, rows: DataFrame, run_id: str) -> list[FactDay]:
        """Write the new rows of some days to the run's folder, and return the days that got rows with their totals."""
        path = self.path(FACT, run_id)
        # Rebalancing splits a day with very many rows and joins small ones, so files get an even size.
        rows.hint("rebalance", F.col("order_day")).write.mode("overwrite").partitionBy("order_day").parquet(path)
        names = [name for name in self._folders(path) if name.startswith("order_day=")]
        if not names:
            return []
        written_rows = self.spark.read.schema(schemas.FACT_ORDERS).option("basePath", path).parquet(*[f"{path}/{n}" for n in names])
        return [FactDay(**(row.asDict() | {"version": run_id})) for row in day_totals(written_rows).collect()]

    def fact_of(self, days: Sequence[FactDay]) -> DataFrame:
        """The fact made of these days; no other folder is looked at, and days are pruned as partitions."""
        if not days:
            return self.spark.createDataFrame([], schemas.FACT_ORDERS)
        names = [(d.version, d.order_day.isoformat() if d.order_day else NO_DAY) for d in days]
        folders = [f"{self.path(FACT, run_id)}/order_day={day}" for run_id, day in names]
        rows = self.spark.read.schema(schemas.FACT_ORDERS).option("basePath", self.path(FACT)).parquet(*folders)
        return rows.select(*schemas.FACT_ORDERS.fieldNames())

    def fact(self) -> DataFrame:
        return self.fact_of(self.fact_days())

    def fact_totals(self) -> DataFrame:
        """Totals of every day of the fact, without reading it."""
        return self.newest(FACT_DAYS, schemas.FACT_DAYS).drop("version", "lowest", "highest")

    def write_days_list(self, days: Sequence[FactDay], run_id: str) -> None:
        """Say which run wrote each day of the fact; counts once the run is a success."""
        listed = self.spark.createDataFrame(list(days), schemas.FACT_DAYS)
        listed.coalesce(1).write.mode("overwrite").parquet(self.path(FACT_DAYS, run_id))

    # --- outputs of one run -----------------------------------------------------------

    def write_run(self, df: DataFrame, table: str, run_id: str) -> DataFrame:
        """Write a run's copy of a table and read it back, with its size now known to Spark."""
        df.write.mode("overwrite").parquet(self.path(table, run_id))
        return self.spark.read.schema(df.schema).parquet(self.path(table, run_id))

    def write_counted(self, df: DataFrame, table: str, run_id: str, ids: Sequence[str] = ()) -> tuple[DataFrame, Part]:
        """``write_run``, and what was counted on the way."""
        part = written(df, self.path(table, run_id), ids)
        return self.spark.read.schema(df.schema).parquet(self.path(table, run_id)), part

    def runs(self) -> DataFrame:
        """The last recorded state of every run; for a run that a manifest lists, that is success."""
        states = self._states()
        done = [(r.run_id, r.started_at, r.finished_at, SUCCESS, r.window_days, None) for r in self.manifests.newest().runs]
        done = self.spark.createDataFrame(done, schemas.PIPELINE_RUNS)
        others = first_per_key(states.join(done, "run_id", "left_anti"), ["run_id"], ["finished_at"])
        return others.select(*schemas.PIPELINE_RUNS.fieldNames()).unionByName(done)

    def record(self, row: tuple) -> None:
        """Add a state to those of the runs, in a folder of its own, as appends to one folder at once disturb each other."""
        state = self.spark.createDataFrame([row], schemas.PIPELINE_RUNS)
        state.coalesce(1).write.parquet(f"{self.path('analytics.pipeline_runs')}/{uuid.uuid4().hex}")

    def _states(self) -> DataFrame:
        path = self.path("analytics.pipeline_runs")
        if not self._folders(path):
            return self.spark.createDataFrame([], schemas.PIPELINE_RUNS)
        return self.spark.read.schema(schemas.PIPELINE_RUNS).parquet(f"{path}/*")

    def commit_run(self, run: RunEntry, settle: Callable[[Manifest], None] = lambda newest: None) -> None:
        """List a run as successful. ``settle`` is shown what was committed first, and may raise."""

        def change(newest: Manifest) -> Manifest:
            settle(newest)
            return newest.with_run(run)

        self.manifests.commit(change)

    @contextmanager
    def pinned(self, run_id: str, base: RunEntry | None) -> Iterator[None]:
        """Keep clean-ups of other runs from deleting what this run writes, and the run it builds on, while the block lasts."""
        files, pin = file_system(self.spark, f"{self.root}/_pins/{run_id}@{base.run_id if base else ''}")
        files.create(pin, True).close()
        try:
            yield
        finally:
            files.delete(pin, False)

    def _pins(self) -> set[str]:
        """Runs that are going, and those they build on."""
        files, folder = file_system(self.spark, f"{self.root}/_pins")
        if not files.exists(folder):
            return set()
        fresh = 1000 * (time.time() - LOST_AFTER)
        names = [s.getPath().getName() for s in files.listStatus(folder) if s.getModificationTime() >= fresh]
        return {run_id for name in names for run_id in name.split("@") if run_id}

    def drop_old_runs(self, keep: int) -> None:
        """Delete what is not needed to read the newest ``keep`` successful runs, nor by runs that are going.

        Logs stay, but for failed runs' rows. A run that has not ended within ``LOST_AFTER`` counts as failed.
        """
        if keep < 1:
            raise ValueError("the newest successful run must stay")
        manifest, pins = self.manifests.newest(), self._pins()
        done = [run.run_id for run in manifest.runs]
        kept = [run for run in manifest.runs if run.run_id in done[-keep:] or run.run_id in pins]
        alone = {run.run_id for run in kept} | pins
        layers = {layer.run_id for run in kept for layer in run.layers} | pins
        self._drop({table: alone for table in (*REBUILT, *WORK)})
        self._drop({table: layers for table in (*LAYERED, *TOUCHED.values())})
        self._drop({table: set(done) | pins for table in LOGS})
        needed: dict[str, set[str]] = {}
        for run in kept:
            for day in self.fact_days(run):
                needed.setdefault(day.version, set()).add(day.order_day.isoformat() if day.order_day else NO_DAY)
        self._drop({FACT: set(needed) | pins})
        for run_id, days in needed.items():
            if run_id in pins and run_id not in done:
                continue
            for name in self._folders(self.path(FACT, run_id)):
                if name.startswith("order_day=") and name.partition("=")[2] not in days:
                    remove(self.spark, f"{self.path(FACT, run_id)}/{name}")
        self.manifests.trim(keep=100)

    def _drop(self, kept: dict[str, Collection[str]]) -> None:
        """Delete all runs' folders of each table but those to keep."""
        for table, run_ids in kept.items():
            for name in self._folders(self.path(table)):
                if name.startswith("run_id=") and name.partition("=")[2] not in run_ids:
                    remove(self.spark, f"{self.path(table)}/{name}")

    def layered(self, table: str, layers: Sequence[Layer], schema: T.StructType) -> DataFrame:
        """A table kept up by deltas: rows of its layers, but for older rows whose key a later layer has touched.

        Layers that touch nothing, as those of loads with new keys only, are read together in one scan.
        """
        key = LAYERED[table]
        found, paths = self.spark.createDataFrame([], schema), []

        def so_far() -> DataFrame:
            return found.unionByName(self.spark.read.schema(schema).parquet(*paths)) if paths else found

        for layer in layers:
            if layer.touched.get(key):
                gone = self.spark.read.parquet(self.path(TOUCHED[key], layer.run_id)).withColumnRenamed(key, "_gone")
                found, paths = so_far().join(gone, F.col(key).eqNullSafe(F.col("_gone")), "left_anti"), []
            paths.append(self.path(table, layer.run_id))
        return so_far()

    def newest(self, table: str, schema: T.StructType, run: RunEntry | None = None) -> DataFrame:
        """A table as the newest run, or a given one, left it. Quarantined rows bear the moment of that run."""
        run = run or self.manifests.newest().newest_run()
        if run is None:
            return self.spark.createDataFrame([], schema)
        if table not in LAYERED:
            return conform(self._read(self.path(table, run.run_id), schema), schema)
        stored = T.StructType([f for f in schema.fields if f.name != "quarantined_at"])
        return conform(self.layered(table, run.layers, stored).withColumn("quarantined_at", moment(run.started_at)), schema)

    def log(self, table: str, schema: T.StructType) -> DataFrame:
        """A log table: the rows of all successful runs."""
        done = self.spark.createDataFrame([(run.run_id,) for run in self.manifests.newest().runs], "run_id string")
        with_run = T.StructType([f for f in schema.fields if f.name != "run_id"] + [schemas.PIPELINE_RUNS["run_id"]])
        rows = self._read(self.path(table), with_run)
        return conform(rows.join(done, "run_id", "left_semi"), schema)


def day_totals(fact: DataFrame) -> DataFrame:
    """Totals of every day of a fact, which add up over days, and the range of its keys."""
    lowest, highest = F.min(by_length("order_id")).alias("lowest"), F.max(by_length("order_id")).alias("highest")
    sums = [F.sum("order_total").alias("revenue"), F.sum(paid_value()).alias("paid")]
    status = F.coalesce("payment_status", F.lit("unknown")).alias("status")
    by_status = fact.groupBy("order_day", status).agg(F.count("*").alias("orders"), *sums, lowest, highest)
    return by_status.groupBy("order_day").agg(
        F.sum("orders").alias("orders"),
        *[F.sum(c).cast("decimal(20,2)").alias(c) for c in ("revenue", "paid")],
        F.min("lowest")["value"].alias("lowest"),
        F.max("highest")["value"].alias("highest"),
        F.map_from_entries(F.collect_list(F.struct("status", "orders"))).alias("statuses"),
    )


class Load:
    """Rows on their way into raw tables. ``run_id`` names the load in their lineage."""

    def __init__(self, warehouse: Warehouse, load_id: str, run_id: str | None):
        self.warehouse, self.load_id, self.run_id = warehouse, load_id, run_id or load_id
        self.base = warehouse.manifests.newest()
        self.parts: dict[str, Part] = {}
        self._keys: dict[str, tuple[str, T.StructType]] = {}
        self._seeds: set[str] = set()
        self._folders: list[str] = []

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        """A raw table as it was when the load began."""
        return self.warehouse.read(table, schema, self.base.loads)

    def append(self, df: DataFrame, table: str, key: str | None = None, seed: bool = False) -> Part:
        """Write rows of the load to a table.

        With ``key`` they are rows whose key the table did not have; with ``seed`` rows for an empty table. That is looked at
        again when another load was committed meanwhile.
        """
        if key:
            self._keys[table] = (key, df.schema)
        if seed:
            self._seeds.add(table)
        self.parts[table] = self._write(df, table, f"load_id={self.load_id}")
        return self.parts[table]

    def _write(self, df: DataFrame, table: str, name: str) -> Part:
        folder = f"{self.warehouse.path(table)}/{name}"
        self._folders.append(folder)
        return written(df, folder, id_columns(df.schema))

    def settled(self, newest: Manifest) -> Manifest:
        """The newest manifest with this load, less what loads committed since it began have already brought."""
        known = {load.load_id for load in self.base.loads}
        others = [load for load in newest.loads if load.load_id not in known]
        for table in self._seeds:
            if any(part.rows for part in newest.parts(table, others)):
                self.parts.pop(table, None)
        for table, (key, schema) in self._keys.items():
            mine = self.parts[table]
            theirs = [p for p in newest.parts(table, others) if p.rows and p.may_hold(key, mine.ranges[key])]
            if mine.rows and theirs:
                rows = self.warehouse.read_parts(table, schema, [mine])
                taken = self.warehouse.read_parts(table, schema, theirs).select(key)
                name = f"load_id={self.load_id}_{uuid.uuid4().hex[:6]}"
                self.parts[table] = self._write(rows.join(taken, key, "left_anti").select(*rows.columns), table, name)
        self.base = newest
        return newest.with_load(LoadEntry(self.load_id, dict(self.parts)))

    def undo(self) -> None:
        """Delete what was written, unless the load counts in spite of an error after its commit."""
        if self.load_id not in self.warehouse.loads():
            for folder in self._folders:
                remove(self.warehouse.spark, folder)
