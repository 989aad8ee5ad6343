"""Numbered manifests: which loads and runs of a warehouse count, and what they wrote.

A commit writes the next number, by a rename that fails if the number is there. Who comes second reads
the newest manifest, settles with what was committed meanwhile, and tries the number after it. The file system's rename has to be
all or nothing, as it is on HDFS; an object store needs a committer or file system that gives this.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tallyhouse.session import file_system

# The smallest and the greatest value of a text column, shorter values first; None if there is none.
Range = tuple[str, str] | None


def place(value: str) -> tuple[int, str]:
    """What ranges are ordered by."""
    return len(value), value


def overlap(a: Range, b: Range) -> bool:
    """Whether two ranges can share a value."""
    if a is None or b is None:
        return False
    return place(a[0]) <= place(b[1]) and place(b[0]) <= place(a[1])


@dataclass(frozen=True)
class Part:
    """What a load wrote to one table: its folder, its rows, and range and NULLs of every id column."""

    folder: str
    rows: int
    ranges: dict[str, Range] = field(default_factory=dict)
    nulls: dict[str, int] = field(default_factory=dict)

    def may_hold(self, column: str, wanted: Range, with_nulls: bool = False) -> bool:
        """Whether a value of the range, or with ``with_nulls`` a NULL, can be in the column."""
        return overlap(self.ranges.get(column), wanted) or (with_nulls and self.nulls.get(column, 0) > 0)


@dataclass(frozen=True)
class LoadEntry:
    load_id: str
    parts: dict[str, Part]


@dataclass(frozen=True)
class Layer:
    """What a run added to the tables kept up by deltas; ``touched`` counts the older keys it decided anew."""

    run_id: str
    touched: dict[str, int]


@dataclass(frozen=True)
class RunEntry:
    """A successful run. ``covers`` is the number of loads it has seen, in the order of the manifest."""

    run_id: str
    started_at: datetime
    finished_at: datetime
    window_days: int
    covers: int = 0
    mode: str = ""
    layers: tuple[Layer, ...] = ()
    counts: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class Manifest:
    number: int = 0
    loads: tuple[LoadEntry, ...] = ()
    runs: tuple[RunEntry, ...] = ()

    def newest_run(self) -> RunEntry | None:
        return self.runs[-1] if self.runs else None

    def parts(self, table: str, loads: Sequence[LoadEntry] | None = None) -> list[Part]:
        return [load.parts[table] for load in (self.loads if loads is None else loads) if table in load.parts]

    def with_load(self, load: LoadEntry) -> Manifest:
        return replace(self, loads=(*self.loads, load))

    def with_run(self, run: RunEntry) -> Manifest:
        return replace(self, runs=(*self.runs, run))

    def text(self) -> str:
        return json.dumps(asdict(self), default=datetime.isoformat)

    @staticmethod
    def of(text: str) -> Manifest:
        found = json.loads(text)

        def part(p: dict) -> Part:
            ranges = {c: tuple(r) if r else None for c, r in p["ranges"].items()}
            return Part(p["folder"], p["rows"], ranges, p["nulls"])

        def run(r: dict) -> RunEntry:
            moments = {k: datetime.fromisoformat(r[k]) for k in ("started_at", "finished_at")}
            return RunEntry(**(r | moments | {"layers": tuple(Layer(**x) for x in r["layers"])}))

        loads = tuple(LoadEntry(x["load_id"], {t: part(p) for t, p in x["parts"].items()}) for x in found["loads"])
        return Manifest(found["number"], loads, tuple(run(r) for r in found["runs"]))


class Manifests:
    """The manifests in one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, number: int) -> str:
        return f"{self.folder}/{number:012d}.json"

    def _text(self, number: int) -> str | None:
        files, path = file_system(self.spark, self._path(number))
        if not files.exists(path):
            return None
        stream = files.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def numbers(self) -> list[int]:
        files, folder = file_system(self.spark, self.folder)
        names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))

    def newest(self) -> Manifest:
        """The manifest that counts; an empty one if nothing was committed yet."""
        numbers = self.numbers()
        return Manifest.of(self._text(numbers[-1])) if numbers else Manifest()

    def put(self, manifest: Manifest) -> bool:
        """Write a manifest under its number, whole; False if the number is taken."""
        text, target = manifest.text(), self._path(manifest.number)
        files, draft = file_system(self.spark, f"{self.folder}/.{uuid.uuid4().hex}")
        if files.getScheme() == "file":
            return self._link(draft.toUri().getPath(), target, text)
        out = files.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            self._rename(draft, target)
        except Py4JJavaError:
            found = self._text(manifest.number)
            if found is None:
                raise
            return found == text  # an error after the rename went through leaves the commit as it is
        finally:
            files.delete(draft, False)
        return True

    def _rename(self, draft, target: str) -> None:
        """Rename, unless the target is there."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        no_overwrite = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        context = hadoop.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(draft, hadoop.Path(target), no_overwrite)

    def _link(self, draft: str, target: str, text: str) -> bool:
        """The same on a mounted disk, where a rename would overwrite and a hard link does not."""
        target = self.spark._jvm.org.apache.hadoop.fs.Path(target).toUri().getPath()
        os.makedirs(os.path.dirname(target), exist_ok=True)
        with open(draft, "w", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(draft, target)
        except FileExistsError:
            return False
        finally:
            os.remove(draft)
        return True

    def commit(self, change: Callable[[Manifest], Manifest]) -> Manifest:
        """Commit what ``change`` makes of the newest manifest; it is asked again when another commit came first."""
        while True:
            newest = self.newest()
            after = replace(change(newest), number=newest.number + 1)
            if self.put(after):
                return after

    def trim(self, keep: int) -> None:
        """Delete all but the newest manifests."""
        for number in self.numbers()[:-keep]:
            files, path = file_system(self.spark, self._path(number))
            files.delete(path, False)
