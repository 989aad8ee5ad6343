"""Near duplicates by SimHash fingerprints and multi-index hashing.

Fingerprints are cut into segments. By the pigeonhole principle two fingerprints at most ``bits`` apart are
close in some segment, so every fingerprint looks up a small Hamming ball around each of its segments in
a table of segments, and the whole distance of what it finds is verified. Equal fingerprints
are one entry. A segment shared by very many entries would make all their pairs candidates; there the
entries look up the ball around their whole fingerprint instead, which finds true links only.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import by_batch, kept, utf8

SEED = 42
#: Entries of one segment beyond which balls of whole fingerprints are looked up.
CROWD = 512
MOST_BITS = 3


def fingerprint(text: bytes, width: int) -> int:
    words = text.lower().split()  # bytes: A-Z only, and \x20, \x09-\x0D only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        digest = xxhash.xxh64_intdigest
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.r_[0, ends[:-width] + 1].tolist()
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)], np.uint64)
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, width: int, also: Sequence[str] = ()) -> DataFrame:
    """doc_id and the 64-bit fingerprint of every text, as a signed long; a text without words has 0. ``also`` names further
    columns of longs to hand on."""

    def task():
        def rows(batch: pa.RecordBatch) -> dict:
            found = [fingerprint(x.as_py(), width) for x in batch.column("utf8")]
            return {"doc_id": batch.column("doc_id"), "fp": found} | {name: batch.column(name) for name in also}

        return rows

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("utf8"), *also)
    return by_batch(columns, task, ", ".join(["doc_id long", "fp long", *[f"{name} long" for name in also]]))


def ball(width: int, radius: int) -> list[int]:
    """The masks that flip at most ``radius`` of the low ``width`` bits."""
    return [sum(1 << b for b in flips) for r in range(radius + 1) for flips in combinations(range(width), r)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def segments(bits: int) -> list[tuple[int, int, int]]:
    """Place, width and search radius of each segment.

    With m segments, fingerprints at most ``bits`` apart are at most bits // m apart in one of the first
    bits % m + 1 segments, or one less in one of the others.
    """
    m = max(2, bits // 2 + 1)
    edges = [64 * i // m for i in range(m + 1)]
    radii = [bits // m - (i > bits % m) for i in range(m)]
    return [(a, b - a, r) for a, b, r in zip(edges, edges[1:], radii) if r >= 0]


def links(entries: DataFrame, bits: int, crowd: int = CROWD) -> DataFrame:
    """All pairs a < b of the distinct fingerprints ``entries`` (fp) that differ in at most ``bits`` bits."""
    if not 0 <= bits <= MOST_BITS:
        raise ValueError(f"bits must be 0 to {MOST_BITS}")
    if bits == 0:
        return entries.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    parts = segments(bits)

    def key(number: int, place: int, width: int):
        return F.shiftrightunsigned("fp", place).bitwiseAND((1 << width) - 1) * len(parts) + number

    table = entries.select("fp", F.explode(F.array(*[key(i, p, w) for i, (p, w, _) in enumerate(parts)])).alias("key"))
    looked = F.array(
        *[
            F.shiftrightunsigned("fp", p).bitwiseAND((1 << w) - 1).bitwiseXOR(F.lit(mask)) * len(parts) + i
            for i, (p, w, r) in enumerate(parts)
            for mask in ball(w, r)
        ]
    )
    probes = entries.select("fp", F.explode(looked).alias("key"))
    crowded = kept(table.groupBy("key").count().where(F.col("count") > crowd).select("key"), "crowded")

    left, right = probes.alias("p"), table.join(crowded, "key", "left_anti").alias("t")
    near = left.join(
        right,
        (F.col("p.key") == F.col("t.key"))
        & (F.col("p.fp") < F.col("t.fp"))
        & (F.bit_count(F.col("p.fp").bitwiseXOR(F.col("t.fp"))) <= bits),
    ).select(F.col("p.fp").alias("a"), F.col("t.fp").alias("b"))

    seekers = probes.join(crowded, "key", "left_semi").select("fp").distinct()
    masks = F.array(*[F.lit(signed(mask)) for mask in ball(64, bits)[1:]])
    above = F.filter(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m)), lambda x: x > F.col("fp"))
    sought = seekers.select(F.col("fp").alias("a"), F.explode(above).alias("b"))
    around = sought.join(entries.select(F.col("fp").alias("b")), "b").select("a", "b")
    return near.unionByName(around).distinct()


def roots(pairs: DataFrame) -> DataFrame:
    """For every node of the graph ``pairs`` (a, b) the smallest node it is connected with: node, root.

    Stars are grown and shrunk in turn, each round a few joins, until nothing changes.
    """

    def both(edges: DataFrame) -> DataFrame:
        return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def large(edges: DataFrame) -> DataFrame:
        around = both(edges)
        least = around.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        return around.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()

    def small(edges: DataFrame) -> DataFrame:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()

    def state(edges: DataFrame):
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    edges = kept(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")), "links")
    before = state(edges)
    while before[0]:
        edges = kept(small(large(edges)), "stars")
        now = state(edges)
        if now == before:
            break
        before = now
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(centres)


def near_groups(docs: DataFrame, width: int, bits: int) -> DataFrame:
    """doc_id, fp and component_id of every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that can be reached over fingerprints at most ``bits`` apart. Null and
    empty texts share fingerprint 0. A null doc_id names no component; where a component has no other, its
    component_id is null. Repeated rows are kept. Other columns are not read. An empty table gives no rows.
    """
    found, labels = labelled(docs, width, bits)
    return found.join(labels, "fp").select("doc_id", "fp", "component_id")


def labelled(docs: DataFrame, width: int, bits: int, also: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """The fingerprint of every row, and of every fingerprint its component: by one of its fingerprints, and by its smallest doc_id."""
    found = kept(fingerprints(docs, width, also), "fingerprints")
    entries = kept(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "entries")
    rooted = kept(roots(links(entries.select("fp"), bits)), "roots")
    named = rooted.join(entries.withColumnRenamed("fp", "node"), "node").groupBy("root").agg(F.min("least").alias("component"))
    grouped = rooted.join(named, "root").select(F.col("node").alias("fp"), "root", "component")
    # Written, so that both sides of the last join come straight from a shuffle, where Spark splits a hot fingerprint.
    component = F.coalesce("component", "least").alias("component_id")
    labels = entries.join(grouped, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), component)
    return found, kept(labels, "labels")


def digests(groups: DataFrame) -> DataFrame:
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, width: int, bits: int) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one of the smallest doc_id, a missing one last, then by its place.

    A row is known by its place, the file and row it is read from, so rows that share a doc_id, or have none, are told apart:
    of each group exactly one row stays, whatever the ids, and rows of other groups are not looked at. A table that does not come
    from files is written first. Only the places of rows that go are joined with the texts.
    """
    place = [F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    names = docs.columns
    try:
        placed = docs.select("*", *place)
    except AnalysisException:
        placed = kept(docs, "texts").select("*", *place)
    found, labels = labelled(placed, width, bits, ["_file", "_row"])
    grouped = found.join(labels.select("fp", "root"), "fp")
    first = grouped.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "_file", "_row")).alias("first"))
    stays = (F.col("_file") == F.col("first._file")) & (F.col("_row") == F.col("first._row"))
    goes = kept(grouped.join(first, "root").where(~stays).select("_file", "_row"), "going")
    return placed.join(goes, ["_file", "_row"], "left_anti").select(*names)
