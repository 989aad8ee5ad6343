"""Runs of repeated words in a text, found with a dictionary of basic factors.

A basic factor is a stretch of 2^k words. The dictionary numbers, for every k, the factors that occur more than once, each
level from pairs of names of the one below. Where successive occurrences of a factor, no more than twice its length apart,
form an arithmetic progression, their distance is proposed as a period. The dictionary then tells how far the
period holds to either side, in one step per level; equal proposals fall together.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import by_batch, utf8

#: A run has at least this many words, and this many times its period.
MIN_WORDS, MIN_PERIODS = 6, 4
#: Texts are worked on together until they have this many words; a longer text is worked on alone, and whole.
WORDS_AT_ONCE = 1 << 17

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"


def levels(ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Every level of the dictionary: length, name of the factor at each place (-1 if it occurs once), places that have a
    next occurrence of their factor, and how far on that is."""
    n, size = len(ids), 1
    at, keys = np.arange(n), ids.astype(np.int64)
    while len(at):
        order = np.argsort(keys, kind="stable")  # equal factors together, in order of place
        ranked, places = keys[order], at[order]
        same = ranked[1:] == ranked[:-1]
        names = np.full(n, -1, np.int32)
        numbers = np.cumsum(np.r_[True, ~same], dtype=np.int32)
        again = np.r_[same, False] | np.r_[False, same]
        names[places[again]] = numbers[again]
        yield size, names, places[:-1][same], (places[1:] - places[:-1])[same]
        at = np.flatnonzero(names[: max(0, n - size)] >= 0)
        at = at[names[at + size] >= 0]
        keys = names[at].astype(np.int64) * (n + 1) + names[at + size]
        size *= 2


def proposals(size: int, n: int, places: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and periods of factors whose successive occurrences form an arithmetic progression of three or more."""
    step = np.zeros(n, np.int64)
    step[places] = gaps
    near = (gaps <= 2 * size) & (step[places + gaps] == gaps)
    order = np.argsort(places[near])
    at, period = places[near][order], gaps[near][order]
    if len(at):
        first = np.r_[True, (at[1:] != at[:-1] + 1) | (period[1:] != period[:-1])]
        at, period = at[first], period[first]
    return at, period


def extend(dictionary: list[np.ndarray], at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word (exclusive) of the stretch around each place in which words a period apart are identical."""
    n = len(dictionary[0])
    left, right = at.copy(), at.copy()
    for k in reversed(range(len(dictionary))):
        names, size = dictionary[k], 1 << k
        here = np.flatnonzero(right + period + size <= n)
        x = right[here]
        right[here] += size * ((names[x] >= 0) & (names[x] == names[x + period[here]]))
        here = np.flatnonzero(left >= size)
        x = left[here] - size
        left[here] -= size * ((names[x] >= 0) & (names[x] == names[x + period[here]]))
    return left, right + period


def runs_of(ids: np.ndarray) -> np.ndarray:
    """All runs in a sequence of numbers: rows of start, length and smallest period, in that order."""
    dictionary, found = [], []
    for size, names, places, gaps in levels(ids):
        dictionary.append(names)
        found.append(proposals(size, len(ids), places, gaps))
    at, period = (np.concatenate([x[i] for x in found]) if found else np.zeros(0, np.int64) for i in (0, 1))
    if not len(at):
        return np.zeros((0, 3), np.int64)
    start, end = extend(dictionary, at, period)
    length = end - start
    runs = np.stack([start, length, period], axis=1)[length >= np.maximum(MIN_WORDS, MIN_PERIODS * period)]
    return np.unique(runs, axis=0)[:, [0, 1, 2]]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay when every run keeps its first period only."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def of_texts(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of every text. All texts share one sequence; words of different texts never get the same number."""
    sizes = np.array([len(words) for words in texts])
    ids, used = [], 0
    for words in texts:
        numbers: defaultdict[bytes, int] = defaultdict(count(used).__next__)
        ids.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        used += len(numbers)
    runs = runs_of(np.concatenate(ids)) if used else np.zeros((0, 3), np.int64)
    ends = np.cumsum(sizes)
    whose = np.searchsorted(ends, runs[:, 0], side="right")
    cuts = np.searchsorted(whose, np.arange(len(texts) + 1))
    shift = np.array([1, 0, 0])
    return [runs[a:b] - shift * (ends[i] - sizes[i]) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def find_runs(docs: DataFrame) -> DataFrame:
    """The runs of every text of ``docs`` (doc_id, text), and the text with each run cut to its first period.

    A run is a stretch of at least six words and four periods that no neighbouring word extends, given by the number of its
    first word, its length and its smallest period; ``runs`` has them by start, then period. ``collapsed`` has the words that stay,
    joined by one blank. One row per input row, repeated rows included; other columns are not read. A null
    or empty text has no words; a null doc_id stays null. Long texts are worked on whole, at a cost of n log n.
    """

    def task():
        def rows(batch: pa.RecordBatch) -> dict:
            sizes, runs, collapsed, waiting = [], [], [], []

            def work() -> None:
                for words, found in zip(waiting, of_texts(waiting)):
                    sizes.append(len(words))
                    runs.append([{"start": s, "length": n, "period": p} for s, n, p in found.tolist()])
                    stay = words if not len(found) else [words[i] for i in np.flatnonzero(kept_words(len(words), found))]
                    collapsed.append(b" ".join(stay))
                waiting.clear()

            total = 0
            for text in batch.column("utf8"):
                waiting.append(text.as_py().split())  # bytes are split at \x20 and \x09-\x0D only
                total += len(waiting[-1])
                if total >= WORDS_AT_ONCE:
                    work()
                    total = 0
            work()
            return {"doc_id": batch.column("doc_id"), "n_words": sizes, "runs": runs, "collapsed": collapsed}

        return rows

    return by_batch(docs.select(docs["doc_id"].cast("long").alias("doc_id"), utf8().alias("utf8")), task, SCHEMA)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the end of every tenth text, picked by the checksum of its id, made periodic.

    With h the crc32 of the id in decimal and g = h div 10, of a text of n words all from a = g % n on are replaced by repeats of
    the 1 + (n - a) div (3 + g % 8) words there. Rows without an id, and texts without words, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    planted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.floor(h / 10).alias("g"),
        F.when(h % 10 == 0, words).alias("words"),
    )
    n = F.size("words").cast("long")
    planted = planted.withColumn("a", F.when(n > 0, F.col("g") % n))
    p = 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))
    planted = planted.withColumn("p", p)

    def word(i: Column) -> Column:
        source = F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
        return F.get(F.col("words"), source.cast("int"))

    folded = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), word), " ")
    return planted.select("doc_id", F.when(F.col("p").isNotNull(), folded).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """What ``find_runs`` found, reduced to the number of runs, the longest one, and digests of runs and text."""
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    )
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
