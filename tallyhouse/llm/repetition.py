"""Quality rules by repetition coverage.

A text is measured by the share of its characters that lie in word n-grams or lines which
occur more than once in it. N-grams are compared by polynomial hashes over word numbers, taken
for all windows of a length at once from one array of prefix sums.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import by_batch, utf8

SYMBOLS = b"#*$%&|<>"
NOT_SYMBOLS = bytes(set(range(256)) - set(SYMBOLS))
HAS_WORD = re.compile(rb"[^\x20\x09-\x0D]")
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, repeat_share array<double>, line_share double"
)


@dataclass(frozen=True)
class Rules:
    """Most of a text's word characters that repeated n-grams of each length, and repeated lines, may cover.

    Both the first occurrence and its repeats are covered, so a text of which an eighth is said twice has a share of a quarter. The
    base rule alone lets half of the words lie in repeated windows of three; these bounds lie well below.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    ngram_shares: tuple[tuple[int, float], ...] = ((4, 0.30), (6, 0.25), (10, 0.15))
    line_share: float = 0.25


class Words:
    """Numbers for words, with their lengths in code points."""

    LIMIT = 1 << 17

    def __init__(self) -> None:
        self.numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.lengths = np.zeros(0, np.int64)

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self.numbers) > self.LIMIT:
            self.__init__()
        known = len(self.numbers)
        ids = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        if len(self.numbers) > known:
            new = list(self.numbers)[known:] if known == 0 else words_after(self.numbers, known)
            if len(self.lengths) < len(self.numbers):
                grown = np.zeros(max(1024, 2 * len(self.numbers)), np.int64)
                grown[: len(self.lengths)] = self.lengths
                self.lengths = grown
            self.lengths[known : len(self.numbers)] = [code_points(w) for w in new]
        return ids


def words_after(numbers: dict[bytes, int], known: int) -> list[bytes]:
    """The words numbered ``known`` and up, in order: the last ones of the dictionary."""
    new = []
    for word in reversed(numbers):
        if numbers[word] < known:
            break
        new.append(word)
    return new[::-1]


def code_points(text: bytes) -> int:
    return len(text) if text.isascii() else len(text.decode("utf-8", "replace"))


def repeated(keys: np.ndarray) -> np.ndarray | None:
    """Which keys occur twice or more; None if none does."""
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    return np.isin(keys, twice) if len(twice) else None


def covered(starts: np.ndarray | None, length: int, n: int) -> np.ndarray:
    """Which of n words lie in a marked window."""
    change = np.zeros(n + 1, np.int32)
    if starts is not None:
        at = np.flatnonzero(starts)
        change[at] += 1
        change[at + length] -= 1
    return np.cumsum(change[:-1]) > 0


def windows_of_three(ids: np.ndarray) -> np.ndarray:
    """A number for each window of three words, equal only for equal windows."""
    pair = np.unique(ids[:-1] * (ids.max() + 1) + ids[1:], return_inverse=True)[1] if ids.max() >= 1 << 21 else None
    if pair is None:
        width = int(ids.max()) + 1
        return (ids[:-2] * width + ids[1:-1]) * width + ids[2:]
    return pair[:-1] * (ids.max() + 1) + ids[2:]


def scatter(ids: np.ndarray) -> np.ndarray:
    """Well mixed 64-bit numbers for small ones."""
    x = ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the hash base and of its inverse, as many as the longest text so far needs."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            size = 2 * n
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(size, BASE, np.uint64)], dtype=np.uint64)
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(size, INVERSE, np.uint64)], dtype=np.uint64)

    def prefix_sums(self, ids: np.ndarray) -> np.ndarray:
        self.reach(len(ids) + 1)
        return np.r_[np.uint64(0), np.cumsum(scatter(ids) * self.up[: len(ids)], dtype=np.uint64)]

    def windows(self, sums: np.ndarray, length: int) -> np.ndarray:
        """The hash of every window of the length, independent of where it stands."""
        raw = sums[length:] - sums[:-length]
        return raw * self.down[: len(raw)]


def repeated_lines(text: bytes) -> tuple[int, float]:
    """How many lines with a word equal an earlier line, and the share of all lines' bytes in lines that occur again."""
    lines = [x for x in text.split(b"\n") if HAS_WORD.search(x)]
    if len(set(lines)) == len(lines):
        return 0, 0.0
    times: defaultdict[bytes, int] = defaultdict(int)
    for line in lines:
        times[line] += 1
    inside = sum(len(x) * n for x, n in times.items() if n > 1)
    return len(lines) - len(times), inside / sum(map(len, lines))


def measure(text: bytes, words: Words, powers: Powers, rules: Rules) -> tuple:
    """All figures of one text, in the order of the schema after doc_id."""
    found = text.split()  # bytes are split at \x20 and \x09-\x0D only
    n = len(found)
    symbols = len(text.translate(None, NOT_SYMBOLS))
    dup_lines, line_share = repeated_lines(text)
    shares = [0.0] * len(rules.ngram_shares)
    repeat_words = chars = 0
    if n:
        ids = words.of(found)
        lengths = words.lengths[ids]
        chars = int(lengths.sum())
        if n >= 3:
            again = repeated(windows_of_three(ids))
            if again is not None:
                repeat_words = int(covered(again, 3, n).sum())
                sums = powers.prefix_sums(ids)
                for i, (length, _) in enumerate(rules.ngram_shares):
                    if n > length:
                        again = repeated(powers.windows(sums, length))
                        if again is None:
                            continue
                        shares[i] = float(lengths[covered(again, length, n)].sum()) / chars
    failed = n < rules.min_words or 100 * repeat_words > rules.max_repeat_percent * n
    good = not failed and line_share <= rules.line_share
    good = good and all(share <= most for share, (_, most) in zip(shares, rules.ngram_shares, strict=True))
    return n, chars, symbols, dup_lines, repeat_words, failed, good, shares, line_share


def judge(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Measure every text of ``docs`` (doc_id, text) and say whether it is kept.

    One row per input row, repeated rows included; other columns are not read. A null or empty
    text has no words and is not kept; a null doc_id stays null. Long texts are measured whole.
    The work needs no shuffle, and one text at a time is held besides the batch.
    """

    def task():
        words, powers = Words(), Powers()
        names = [x.split()[0] for x in SCHEMA.split(", ")][1:]

        def rows(batch: pa.RecordBatch) -> dict:
            figures = [measure(x.as_py(), words, powers, rules) for x in batch.column("utf8")]
            return {"doc_id": batch.column("doc_id")} | dict(zip(names, map(list, zip(*figures)), strict=True))

        return rows

    return by_batch(docs.select(docs["doc_id"].cast("long").alias("doc_id"), utf8().alias("utf8")), task, SCHEMA)


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns; the verdict is taken in one pass, without a join."""

    @F.arrow_udf("boolean")
    def good(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, powers = Words(), Powers()
        for batch in texts:
            yield pa.array([measure(t.as_py(), words, powers, rules)[6] for t in batch], pa.bool_())

    return docs.where(good(utf8()))
