"""Alignment of two tokenizers' tokens by galloping intersection of their byte ends.

Both tokenizers cut the same bytes. The offsets where tokens of both end are found by letting the shorter list of ends drive
an exponential search, then a binary one, into the longer. The common ends slice both sequences into groups, and the
difference of their ranks in either list gives the range of tokens in each group.

A table for the whole corpus then says how often each pair of ids was linked. Texts are put into blocks of bounded size, each with
a list of its distinct links; the lists are counted and judged in Spark and come back to the texts of their block.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyhouse.llm.common import by_batch, kept, to_arrow
from tallyhouse.llm.pieces import Encoder, listed

#: How the byte-level tokenizer cuts a text before merging, a fixed value of its kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts are aligned together until they have this many bytes.
BYTES_AT_ONCE = 1 << 21
#: A block of texts is closed at this many links, or this many texts.
BLOCK_LINKS, BLOCK_TEXTS = 500_000, 20_000
#: Strings that are put together at once; each byte of theirs takes 17 bytes meanwhile.
JOINED_AT_ONCE = 200_000
#: Elements of the shorter list that start from one place found before.
STRIDE = 32
#: An id of the second tokenizer takes the lower bits of a pair.
ID_BITS = 20

ROW = "doc_id long, block long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links array<int>"
LISTS = "pairs array<long>, times array<int>"
COUNTED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, then the rest from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Strings:
    """Byte strings by number, one after another in one array."""

    def __init__(self, strings: list[bytes]):
        self.sizes = np.array([len(x) for x in strings], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(strings), np.uint8)

    @classmethod
    def of(cls, tokens: dict[int, bytes]) -> Strings:
        return cls([tokens.get(i, b"") for i in range(max(tokens) + 1)])

    def joined(self, numbers: np.ndarray) -> bytes:
        """The strings of these numbers in a row."""
        parts = []
        for start in range(0, len(numbers), JOINED_AT_ONCE):
            mine = numbers[start : start + JOINED_AT_ONCE]
            sizes = self.sizes[mine]
            at = np.repeat(self.starts[mine] - (np.cumsum(sizes) - sizes), sizes)
            at += np.arange(len(at))
            parts.append(self.letters[at].tobytes())
        return b"".join(parts)


class ByteLevel:
    """Ids and bytes of a byte-level BPE tokenizer given as JSON.

    Where ids follow the order of merges, the rank-based library gives the same ids faster; else, and for texts it refuses,
    the library of the file itself is asked.
    """

    def __init__(self, spec: bytes, pattern: str = PATTERN):
        self.spec = spec
        model = json.loads(spec)["model"]
        letters = byte_letters()
        self.bytes = {i: bytes(letters[c] for c in piece) for piece, i in model["vocab"].items()}
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        single = len(model["vocab"]) - len(merged)
        ranked = all(model["vocab"][piece] == single + i for i, piece in enumerate(merged))
        ranks = {token: i for i, token in self.bytes.items()}
        # A special token that is never allowed: without one, the library looks for the empty one at every place of a text.
        special = {"<|endoftext|>": max(self.bytes) + 1}
        self.fast = tiktoken.Encoding("byte_level", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special) if ranked else None

    @cached_property
    def slow(self) -> Tokenizer:
        made = Tokenizer.from_str(self.spec.decode())
        made.encode_special_tokens = True
        return made

    def ids(self, text: str) -> np.ndarray:
        if self.fast:
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
            except BaseException as refused:  # the pattern's engine gives up on some very long runs with a panic
                if isinstance(refused, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return np.array(self.slow.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)

    def encode(self, text: str) -> list[int]:
        return self.ids(text).tolist()


class Pieces:
    """Ids and bytes of a SentencePiece model."""

    def __init__(self, model: bytes):
        self.encoder = Encoder(model, eos=False)
        sp = self.encoder.sp
        self.bytes = {i: self.as_bytes(piece) for i, piece in enumerate(sp.id_to_piece(list(range(sp.get_piece_size()))))}

    @staticmethod
    def as_bytes(piece: str) -> bytes:
        byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    def all(self, texts: list[str]) -> list[np.ndarray]:
        return [ids.astype(np.int64) for ids in self.encoder.all(texts)]


def lower_bounds(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each value of a sorted list, how many of the longer sorted list lie below it, by galloping.

    Every value starts where the last multiple of ``STRIDE`` before it was found, doubles its step until it is passed, and
    halves it again; all values of the list take their steps together.
    """
    anchors = lower_bounds(short[::STRIDE], long) if len(short) > STRIDE else np.zeros(1, np.int64)
    low = np.repeat(anchors, STRIDE)[: len(short)]  # values below are known to be smaller
    high = low.copy()
    step, going = 1, np.arange(len(short))
    while len(going):
        going = going[high[going] < len(long)]
        going = going[long[high[going]] < short[going]]
        low[going] = high[going] + 1
        high[going] = np.minimum(low[going] + step, len(long))
        step *= 2
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_]) // 2
        below = long[middle] < short[open_]
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]
    return low


def common_ends(a: list[np.ndarray], b: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every text, the places in either list of ends that both lists have.

    Texts are put one after the other: all whose first list is the shorter in one search, the others in a second.
    """
    found: list = [None] * len(a)
    for swapped in (False, True):
        here = [i for i in range(len(a)) if (len(b[i]) < len(a[i])) == swapped]
        if not here:
            continue
        lists = [(b[i], a[i]) if swapped else (a[i], b[i]) for i in here]
        lengths = np.array([x[-1] if len(x) else 0 for x, _ in lists])
        base = np.cumsum(lengths) - lengths
        short = np.concatenate([x + s for (x, _), s in zip(lists, base)])
        long = np.concatenate([x + s for (_, x), s in zip(lists, base)])
        places = lower_bounds(short, long)
        hit = np.flatnonzero(places < len(long))
        hit = hit[long[places[hit]] == short[hit]]
        ends = [np.cumsum([len(x[k]) for x in lists]) for k in (0, 1)]
        cuts = np.searchsorted(hit, ends[0])
        for i, start, stop, s, t in zip(here, np.r_[0, cuts[:-1]], cuts, np.r_[0, ends[0][:-1]], np.r_[0, ends[1][:-1]]):
            mine = hit[start:stop]
            pair = mine - s, places[mine] - t
            found[i] = pair[::-1] if swapped else pair
    return found


class Aligner:
    """Tokens of both kinds of a text, and the groups its common ends cut them into."""

    def __init__(self, a: bytes, b: bytes, pattern: str = PATTERN):
        self.a, self.b = ByteLevel(a, pattern), Pieces(b)
        self.bytes_a, self.bytes_b = Strings.of(self.a.bytes), Strings.of(self.b.bytes)
        #: An id with what may follow it in the text of groups: another of its kind, the other kind, the next group, nothing.
        most = max(len(self.bytes_a.sizes), len(self.bytes_b.sizes))
        self.shown = Strings([b"%d%s" % (i, x) for i in range(most) for x in (b",", b"|", b";", b"")])

    def tokens(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of both tokenizers for every text, none where either does not spell the blank and the text."""
        none = np.zeros(0, np.int64)
        for text, b in zip(texts, self.b.all([text or "" for text in texts])):
            whole = f" {text}"
            spelt, a = whole.encode(), self.a.ids(whole) if text else none
            yield (a, b) if self.bytes_a.joined(a) == spelt == self.bytes_b.joined(b) else (none, none)

    def align(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For every text: both kinds of ids, and the places of the tokens that end each group."""
        ids = list(self.tokens(texts))
        sizes_a, sizes_b = self.bytes_a.sizes, self.bytes_b.sizes
        ends = common_ends([np.cumsum(sizes_a[a]) for a, _ in ids], [np.cumsum(sizes_b[b]) for _, b in ids])
        return [(*x, *y) for x, y in zip(ids, ends)]

    def groups(self, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray) -> bytes:
        """The groups as text: ``a1,a2|b1;a3|b2,b3``."""
        if not len(a):
            return b""
        codes = np.empty(len(a) + len(b), np.int64)
        after_a, after_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        after_a[end_a], after_b[end_b] = 1, 2
        after_b[-1] = 3
        before = np.repeat(np.r_[0, end_b[:-1] + 1], np.diff(np.r_[-1, end_a]))
        codes[np.arange(len(a)) + before] = 4 * a + after_a
        codes[np.arange(len(b)) + np.repeat(end_a + 1, np.diff(np.r_[-1, end_b]))] = 4 * b + after_b
        return self.shown.joined(codes)


def some_texts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with a bounded number of bytes of text, or one row."""
    sizes = np.array([len(x.as_buffer()) if x.is_valid else 0 for x in batch.column("text")])
    start, total = 0, 0
    for i, size in enumerate(sizes):
        total += size
        if total >= BYTES_AT_ONCE:
            yield batch.slice(start, i + 1 - start)
            start, total = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def groups(docs: DataFrame, a: bytes, b: bytes, pattern: str = PATTERN) -> DataFrame:
    """Ids of both tokenizers for every text, and the number of the last token of every group: doc_id, a_ids, b_ids, a_ends, b_ends.

    See ``align`` for which texts have tokens.
    """

    def task():
        aligner = Aligner(a, b, pattern)

        def rows(batch: pa.RecordBatch) -> dict:
            found = [x for part in some_texts(batch) for x in aligner.align(part.column("text").to_pylist())]
            columns = zip(("a_ids", "b_ids", "a_ends", "b_ends"), zip(*found))
            return {"doc_id": batch.column("doc_id")} | {name: listed(list(x)) for name, x in columns}

        return rows

    return by_batch(texts_of(docs), task, "doc_id long, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>")


def linked(docs: DataFrame, a: bytes, b: bytes, pattern: str = PATTERN) -> DataFrame:
    """Every text with its links as numbers into the list of its block, and, in rows of their own, the lists."""
    schema = to_arrow(f"{ROW}, {LISTS}")
    names = schema.names

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a, b, pattern)
        rows: list[tuple] = []
        links: list[np.ndarray] = []
        block, held = None, 0

        def close() -> pa.RecordBatch:
            """The texts of a block, and a row with its distinct links."""
            pairs, at, times = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
            sizes = [len(x) for x in links]
            mine = np.split(at.astype(np.int32), np.cumsum(sizes)[:-1])
            columns = dict(zip(names, zip(*rows)))
            made = [pa.array([*columns[n], None], schema.field(n).type) for n in names[:1]]
            made.append(pa.array([block] * (len(rows) + 1), pa.int64()))
            made += [pa.array([*columns[n], None], schema.field(n).type) for n in names[2:7]]
            made.append(pa.concat_arrays([listed(mine), pa.nulls(1, pa.list_(pa.int32()))]))
            for values, kind in ((pairs, pa.int64()), (times.astype(np.int32), pa.int32())):
                made.append(pa.concat_arrays([pa.nulls(len(rows), pa.list_(kind)), pa.array([values], pa.list_(kind))]))
            rows.clear()
            links.clear()
            made = [x.cast(f.type) for x, f in zip(made, schema)]
            return pa.RecordBatch.from_arrays(made, schema=schema)

        for batch in batches:
            for part in some_texts(batch):
                texts = part.column("text").to_pylist()
                for doc_id, (ta, tb, ea, eb) in zip(part.column("doc_id").to_pylist(), aligner.align(texts)):
                    if block is None:
                        block = part.column("part")[0].as_py() << 32
                    digest = hashlib.sha256(aligner.groups(ta, tb, ea, eb)).hexdigest() if len(ta) else ""
                    rows.append((doc_id, None, len(ta), len(tb), len(ea), len(ea), digest))
                    links.append((ta[ea] << ID_BITS) | tb[eb])
                    held += len(ea)
                    if len(rows) >= BLOCK_TEXTS or held >= BLOCK_LINKS:
                        yield close()
                        block, held = block + 1, 0
        if rows:
            yield close()

    return texts_of(docs).withColumn("part", F.spark_partition_id()).mapInArrow(task, f"{ROW}, {LISTS}")


def judged_pairs(lists: DataFrame) -> DataFrame:
    """How often each pair was linked in all texts, and whether no other pair of its second id was linked more often."""
    counts = lists.groupBy("pair").agg(F.sum("times").alias("count"))
    counts = counts.withColumn("b", F.col("pair").bitwiseAND((1 << ID_BITS) - 1))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def summed(schema: pa.Schema):
    """The function that gives the texts of a block the sums over their links."""

    def function(key: tuple, texts: pa.Table, lists: pa.Table) -> pa.Table:
        counts = np.zeros(lists.num_rows + 1, np.int64)
        best = np.zeros(lists.num_rows + 1, np.int64)
        at = lists.column("number").to_numpy()
        counts[at] = lists.column("count").to_numpy()
        best[at] = lists.column("best").to_numpy()
        links = texts.column("links").combine_chunks()
        sizes = links.value_lengths().to_numpy(zero_copy_only=False)
        flat = links.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)

        def sums(values: np.ndarray) -> pa.Array:
            running = np.r_[0, np.cumsum(values[flat])]
            return pa.array(running[ends] - running[ends - sizes], pa.int64())

        made = {"n_best": sums(best), "count_sum": sums(counts)}
        return pa.table([made[f.name] if f.name in made else texts.column(f.name) for f in schema], schema=schema)

    return function


def align(docs: DataFrame, a: bytes, b: bytes, pattern: str = PATTERN) -> DataFrame:
    """Align the tokens of every text of ``docs`` (doc_id, text) under a byte-level BPE and a SentencePiece model.

    Per text: numbers of tokens, groups and links, the digest of its groups, and over its links ``n_best``, those whose pair of ids
    is the most frequent of its second id in all texts, and ``count_sum``, the sum of the pairs' counts. A text that is null or
    empty, or that a tokenizer does not spell as it is (a text with the marker U+2581), has no tokens. No token is without bytes,
    so a link is a common end. One row per input row, repeated rows included and counted each; a null doc_id stays null, other
    columns are not read. Long texts are aligned whole and stay in one block.

    Texts are tokenized once. A pair that every block has is one row per block in its join, which Spark cuts up at run time.
    """
    written = kept(linked(docs, a, b, pattern), "linked")
    texts = written.where(F.col("pairs").isNull()).select(*[x.split()[0] for x in ROW.split(", ")])
    lists = written.where(F.col("pairs").isNotNull()).select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("number", "x"))
    lists = lists.select("block", "number", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    found = lists.join(judged_pairs(lists), "pair").select(F.col("block").alias("of"), "number", "count", "best")
    return texts.groupBy("block").cogroup(found.groupBy("of")).applyInArrow(summed(to_arrow(COUNTED)), COUNTED)
