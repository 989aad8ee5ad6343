"""Language model scores by prediction by partial matching.

The trie holds what follows every context of up to three bytes in the training texts; Spark sums its counts
over all of them. A symbol unseen in a context escapes to the context one byte shorter, with probability
t / (n + t) after t different of n symbols, and symbols already ruled out by longer contexts are excluded.
Every context seen is kept: its escape and exclusions are worked out in Spark from its counts and those of the context one
byte shorter. As the trained trie does not change while it scores, the code length of every gram that some text has is
worked out once, joined with each block of texts by gram, and a text's length is added up from it.

Beside it, a word model's score: counts of all training words are joined with each block of texts by word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import kept, utf8
from tallyhouse.llm.langid import held_out

ORDER = 3
#: Bytes that no UTF-8 text has: one stands for the end of a text, one pads its start.
END, START = 0xFE, 0xFF
WORDS, TEXTS = -1, -2
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass(frozen=True)
class Settings:
    """``contexts``: if given, a context of two or three bytes is kept only if it holds at least one in this many training
    symbols; else all are. ``block_bytes``: text that is scored together."""

    contexts: int | None = None
    block_bytes: int = 24_000_000


def symbols(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The context of three bytes before each symbol of a text, and the symbol, the end of the text included."""
    b = np.full(len(text) + ORDER + 1, START, np.uint32)
    b[ORDER:-1] = np.frombuffer(text, np.uint8)
    b[-1] = END
    return (b[:-3] << np.uint32(16)) | (b[1:-2] << np.uint32(8)) | b[2:-1], b[ORDER:]


def word_starts(text: bytes) -> int:
    inside = ~SPACE[np.frombuffer(text, np.uint8)]
    return int(inside[:1].sum() + (inside[1:] & ~inside[:-1]).sum())


class Grams:
    """Counts of symbols by context, in a dense row per context met so far."""

    MOST = 24_000

    def __init__(self) -> None:
        self.row = np.full(1 << 24, -1, np.int32)
        self.contexts = np.zeros(0, np.int64)
        self.counts = np.zeros((0, 256), np.int64)

    def full(self) -> bool:
        return len(self.contexts) > self.MOST

    def add(self, context: np.ndarray, symbol: np.ndarray) -> None:
        row = self.row[context]
        if (row < 0).any():
            new = np.unique(context[row < 0])
            self.row[new] = np.arange(len(self.contexts), len(self.contexts) + len(new))
            self.contexts = np.r_[self.contexts, new]
            self.counts = np.concatenate([self.counts, np.zeros((len(new), 256), np.int64)])
            row = self.row[context]
        self.counts += np.bincount(row.astype(np.int64) * 256 + symbol, minlength=self.counts.size).reshape(-1, 256)

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        """Grams of four bytes and their counts; begins anew."""
        at = np.flatnonzero(self.counts)
        found = self.contexts[at >> 8] << 8 | (at & 255), self.counts.ravel()[at]
        self.row[self.contexts] = -1
        self.contexts, self.counts = self.contexts[:0], self.counts[:0]
        return found


def gram_counts(texts: DataFrame) -> DataFrame:
    """How often each gram of four bytes occurs in the texts (utf8): gram, n. Under WORDS and TEXTS, how many words and texts there are."""
    at_once = 4_000_000

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, words, count = Grams(), 0, 0
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def rows(gram, n) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(gram, pa.int64()), pa.array(n, pa.int64())], names=["gram", "n"])

        def drain() -> None:
            nonlocal size
            if waiting:
                grams.add(np.concatenate([c for c, _ in waiting]), np.concatenate([s for _, s in waiting]))
                waiting.clear()
                size = 0

        for batch in batches:
            for value in batch.column("utf8"):
                text = value.as_py().lower()
                words, count, size = words + word_starts(text), count + 1, size + len(text)
                waiting.append(symbols(text))
                if size >= at_once:
                    drain()
                    if grams.full():
                        yield rows(*grams.taken())
        drain()
        if grams.contexts.size:
            yield rows(*grams.taken())
        yield rows([WORDS, TEXTS], [words, count])

    return texts.mapInArrow(task, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


@dataclass
class Trie:
    """Code lengths (log10 of probabilities) of every symbol in every context kept, and the row of each context by its order."""

    lengths: np.ndarray
    contexts: list[np.ndarray]

    def rows(self) -> np.ndarray:
        """The row for every context of three bytes: that of its longest form in the trie."""
        row = np.zeros(1 << 24, np.uint16)
        first = 1
        for order, contexts in enumerate(self.contexts[1:], start=1):
            row.reshape(-1, 1 << 8 * order)[:, contexts] = np.arange(first, first + len(contexts))
            first += len(contexts)
        return row


def train(grams: DataFrame, settings: Settings) -> Trie:
    """The trie of gram counts as one dense table on the driver: for small corpora, ``score`` uses ``lengths``."""
    grams = grams.where("gram >= 0")
    total = grams.agg(F.sum("n")).first()[0] or 0
    contexts, counts = [], []
    for order in range(ORDER + 1):
        mask = (1 << 8 * order) - 1
        context = F.shiftright("gram", 8).bitwiseAND(mask)
        level = grams.groupBy(context.alias("context"), F.col("gram").bitwiseAND(255).alias("symbol")).agg(F.sum("n").alias("n"))
        if order > 1 and settings.contexts:
            weight = grams.groupBy(context.alias("context")).agg(F.sum("n").alias("all"))
            level = level.join(weight.where(F.col("all") * settings.contexts >= total).select("context"), "context")
        found = level.toArrow()
        context, symbol, n = (found.column(c).to_numpy() for c in ("context", "symbol", "n"))
        known, row = np.unique(context, return_inverse=True)
        dense = np.zeros((max(1, len(known)) if order == 0 else len(known), 256))
        dense[row, symbol] = n
        contexts.append(known if order else np.zeros(1, np.int64))
        counts.append(dense)
    return Trie(np.concatenate([code_lengths(contexts, counts, order) for order in range(ORDER + 1)]), contexts)


def code_lengths(contexts: list[np.ndarray], counts: list[np.ndarray], order: int, at_once: int = 4096) -> np.ndarray:
    """log10 of the probability of every symbol after every context of the order, escapes and exclusions worked in."""
    out = np.zeros((len(contexts[order]), 256), np.float32)
    for begin in range(0, len(out), at_once):
        part = contexts[order][begin : begin + at_once]
        escape, p, excluded = np.ones(len(part)), np.zeros((len(part), 256)), np.zeros((len(part), 256), bool)
        for shorter in range(order, -1, -1):
            at = np.searchsorted(contexts[shorter], part & ((1 << 8 * shorter) - 1))
            seen = np.where(excluded, 0.0, counts[shorter][at])
            n, kinds = seen.sum(axis=1), (seen > 0).sum(axis=1)
            whole = np.where(n > 0, n + kinds, 1.0)
            p += seen * (escape / whole)[:, None]
            escape = np.where(n > 0, escape * kinds / whole, escape)
            excluded |= seen > 0
        excluded[:, START] = True
        left = ~excluded
        p += left * (escape / np.maximum(left.sum(axis=1), 1))[:, None]
        out[begin : begin + at_once] = np.log10(np.maximum(p, 1e-30))
    return out


def low_bytes(gram: str, count: int) -> Column:
    return F.col(gram).bitwiseAND((1 << 8 * count) - 1)


def lengths(grams: DataFrame, needed: DataFrame, settings: Settings) -> DataFrame:
    """log10 of the probability of every gram of ``needed`` (gram: a context of three bytes and a symbol) after training on ``grams``
    (gram, n): gram, length.

    The symbols of a context are among those of its shorter form, so what is excluded there, and the escape from there, depend on
    the two alone. A row of ``contexts`` of an order has ``own``, the length that every symbol seen in it starts from, and in ``below<k>``
    that of the symbols last seen at the shorter order k, or never (k = -1).
    """
    trained = grams.where("gram >= 0")
    total = trained.agg(F.sum("n")).first()[0] or 0
    levels, contexts = [], []
    for order in range(ORDER + 1):
        level = trained.groupBy(low_bytes("gram", order + 1).alias("gram")).agg(F.sum("n").alias("n"))
        level = level.withColumn("context", F.shiftright("gram", 8))
        if order > 1 and settings.contexts:
            weight = level.groupBy("context").agg(F.sum("n").alias("all"))
            level = level.join(weight.where(F.col("all") * settings.contexts >= total).select("context"), "context")
        levels.append(kept(level.select("gram", "n", "context"), "grams_of_order"))
        if order == 0:
            first = levels[0].groupBy("context").agg(F.sum("n").alias("all"), F.count("*").alias("kinds"))
            inner = first.withColumn("inner-1", -F.log10(255 - F.col("kinds")))
        else:
            shorter = levels[-2].select(F.col("gram").alias("short"), F.col("n").alias("excluded"))
            shorter = F.broadcast(shorter) if order <= 2 else shorter
            found = levels[-1].join(shorter, low_bytes("gram", order) == F.col("short")).groupBy("context")
            found = found.agg(F.sum("n").alias("all"), F.count("*").alias("kinds"), F.sum("excluded").alias("excluded"))
            above = contexts[-1].withColumnsRenamed({"context": "short", "all": "above_all", "kinds": "above_kinds"})
            found = found.join(F.broadcast(above), low_bytes("context", order - 1) == F.col("short"))
            left, kinds = F.col("above_all") - F.col("excluded"), F.col("above_kinds") - F.col("kinds")
            down = F.when(kinds > 0, F.log10(kinds / (left + kinds))).otherwise(0.0)
            on = [(down + F.col(f"inner{k}")).alias(f"inner{k}") for k in range(-1, order - 1)]
            # Null where nothing is left to the shorter context: no symbol is last seen there.
            here = F.when(kinds > 0, -F.log10(left + kinds)).alias(f"inner{order - 1}")
            inner = found.select("context", "all", "kinds", *on, here)
        contexts.append(kept(inner, "contexts_of_order"))

    coded, length = needed, F.lit(-float(np.log10(255)))
    for order in range(ORDER + 1):
        level = levels[order].select(F.col("gram").alias(f"gram{order}"), F.col("n").alias(f"n{order}"))
        escape = F.log10(F.col("kinds") / (F.col("all") + F.col("kinds")))
        below = [(escape + F.col(f"inner{k}")).alias(f"below{order}_{k}") for k in range(-1, order)]
        own = (-F.log10(F.col("all") + F.col("kinds"))).alias(f"own{order}")
        context = contexts[order].select(F.col("context").alias(f"context{order}"), own, *below)
        # What one or two bytes can make is a small table at any size.
        level, context = (F.broadcast(level) if order < 2 else level), (F.broadcast(context) if order < 3 else context)
        coded = coded.join(level, low_bytes("gram", order + 1) == F.col(f"gram{order}"), "left")
        coded = coded.join(context, F.shiftright(low_bytes("gram", order + 1), 8) == F.col(f"context{order}"), "left")
        seen = [F.log10(f"n{k}") + F.col(f"below{order}_{k}") for k in range(order - 1, -1, -1)]
        here = F.coalesce(F.log10(f"n{order}") + F.col(f"own{order}"), *seen, F.col(f"below{order}_-1"))
        length = F.when(F.col(f"context{order}").isNotNull(), here).otherwise(length)
    return coded.select("gram", length.alias("length"))


#: Symbols whose grams are looked up together.
AT_ONCE = 2_000_000


def grams_of(texts: pa.ChunkedArray) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The grams of texts, some texts at a time, and where each text starts in them."""
    waiting: list[np.ndarray] = []
    size = 0
    for i, value in enumerate(texts, start=1):
        context, symbol = symbols(value.as_py().lower())
        waiting.append((context << np.uint32(8)) | symbol)
        size += len(symbol)
        if size >= AT_ONCE or i == len(texts):
            yield pa.array(np.concatenate(waiting)), np.cumsum([0, *map(len, waiting[:-1])])
            waiting, size = [], 0


def block_words(block: pa.Table) -> pa.Table:
    """The different words of a block, with how often its training texts have them, and after them its different grams."""
    taught: Counter[bytes] = Counter()
    other: set[bytes] = set()
    for text, held in zip(block.column("utf8"), block.column("held_out"), strict=True):
        words = text.as_py().lower().split()
        if held.as_py():
            other.update(words)
        else:
            taught.update(words)
    other.difference_update(taught)
    words = [*taught, *other]
    n = np.zeros(len(words), np.int64)
    n[: len(taught)] = np.fromiter(taught.values(), np.int64, len(taught))
    number = block.column("block")[0].as_py()
    grams = pc.unique(pa.chunked_array([pc.unique(found) for found, _ in grams_of(block.column("utf8"))], pa.uint32())).cast(pa.int64())
    return pa.table(
        {
            "block": pa.array(np.full(len(words) + len(grams), number), pa.int64()),
            "word": pa.concat_arrays([pa.array(words, pa.binary()), pa.nulls(len(grams), pa.binary())]),
            "gram": pa.concat_arrays([pa.nulls(len(words), pa.int64()), grams]),
            "n": np.r_[n, np.zeros(len(grams), np.int64)],
        }
    )


def score(docs: DataFrame, folds: int = 10, settings: Settings = Settings()) -> DataFrame:
    """Both models' scores of every row of ``docs`` (doc_id, text), learned from those not held out.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score, a row per row. A null text is an
    empty one: it has its end alone. A row without doc_id is held out. With nothing to learn from all symbols
    are equally likely, and every word's base score is 0. Texts are read whole, other columns are not read.

    Texts are dealt into blocks of a bounded size by a hash; per block only its different words and grams are
    sent to be counted, and only their counts and code lengths come back.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(folds).alias("held_out"), utf8().alias("utf8"))
    grams = kept(gram_counts(read.where("not held_out").select("utf8")), "grams")
    learned = {r["gram"]: r["n"] for r in grams.where("gram < 0").collect()}
    texts_learned = learned.get(TEXTS, 0)
    tokens = learned.get(WORDS, 0) + texts_learned

    size = read.agg(F.sum(F.octet_length("utf8"))).first()[0] or 0
    blocks = max(8, -(-size // settings.block_bytes))
    blocked = read.withColumn("block", F.pmod(F.xxhash64("doc_id", "utf8"), F.lit(blocks))).repartition("block")
    words = blocked.groupBy("block").applyInArrow(block_words, "block long, word binary, gram long, n long")
    everywhere = Window.partitionBy("word", "gram")
    first = F.row_number().over(everywhere.orderBy("block")) == 1
    counted = kept(words.select("block", "word", "gram", F.sum("n").over(everywhere).alias("c"), first.alias("first")), "words")
    kinds = counted.where("first and c > 0").count() + (texts_learned > 0)
    coded = kept(lengths(grams, counted.where("first and gram is not null").select("gram"), settings), "code_lengths")
    of_words = counted.where("gram is null").select("block", "word", "gram", F.log10(F.col("c") + 0.1).alias("value"))
    of_grams = counted.where("gram is not null").select("block", "word", "gram").join(coded, "gram")
    of_grams = of_grams.select("block", "word", "gram", F.col("length").alias("value"))
    norm = float(np.log10(tokens + 0.1 * (kinds + 1)))
    end = float(np.log10(texts_learned + 0.1))
    fields = pa.schema(
        [
            ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
            ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
        ]
    )

    def score_block(texts: pa.Table, counts: pa.Table) -> pa.Table:
        is_gram = pc.is_valid(counts.column("gram"))
        coded, words = counts.filter(is_gram), counts.filter(pc.invert(is_gram))
        values = dict(zip(words.column("word").to_pylist(), words.column("value").to_pylist(), strict=True))
        grams, code = coded.column("gram").cast(pa.uint32()).combine_chunks(), coded.column("value").to_numpy()
        made: dict[str, list] = {name: [] for name in fields.names[2:]}
        for value in texts.column("utf8"):
            found = value.as_py().lower().split()
            scores = np.fromiter(map(values.__getitem__, found), np.float64, len(found))
            made["n_tokens"].append(len(found) + 1)
            made["n_known"].append(int((scores > 0).sum()) + (texts_learned > 0))
            made["train_tokens"].append(tokens)
            made["base_score"].append(float(scores.sum()) + end - (len(found) + 1) * norm)
        for found, starts in grams_of(texts.column("utf8")):
            at = pc.index_in(found, value_set=grams).to_numpy()
            made["score"].extend(np.add.reduceat(code[at], starts).tolist())
        return pa.table({"doc_id": texts.column("doc_id"), "held_out": texts.column("held_out"), **made}, schema=fields)

    pairs = blocked.groupBy("block").cogroup(of_words.unionByName(of_grams).groupBy("block"))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return pairs.applyInArrow(score_block, schema)
