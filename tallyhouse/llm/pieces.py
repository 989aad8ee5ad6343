"""SentencePiece encoding and decoding with a table of distinct chunks.

A chunk is a run of whitespace markers with the word after it. Where no piece of a model has a marker
behind another character, no merge can cross from one chunk into the next, so a text's ids are
those of its chunks in turn. Every task numbers the distinct chunks it meets, has the library segment
each of them once, and joins the ids back by position. The table is bounded; when it is full a
new one is begun, which changes no id.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import by_batch

MARK = "▁"
CHUNK = re.compile(r" *[^ ]+| +")


def processor(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def chunks_apart(sp: sentencepiece.SentencePieceProcessor) -> bool:
    """Whether chunks can be segmented on their own: no piece crosses from one to the next, and text is taken as it is."""
    pieces = sp.id_to_piece(list(range(sp.get_piece_size())))
    crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
    probe = " a  b c "
    as_is = "".join(sp.encode(probe, out_type=str)) == (" " + probe).replace(" ", MARK) and sp.decode(sp.encode("ﬁ ① Å")) == "ﬁ ① Å"
    return not crossing and as_is and sp.piece_to_id(MARK) != sp.unk_id()


def chunks(text: str) -> list[str]:
    """The chunks of a text, without the marker that each begins with."""
    if not text:
        return []
    text = text.replace(MARK, " ")
    # The library puts one marker before the text, so every chunk begins with one, which is left out here.
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [c[1:] for c in CHUNK.findall(" " + text)]
    return text.split(" ")


class ChunkTable:
    """The ids of distinct chunks, one after another in one array, by the chunk's number."""

    def __init__(self, sp: sentencepiece.SentencePieceProcessor, most: int = 300_000, most_chars: int = 24_000_000):
        self.sp, self.most, self.most_chars = sp, most, most_chars
        self.alone = [sp.piece_to_id(MARK)]
        self.clear()

    def clear(self) -> None:
        self.numbers: defaultdict[str, int] = defaultdict(count().__next__)
        self.starts, self.sizes = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.ids, self.used, self.chars = np.zeros(1 << 14, np.int32), 0, 0

    def segment(self, new: list[str], at: int) -> None:
        """Have the library segment chunks that got the numbers from ``at`` on."""
        found = self.sp.encode(new, num_threads=1)
        found = [ids if chunk else self.alone for ids, chunk in zip(found, new, strict=True)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        end = at + len(new)
        while len(self.starts) < end:
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        self.sizes[at:end] = sizes
        self.starts[at:end] = self.used + np.cumsum(sizes) - sizes
        total = self.used + int(sizes.sum())
        while len(self.ids) < total:
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : total] = np.fromiter((i for ids in found for i in ids), np.int32, total - self.used)
        self.used = total
        self.chars += sum(map(len, new))

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text, as the library gives them for the whole of it; new chunks of all texts are segmented in one call."""
        if len(self.numbers) > self.most or self.chars > self.most_chars:
            self.clear()
        found = [chunks(text) for text in texts]
        known, counts = len(self.numbers), np.fromiter(map(len, found), np.int64, len(found))
        numbers = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(found)), np.int64, int(counts.sum()))
        if len(self.numbers) > known:
            new, last = [], reversed(self.numbers)
            for _ in range(len(self.numbers) - known):
                new.append(next(last))
            self.segment(new[::-1], known)
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.starts[numbers] - (ends - sizes), sizes)
        ids = self.ids[shift + np.arange(len(shift))]
        cuts = np.r_[0, ends][np.r_[0, np.cumsum(counts)]].tolist()
        return [ids[start:stop] for start, stop in zip(cuts, cuts[1:])]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]


class Encoder:
    """Ids of whole texts, over the table where the model allows it."""

    def __init__(self, model: bytes, eos: bool):
        self.sp = processor(model)
        self.end = np.array([self.sp.eos_id()] if eos else [], np.int32)
        self.table = ChunkTable(self.sp) if chunks_apart(self.sp) else None

    def all(self, texts: list[str]) -> list[np.ndarray]:
        found = self.table.encode_all(texts) if self.table else [np.array(self.sp.encode(text), np.int32) for text in texts]
        return [np.concatenate([ids, self.end]) for ids in found]

    def __call__(self, text: str) -> np.ndarray:
        return self.all([text])[0]


def listed(found: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(found) + 1, np.int32)
    np.cumsum([len(x) for x in found], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found).astype(np.int32)))


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def encode(docs: DataFrame, model: bytes, eos: bool = True) -> DataFrame:
    """The piece ids of every text of ``docs`` (doc_id, text): doc_id, ids.

    Equal to the library's own ids for the whole text, with the end id if ``eos``. One row per input row; a
    null text is an empty one, a null doc_id stays null, other columns are not read. A model whose pieces
    cross markers, or that rewrites texts, is run over whole texts instead.
    """

    def task():
        encoder = Encoder(model, eos)

        def rows(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch.column("doc_id"), "ids": listed([encoder(x.as_py()) for x in batch.column("text")])}

        return rows

    return by_batch(texts_of(docs), task, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """The texts of piece ids (doc_id, ids), as the library's decode gives them: doc_id, ids, text. Null ids give an empty text."""

    def task():
        sp = processor(model)

        def rows(batch: pa.RecordBatch) -> dict:
            ids = batch.column("ids")
            return {"doc_id": batch.column("doc_id"), "ids": ids, "text": [sp.decode(x.as_py() or []) for x in ids]}

        return rows

    return by_batch(encoded.select("doc_id", "ids"), task, "doc_id long, ids array<int>, text string")


def round_trip(docs: DataFrame, model: bytes, eos: bool = True) -> DataFrame:
    """``decode`` of ``encode`` in one pass, so that ids do not leave a worker to come back to another: doc_id, ids, text."""

    def task():
        encoder = Encoder(model, eos)

        def rows(batch: pa.RecordBatch) -> dict:
            found = [encoder(x.as_py()) for x in batch.column("text")]
            return {"doc_id": batch.column("doc_id"), "ids": listed(found), "text": [encoder.sp.decode(x.tolist()) for x in found]}

        return rows

    return by_batch(texts_of(docs), task, "doc_id long, ids array<int>, text string")


def round_trip_digests(docs: DataFrame, model: bytes) -> DataFrame:
    """Encode, decode, and reduce ids and texts to their digests."""
    return round_trip(docs, model).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
