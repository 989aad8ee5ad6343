"""SentencePiece encoding and decoding against the library on whole texts."""

import hashlib
from pathlib import Path

import pytest

from tallyhouse.llm import pieces
from tallyhouse.llm.queries import TOKENIZER, op1_sentencepiece

MODEL = Path(TOKENIZER).read_bytes()
TEXTS = [
    None, "", " ", "   ", "a", " a", "a ", "  two  spaces  ", "line\nbreak\n\n\ttab ", "▁marker ▁ ▁▁x", "Größe é ß 漢字 🙂 \x00 ​",
    "<s> </s> <unk> <0x41>", "x" * 5000, "word " * 3000, "naïve naïve naïve", " nbsp　wide", "ﬁ ① Å",
]


def library(text):
    sp = pieces.processor(MODEL)
    ids = sp.encode(text or "") + [sp.eos_id()]
    return ids, sp.decode(ids)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens string")


def test_every_text_as_the_library_does(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(TEXTS)] + [(None, "no id", None, None), (3, "   ", "x", "y")]
    expected = sorted((str(i), *library(t)) for i, t, _, _ in rows)
    df = frame(spark, rows)
    for done in (pieces.decode(pieces.encode(df, MODEL), MODEL), pieces.round_trip(df, MODEL)):
        assert sorted((str(r.doc_id), list(r.ids), r.text) for r in done.collect()) == expected


def test_empty_table(spark):
    done = pieces.round_trip_digests(frame(spark, []), MODEL)
    assert done.collect() == [] and done.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_full_table_begins_anew():
    sp = pieces.processor(MODEL)
    table = pieces.ChunkTable(sp, most=5, most_chars=40)
    for text in ("one two three four five six seven", "two two eight", " nine  ten", "one"):
        for _ in range(2):
            assert table.encode(text).tolist() == sp.encode(text)


def test_texts_at_once():
    sp = pieces.processor(MODEL)
    texts = ["", "one two", " two  three ", "", "▁ marked▁ text", "  ", "naïve 日本語 🙂", "one", "line\nline\ttab", ""]
    for most in (300_000, 3):
        table = pieces.ChunkTable(sp, most=most)
        for some in (texts, texts[::-1], [], [""]):
            assert [x.tolist() for x in table.encode_all(some)] == [sp.encode(x) for x in some]


def test_model_allows_chunks():
    assert pieces.chunks_apart(pieces.processor(MODEL))


def test_null_ids_decode_to_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.text for r in pieces.decode(df, MODEL).collect()] == ["", ""]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = op1_sentencepiece(spark, folder).collect()
    assert len(got) == len(docs)
    for r in got:
        ids, text = library(docs[r.doc_id])
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(text))
