"""Language identification: held-out accuracy, what is learned from, and odd texts."""

import zlib

import numpy as np
import pytest

from tallyhouse.llm import langid
from tallyhouse.llm.queries import op5_language

SMALL = langid.Settings(per_language=60, features=1 << 12)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy(spark, docs):
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = op5_language(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(lang)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held if lang[r.doc_id]]) > 0.97


def test_held_out_rows_and_labels_are_not_looked_at(spark, docs):
    """Other texts and languages in held-out rows change no other prediction."""
    marked = docs.select("doc_id", "text", "lang", langid.held_out(5).alias("held_out"))
    spoiled = marked.selectExpr("doc_id", "if(held_out, 'zz zz zz', text) as text", "if(held_out, 'xx', lang) as lang")
    plain = {r.doc_id: r for r in langid.identify(docs, settings=SMALL).collect()}
    for r in langid.identify(spoiled, settings=SMALL).collect():
        assert r.lang_pred != "xx"
        assert r.held_out or (r.lang_pred, r.score) == (plain[r.doc_id].lang_pred, plain[r.doc_id].score)


def test_odd_texts(spark, docs):
    model = langid.fit(docs.limit(300), SMALL)
    rows = [(1, None), (2, ""), (3, "12 34 !? ·"), (4, "a"), (5, "漢字"), (6, "the of and " * 20000), (None, "the and"), (6, "the")]
    df = spark.createDataFrame([(i, t, False, "q", 1) for i, t in rows], "doc_id long, text string, held_out boolean, lang_pred string, score int")
    got = {(r.doc_id, i): r for i, r in enumerate(langid.predict(df, model, SMALL).collect())}
    assert [(r.lang_pred, r.score) for r in list(got.values())[:3]] == [("und", 0.0)] * 3
    assert all(r.lang_pred in model.languages for r in list(got.values())[3:]) and len(got) == len(rows)


@pytest.mark.parametrize("rows", [[], [(1, "some text", None)], [(1, None, "en")]])
def test_nothing_to_learn_from(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identify(df).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * len(rows)


def test_weights_are_sparse_and_temperature_calibrates(docs):
    model = langid.fit(docs, SMALL)
    assert (model.weights == 0).mean() > 0.2
    rng = np.random.default_rng(1)
    truth = rng.integers(0, 3, 2000)
    sure = np.eye(3)[np.where(rng.random(2000) < 0.8, truth, rng.integers(0, 3, 2000))] * 30
    t = langid.temperature(sure, truth)
    right = langid.softmax(sure / t).max(axis=1).mean()
    assert abs(right - (sure.argmax(axis=1) == truth).mean()) < 0.02


def test_ngram_counts_against_plain_hashes():
    s = langid.Settings()
    found = langid.counts("Ab, é1", s)
    text, expected = "ab  é ", np.zeros(s.features, np.int64)
    m = 2**32
    for n in s.lengths:
        for i in range(len(text) - n + 1):
            h = 0
            for k, c in enumerate(text[i : i + n], 1):
                h = (h * 0x01000193 % m) ^ (ord(c) + k)
            h = h * 0x9E3779B1 % m
            expected[((h ^ (h >> 15)) * 0x85EBCA77 % m) >> 18] += 1
    assert found.tolist() == expected.tolist()


def test_copies_leave_the_sample_its_size(spark):
    rows = [("en", "the same text")] * 2800 + [("en", f"text {i}") for i in range(200)] + [("fr", f"texte {i}") for i in range(100)]
    languages, picked = langid.sample(spark.createDataFrame(rows, "lang string, text string"), langid.Settings(per_language=150))
    counted = {r["lang"]: r["count"] for r in picked.groupBy("lang").count().collect()}
    assert languages == ["en", "fr"] and 110 < counted["en"] < 190 and counted["fr"] == 100


def test_numeric_signs_are_no_letters():
    assert not any(langid.LETTER.search(x) for x in ("½ ²", "１２ ① 3", "_ 7 Ⅷ", "٣", "\u0301", "🙂"))
    assert all(langid.LETTER.search(x) for x in ("é", "日", "ª", "ʰ", "１a"))


def test_every_language_is_learned(spark):
    rows = [(f"l{i:03d}", f"text {i} {j}") for i in range(300) for j in range(2)]
    languages, picked = langid.sample(spark.createDataFrame(rows, "lang string, text string"), langid.Settings())
    assert len(languages) == 300 and picked.count() == 600
    few = langid.sample(spark.createDataFrame(rows, "lang string, text string"), langid.Settings(sample_texts=300))
    assert len(few[0]) == 300 and 220 < few[1].count() < 380
