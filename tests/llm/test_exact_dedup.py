"""Exact groups against plain Python and SQL."""

import hashlib
import re

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from tallyhouse.llm import exact_dedup
from tallyhouse.llm.queries import EXACT_SQL, op13_exact_dedup

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def plain(rows):
    """Groups by text without blanks; the row that stays by length, id, place."""
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append(i)
    for bare, members in groups.items():
        first = min(members, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0, i))
        for i in members:
            yield rows[i][0], rows[first][0], len(members), i == first, hashlib.sha256(bare.encode()).hexdigest()


def in_order(rows):
    return sorted(rows, key=lambda r: [(x is not None, x) for x in r])


ODD = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "a b"), (5, "ab"), (6, " a b "), (7, "a\x1fb"), (8, "a b"), (9, "AB"),
    (10, "🙂 é"), (11, "🙂é"), (12, "🙂é"), (None, "a  b  c"), (None, "abc"), (13, "abc "), (14, "word " * 200_000), (15, "word" * 200_000),
    (4, "a b"), (4, "a b"), (None, "only"), (-5, "x"), (-6, "x"), (16, "\x00"), (17, " \x00 "),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(*r, "f", 1) for r in ODD], "doc_id int, text string, file string, row int").coalesce(1)
    got = exact_dedup.deduplicate(docs)
    assert got.columns == COLUMNS
    assert in_order(tuple(r) for r in got.collect()) == in_order(plain(ODD))


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.deduplicate(docs).collect() == []
    docs.write.parquet(f"{tmp_path}/none")
    assert exact_dedup.deduplicate(spark.read.parquet(f"{tmp_path}/none")).collect() == []


def test_different_texts_under_one_digest_stay_apart(spark):
    """A digest of two values only: all groups but two are told apart by their bytes."""
    docs = spark.createDataFrame(ODD, "doc_id long, text string").coalesce(1)
    got = exact_dedup.deduplicate(docs, lambda content: (F.crc32(content) % 2).cast("string")).drop("text_sha256")
    assert in_order(tuple(r) for r in got.collect()) == in_order(r[:4] for r in plain(ODD))


def test_one_group_of_most_rows(spark):
    rows = [(i, "the same text" + " " * (i % 7) if i % 3 else f"text {i}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    assert {tuple(r) for r in exact_dedup.deduplicate(docs).collect()} == set(plain(rows))


def test_batches_meet_the_texts_of_earlier_ones(spark, tmp_path):
    store, schema = str(tmp_path / "store"), "doc_id long, text string"
    first, second = [(1, "one"), (2, "t w o"), (3, "one ")], [(4, "two"), (5, "three"), (0, "o n e")]
    exact_dedup.deduplicate_more(spark.createDataFrame(first, schema), store, "monday").collect()
    for _ in range(2):  # a batch that is given again adds nothing
        got = exact_dedup.deduplicate_more(spark.createDataFrame(second, schema), store, "tuesday")
        assert {tuple(r) for r in got.collect()} == set(plain(first + second))


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = exact_dedup.deduplicate(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|ExternalRDD", plan)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query(spark, size):
    folder = f"/root/testdata/{size}"
    got = op13_exact_dedup(spark, folder)
    assert got.columns == COLUMNS
    assert difference(got, connect(folder), EXACT_SQL) == ""
    assert got.where("group_size > 1").count() > 0
