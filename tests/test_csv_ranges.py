"""CSV files cut into byte ranges against the reader that takes a file whole."""

import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.session import scratch
from tallyhouse.sources.csv import read_csv
from tallyhouse.sources.csv_ranges import lines, read_csv_ranges

SCHEMA = T.StructType().add("id", "long").add("name", "string").add("amount", "decimal(12,2)").add("note", "string")
CELLS = ["", '""', "plain", '"a, b"', '"one\ntwo"', '"\n"', '"x ""said"" y\n\n\nz"', '""""', '"""\n"""', " blanks ", "é – ü", '"\r\nkept"', "\\N", '"' + "long\n" * 40 + '"']


@pytest.fixture
def cut(spark):
    """Files cut into ranges of some bytes."""

    def at(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield at
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def written(path, rows, end="\n", header="id,name,amount,note"):
    path.write_bytes((end.join([header, *(",".join(r) for r in rows)]) + end).encode())
    return str(path)


def rows_of(seed, n):
    rng = random.Random(seed)
    return [(str(i), rng.choice(CELLS), f"{rng.randrange(10**6) / 100:.2f}", rng.choice(CELLS)) for i in range(n)]


def by_ranges(spark, path):
    with scratch(spark) as keep:
        return Counter(map(tuple, read_csv_ranges(spark, path, SCHEMA, keep).collect()))


def whole(spark, path):
    return Counter(map(tuple, read_csv(spark, path, SCHEMA, multiline=True).collect()))


@pytest.mark.parametrize("size", [7, 61, 256, 10**6])
def test_equal_to_the_reader_of_whole_files(spark, tmp_path, cut, size):
    paths = [written(tmp_path / f"{k}.csv", rows_of(k, 60)) for k in range(3)]
    paths.append(written(tmp_path / "plain.csv", [(str(i), "a", "1.50", "b") for i in range(40)]))
    expected = whole(spark, paths)
    cut(size)
    assert by_ranges(spark, paths) == expected
    if size < 300:
        assert lines(spark, paths).rdd.getNumPartitions() > 20


def test_breaks_on_every_border(spark, tmp_path, cut):
    path = written(tmp_path / "b.csv", [("1", '"' + "\n" * 50 + '"', "2.00", "x"), ("2", "y", "3.00", '"' + "\n" * 30 + '"'), ("3", "z", "1.00", "")])
    expected = whole(spark, path)
    assert len(expected) == 3
    for size in (5, 16, 23):
        cut(size)
        assert by_ranges(spark, path) == expected


def test_returns_before_breaks_broken_headers_and_empty_files(spark, tmp_path, cut):
    ended = written(tmp_path / "r.csv", [("1", '"a\r\nb"', "2.00", ""), ("2", "", "3.00", "last")], end="\r\n")
    titled = written(tmp_path / "h.csv", rows_of(9, 5), header='id,"na\nme",amount,note')
    empty = tmp_path / "e.csv"
    empty.write_text("")
    bare = written(tmp_path / "o.csv", [])
    blank = tmp_path / "l.csv"
    blank.write_text("id,name,amount,note\n\n5,a,1.00,b\n  \n")
    for size in (10**6, 11):
        cut(size)
        assert by_ranges(spark, ended) == Counter([(1, "a\r\nb", Decimal("2.00"), None), (2, None, Decimal("3.00"), "last")])
        assert by_ranges(spark, titled) == whole(spark, titled)
        assert by_ranges(spark, str(empty)) == by_ranges(spark, bare) == Counter()
        assert [r[0] for r in by_ranges(spark, str(blank))] == [5]


def test_conditions_on_cells_do_not_reach_headers(spark, tmp_path, cut):
    paths = [written(tmp_path / "a.csv", rows_of(3, 20)), written(tmp_path / "b.csv", [("7", "a", "1.50", "b")])]
    cut(61)
    with scratch(spark) as keep:
        rows = read_csv_ranges(spark, paths, SCHEMA, keep)
        refused = F.when(F.col("id").isNull(), F.raise_error(F.lit("no id")).cast("boolean")).otherwise(F.col("id") > 4)
        assert sorted(r.id for r in rows.where(refused).collect()) == sorted([*range(5, 20), 7])


@pytest.mark.parametrize(
    "text, fault",
    [
        ('1,a,2.00,"never ends\n2,b,1.00,c\n', "never ends"),
        ('1,a 5" pipe,2.00,b\n2,a 6" pipe,1.00,c\n', "outside of a quoted cell"),
        ("1,a,2.00,b\r2,b,1.00,c\n", "outside of a quoted cell"),
        ("1,a,two,b\n", "(?i)malformed"),
    ],
)
def test_faults_fail_the_load(spark, tmp_path, cut, text, fault):
    path = tmp_path / "f.csv"
    path.write_bytes(("id,name,amount,note\n" + text).encode())
    cut(16)
    with pytest.raises(Exception, match=fault):
        by_ranges(spark, str(path))
