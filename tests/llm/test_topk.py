"""Top-k search against all inner products."""

import math

import numpy as np
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from tallyhouse.llm import topk
from tallyhouse.llm.queries import op2_topk, oracle_sql


def brute(rows, is_query, k):
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            scaled = [max(-topk.MOST, min(topk.MOST, math.floor(1024 * x))) for x in v]
            usable[i] = max(usable[i], scaled) if i in usable else scaled
    out = set()
    for q, a in usable.items():
        if is_query(q):
            score = lambda b: max(-topk.LAST, min(topk.LAST, sum(x * y for x, y in zip(a, b))))  # noqa: E731, B023
            best = sorted((-score(b), i) for i, b in usable.items() if i != q)[:k]
            out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)}
    return out


def found(df):
    rows = [(r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_odd_rows_ties_and_blocks(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8).round(1)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(60)]  # ties
    rows += [(400, None), (401, [1.0, None] + [0.0] * 6), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (None, rows[0][1])]
    rows += [(404, [1e30, -1e30] + [0.0] * 6), (405, [2.0, 1.0]), (406, []), (10, rows[10][1]), (20, [9.0] * 8), (410, [0.0] * 8)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, score string, rank int")
    got = topk.search(df, F.col("vec_id") % 10 == 0, 10, block_rows=70, query_rows=9)
    assert found(got) == brute(rows, lambda i: i % 10 == 0, 10)


def test_fewer_rows_than_k(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, -1.0]), (100, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert found(topk.search(df, F.col("vec_id") % 100 == 0, 10)) == brute([(0, [1.0, 2.0]), (1, [3.0, -1.0]), (100, [0.5, 0.5])], lambda i: i % 100 == 0, 10)


@pytest.mark.parametrize("rows", [[], [(1, [1.0])], [(0, [1.0])]])
def test_empty_results(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert topk.search(df, F.col("vec_id") % 100 == 0, 10).collect() == []


def test_rows_are_ruled_out_by_proof():
    """Long-tailed components let the search stop early, and what it rules out is right."""
    rng = np.random.default_rng(5)
    data = (rng.standard_t(2, size=(3000, 16)) * 100).astype(np.int32)
    block = topk.Block.build(np.arange(3000), data)
    few = 0
    for own in range(0, 3000, 500):
        q = data[own].astype(np.int64)
        valid = np.arange(3000) != own
        possible = block.possible(q, valid, 10)
        scores = data.astype(np.int64) @ q
        kth = np.sort(scores[valid])[-10]
        assert possible[valid & (scores >= kth)].all()
        few += possible.sum() < 1500
    assert few


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert found(op2_topk(spark, folder)) == brute(rows, lambda i: i % 100 == 0, 10)


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert difference(op2_topk(spark, folder), connect(folder), oracle_sql()["op2_topk"]) == ""


def test_large_components(spark):
    """Components from 1e5 to 1e9 and beyond, repeated ids and unequal lengths, against whole numbers of any size."""
    import math
    import random

    rng = random.Random(5)
    rows = [(i, [rng.choice([-1, 1]) * 10 ** rng.uniform(-1, rng.choice([5, 9])) for _ in range(rng.choice([2, 3, 4]))]) for i in range(0, 700, 7)]
    rows += [(0, [1.0, 0.0]), (1, [200000.0, 0.0]), (2, [150000.0, 0.0]), (3, [1e300, 1.0]), (4, [-1e300, 1.0])]
    best = {}
    for i, v in rows:
        v = tuple(max(-(1 << 61), min(1 << 61, math.floor(1024 * x))) for x in v)
        best[i] = max(best.get(i, v), v)
    last = (1 << 63) - 1
    expected = {}
    for q, v in best.items():
        if q % 100 == 0:
            scores = [(-max(-last, min(last, sum(a * b for a, b in zip(v, w)))), i) for i, w in best.items() if i != q]
            expected |= {(q, r + 1): (i, -score) for r, (score, i) in enumerate(sorted(scores)[:10])}
    for block in (16384, 20):
        got = topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0, 10, block_rows=block)
        assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in got.collect()} == expected


def test_scores_that_were_clipped_once(spark):
    rows = [(0, [1.0, 0.0]), (1, [200000.0, 0.0]), (2, [150000.0, 0.0])]
    got = topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, 10).collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 209715200000), (2, 157286400000)]
