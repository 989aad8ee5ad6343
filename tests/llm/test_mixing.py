"""Mixing: targets against plain water filling, and what is taken."""

import random
import re
from collections import Counter

import pytest

from tallyhouse.llm import mixing
from tallyhouse.llm.queries import op7_mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(size, mix):
    sources = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: mix.weights[i % len(mix.weights)] for i, s in enumerate(sources)}
    total, capped = mix.share * sum(size.values()), set()
    while True:
        rest = total - sum(mix.most * size[s] for s in capped)
        open_ = sum(weight[s] for s in sources if s not in capped)
        target = {s: mix.most * size[s] if s in capped else rest * weight[s] / open_ for s in sources}
        over = {s for s in sources if s not in capped and target[s] > mix.most * size[s]}
        if not over:
            return target
        capped |= over


def rows_of(n, sources, seed=1, longest=200):
    random.seed(seed)
    return [(i, "w " * random.randint(0, longest), random.choice(sources)) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, size string, block int")


@pytest.mark.parametrize("n, sources", [(600, ["a", "b", "c", None]), (400, ["b"]), (500, [f"s{i}" for i in range(9)] + ["", "ü", "Z"]), (7, ["a", "b", None])])
def test_targets_and_words_taken(spark, n, sources):
    rows, mix = rows_of(n, sources), mixing.Mix()
    size = Counter()
    for _, text, source in rows:
        size[source] += len(WORD.findall(text))
    expected = plain_targets(size, mix)
    got = mixing.taken(frame(spark, rows)).collect()
    by_id = {r[0]: r for r in rows}
    words = Counter()
    assert len(got) == n
    for r in got:
        _, text, source = by_id[r.doc_id]
        assert (r.size, r.source_size) == (len(WORD.findall(text)), size[source])
        assert r.target == pytest.approx(expected[source]) and r.taken in (0, r.size, 2 * r.size)
        words[source] += r.taken
    for source in size:
        assert abs(words[source] - expected[source]) <= max(0.05 * expected[source], 200)


def test_one_hot_source_and_a_small_one(spark):
    rows = [(i, "w " * 100, "big") for i in range(900)] + [(1000 + i, "v " * 10, "tiny") for i in range(5)]
    got = mixing.taken(frame(spark, rows)).collect()
    assert sum(r.taken for r in got if r.doc_id >= 1000) == 100  # twice all it has
    assert abs(sum(r.taken for r in got if r.doc_id < 1000) - (1.5 * 90050 - 100)) <= 100


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "x y", None), (None, "x y", None), (3, "one", "b"), (3, "one", "b"), (4, "w " * 50000, "b")]
    got = mixing.taken(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len(WORD.findall(t or ""))) for i, t, _ in rows)
    assert all(r.taken <= 2 * r.size for r in got)


def test_empty_tables(spark):
    assert mixing.taken(frame(spark, [])).collect() == []
    assert mixing.mixed(frame(spark, [])).collect() == []
    nothing = mixing.taken(frame(spark, [(1, None, None)])).collect()
    assert [(r.size, r.target, r.taken) for r in nothing] == [(0, 0.0, 0)]


def test_mixed_rows_are_those_taken(spark):
    rows = rows_of(500, ["a", "b", "c", None])
    df, mix = frame(spark, rows), mixing.Mix(shards=5)
    got = mixing.mixed(df, mix)
    assert got.columns == [*df.columns, "shard"]
    times = Counter(r.doc_id for r in got.collect())
    taken = {r.doc_id: r for r in mixing.taken(df, mix).collect()}
    for i, r in taken.items():
        if r.size:
            assert times[i] * r.size == r.taken
    assert set(r.shard for r in got.select("shard").distinct().collect()) == set(range(5))
    again = [tuple(r) for r in mixing.mixed(df, mix).collect()]
    assert sorted(map(str, again)) == sorted(map(str, (tuple(r) for r in got.collect())))


def test_fills_that_were_taken_already_are_mixed_twice(spark):
    """Few blocks and targets below the sources' sizes: fills fall on rows that the last block has taken."""
    df, mix = frame(spark, rows_of(120, ["a", "b", "c"])), mixing.Mix(share=0.5, blocks=2, shards=3)
    times = Counter(r.doc_id for r in mixing.mixed(df, mix).collect())
    taken = {r.doc_id: r for r in mixing.taken(df, mix).collect()}
    assert any(r.size and r.taken == 2 * r.size for r in taken.values())
    assert all(times[i] * r.size == r.taken for i, r in taken.items() if r.size)


@pytest.mark.parametrize("shards", [1, 2, 5, 64])
def test_splitting_tree(spark, shards):
    """Every block copy goes to one shard, shards are of equal size, and sources mix as the law of the urn says."""
    rows, mix = rows_of(800, ["a", "b", "c"]), mixing.Mix(shards=shards, blocks=300)
    sized = frame(spark, rows).select("doc_id", "source", mixing.word_count().alias("size"))
    plan = mixing.plan(sized, mix)
    tokens = plan.shards.collect()
    keys = Counter((t.sid, t.block, t.copy) for t in tokens)
    assert max(keys.values()) == 1
    per_shard = Counter(t.shard for t in tokens)
    assert set(per_shard) <= set(range(shards)) and max(per_shard.values()) - min(per_shard.values()) <= max(1, shards.bit_length())
    drawn = Counter(t.sid for t in tokens)
    by_node = Counter((t.sid, t.shard < shards // 2) for t in tokens)
    for sid, k in drawn.items():
        left = by_node[sid, True] / max(1, sum(n for (_, side), n in by_node.items() if side))
        if shards > 1:
            assert abs(left - k / len(tokens)) < 0.15


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    size = Counter()
    for d in docs:
        size[d.source] += len(WORD.findall(d.text or ""))
    expected, words = plain_targets(size, mixing.Mix()), Counter()
    source = {d.doc_id: d.source for d in docs}
    for r in op7_mixing(spark, folder).collect():
        assert r.target == pytest.approx(expected[source[r.doc_id]])
        words[source[r.doc_id]] += r.taken
    assert all(abs(words[s] - t) <= 0.03 * t for s, t in expected.items())


def test_native(spark):
    plan = op7_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
