"""Fingerprints, links and groups against brute force."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tallyhouse.llm import simhash
from tallyhouse.llm.queries import op8_simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text, width=3):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_groups(fps, bits):
    """fps: list of (doc_id, fingerprint); the smallest id reachable, by entry."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= bits:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(fps):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [least.get(find(i)) for i in range(len(fps))]


TEXTS = [None, "", " \n ", "One", "one", "a b", "a b c", "A B C", "a b c d", "a b c a b c a b c", "ÀÉ été a b c", "w " * 30000, "a  b\tc"]


def test_fingerprints_and_groups(spark):
    rows = [(i + 5, t, "x", 1) for i, t in enumerate(TEXTS)] + [(None, "a b c", "x", 1), (None, "alone here now", "x", 1), (5, None, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    got = simhash.digests(simhash.near_groups(df, 3, 2)).collect()
    fps = [(i, plain_fingerprint(t)) for i, t, _, _ in rows]
    expected = [(str(i), f"{f:016x}", c) for (i, f), c in zip(fps, plain_groups(fps, 2))]
    assert sorted(str((str(r.doc_id), r.fingerprint, r.component_id)) for r in got) == sorted(map(str, expected))


def near_fingerprints(seed, crowded):
    random.seed(seed)
    fps = {random.getrandbits(64) for _ in range(60)}
    for base in random.sample(sorted(fps), 12):
        x = base
        for _ in range(12):  # chains of one to three flips
            for _ in range(random.randint(1, 3)):
                x ^= 1 << random.randrange(64)
            fps.add(x)
    if crowded:  # many entries that share one half
        half = random.getrandbits(32) << 32
        fps |= {half | random.getrandbits(6) << 3 for _ in range(80)}
    return sorted(fps | {0, (1 << 64) - 1, 1 << 63})


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
@pytest.mark.parametrize("crowd", [512, 3])
def test_links(spark, bits, crowd):
    fps = near_fingerprints(bits, crowded=True)
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    if bits == 3 and crowd == 3:
        df = df.limit(40)
        fps = sorted(r.fp & (2**64 - 1) for r in df.collect())
        df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    got = [(r.a, r.b) for r in simhash.links(df, bits, crowd).collect()]
    pairs = {tuple(sorted((signed(x), signed(y)))) for i, x in enumerate(fps) for y in fps[:i] if (x ^ y).bit_count() <= bits}
    assert len(got) == len(set(got)) and set(got) == pairs


def test_too_many_bits(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.range(1).select(F.col("id").alias("fp")), 4)


def test_roots_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 202), (201, 202), (201, 203)]
    got = {r.node: r.root for r in simhash.roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200, 202: 200, 203: 200}


def test_one_of_each(spark):
    rows = [(3, "a b c d"), (1, "A b c d"), (2, "quite another text"), (2, "quite another text"), (None, "a b c d"), (7, None), (8, "")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, component_id string, goes int")
    got = simhash.one_of_each(df, 3, 2)
    assert got.columns == df.columns
    assert sorted(str(r.doc_id) for r in got.collect()) == ["1", "2", "7"]


def test_one_of_each_loses_no_text_of_a_shared_or_missing_id(spark, tmp_path):
    texts = ["first words of one", "some other matter here", "first words of one", "no id at all", "no id at all", "yet another text", "some other matter here"]
    ids = [1, 1, 1, None, None, None, 4]
    spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    for df in (docs, docs.select("doc_id", "text"), docs.union(docs)):
        got = simhash.one_of_each(df, 3, 2).collect()
        assert sorted((str(r.doc_id), r.text) for r in got) == sorted(
            [("1", texts[0]), ("1", texts[1]), ("None", texts[3]), ("None", texts[5])]
        )
        assert sorted(map(str, simhash.one_of_each(df, 3, 2).collect())) == sorted(map(str, got))  # a rerun keeps the same rows
    assert "texts-" not in simhash.one_of_each(docs.select("doc_id", "text"), 3, 2)._jdf.queryExecution().toString()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_groups(df, 3, 2).collect() == [] and simhash.one_of_each(df, 3, 2).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    fps = [(r.doc_id, plain_fingerprint(r.text)) for r in docs]
    expected = {(i, f"{f:016x}", c) for (i, f), c in zip(fps, plain_groups(fps, 2))}
    assert {tuple(r) for r in op8_simhash(spark, folder).collect()} == expected
