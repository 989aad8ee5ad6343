"""Language model scores against plain Python."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyhouse.llm import ppm
from tallyhouse.llm.queries import op9_ppm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def is_held(i, folds=10):
    return i is None or zlib.crc32(str(i).encode()) % folds == 0


class PlainModel:
    """Prediction by partial matching as it is defined: escapes by the number of kinds, symbols of longer contexts excluded."""

    def __init__(self, texts, order=3):
        self.order, self.next = order, defaultdict(Counter)
        for text in texts:
            b = self.padded(text)
            for i in range(order, len(b)):
                for k in range(order + 1):
                    self.next[b[i - k : i]][b[i]] += 1

    def padded(self, text):
        return bytes([ppm.START] * self.order) + lower(text).encode() + bytes([ppm.END])

    def probability(self, context, symbol):
        p, excluded = 1.0, set()
        for k in range(self.order, -1, -1):
            seen = {s: n for s, n in self.next.get(context[self.order - k :], {}).items() if s not in excluded}
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if symbol in seen:
                return p * seen[symbol] / whole
            p *= len(seen) / whole
            excluded |= set(seen)
        return p / (255 - len(excluded))

    def score(self, text):
        b = self.padded(text)
        return sum(math.log10(self.probability(b[i - self.order : i], b[i])) for i in range(self.order, len(b)))


def plain(rows):
    taught = [t for i, t in rows if not is_held(i)]
    counts = Counter(w for t in taught for w in [*WORD.findall(lower(t)), "\0"])
    n, v = sum(counts.values()), len(counts)
    model = PlainModel(taught)
    for i, t in rows:
        words = [*WORD.findall(lower(t)), "\0"]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        yield i, is_held(i), len(words), sum(counts[w] > 0 for w in words), n, base, model.score(t)


def check(got, rows):
    assert len(got) == len(rows)
    key = lambda r: (str(r[0]), round(r[5], 6), round(r[6], 3))
    for g, e in zip(sorted(map(tuple, got), key=key), sorted(plain(rows), key=key), strict=True):
        assert g[:5] == e[:5]
        assert g[5] == pytest.approx(e[5], abs=1e-6) and g[6] == pytest.approx(e[6], rel=1e-4, abs=1e-3)


def test_odd_texts(spark):
    rows = [(i, f"The cat {i} sat on the mat, été {i % 3}.") for i in range(40)]
    rows += [(100, None), (101, ""), (102, " \n"), (103, "zzz ÿ 漢 🙂"), (None, "the cat"), (104, "AB ab aB"), (104, "AB ab aB"), (105, "x " * 30000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, score string, block int")
    check(ppm.score(df, settings=ppm.Settings(contexts=10**9)).collect(), rows)


@pytest.mark.parametrize("rows", [[], [(0, "held out")], [(None, None)]])
def test_little_or_nothing_to_learn(spark, rows):
    rows = [r for r in rows if is_held(r[0])]
    check(ppm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


def test_probabilities_sum_to_one(spark):
    texts = spark.createDataFrame([(bytearray(t.encode()),) for t in ("abracadabra", "a cat", "")], "utf8 binary")
    for contexts in (1, 5, 10**9):
        trie = ppm.train(ppm.gram_counts(texts), ppm.Settings(contexts=contexts))
        sums = (10.0 ** trie.lengths.astype(float))[:, : ppm.START].sum(axis=1)
        assert np.allclose(sums, 1.0, atol=1e-4)
        assert trie.rows().max() == len(trie.lengths) - 1


def test_rare_contexts_are_left_to_shorter_ones(spark):
    texts = spark.createDataFrame([(bytearray(b"abcabcabcabd"),)], "utf8 binary")
    trie = ppm.train(ppm.gram_counts(texts), ppm.Settings(contexts=6))
    assert len(trie.contexts[3]) < 5 and len(trie.contexts[1]) == 5  # a, b, c, d and the start


def test_rare_contexts_are_kept(spark):
    """Contexts far rarer than one in 20,000 symbols count, in a text that is learned and in one that is not."""
    rows = [(i, "ab " * 6000 + f"q{i}zx") for i in range(1, 9)] + [(20, "xyzzy quux"), (21, "xyzza"), (None, "xyzzy quuz q3zx"), (None, "zyx ab")]
    check(ppm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


def test_grams_over_batches(monkeypatch):
    monkeypatch.setattr(ppm.Grams, "MOST", 3)
    grams, total = ppm.Grams(), Counter()
    for text in (b"abcabc", b"xyz", b"abc"):
        grams.add(*ppm.symbols(text))
        if grams.full():
            for g, n in zip(*grams.taken()):
                total[int(g)] += int(n)
    for g, n in zip(*grams.taken()):
        total[int(g)] += int(n)
    plain_counts = Counter()
    for text in (b"abcabc", b"xyz", b"abc"):
        b = bytes([255] * 3) + text + bytes([254])
        plain_counts.update(int.from_bytes(b[i - 3 : i + 1], "big") for i in range(3, len(b)))
    assert total == plain_counts


def test_word_starts():
    for text in ("", " ", "a", " a b\x0bc\x1cd  ", "é è"):
        assert ppm.word_starts(text.encode()) == len(WORD.findall(text))


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = op9_ppm(spark, folder).collect()
    taught = Counter(w for d in docs if not is_held(d.doc_id) for w in [*WORD.findall(lower(d.text)), "\0"])
    n, v = sum(taught.values()), len(taught)
    text = {d.doc_id: d.text for d in docs}
    assert len(got) == len(docs)
    for r in got:
        words = [*WORD.findall(lower(text[r.doc_id])), "\0"]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (is_held(r.doc_id), len(words), sum(taught[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(sum(math.log10((taught[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words))
        assert r.score < 0
