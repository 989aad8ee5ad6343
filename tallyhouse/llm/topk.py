"""Exact top-k search by inner product over an impact-ordered index.

Vectors are cut into blocks, and each block is indexed by itself: per dimension its postings in
descending order of the component, cut into segments of equal quantised impact. A query
takes the segments of all dimensions in rounds of descending impact, score at a time. What a vector can still gain is bounded by the
impact the round has come down to, so vectors are ruled out by proof only; those
that remain possible are scored exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import kept

LEVELS = 256
ROUNDS = 8
#: Largest component after scaling; one beyond it counts as this.
MOST = 1 << 61
#: Scores are 64-bit numbers; a greater sum is shown as the last one there is.
LAST = (1 << 63) - 1


def scaled(vectors: DataFrame, vector: str, by: int) -> Column:
    """floor(by * x) of every component; null if the vector or a component is null or not finite."""
    x = F.col(vector).cast("array<double>")
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    limit = lambda c: F.greatest(F.lit(float(-MOST)), F.least(F.lit(float(MOST)), c * by))
    return F.when(~odd, F.transform(x, lambda c: F.floor(limit(c)).cast("long")))


def matrix(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids in order and their vectors; of rows that share an id the greatest vector, shorter vectors filled with zeros."""
    best: dict[int, tuple] = {}
    for vec_id, vector in zip(rows["vec_id"], rows["v"], strict=True):
        best[vec_id] = max(best.get(vec_id, ()), tuple(vector)) if vec_id in best else tuple(vector)
    ids = np.array(sorted(best), np.int64)
    width = max(1, max((len(v) for v in best.values()), default=1))
    data = np.zeros((len(ids), width), np.int64)
    for i, vec_id in enumerate(ids.tolist()):
        data[i, : len(best[vec_id])] = best[vec_id]
    return ids, data


def narrow(data: np.ndarray) -> np.ndarray:
    """The numbers in 32 bits where they fit."""
    return data.astype(np.int32) if not data.size or (data.min() >= -(1 << 31) and data.max() < 1 << 31) else data


@dataclass
class Block:
    """The index of one block.

    ``order[d]``: rows by descending component d; ``level[d]``: their quantised impact in that order;
    ``upto[d, l]``: how many postings of d have level l or more.
    """

    ids: np.ndarray
    data: np.ndarray
    order: np.ndarray
    level: np.ndarray
    upto: np.ndarray
    low: np.ndarray
    step: np.ndarray

    @classmethod
    def build(cls, ids: np.ndarray, data: np.ndarray) -> Block:
        low = data.min(axis=0)
        step = (data.max(axis=0) - low + 1) / LEVELS
        order = np.argsort(-data, axis=0, kind="stable").T
        level = np.minimum((np.take_along_axis(data.T, order, axis=1) - low[:, None]) / step[:, None], LEVELS - 1).astype(np.uint8)
        upto = np.stack([len(ids) - np.searchsorted(row[::-1], np.arange(LEVELS + 1)) for row in level.astype(np.int32)])
        return cls(ids, narrow(data), order.astype(np.uint32), level, upto.astype(np.int64), low, step)

    FIELDS = {"ids": np.int64, "data": np.int32, "order": np.uint32, "level": np.uint8, "upto": np.int64, "low": np.int64, "step": np.float64}

    def stored(self) -> dict[str, bytes]:
        kinds = self.FIELDS | {"data": self.data.dtype}
        return {name: np.ascontiguousarray(getattr(self, name), kind).tobytes() for name, kind in kinds.items()}

    @classmethod
    def load(cls, row: pd.Series) -> Block:
        n, width = len(row["ids"]) // 8, len(row["low"]) // 8
        wide = len(row["data"]) > 4 * n * width
        kinds = cls.FIELDS | ({"data": np.int64} if wide else {})
        arrays = {name: np.frombuffer(row[name], kind) for name, kind in kinds.items()}
        for name, shape in (("data", (n, width)), ("order", (width, n)), ("level", (width, n)), ("upto", (width, LEVELS + 1))):
            arrays[name] = arrays[name].reshape(shape)
        return cls(**arrays)

    def search(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows other than ``own``, by score, then by id."""
        n, width = self.data.shape
        q = np.zeros(width, np.int64)
        q[: min(width, len(query))] = query[:width]
        valid = np.ones(n, bool)
        valid[self.ids == own] = False
        possible = valid
        if valid.sum() > k:
            possible = self.possible(q, valid, k)
        rows = np.flatnonzero(possible)
        # The last 64 bits of a sum are right whatever happens on the way, so only its own size matters.
        ends = np.maximum(np.abs(self.low.astype(np.float64)), np.abs(self.low + self.step * LEVELS))
        if float(ends @ np.abs(q.astype(np.float64))) < float(1 << 62):
            scores = self.data[rows].astype(np.int64) @ q
        else:
            whole = q.tolist()
            exact = [sum(a * b for a, b in zip(row, whole)) for row in self.data[rows].tolist()]
            scores = np.array([max(-LAST, min(LAST, x)) for x in exact], np.int64)
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[best]], scores[best]

    def possible(self, q: np.ndarray, valid: np.ndarray, k: int) -> np.ndarray:
        """The rows that may be among the k best, found by descending impact.

        A posting's impact is |q| times the distance of its component from the end of the range that scores least. ``gained`` adds
        up the least impact of the segments seen, so a row's sum lies between ``gained`` and ``gained`` plus the width of the
        segments plus what its unseen dimensions can hold, at most ``bar`` each.
        """
        n = len(valid)
        weight = np.abs(q).astype(np.float64)
        used = np.flatnonzero(weight)
        spread = self.step * LEVELS
        unit = weight * self.step
        top = weight * spread
        width = float(unit.sum()) + 1e-9 * float(top.sum()) + 1.0
        gained, seen = np.zeros(n), np.zeros(n, np.int64)
        done = np.where(q > 0, 0, n)
        for turn in range(ROUNDS):
            bar = float(top.max(initial=0.0)) * (1 - (turn + 1) / ROUNDS)
            rows, impacts = [], []
            for d in used.tolist():
                if q[d] > 0:
                    reach = int(self.upto[d, min(LEVELS, int(bar / unit[d]))]) if bar > 0 else n
                    part = slice(done[d], max(reach, done[d]))
                    impact = self.level[d, part] * unit[d]
                    done[d] = part.stop
                else:
                    cut = min(LEVELS, max(0, int(np.ceil((spread[d] - bar / weight[d]) / self.step[d]))))
                    reach = int(self.upto[d, cut]) if bar > 0 else 0
                    part = slice(min(reach, done[d]), done[d])
                    impact = (LEVELS - 1.0 - self.level[d, part]) * unit[d]
                    done[d] = part.start
                rows.append(self.order[d, part])
                impacts.append(impact)
            if rows:
                at = np.concatenate(rows)
                gained += np.bincount(at, weights=np.concatenate(impacts), minlength=n)
                seen += np.bincount(at, minlength=n)
            unseen = np.minimum((len(used) - seen) * bar, float(np.minimum(top, bar).sum()))
            floor = np.partition(gained[valid], len(gained[valid]) - k)[-k]
            possible = valid & (gained + width + unseen >= floor)
            if possible.sum() <= max(4 * k, n // 64):
                break
        return possible


def index(vectors: DataFrame, blocks: int) -> DataFrame:
    """The impact-ordered index of ``vectors`` (vec_id, v): one row per block."""
    schema = "block long, " + ", ".join(f"{name} binary" for name in Block.FIELDS)

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"block": key[0]} | Block.build(*matrix(rows)).stored()])

    return vectors.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block")).applyInPandas(build, schema)


def search(
    vectors: DataFrame, queries: Column, k: int, vector: str = "embedding", by: int = 1024, block_rows: int = 16384, query_rows: int = 1024
) -> DataFrame:
    """The k best inner products of every query with all other rows: query_id, rank, vec_id, score.

    ``vectors`` has vec_id and a vector, whose components become floor(by * x), at most 2^61 either way; a score
    beyond 64 bits is shown as the last number of its sign there is. ``queries`` picks the
    query rows by vec_id. Every row but the query's own is a candidate; ties go to the smaller vec_id. Vectors
    that are null or hold null or non-finite components, and rows without vec_id, take no part. Rows that share a vec_id count
    as one, with the greatest of their vectors. A vector counts as zero beyond its length. Fewer candidates than k
    give fewer rows, an empty table none. Other columns are not read.

    Index and queries meet block by block: each index block is copied once per block of queries and each
    block of queries once per index block, and only k rows per query and index block leave a task.
    """
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), scaled(vectors, vector, by).alias("v"))
    usable = kept(usable.where("vec_id is not null and v is not null"), "scaled")
    asked = usable.where(queries)
    n, m = usable.count(), asked.count()
    blocks, query_blocks = max(1, -(-n // block_rows)), max(1, -(-m // query_rows))
    built = kept(index(usable, blocks), "impact_index")

    def score(key: tuple, stored: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found: list[pd.DataFrame] = []
        if len(stored) and len(rows):
            block = Block.load(stored.iloc[0])
            ids, data = matrix(rows)
            for own, query in zip(ids.tolist(), data.astype(np.int64), strict=True):
                vec_ids, scores = block.search(own, query, k)
                found.append(pd.DataFrame({"query_id": own, "vec_id": vec_ids, "score": scores}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    cells = built.withColumn("query_block", F.explode(F.expr(f"sequence(0L, {query_blocks - 1}L)")))
    copies = asked.withColumn("query_block", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks))).withColumn(
        "block", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)"))
    )
    on = ["block", "query_block"]
    best = cells.groupBy(*on).cogroup(copies.groupBy(*on)).applyInPandas(score, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


