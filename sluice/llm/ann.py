"""Approximate nearest neighbours by collision counting (operator 1).

The vectors are dealt to shards of about ``SHARD`` rows by the hash of their id. A shard sorts its
vectors by each of ``PROJECTIONS`` random projections and keeps the sorted values and, for each vector,
its place in the sorted array in 256ths. A query takes the window centred on its own projected value in
each array, and widens all windows step by step (virtual rehashing: the same arrays serve every radius)
until enough vectors lie in the windows of ``THRESHOLD`` of all projections. Those that collide most often
are verified, by their inner product with the query in double precision: ``VERIFIED`` of the shard, or
``EACH`` times as many as are asked for, or all there are. Windows of a block of queries are counted at
once, one array operation a projection.

Largest inner product becomes nearest distance by one more component, sqrt(M^2 - |x|^2) with M the
largest norm (0 for queries). Queries are a stated set, compared with all rows in blocks: every task
holds one shard and one block of at most some ``QUERIES`` queries, and returns ``k`` rows a query;
the best ``k`` of all shards are kept. No count of candidates is capped.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._tables import stored

SHARD = 16384
QUERIES = 1024
#: Collisions are counted in a byte, so at most 255.
PROJECTIONS = 240
THRESHOLD = 0.6
VERIFIED, EACH = 0.07, 25
#: First half width of a window, in parts of the projected values' deviation, and its growth.
WIDTH, GROWTH = 1.0, 1.1
#: Queries whose windows are counted at once.
TOGETHER = 8


class SortedProjections:
    """The sorted arrays of one shard."""

    def __init__(self, vectors: np.ndarray, largest: float, seed: int, projections: int = PROJECTIONS):
        rng = np.random.default_rng([seed, vectors.shape[1]])
        self.directions = rng.standard_normal((vectors.shape[1] + 1, projections))
        self.largest = largest
        self.n = len(vectors)
        norms = np.einsum("ij,ij->i", vectors, vectors)
        values = (vectors @ self.directions[:-1] + np.sqrt(np.maximum(largest**2 - norms, 0))[:, None] * self.directions[-1]).T
        order = np.argsort(values, axis=1, kind="stable")
        self.values = np.take_along_axis(values, order, axis=1)
        self.cells = np.empty(values.shape, np.uint8)
        np.put_along_axis(self.cells, order, self._cell(np.arange(self.n)).astype(np.uint8)[None, :], axis=1)
        self.spread = float(values.std(axis=1).mean()) or 1.0

    def _cell(self, place: np.ndarray) -> np.ndarray:
        return place * 256 // self.n

    def collisions(self, centres: np.ndarray, half: np.ndarray) -> np.ndarray:
        """In how many windows of each query (a row of ``centres``) each vector lies."""
        counts = np.zeros((len(centres), self.n), np.uint8)
        for p, (values, cells) in enumerate(zip(self.values, self.cells)):
            low = np.minimum(np.searchsorted(values, centres[:, p] - half), self.n - 1)
            high = np.maximum(np.searchsorted(values, centres[:, p] + half, side="right") - 1, low)
            first = self._cell(low)
            # bytes wrap around: a cell before the window is as far from its start as one behind it
            counts += cells - first.astype(np.uint8)[:, None] <= (self._cell(high) - first).astype(np.uint8)[:, None]
        return counts

    def candidates(self, queries: np.ndarray, enough: int, share: float) -> list[np.ndarray]:
        """For each query the rows that collide most often with it: at least ``enough`` (or all), each in
        ``share`` of the projections or more. Queries are scaled to the largest norm, which keeps their ranking."""
        sizes = np.sqrt(np.einsum("ij,ij->i", queries, queries))
        centres = (queries * (self.largest / sizes)[:, None]) @ self.directions[:-1]
        need, enough = math.ceil(share * centres.shape[1]), min(enough, self.n)
        half = np.full(len(queries), WIDTH * self.spread)
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
        left = np.arange(len(queries))
        while len(left):
            counts = self.collisions(centres[left], half[left])
            for row, k in zip(counts, left.tolist()):
                having = np.bincount(row, minlength=256)[::-1].cumsum()[::-1]  # vectors of so many collisions or more
                if having[need] >= enough:
                    out[k] = np.flatnonzero(row >= np.flatnonzero(having >= enough)[-1])
                    half[k] = 0
            left = left[half[left] > 0]
            half[left] *= GROWTH
        return out


def _search(k: int, seed: int, verified: float, share: float):
    empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})

    def run(key, asked: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(shard):
            return empty
        ids = shard["vec_id"].to_numpy(np.int64)
        vectors = np.stack(shard["v"].to_numpy()).astype(np.float64)
        index = SortedProjections(vectors, float(shard["largest"].iloc[0]), seed)
        queries, query_ids = np.stack(asked["v"].to_numpy()).astype(np.float64), asked["vec_id"].to_numpy(np.int64)
        enough = max(math.ceil(verified * len(ids)), EACH * k) + 1  # one more: the query itself
        asked_ids, found_ids, found_scores = [], [], []
        for lo in range(0, len(queries), TOGETHER):
            for query_id, query, found in zip(query_ids[lo : lo + TOGETHER], queries[lo : lo + TOGETHER], index.candidates(queries[lo : lo + TOGETHER], enough, share)):
                found = found[ids[found] != query_id]
                scores = (vectors[found] * query).sum(axis=1)
                best = np.lexsort((ids[found], -scores))[:k]
                asked_ids.append(np.full(len(best), query_id))
                found_ids.append(ids[found][best])
                found_scores.append(scores[best])
        return pd.DataFrame({"query_id": np.concatenate(asked_ids), "vec_id": np.concatenate(found_ids), "score": np.concatenate(found_scores)})

    return run


def nearest(rows: DataFrame, asked: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, seed: int = 17, verified: float = VERIFIED, share: float = THRESHOLD) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``asked`` the ``k`` nearest found among ``rows``.

    Vectors that are null, zero, or hold a null or non-finite component take no part, on either side,
    nor do rows with a null id. A query meets the vectors of its own length only, and never its own
    id. Rows that repeat an id count once, with their smallest vector. Ties go to the smaller id. Other
    columns are not read; without rows or queries the result is empty.
    """

    def usable(df: DataFrame) -> DataFrame:
        v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
        df = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
        finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
        df = df.where(finite).withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).where("norm2 > 0")
        return df.groupBy("vec_id").agg(F.min(F.struct("v", "norm2")).alias("s")).select("vec_id", F.size("s.v").alias("dim"), "s.v", "s.norm2")

    rows, asked = stored(usable(rows), "vectors"), stored(usable(asked), "queries")
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.sqrt(F.max("norm2")).alias("largest"))
    asks = asked.groupBy("dim").agg(F.count("*").alias("q"))
    plan = sizes.join(asks, "dim").select("dim", "largest", F.ceil(F.col("n") / SHARD).alias("shards"), F.ceil(F.col("q") / QUERIES).alias("blocks"))
    data = rows.join(plan, "dim").select("dim", F.pmod(F.xxhash64("vec_id"), "shards").alias("shard"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "vec_id", "v", "largest")
    ask = asked.join(plan, "dim").select("dim", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"), F.pmod(F.xxhash64("vec_id"), "blocks").alias("block"), "vec_id", "v")
    on = ["dim", "shard", "block"]
    found = ask.groupBy(*on).cogroup(data.groupBy(*on)).applyInPandas(_search(k, seed, verified, share), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
