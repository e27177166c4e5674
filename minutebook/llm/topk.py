"""Exact top-k search by inner product with the threshold algorithm.

Vectors are cut into blocks. Inside a block every dimension has a list of the vectors sorted by that component. A query walks
all lists from its favourable end (the top where its own component is positive, the bottom where it is negative), scores each vector that
turns up, and stops when no unseen vector can reach the kth score: at depth t an unseen vector scores at most the sum of the
query's components times the lists' values at t. Depth doubles from step to step, so a query costs a few array operations.
Queries meet the blocks in groups of bounded size; the best k of each block are merged by a ranked window. Components are whole
numbers, so scores are exact.

Defined results: vectors that are NULL, or hold NULL or non-finite components take no part; vectors of each length, empty ones too, are searched
among themselves, in one job; equal vectors are each found, ties to the smaller id; rows equal in id and vector count once, rows that share an id but not a vector are candidates (or queries) of their own;
a query is never its own result, nor is another row of its id; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minutebook.llm.common import staged

BLOCK_ROWS = 8_192
QUERY_ROWS = 2_048
FIRST_DEPTH = 16
RESULT = "query_id long, vec_id long, score long"


def whole_components(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component as a long; NULL if any is no finite number."""
    numbers = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(numbers, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.when(fine, F.transform(numbers, lambda x: F.floor(x * scale).cast("long")))


class ThresholdIndex:
    """Sorted lists of one block of vectors (rows), ids ascending."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.up = np.argsort(self.vectors, axis=0, kind="stable").astype(np.int32)  # a list per column, smallest first

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best other vectors, ties to the smaller id."""
        n = len(self.ids)
        dims = np.flatnonzero(query)
        weight = query[dims]
        fresh = np.ones(n, bool)
        fresh[np.searchsorted(self.ids, query_id):np.searchsorted(self.ids, query_id, side="right")] = False
        best, scores = np.empty(0, np.int64), np.empty(0, query.dtype)
        depth, walked = FIRST_DEPTH, 0
        while True:
            if depth >= n or not len(dims):
                found, bound = np.flatnonzero(fresh), None
            else:
                span = np.arange(walked, depth)
                rows = np.where(weight > 0, n - 1 - span[:, None], span[:, None])
                listed = self.up[rows, dims]
                last = self.vectors[listed[-1], dims]
                bound = weight @ last
                seen = np.zeros(n, bool)
                seen[listed.ravel()] = True
                found = np.flatnonzero(seen & fresh)
            fresh[found] = False
            best = np.concatenate([best, found])
            # many rows are scored in place, few are picked out first
            more = (self.vectors @ query)[found] if 4 * len(found) > n else self.vectors[found] @ query
            scores = np.concatenate([scores, more])
            if len(scores) > k:
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                keep = scores >= kth
                best, scores = best[keep], scores[keep]
            if bound is None or (len(scores) >= k and scores.min() > bound):
                order = np.lexsort((self.ids[best], -scores))[:k]
                return self.ids[best[order]], scores[order].astype(np.int64)
            walked, depth = depth, depth * 2


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of each query, which have its length.

    Both tables have vec_id and ``components`` (longs, see ``whole_components``).
    """
    fine = lambda rows: rows.select(F.col("vec_id").cast("long").alias("vec_id"), "components").where("vec_id is not null and components is not null").distinct()
    vectors, queries = staged(fine(vectors), "vectors"), staged(fine(queries), "queries")
    size = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("components")).alias("dims"), F.max(F.expr("aggregate(components, 0L, (m, x) -> greatest(m, abs(x)))")).alias("high")).first()
    blocks = max(1, -(-size["n"] // BLOCK_ROWS))
    groups = max(1, -(-queries.count() // QUERY_ROWS))
    # Doubles hold the scores exactly up to 2**53, which lets the products run in compiled loops.
    kind = np.float64 if (size["high"] or 0) ** 2 * max(size["dims"] or 0, 1) < 2**53 else np.int64
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    length = F.size("components").alias("length")
    candidates = vectors.select("vec_id", "components", length, dealt(blocks).alias("block"), each(groups).alias("part"))
    asked = queries.select("vec_id", "components", length, each(blocks).alias("block"), dealt(groups).alias("part"))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        if len(left) and len(right):
            index = ThresholdIndex(left["vec_id"].to_numpy(), np.stack(left["components"].to_list()).astype(kind))
            for query_id, query in zip(right["vec_id"].tolist(), right["components"], strict=True):
                ids, scores = index.search(query_id, np.asarray(query).astype(kind), k)
                out.extend((query_id, i, s) for i, s in zip(ids.tolist(), scores.tolist(), strict=True))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    keys = ["length", "block", "part"]
    found = candidates.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(search, RESULT)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked).cast("int")).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
