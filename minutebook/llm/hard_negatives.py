"""Hard negatives from R-trees packed in sort-tile-recursive order.

Vectors are dealt into blocks, and each block gets an R-tree: rows are parted by label, sorted along the component that varies most, cut
into slabs, and each slab again along the next component, until a tile fills a leaf; runs of neighbouring boxes make the boxes above. A box
has the least and greatest value of every component and of the label. For an anchor, the interval of each component times the
anchor's own gives an interval of inner products, which no row of the box can leave. Boxes wait in a queue, the one with the highest
bound first. A box is passed over if its interval misses all score windows asked for, if its bound lies strictly below the kth score so
far of each, or if its labels cannot serve; the search ends when the best bound left is too low for all. Leaves are scored in rounds, the
first one alone and in each round twice as many as before, as they come from the queue: where bounds tell little and most leaves are scored, an anchor costs
a few array operations and not one for each leaf and window, and where they tell much, at most about twice the leaves are scored.

The job runs twice: first for the best rows of the anchor's own label, without a window, then for the others, with one window per
positive. Anchors meet the blocks in groups of bounded size, and what the blocks found is merged by a ranked window.

Defined results: rows without id, label or components take no part (components are NULL where a vector is NULL or holds anything that is not
a finite number); vectors of each length are searched among themselves; rows equal in id, label and vector count once, others that share an
id are rows, and anchors, of their own, but no row is compared with one of its own id; ties go to the smaller id; an anchor
without positives, or a positive without negatives in its window, gives no rows; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from minutebook.llm.common import staged

BLOCK_ROWS = 32_768  # in a block at most, by expectation
LEAST_ROWS = 2_048  # in a block, if the table has more
ANCHOR_ROWS = 16_384  # anchors that meet a block at once
LEAF, FAN = 64, 16  # rows in a leaf, boxes in a box
EVERY = (-(1 << 62), 1 << 62)  # a window for all scores
FOUND = "anchor long, window int, vec_id long, score long"


def tiles(vectors: np.ndarray, rows: np.ndarray, dims: np.ndarray, leaf: int) -> Iterator[np.ndarray]:
    """The rows in tiles of at most ``leaf``, cut along the dimensions in turn."""
    pages = -(-len(rows) // leaf)
    if pages <= 1 or not len(dims):
        for at in range(0, len(rows), leaf):
            yield rows[at:at + leaf]
        return
    slabs = int(np.ceil(round(pages ** (1 / len(dims)), 9)))
    width = leaf * -(-pages // slabs)
    rows = rows[np.argsort(vectors[rows, dims[0]], kind="stable")]
    for at in range(0, len(rows), width):
        yield from tiles(vectors, rows[at:at + width], dims[1:], leaf)


class PackedTree:
    """An R-tree over the rows of one block."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, leaf: int = LEAF, fan: int = FAN):
        by_label = np.argsort(labels, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(labels[by_label]) != 0])
        dims = np.argsort(-vectors.astype(np.float64).var(0), kind="stable")
        parts: list[np.ndarray] = []
        few: list[np.ndarray] = []  # labels too small for leaves of their own share some
        for part in np.split(by_label, starts[1:]):
            if len(part) >= leaf // 2:
                parts.extend(tiles(vectors, part, dims, leaf))
            else:
                few.append(part)
        if few:
            rest = np.concatenate(few)
            parts.extend(rest[at:at + leaf] for at in range(0, len(rest), leaf))
        order = np.concatenate(parts)
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        ends = np.cumsum([len(p) for p in parts])
        low, high = [], []
        boxes = [self._box(a, b) for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True)]
        self.leaves = len(boxes)
        self.children = [(int(a), int(b)) for a, b in zip(np.r_[0, ends[:-1]], ends, strict=True)]
        first, end = 0, len(boxes)
        while end - first > 1:
            for at in range(first, end, fan):
                to = min(at + fan, end)
                boxes.append(tuple(f([b[k] for b in boxes[at:to]], axis=0) for k, f in enumerate((np.min, np.max, np.min, np.max))))
                self.children.append((at, to))
            first, end = end, len(boxes)
        low, high, self.first_label, self.last_label = zip(*boxes, strict=True)
        self.low, self.high = np.stack(low), np.stack(high)
        self.first_label, self.last_label = np.array(self.first_label), np.array(self.last_label)
        self.places = np.arange(len(order))
        self.opened = self.scored = self.rounds = 0  # boxes and rows looked into, and rounds, for measurements

    def _box(self, a: int, b: int) -> tuple:
        rows, labels = self.vectors[a:b], self.labels[a:b]
        return rows.min(0), rows.max(0), labels.min(), labels.max()

    def search(self, anchor_id: int, label: int, query: np.ndarray, windows: list[tuple[int, int]], k: int, same: bool) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and scores of the k best rows in each score window, of the anchor's label or of all others."""
        up, down = np.maximum(query, 0), np.minimum(query, 0)
        bound = (self.high @ up + self.low @ down).tolist()
        least = (self.low @ up + self.high @ down).tolist()
        serves = (self.first_label <= label) & (label <= self.last_label)
        if not same:
            serves = (self.first_label != label) | (self.last_label != label)
        serves = serves.tolist()
        best = [(np.empty(0, np.int64), np.empty(0, query.dtype))] * len(windows)
        floor = [low for low, _ in windows]  # what a score must reach
        top = len(bound) - 1
        queue = [(-bound[top], top)] if serves[top] else []
        ahead = 1  # leaves of the next round
        while queue:
            leaves: list[tuple[int, int]] = []
            least_floor = min(floor)
            while queue and len(leaves) < ahead:
                reach, node = heappop(queue)
                reach = -reach
                if reach < least_floor:
                    queue.clear()
                    break
                if not any(least[node] <= high and reach >= floor[w] for w, (_, high) in enumerate(windows)):
                    continue
                self.opened += 1
                a, b = self.children[node]
                if node < self.leaves:
                    leaves.append((a, b))
                    continue
                for child in range(a, b):
                    if serves[child] and bound[child] >= least_floor:
                        heappush(queue, (-bound[child], child))
            if not leaves:
                break
            self.rounds += 1
            ahead *= 2
            scores = np.concatenate([self.vectors[a:b] @ query for a, b in leaves])
            places = np.concatenate([self.places[a:b] for a, b in leaves])
            self.scored += len(places)
            high_enough = np.flatnonzero(scores >= least_floor)
            scores, places = scores[high_enough], places[high_enough]
            fits = (self.ids[places] != anchor_id) & ((self.labels[places] == label) == same)
            scores, found = scores[fits], self.ids[places[fits]]
            for w, (_, high) in enumerate(windows):
                at = np.flatnonzero((scores >= floor[w]) & (scores <= high))
                if len(at):
                    ids, values = np.r_[best[w][0], found[at]], np.r_[best[w][1], scores[at]]
                    if len(ids) >= k:
                        order = np.lexsort((ids, -values))[:k]
                        ids, values = ids[order], values[order]
                        floor[w] = values[-1]
                    best[w] = ids, values
        return best


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten()).reshape(len(column), size)


def _searched(vectors: DataFrame, anchors: DataFrame, k: int, same: bool, blocks: int, groups: int, whole: bool) -> DataFrame:
    """anchor, window, vec_id and score: the k best of each block. ``anchors`` has lows and highs, the ends of their windows."""
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda column, n: F.pmod(F.xxhash64(column), F.lit(n)).cast("int")
    size = F.size("components").alias("size")
    candidates = vectors.select("vec_id", "label", "components", size, dealt("row", blocks).alias("block"), each(groups).alias("part"))
    asked = anchors.select("anchor", "vec_id", "label", "components", "lows", "highs", size, each(blocks).alias("block"), dealt("anchor", groups).alias("part"))
    kind = np.float64 if whole else np.int64

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(left) and len(right):
            n = left["size"][0].as_py()
            tree = PackedTree(np.asarray(left["vec_id"]), np.asarray(left["label"]), _matrix(left["components"], n).astype(kind))
            queries = _matrix(right["components"], n).astype(kind)
            rest = (right[c].to_pylist() for c in ("anchor", "vec_id", "label", "lows", "highs"))
            for query, anchor, vec_id, label, lows, highs in zip(queries, *rest, strict=True):
                found = tree.search(vec_id, label, query, list(zip(lows, highs, strict=True)), k, same)
                for w, (ids, scores) in enumerate(found):
                    out += [(anchor, w, i, int(s)) for i, s in zip(ids.tolist(), scores.tolist(), strict=True)]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        columns = zip(*out, strict=True) if out else ((), (), (), ())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["anchor", "window", "vec_id", "score"])

    keys = ["size", "block", "part"]
    return candidates.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, FOUND)


def mine(
    rows: DataFrame, anchors: str, positives: int = 5, negatives: int = 3, low_percent: int = 50, high_percent: int = 95,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``rows`` has vec_id, label and components (longs, see ``topk.whole_components``); ``anchors`` is the condition on vec_id and
    label that makes a row an anchor. A negative's score lies between ``low_percent`` and ``high_percent`` of its positive's, both included.
    """
    spark = rows.sparkSession
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "components")
    rows = rows.where("vec_id is not null and label is not null and components is not null").distinct()
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, high, longest = rows.agg(
        F.count(F.lit(1)), F.max(F.expr("aggregate(components, 0L, (m, x) -> greatest(m, abs(x)))")), F.max(F.size("components"))
    ).first()
    asked = staged(rows.where(anchors).withColumnRenamed("row", "anchor"), "anchors")
    per_block = min(BLOCK_ROWS, max(LEAST_ROWS, n // int(spark.conf.get("spark.sql.shuffle.partitions"))))
    blocks, groups = max(1, -(-n // per_block)), max(1, -(-asked.count() // ANCHOR_ROWS))
    # doubles hold all scores and bounds exactly up to 2**53, which lets the products run in compiled loops
    whole = (high or 0) ** 2 * max(longest or 0, 1) < 2**53

    every = [F.array(F.lit(end)).alias(name) for end, name in zip(EVERY, ("lows", "highs"), strict=True)]
    near = _searched(rows, asked.select("*", *every), positives, True, blocks, groups, whole)
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives)
    # at most ``positives`` entries an anchor
    pairs = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("pairs"))
    pairs = staged(pairs.join(asked, "anchor"), "positives")
    scores = F.col("pairs.score")
    windowed = pairs.select(
        "anchor", "vec_id", "label", "components",
        F.transform(scores, lambda s: F.ceil(s * low_percent / F.lit(100).cast("decimal(3,0)")).cast("long")).alias("lows"),
        F.transform(scores, lambda s: F.floor(s * high_percent / F.lit(100).cast("decimal(3,0)")).cast("long")).alias("highs"),
    )
    hard = _searched(rows, windowed, negatives, False, blocks, groups, whole)
    ranked = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id")
    hard = hard.withColumn("rank", F.row_number().over(ranked).cast("int")).where(F.col("rank") <= negatives)
    named = pairs.select(
        F.col("anchor").alias("of"), F.col("vec_id").alias("anchor_id"), F.posexplode("pairs").alias("at", "pair")
    )
    return hard.join(named, (F.col("anchor") == F.col("of")) & (F.col("window") == F.col("at"))).select(
        "anchor_id", F.col("pair.vec_id").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("pair.score").alias("positive_score"), F.col("score").alias("negative_score"),
    )
