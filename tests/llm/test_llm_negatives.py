"""Hard negatives against all pairs."""

import random

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from minutebook.llm import hard_negatives, queries, topk

SF = "/root/testdata/sf0.01"


def plain(rows, is_anchor, positives=5, negatives=3):
    """anchor_id, positive_id, rank, negative_id and scores by comparing all pairs."""
    rows, out = sorted(set(rows)), []
    for a, label, x in filter(lambda r: is_anchor(r[0]), rows):
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, other == label) for i, other, y in rows if i != a and len(y) == len(x))
        for score, i, _ in [s for s in scored if s[2]][:positives]:
            fits = [s for s in scored if not s[2] and 50 * -score <= 100 * -s[0] <= 95 * -score][:negatives]
            out += [(a, i, k, j, -score, -other) for k, (other, j, _) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, **more):
    data = spark.createDataFrame([(i, label, list(v), "x") for i, label, v in rows], "vec_id long, label int, components array<long>, row string")
    return sorted(map(tuple, hard_negatives.mine(data, "vec_id % 5 = 0", **more).collect()))


def test_twin(spark):
    got = queries.QUERIES["op13_hard_negatives"](spark, SF).toPandas()
    assert compare.difference(got, compare.duck(SF).execute(queries.SQL["op13_hard_negatives"]).df()) is None


@pytest.mark.parametrize("least_rows", [1, 16, 10_000])
def test_against_all_pairs(spark, monkeypatch, least_rows):
    """Ties, copies, a hot label, rare labels, vectors of several lengths, small blocks and groups."""
    monkeypatch.setattr(hard_negatives, "LEAST_ROWS", least_rows)
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 7)
    rng = random.Random(3)
    rows = [(k, rng.choice([0, 0, 0, 1, 2, 3]) if k % 9 else k, tuple(rng.randrange(-3, 9) for _ in range(rng.choice([3, 3, 4])))) for k in range(200)]
    rows += [(k, 0, (5, 5, 5)) for k in range(200, 260)] + [(k, 1, (4, 4, 4)) for k in range(260, 300)]
    rows += [(300, 0, ()), (301, 1, ()), (305, 0, ()), (5, 2, (1, 2, 3)), rows[0], rows[0], (3, rows[3][1], rows[3][2])]
    got = mined(spark, rows)
    assert got == plain(rows, lambda i: i % 5 == 0) and len(got) > 100


def test_large_numbers(spark):
    rng = random.Random(4)
    rows = [(k, k % 3, tuple(rng.randrange(1 << 27) for _ in range(6))) for k in range(60)]
    assert mined(spark, rows) == plain(rows, lambda i: i % 5 == 0)


def test_odd_rows(spark):
    vectors = [[0.5, 1.0], None, [float("nan"), 1.0], [float("inf"), 0.0], [None, 1.0], [0.25, 0.25], [0.5, 0.75], [0.5, 0.75]]
    rows = [(5 * k, None if k == 7 else 1, v) for k, v in enumerate(vectors)] + [(None, 1, [0.5, 1.0]), (3, 2, [0.375, 0.75]), (4, 2, [0.5, 1.0])]
    data = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    data = data.select("vec_id", "label", topk.whole_components(F.col("embedding")).alias("components"))
    got = sorted(map(tuple, hard_negatives.mine(data, "vec_id % 5 = 0").collect()))
    whole = {0: (128, 256), 25: (64, 64), 30: (128, 192)}
    want = [(i, 1, v) for i, v in whole.items()] + [(3, 2, (96, 192)), (4, 2, (128, 256))]
    assert got == plain(want, lambda i: i % 5 == 0) and got
    assert hard_negatives.mine(data.limit(0), "vec_id % 5 = 0").count() == 0
    assert hard_negatives.mine(data, "vec_id = 1").count() == 0


def test_boxes_hold_their_rows_and_are_passed_over():
    """On clustered vectors the bounds decide; every box is left only when it cannot serve."""
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 200, (40, 8))
    which = np.arange(4_000) % 40
    vectors = np.floor(centres[which] + rng.normal(0, 4, (4_000, 8)))
    ids, labels = rng.permutation(4_000), which % 4
    tree = hard_negatives.PackedTree(ids, labels, vectors)
    for node, (a, b) in enumerate(tree.children):
        inside = (tree.vectors if node < tree.leaves else tree.low)[a:b]
        above = (tree.vectors if node < tree.leaves else tree.high)[a:b]
        assert (inside >= tree.low[node]).all() and (above <= tree.high[node]).all()
    assert sorted(tree.ids) == list(range(4_000)) and max(b - a for a, b in tree.children) <= hard_negatives.LEAF
    scores = vectors @ vectors[0]
    for same in (True, False):
        (found, values), = tree.search(int(ids[0]), int(labels[0]), vectors[0], [hard_negatives.EVERY], 5, same)
        may = [k for k in range(4_000) if (labels[k] == labels[0]) == same and k]
        want = sorted(may, key=lambda k: (-scores[k], ids[k]))[:5]
        assert found.tolist() == [ids[k] for k in want] and values.tolist() == [scores[k] for k in want]
    assert tree.scored < 1_500  # of 2 * 4,000


@pytest.mark.parametrize("same", [True, False])
def test_leaves_are_scored_in_few_rounds_where_bounds_tell_little(same):
    """Independent components: nearly every leaf is scored, in rounds that double. Ties and narrow windows are kept."""
    rng = np.random.default_rng(8)
    vectors = rng.integers(-4, 5, (6_000, 24)).astype(np.float64)
    ids, labels = rng.permutation(6_000), rng.integers(0, 3, 6_000)
    for k in range(0, 6_000, 500):
        tree = hard_negatives.PackedTree(ids, labels, vectors)
        scores = vectors @ vectors[k]
        may = np.flatnonzero((ids != ids[k]) & ((labels == labels[k]) == same))
        top = int(scores[may].max())
        windows = [hard_negatives.EVERY, (top // 2, top * 9 // 10), (top // 2, top // 2), (top * 9 // 10, top)]
        got = tree.search(int(ids[k]), int(labels[k]), vectors[k], windows, 3, same)
        for (low, high), (found, values) in zip(windows, got, strict=True):
            want = sorted((-scores[j], ids[j]) for j in may if low <= scores[j] <= high)[:3]
            assert sorted(zip(-values, found, strict=True)) == want
        assert tree.rounds <= np.log2(tree.leaves) + 1
