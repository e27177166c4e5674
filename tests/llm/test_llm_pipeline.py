"""The pipeline: stages one by one against what each must keep."""

import random
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline as pipeline
from minutebook.llm import decontaminate, jaccard_join, language_gru, toxicity

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="shared tables absent")


def test_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, columns, all_docs = docs, docs.columns, docs.count()
    for name, stage in pipeline.STAGES[:-1]:
        got = pipeline.staged(stage(spark, kept, SF), name)
        assert got.columns == columns
        ids = {r["doc_id"] for r in got.select("doc_id").collect()}
        if name == "language_id":
            found = language_gru.predict(kept, language_gru.fit(kept)).collect()
            want = {r["doc_id"] for r in found if r["lang_pred"] != "und" and r["score"] >= pipeline.LEAST_LANGUAGE_SCORE}
            assert len(want) > 0.95 * all_docs
        elif name == "toxicity":
            model = toxicity.fit(kept, spark.read.parquet(f"{SF}/labels.parquet"))
            want = {r["doc_id"] for r in toxicity.predict(kept, model).where("predicted = 0").collect()}
        elif name == "near_duplicates":
            rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
            want = {min(rows[k][0] for k in group) for group in groups_of(rows, pipeline.SHINGLE_WORDS, pipeline.SHARED_PERCENT)}
            assert len(want) < len(rows)
        else:
            judged = decontaminate.decontaminate(kept, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
            want = {r["doc_id"] for r in judged if not r["contaminated"]}
            assert len(want) < len(judged)
        assert ids == want
        kept = got
    packed = pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == ids


def test_odd_rows(spark):
    texts = ["the cat sat on the mat and the dog ran to it", None, "", "123", "the cat sat on the mat and the dog ran to it"]
    rows = [(k, t, "en", "s", 1, 0.5) for k, t in zip([1, 2, 3, None, 5], texts, strict=True)] + [(1, texts[0], "en", "s", 1, 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double")
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    kept = sorted((r["doc_id"] or 0) for r in pipeline.near_duplicates(spark, docs, SF).collect())
    assert kept == [0, 1, 2, 3]
    assert pipeline.pack(spark, docs.limit(0), SF).count() == 0


def groups_of(rows, size, percent):
    """Positions of the rows in each near-duplicate group, by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = (text or "").lower().split()
        sets.append({tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    name = list(range(len(rows)))
    for k, s in enumerate(sets):
        for j in range(k):
            if s and 100 * len(s & sets[j]) >= percent * len(s | sets[j]):
                name = [name[j] if n == name[k] else n for n in name]
    return [[k for k, n in enumerate(name) if n == g] for g in set(name)]


def edited(words, *places):
    return " ".join(f"new{k}" if k in places else w for k, w in enumerate(words))


def test_near_duplicates_by_five_words_and_four_fifths(spark):
    rng, rows = random.Random(6), []
    for length in (100, 100, 60, 400, 5, 4):
        base = [f"w{rng.randrange(3_000)}" for _ in range(length)]
        for edits in (0, 1, 2, 2, 3, 4, 6, 8, 12, 16, 24):
            rows.append((len(rows) * 7 % 101, edited(base, *rng.sample(range(length), min(edits, length // 5)))))
    base = [f"v{k}" for k in range(100)]
    rows += [(1_000, " ".join(base)), (1_001, edited(base, 30, 70)), (1_002, edited(base, 20, 50, 80))]  # 86 of 106, 81 of 111
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r["doc_id"] for r in pipeline.near_duplicates(spark, docs, SF).collect())
    want = sorted(min(rows[k][0] for k in group) for group in groups_of(rows, 5, 80))
    assert got == want and {1_000, 1_002} < set(got) and 1_001 not in got
    assert want != sorted(min(rows[k][0] for k in group) for group in groups_of(rows, 3, 90))


@pytest.mark.parametrize("n_common", [0, 50, 400])
def test_similar_sets_share_a_first_token(n_common):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, 500, dtype=np.int64).astype(np.uint64) * np.uint64(2)
    common = np.unique(rng.choice(base, n_common, replace=False))
    ranks, similar = rng.permutation(len(common)) + 1, 0
    for _ in range(3_000):
        size = int(rng.integers(1, 120))
        x = rng.choice(base, size, replace=False)
        y = np.unique(np.r_[x[int(rng.integers(0, size // 4 + 1)):], rng.choice(base, int(rng.integers(0, size // 4 + 1)), replace=False)])
        both = len(np.intersect1d(x, y))
        if 100 * both >= 80 * (size + len(y) - both):
            similar += 1
            a, b = (jaccard_join.first_tokens(np.unique(t), 80, common, ranks) for t in (x, y))
            assert len(np.intersect1d(a, b))
    assert similar > 500


def test_rows_are_dropped_one_by_one(spark):
    """Rows that share an id, or have none, do not go with each other."""
    text = lambda name: " ".join(f"{name}{k}" for k in range(100))
    a, b, c, d = map(text, "abcd")
    rows = [
        (1, a), (2, edited(a.split(), 30)), (2, b), (3, b), (4, c), (4, edited(c.split(), 50)), (None, a), (None, c + " end"),
        (None, d), (None, edited(d.split(), 9)), (5, None), (5, None), (6, None), (None, ""), (None, ""),
    ]
    docs = spark.createDataFrame([(*r, 7, 77) for r in rows], "doc_id long, text string, component_id int, _row int")
    got = pipeline.near_duplicates(spark, docs, SF).collect()
    assert {tuple(r)[2:] for r in got} == {(7, 77)}
    ids = sorted(((r["doc_id"] or 0), (r["text"] or "")[:1]) for r in got)
    assert ids == [(0, ""), (0, ""), (0, "d"), (1, "a"), (2, "b"), (4, "c"), (5, ""), (6, "")]


def test_clean_rows_stay_whatever_their_id(spark):
    item = next(r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect() if r["text"])
    rows = [(None, item), (None, "clean without an id"), (1, f"so {item}"), (1, "clean with an id"), (2, item), (3, "clean alone"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = pipeline.decontamination(spark, docs, SF).collect()
    assert sorted(((r["doc_id"] or 0), (r["text"] or "")) for r in got) == [
        (0, ""), (0, "clean without an id"), (1, "clean with an id"), (3, "clean alone"),
    ]


def similar_sets(rng, most, n):
    """Pairs of token sets, n of them just or well similar at 80 %, some at the borders of the wide bands."""
    base = np.unique(rng.integers(0, 1 << 63, 4 * most, dtype=np.int64).astype(np.uint64) * np.uint64(2))
    borders = jaccard_join.bands(most // 2, 80, jaccard_join.WIDE_BAND_RATIO)
    while n:
        size = max(1, int(rng.choice(borders) + rng.integers(-3, 4)) if rng.random() < 0.5 else int(rng.integers(1, most)))
        x = rng.choice(base, size, replace=False)
        y = np.r_[x[int(rng.integers(0, size // 5 + 2)):], rng.choice(base, int(rng.integers(0, size // 4 + 2)), replace=False)]
        x, y = np.unique(x), np.unique(y)
        both = len(np.intersect1d(x, y))
        if 100 * both >= 80 * (len(x) + len(y) - both):
            n -= 1
            yield x, y


@pytest.mark.parametrize("n_common", [0, 50, 400])
@pytest.mark.parametrize("share", [None, 0.0, 0.3, 1.0])
def test_similar_sets_share_a_kept_segment(n_common, share):
    """``share`` of the differences go to one-deletion segments; without it, what costs say."""
    rng, starts = np.random.default_rng(8), jaccard_join.bands(400, 80, jaccard_join.WIDE_BAND_RATIO)
    plans = {}
    for band, (start, end) in enumerate(zip(starts, starts[1:], strict=False)):
        if share is not None:
            differing = jaccard_join.most_differing(end - 1, (end - 1) * 100 // 80, 80)
            deletions = int(share * (differing + 2) / 2)
            plans[band] = (max(0, differing + 1 - 2 * deletions) + int(rng.integers(0, end // 3 + 1)), deletions)
    for x, y in similar_sets(rng, 300, 800):
        common = np.unique(rng.choice(x, min(len(x), n_common * len(x) // 400), replace=False))
        ranks = rng.permutation(len(common)) + 1
        a, b = (jaccard_join.kept_segments(t, 80, 1_000, plans, common, ranks) for t in (x, y))
        assert len(np.intersect1d(a, b))


def test_kept_segments_are_few_and_say_more_than_a_token():
    rng, none, meet = np.random.default_rng(9), np.empty(0, np.uint64), [0, 0]
    for _ in range(300):
        shared, *rest = np.split(rng.integers(0, 1 << 63, 200, dtype=np.int64).astype(np.uint64) * np.uint64(2), [20, 110])
        x, y = (np.unique(np.r_[shared, r]) for r in rest)  # 20 of 110 tokens
        kept = [jaccard_join.kept_segments(t, 80, 1_000, {}, none, none) for t in (x, y)]
        first = [jaccard_join.first_tokens(t, 80, none, none) for t in (x, y)]
        assert max(map(len, kept)) <= 0.25 * 110 + 1
        meet = [meet[0] + (len(np.intersect1d(*kept)) > 0), meet[1] + (len(np.intersect1d(*first)) > 0)]
    assert meet[0] < 0.3 * 300 < 0.9 * 300 < meet[1]


def test_near_duplicates_go_by_universe_partition(spark, monkeypatch):
    """Also where a text and its copy lie in two wide bands, which begin at 81 and 243 shingles."""
    rng, rows, called = random.Random(12), [], []
    for length in (84, 88, 246, 250):
        for _ in range(6):
            base = [f"w{rng.randrange(5_000)}" for _ in range(length)]
            rows += [(len(rows) + k, " ".join(base[cut:])) for k, cut in enumerate((0, 1, 3, 5, 9, 14, 20, 30))]
    by_segments = jaccard_join.near_duplicates_by_segments
    monkeypatch.setattr(jaccard_join, "near_duplicates_by_segments", lambda *given: called.append(given[1:]) or by_segments(*given))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r["doc_id"] for r in pipeline.near_duplicates(spark, docs, SF).collect())
    assert got == sorted(min(group) for group in groups_of(rows, 5, 80))
    assert called == [(80, 5)]
