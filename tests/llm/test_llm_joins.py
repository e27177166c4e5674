"""Near duplicates, decontamination and top-k search against brute force."""

import hashlib
import random
import re
from pathlib import Path

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from minutebook.llm import decontaminate, jaccard_join, queries, topk

SF = "/root/testdata/sf0.01"
shared = pytest.mark.skipif(not Path(SF).exists(), reason="shared tables absent")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(rows):
    out = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        out.append(frozenset(zip(words, words[1:], words[2:], strict=False)) if len(words) >= 3 else frozenset([tuple(words)] if words else []))
    return out


def brute_components(rows, percent=90):
    sets = sets_of(rows)
    at = {}
    for k, s in enumerate(sets):
        for token in s:
            at.setdefault(token, []).append(k)
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, s in enumerate(sets):
        for j in {j for token in s for j in at[token] if j < k}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[root(k)] = root(j)
    lowest = {}
    for k, (doc_id, _) in enumerate(rows):
        lowest[root(k)] = min(lowest.get(root(k), doc_id), doc_id)
    return sorted((doc_id, len(sets[k]), lowest[root(k)]) for k, (doc_id, _) in enumerate(rows))


def families(seed, n_families, copies, size, edits):
    """Texts near some base texts, at many distances around the limit."""
    rng, rows = random.Random(seed), []
    for f in range(n_families):
        base = [f"w{rng.randrange(4_000)}" for _ in range(size)]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(edits)):
                k = rng.randrange(len(words))
                if rng.random() < 0.3:
                    del words[k]
                else:
                    words[k] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows) * 7 % 10_007 + f * 20_000, " ".join(words)))
    return rows


@pytest.mark.parametrize(("size", "edits", "copies"), [(160, 8, 150), (25, 3, 100), (900, 40, 40), (9, 2, 60)])
def test_components_of_families(spark, size, edits, copies):
    rows = families(size, 3, copies, size, edits)
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == brute_components(rows)


def test_components_by_tiles_and_failing_edges(spark, monkeypatch):
    """Small tiles, and sketches so short that many pairs pass which are no links."""
    monkeypatch.setattr(jaccard_join, "TILE", 16)
    monkeypatch.setattr(jaccard_join, "SKETCH_WORDS", 1)
    monkeypatch.setattr(jaccard_join, "TOKEN_BITS", 1 / 64)
    rows = families(5, 2, 120, 120, 9)
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == brute_components(rows)


def test_components_of_odd_rows(spark):
    texts = [None, "", " \t\n", "One", "one ", "one two", "one\x0btwo", "É", "é", "\x1c a", "\x1c A"] + ["big " * 30_000 + "end"] * 3
    rows = [(k + 10, t) for k, t in enumerate(texts)] + [(13, "One")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, node int, component_id int")
    got = jaccard_join.near_duplicates(docs).collect()
    assert sorted(map(tuple, got)) == brute_components(rows)
    assert jaccard_join.near_duplicates(docs.limit(0)).count() == 0
    nameless = spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (None, None)], "doc_id long, text string")
    assert sorted(map(str, jaccard_join.near_duplicates(nameless).collect()))[0].endswith("component_id=4)")


def test_components_of_shared_ids(spark):
    rows = [(doc_id // 3 % 50, text) for doc_id, text in families(8, 2, 60, 80, 5)]
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == brute_components(rows)


def test_many_copies_stay_one_node(spark):
    docs = spark.range(20_000).selectExpr("id + 5 AS doc_id", "concat_ws(' ', 'a', 'b', 'c', 'd', 'e', CASE WHEN id % 1000 = 0 THEN id END) AS text")
    got = {tuple(r) for r in jaccard_join.near_duplicates(docs).groupBy("component_id").count().collect()}
    assert (6, 19_980) in got and len(got) == 21


@pytest.mark.parametrize("sets", [10, 10**6, 10**9])
def test_similar_sets_share_a_signature(sets):
    rng = np.random.default_rng(3)
    chosen = set()
    for _ in range(300):
        size = int(rng.integers(1, 300))
        base = rng.integers(0, 1 << 63, size + 40, dtype=np.int64).astype(np.uint64)
        for gone in range(0, size // 8 + 1, max(1, size // 40)):
            for new in range(0, size // 8 + 1, max(1, size // 20)):
                x, y = np.unique(base[:size]), np.unique(base[gone:size + min(new, 40)])
                both = len(np.intersect1d(x, y))
                if 100 * both >= 90 * (len(x) + len(y) - both):
                    plans = {}
                    a, b = (jaccard_join.signatures(t, 90, sets, plans) for t in (x, y))
                    chosen |= set(plans.values())
                    assert len(np.intersect1d(a, b)), (size, gone, new)
                    bits = [np.frombuffer(jaccard_join.sketch(t), np.uint64) for t in (x, y)]
                    assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= jaccard_join.most_differing(len(x), len(y), 90)
    assert sets < 10**9 or any(deletions for _, deletions in chosen)


@shared
def test_op4_over_all_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.QUERIES["op4_jaccard_join"](spark, SF).collect())) == brute_components(rows)


@shared
@pytest.mark.parametrize("name", ["op4_jaccard_join", "op6_decontamination", "op9_topk_search"])
def test_twin(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert compare.difference(got, compare.duck(SF).execute(queries.SQL[name]).df()) is None


def brute_hits(docs, items):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    out = []
    for doc_id, text in docs:
        have, hit, found = words(text), set(), set()
        for item_id, item in items:
            need = words(item)
            size = min(10, len(need))
            windows = {tuple(need[i:i + size]) for i in range(len(need) - size + 1)} if need else set()
            for i in range(len(have) - size + 1 if windows else 0):
                if tuple(have[i:i + size]) in windows:
                    hit |= set(range(i, i + size))
                    found.add(str(item_id))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(have), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_ROWS, 0])
def test_decontamination_of_odd_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice("abcd") for _ in range(n))
    items = [(1, text(14)), (2, text(12)), (10, "Only three-words"), (3, None), (4, " ."), (5, "the the the the the the the the the the the"), (6, "É x")]
    docs = [(k, text(300)) for k in range(8)] + [
        (20, None), (21, ""), (22, "only THREE words only three"), (23, "the " * 30), (23, "the " * 30), (24, "é x É x"), (25, "z" * 90_000 + " only,three;words"),
        (26, items[0][1] + "! " + items[1][1]), (None, items[0][1]),
    ]
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, n_hit int, row int")
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, words int")
    got = sorted(map(tuple, decontaminate.decontaminate(frame, bench).collect()), key=str)
    assert got == brute_hits(docs, items)
    assert not decontaminate.decontaminate(frame, bench.limit(0)).where("contaminated").count()
    assert decontaminate.decontaminate(frame.limit(0), bench).count() == 0


def test_decontamination_plan_is_native(spark):
    frame = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    plan = decontaminate.decontaminate(frame, frame.withColumnRenamed("doc_id", "item_id"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_topk_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rng = random.Random(4)
    rows = [(k, [rng.uniform(-1, 1) for _ in range(6)]) for k in range(300)]
    rows += [(300 + k, [0.5] * 6) for k in range(20)]  # ties
    rows += [(400, None), (450, []), (500, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (550, [nan] * 6), (600, [inf] * 6), (650, [1.0] * 5), (None, [1.0] * 6), (50, rows[50][1])]
    frame = spark.createDataFrame([(*r, 9) for r in rows], "vec_id long, embedding array<float>, score int")
    vectors = frame.select("vec_id", topk.whole_components(F.col("embedding")).alias("components"))
    got = topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5).collect()
    whole = {i: np.floor(256 * np.array(v, np.float32).astype(float)).astype(int) for i, v in rows[:320]}
    want = []
    for q in range(0, 320, 50):
        best = sorted(((-int(v @ whole[q]), i) for i, v in whole.items() if i != q))[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted(map(tuple, got)) == want
    few = topk.top_k(vectors.where("vec_id < 3"), vectors.where("vec_id = 0"), 5).collect()
    assert [r["rank"] for r in few] == [1, 2]
    assert topk.top_k(vectors.limit(0), vectors, 5).count() == 0


def test_vectors_of_several_lengths(spark, tmp_path):
    """A stray row takes no other with it, and query and twin agree."""
    rng = random.Random(2)
    rows = [(k, [rng.uniform(-1, 1) for _ in range(rng.choice([3, 3, 4, 0]))]) for k in range(200)] + [(300, [1.0] * 5), (350, [0.5] * 70), (400, None), (None, [1.0] * 3)]
    spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = queries.QUERIES["op9_topk_search"](spark, str(tmp_path)).toPandas()
    con = compare.duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert compare.difference(got, con.execute(queries.SQL["op9_topk_search"]).df()) is None
    assert len(got) == 20 and not {300, 350} & set(got["query_id"])


def test_threshold_stops_early():
    rng = np.random.default_rng(0)
    index = topk.ThresholdIndex(np.arange(4_000), np.floor(256 * rng.standard_cauchy((4_000, 8))).clip(-10**6, 10**6))
    scored = []

    class Counting(np.ndarray):
        def __matmul__(self, other):
            scored.append(len(self))
            return np.asarray(self) @ other

    index.vectors = index.vectors.view(Counting)
    query = np.array([3.0, 0, 0, 1, 0, 0, 0, -2])
    ids, scores = index.search(-1, query, 5)
    exact = np.asarray(index.vectors) @ query
    assert scores.tolist() == sorted(exact.astype(int), reverse=True)[:5] and sum(scored) < 2_000


def test_near_duplicates_against_sql(spark, tmp_path):
    """Query and SQL agree on texts without words, short texts, copies, chains of near copies and pairs just on either side of the limit."""
    words = [f"w{i}" for i in range(60)]
    texts = [None, "", " \t ", "one", "ONE", "one two", "one  two", "one two three", " ".join(words), " ".join(words).upper(), " ".join(words)]
    texts += [" ".join(words[k:] + [f"x{i}" for i in range(k)]) for k in range(1, 12)]
    docs = spark.createDataFrame([(100 - i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op4_jaccard_join"](spark, str(tmp_path)).toPandas()
    con = compare.duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert compare.difference(got, con.execute(queries.SQL["op4_jaccard_join"]).df()) is None
    assert len(set(got["component_id"])) < len(got) - 5
