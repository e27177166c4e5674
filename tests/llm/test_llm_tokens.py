"""Token ids, token counts and packing against brute force."""

import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from minutebook.llm import packing, queries, token_counts
from minutebook.llm.common import staged
from minutebook.llm.encoding import Encoder

SF = "/root/testdata/sf0.001"
shared = pytest.mark.skipif(not Path(SF).exists(), reason="shared tables absent")


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


ENCODER = Encoder()


@given(st.lists(st.sampled_from(["a", "It's", " ", "  ", "\n", "\t ", " ", "\u0085", "\x1c", "é", "漢字", "12", "!?", "<|endoftext|>", "'s", "​", "😀"]), max_size=12))
@settings(max_examples=300, deadline=None)
def test_ids_equal_those_of_the_tokenizer(reference, parts):
    for glue in ("", " "):
        text = glue.join(parts)
        assert list(ENCODER.ids(text)) == reference(text)


def frame(spark):
    texts = [None, "", "word " * 30_000, "a b c", "a b c", "<|endoftext|>", "x"]
    return spark.createDataFrame([(i, t, 0, 0) for i, t in zip([None, 1, 2, 3, 3, 4, 5], texts, strict=True)], "doc_id long, text string, length int, n_tokens int")


def test_curve_against_brute_force(spark, reference):
    docs = frame(spark)
    sizes = [len(reference(r["text"])) for r in docs.collect()]
    curve = token_counts.token_counts(docs).collect()
    assert sorted(r["context_limit"] for r in curve) == sorted(set(sizes))
    histogram = staged(token_counts.length_histogram(docs), "lengths")
    other = token_counts.totals_at(histogram, [0, 2, 7, 10**6]).collect()
    for r in [*curve, *other]:
        limit = r["context_limit"]
        assert r["docs_over"] == sum(n > limit for n in sizes)
        assert r["tokens_over"] == sum(n for n in sizes if n > limit)
        assert r["tokens_truncated"] == sum(min(n, limit) for n in sizes)
    for r in curve:
        assert r["n_docs"] == sizes.count(r["context_limit"]) and r["tokens_total"] == sum(sizes)
        assert r["share_within"] == pytest.approx(sum(n <= r["context_limit"] for n in sizes) / len(sizes))
    assert token_counts.token_counts(docs.limit(0)).count() == 0


@shared
def test_op3_over_all_documents(spark, reference):
    sizes = Counter(len(reference(r["text"])) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = queries.QUERIES["op3_token_counts"](spark, SF).collect()
    assert {r["context_limit"]: r["n_docs"] for r in got} == sizes


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 5), max_size=8), st.integers(0, 60))
@settings(max_examples=200, deadline=None)
def test_closest_multiset(counts, room):
    have = np.zeros(64, np.int64)
    for n, c in counts.items():
        have[n] = c
    picked = packing.closest_multiset(room, have)
    sums = {0}
    for n, c in counts.items():
        sums = {s + n * k for s in sums for k in range(c + 1) if s + n * k <= room}
    assert sum(n * k for n, k in picked.items()) == max(sums)
    assert all(k <= have[n] for n, k in picked.items())


def check_places(rows, window):
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
    for pieces in by.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
    return sum(window - sum(r["length"] for r in p) for p in by.values())


def test_pack_odd_rows(spark, reference):
    docs = frame(spark)
    rows = packing.pack(staged(packing.cut_documents(docs, window=100), "pieces"), 100).collect()
    check_places(rows, 100)
    ids: dict = {}
    for r in sorted(rows, key=lambda r: r["start"]):
        ids.setdefault(r["doc_id"], []).append(np.frombuffer(bytes(r["ids"]), "<u4").tolist())
    for doc_id, text in [(None, None), (1, ""), (2, "word " * 30_000), (4, "<|endoftext|>")]:
        assert sum(ids[doc_id], []) == [*reference(text), 1]
    assert ids[3] == [[*reference("a b c"), 1]] * 2
    assert packing.pack(staged(packing.cut_documents(docs.limit(0)), "pieces")).count() == 0


def test_pack_one_hot_length(spark):
    pieces = spark.range(50_000).selectExpr("id AS doc_id", "0L AS start", "CASE WHEN id % 3 = 0 THEN 700L ELSE 1 + id % 2000 END AS length")
    rows = packing.pack(staged(pieces, "pieces")).collect()
    assert len(rows) == 50_000
    wasted = check_places(rows, 2048)
    assert wasted / sum(r["length"] for r in rows) < 0.2  # 700 fills a window badly, and a third of the rows have it
    plan = packing.plan({700: 10**12, 648: 10**12, 1400: 10**9, 2048: 10**13})
    assert len(plan) < 100


@shared
def test_op7_over_all_documents(spark, reference):
    docs = {r["doc_id"]: [*reference(r["text"]), 1] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op7_packing"](spark, SF).collect()
    wasted = check_places(rows, 2048)
    total = sum(map(len, docs.values()))
    assert wasted < 2048 * 2 + 0.002 * total
    at = Counter()
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        ids = docs[r["doc_id"]]
        assert r["start"] == at[r["doc_id"]] and r["doc_tokens"] == len(ids)
        part = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4")
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
        at[r["doc_id"]] += r["length"]
    assert at == {d: len(ids) for d, ids in docs.items()}
