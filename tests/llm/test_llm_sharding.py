"""Shards by rendezvous hashing."""

import math
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from minutebook.llm import queries, sharding

SF = "/root/testdata/sf0.01"


def bid(key, shard, weight):
    h = 42 if key is None else xxhash.xxh64_intdigest(str(key).encode(), 42)
    h = xxhash.xxh64_intdigest(shard.to_bytes(4, "little", signed=True), h)
    return -math.log(((h >> 11) + 0.5) * 2.0**-53) / weight


def winner(key, weights):
    return min(sorted(weights), key=lambda s: bid(key, s, weights[s]))


def gapless(rows):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    return all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())


def test_query_against_plain_hashing(spark):
    got = queries.QUERIES["op11_sharding"](spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) == len(texts) and gapless(got)
    for r in got:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 1, zlib.crc32(data), "key")
        assert r["shard"] == winner(r["doc_id"], sharding.even(16))
        assert r["grown_shard"] == winner(r["doc_id"], sharding.even(17))
        assert r["grown_shard"] in (r["shard"], 16)
    share = Counter(r["shard"] for r in got)
    assert set(share) == set(range(16)) and max(share.values()) < 2 * min(share.values())
    assert 20 < sum(r["grown_shard"] == 16 for r in got) < 110


def test_weights_and_moves(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "key")
    before = {0: 1.0, 5: 2.0, 9: 1.0}
    lists = [before, before | {7: 4.0}, {0: 1.0, 9: 1.0}, before | {0: 3.0}]
    rows = keys.select("key", *[sharding.shard_of(F.col("key"), w).alias(f"s{k}") for k, w in enumerate(lists)]).collect()
    share = Counter(r["s0"] for r in rows)
    assert abs(share[5] - 10_000) < 400 and abs(share[0] - 5_000) < 400
    for r in rows:
        assert r["s1"] in (r["s0"], 7)
        assert r["s2"] == r["s0"] or r["s0"] == 5
        assert r["s3"] in (r["s0"], 0)
    assert abs(sum(r["s1"] == 7 for r in rows) - 10_000) < 400
    assert [r["s0"] for r in rows[:300]] == [winner(r["key"], before) for r in rows[:300]]


@pytest.mark.parametrize("weights", [{}, {0: 0.0}, {0: 1.0, 1: math.inf}, {0: -1.0}])
def test_bad_weights(weights):
    with pytest.raises(ValueError):
        sharding.shard_of(F.lit(1), weights)


def test_odd_rows(spark):
    text = "é " * 200_000
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, None), (None, ""), (2, text)] + [(None, "x")] * 500
    docs = spark.createDataFrame([(*r, "place", 9, -1) for r in rows], "doc_id long, text string, row string, shard int, slot int").repartition(5)
    got = sharding.document_shards(docs).collect()
    assert len(got) == len(rows) and gapless(got)
    assert {r["size"] for r in got if r["doc_id"] == 2} == {600_001}
    assert {(r["size"], r["text_crc32"]) for r in got if r["doc_id"] is None} == {(1, 0), (2, zlib.crc32(b"x"))}
    assert all(len({r["shard"] for r in got if r["doc_id"] == key}) == 1 for key in (1, 2, None))
    assert sharding.document_shards(docs.limit(0)).count() == 0
    carried = sharding.assign(docs, "doc_id", sharding.even(3))
    assert carried.columns == ["doc_id", "text", "row", "shard", "grown_shard", "slot"]
    assert {r["row"] for r in carried.collect()} == {"place"} and gapless(carried.collect())


def test_written_shards_come_back(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    placed = sharding.assign(docs, "doc_id", sharding.even(4))
    sharding.write_shards(placed, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    want = sorted((r["shard"], r["slot"], r["doc_id"], r["text"]) for r in placed.collect())
    assert sorted((int(r["shard"]), r["slot"], r["doc_id"], r["text"]) for r in back.collect()) == want
