"""Shards by weighted rendezvous hashing of stable record keys.

Each shard bids for a key with ``-ln(u) / weight``, u being a number in (0, 1) hashed from key and shard, and the lowest bid wins. A
bid depends on nothing but the key and that one shard, so a shard that is added takes records only into itself, one that is taken
away gives its own to the others, and a changed weight moves records only to or from its shard. Shares are in proportion to the weights.

Rows are numbered within their shards without being sorted or gathered: each task counts on by itself, what it numbered is
stored, and one small row per task and shard then tells how many slots the tasks before it have filled. A shard or a key that holds
most rows thus takes no more from one task than any other.

Defined results: rows with equal keys, repeated rows among them, share a shard and get a slot each; a NULL key is a key like any other;
texts play no part, so equal texts under different keys need not meet; a NULL text has no bytes and checksum 0; no rows give no rows. Other
columns are carried, but columns called like one that is added are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minutebook.llm.common import staged

SHARDS = 16
UNIT = 2.0**-53


def even(n: int) -> dict[int, float]:
    """Shards 0 to n - 1, all of one weight."""
    return dict.fromkeys(range(n), 1.0)


def shard_of(key: Column, weights: dict[int, float]) -> Column:
    """The shard of a key. ``weights`` has the weight of every shard."""
    if not weights or not all(0 < w < math.inf for w in weights.values()):
        raise ValueError("shards need weights above zero")
    shards = F.array(*[F.struct(F.lit(int(s)).cast("int").alias("shard"), F.lit(float(w)).alias("weight")) for s, w in sorted(weights.items())])

    def bid(s: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key.cast("string"), s["shard"]), 11)
        return F.struct((-F.ln((bits + 0.5) * UNIT) / s["weight"]).alias("bid"), s["shard"].alias("shard"))

    return F.array_min(F.transform(shards, bid))["shard"]


def numbered(rows: DataFrame, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """The rows with their place in their shard, from 0 without gaps. A row whose shard is NULL is numbered among those."""
    columns = [c for c in rows.columns if c != slot]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled: dict[int | None, int] = {}
        for batch in batches:
            coded = batch.column("shard").dictionary_encode(null_encoding="encode")
            codes = np.asarray(coded.indices)
            order = np.argsort(codes, kind="stable")
            sizes = np.bincount(codes, minlength=len(coded.dictionary))
            places = np.empty(len(codes), np.int64)
            places[order] = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            names = coded.dictionary.to_pylist()
            places += np.array([filled.get(s, 0) for s in names], np.int64)[codes]
            for s, n in zip(names, sizes.tolist(), strict=True):
                filled[s] = filled.get(s, 0) + n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places)], [*batch.schema.names, "place"])

    dealt = rows.select(F.struct(*columns).alias("row"), F.col(shard).alias("shard"), F.spark_partition_id().alias("task"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields)
    placed = staged(dealt.mapInArrow(count, f"{kinds}, place long"), "placed")
    earlier = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    filled = placed.groupBy("shard", "task").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("shard").alias("of"), F.col("task").alias("by"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    # stored, so that Spark sees its size and sends it round only if that is small
    filled = staged(filled, "filled")
    return placed.join(filled, F.col("shard").eqNullSafe(F.col("of")) & (F.col("task") == F.col("by"))).select(
        "row.*", (F.col("before") + F.col("place")).alias(slot)
    )


def assign(rows: DataFrame, key: str, weights: dict[int, float], grown: dict[int, float] | None = None) -> DataFrame:
    """The rows with shard and slot, and with grown_shard, where they go under other weights (NULL if none are given)."""
    columns = [c for c in rows.columns if c not in ("shard", "slot", "grown_shard")]
    later = shard_of(F.col(key), grown) if grown else F.lit(None).cast("int")
    return numbered(rows.select(*columns, shard_of(F.col(key), weights).alias("shard"), later.alias("grown_shard")))


def write_shards(rows: DataFrame, folder: str) -> None:
    """Write the rows by shard; small shards share a task, a large one is split by size."""
    rows.hint("rebalance", "shard").write.partitionBy("shard").parquet(folder)


def document_shards(docs: DataFrame, n: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document in n shards of one weight, keyed by doc_id."""
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(
        "doc_id", (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), F.lit("key").alias("law")
    )
    return assign(rows, "doc_id", even(n), even(n + 1)).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
