"""URL rules: a blocked Bloom filter in front of an exact hash join.

Every rule is a listed canonical URL: a host, which stands for itself and its subdomains, and a path prefix. The rules' keys
(host + path) set bits in a filter of 256-bit blocks. Each URL yields the few keys a rule could have for it; those that the
filter passes go to an exact join on the key, which removes the false positives. The longest rule that remains decides.
Everything runs in built-in functions.

Defined results: a NULL URL, or one without ``://``, has an empty host and path and no rule; repeated rows are each judged;
further columns of the pages are ignored; no rules or no pages give no decisions or no rows. Of rules with the same key one
stays (block before allow). Rules of equal length are told apart by the longer host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minutebook.llm.common import ascii_lower

BITS_PER_KEY = 16
BLOCK_WORDS = 4  # longs in a block; each key sets one bit in each
# Rules (under 300 bytes each) and blocks of the filter (a number and four longs, under 100 bytes) that may be broadcast; more are shuffled.
# A block serves 16 keys, so the filter of several million rules still is sent round, and only keys that pass it are shuffled.
BROADCAST_ROWS = 100_000
BROADCAST_BLOCKS = 300_000
SALTS = 32


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, shape, 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, shape, 2), F.lit(""))
    return ascii_lower(host), path


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _mask(key: Column, word: int) -> Column:
    """The bit the key sets in one word of its block."""
    bit = F.shiftrightunsigned(F.xxhash64(key, F.lit(word)), 58).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def bloom_filter(keys: DataFrame, n_keys: int) -> tuple[DataFrame, int]:
    """One row of bit words per block that holds a key, and the number of blocks."""
    blocks = max(1, -(-n_keys * BITS_PER_KEY // (64 * BLOCK_WORDS)))
    words = [F.bit_or(_mask(F.col("key"), i)).alias(f"w{i}") for i in range(BLOCK_WORDS)]
    return keys.groupBy(_block(F.col("key"), blocks).alias("block")).agg(*words), blocks


def _join(left: DataFrame, right: DataFrame, on: str, small: bool) -> DataFrame:
    """Inner join with a table of unique keys; beyond the size for a broadcast, hot keys are dealt out by salt."""
    if small:
        return left.join(F.broadcast(right), on)
    salted = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(salted, [on, "salt"])


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    ``rules`` has host, path and verdict (allow or block); a URL no rule fits gets ``default``.
    """
    listed = (
        rules.select(ascii_lower(F.col("host")).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), "verdict")
        .where("r_host is not null")
        .groupBy("r_host", "r_path").agg(F.max("verdict").alias("verdict"))
        .withColumn("key", F.concat("r_host", "r_path"))
    )
    # What keys can look like: label counts of hosts and lengths of paths, both bounded by the longest URL listed.
    shape = listed.agg(
        F.count(F.lit(1)).alias("n"),
        F.collect_set(F.size(F.split("r_host", r"\.", -1))).alias("labels"),
        F.collect_set(F.length("r_path")).alias("lengths"),
    ).first()
    host, path = split_url(F.col("url"))
    urls = pages.select("page_id", "url").select("page_id", "url", host.alias("host"), path.alias("path"))
    labels = F.array(*map(F.lit, sorted(shape["labels"]))).cast("array<int>")
    lengths = F.array(*map(F.lit, sorted(shape["lengths"]))).cast("array<int>")
    n_labels = F.size(F.split("host", r"\.", -1))
    keys = (
        urls.where("host <> ''")
        .withColumn("n", F.explode(F.filter(labels, lambda n: n <= n_labels)))
        .withColumn("m", F.explode(F.filter(lengths, lambda m: m <= F.length("path"))))
        .withColumn("k_host", F.expr("substring_index(host, '.', -n)"))
        .withColumn("k_path", F.expr("left(path, m)"))
        .withColumn("key", F.concat("k_host", "k_path"))
        .withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    )
    bloom, blocks = bloom_filter(listed.select("key"), shape["n"])
    possible = _join(keys.withColumn("block", _block(F.col("key"), blocks)), bloom, "block", blocks <= BROADCAST_BLOCKS)
    for i in range(BLOCK_WORDS):
        possible = possible.where(F.col(f"w{i}").bitwiseAND(_mask(F.col("key"), i)) != 0)
    exact = _join(possible, listed.select("key", "r_host", "r_path", "verdict"), "key", shape["n"] <= BROADCAST_ROWS)
    best = (
        exact.where("k_host = r_host and k_path = r_path")
        .groupBy("page_id", "url")
        .agg(F.max(F.struct(
            F.length("key").alias("size"), F.length("r_host").alias("host_size"), "key", "verdict",
        )).alias("best"))
        .select(F.col("page_id").alias("b_id"), F.col("url").alias("b_url"), "best")
    )
    fits = F.col("page_id").eqNullSafe(F.col("b_id")) & F.col("url").eqNullSafe(F.col("b_url"))
    return urls.join(best, fits, "left").select(
        "page_id", "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
