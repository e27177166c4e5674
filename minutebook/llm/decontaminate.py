"""Benchmark decontamination: a prefix-filtered set join that finds benchmark windows in documents, in built-in functions only.

A window is a run of consecutive item words (a shorter item is one window). All of a window's words must be in a document that
contains it, so one of them is prefix enough: words are ordered by rarity in the corpus, and each window is looked up by its
rarest word. Where that word stands in a document, its place in the window says where the window would have to start; length and position
bounds drop what does not fit, and the words around are compared with the window's one by one.

Defined results: NULL, empty and wordless texts have no words and hit nothing; items without words are no items; each row is judged
alone, also if it repeats; other columns are ignored; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minutebook.llm.common import ascii_lower, staged

WINDOW = 10
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# A row of the benchmark's windows takes under 1 KB; a table of at most this many may be broadcast, a larger one is shuffled.
BROADCAST_ROWS = 50_000


def plain_words(text: Column) -> Column:
    """The words, A-Z lower-cased, one space between them."""
    return F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, " "))


def word_list(plain: Column) -> Column:
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " ", -1))


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """window_id, item_id and words of every distinct window of every item."""
    words = items.select("item_id", word_list(plain_words(F.col("text"))).alias("all")).where(F.size("all") > 0)
    size = F.least(F.lit(window), F.size("all"))
    each = words.withColumn("begin", F.explode(F.sequence(F.lit(1), F.size("all") - size + 1)))
    return each.select("item_id", F.slice("all", F.col("begin"), size).alias("words")).distinct().withColumn(
        "window_id", F.monotonically_increasing_id()
    )


def _near(table: DataFrame, n: int) -> DataFrame:
    return F.broadcast(table) if n <= BROADCAST_ROWS else table


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """row, start (words before it), size and item_id of every occurrence of a window. ``docs`` has row and plain, and is stored."""
    windows = staged(item_windows(items, window), "windows")
    n_windows = windows.count()
    spots = windows.select("window_id", F.posexplode("words").alias("place", "word"))
    vocabulary = spots.select("word").distinct()
    n_words = vocabulary.count()
    frequency = (
        docs.select(F.explode(F.split("plain", " ", -1)).alias("word")).join(_near(vocabulary, n_words), "word")
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    )
    rarest = (
        spots.join(staged(frequency, "frequency"), "word", "left").groupBy("window_id")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "place")).alias("first"))
        .where("first.n > 0")  # else no document has the word
    )
    prefixes = staged(windows.join(rarest, "window_id").select("item_id", "words", "first.word", "first.place"), "prefixes")
    tokens = prefixes.select("word").distinct()
    found = (
        docs.select("row", F.posexplode(F.split("plain", " ", -1)).alias("at", "word")).join(_near(tokens, n_words), "word")
        .groupBy("row").agg(F.collect_list(F.struct("at", "word")).alias("found"))
    )
    reach = window - 1
    around = (
        docs.join(staged(found, "found"), "row").select("row", F.split("plain", " ", -1).alias("all"), "found")
        .select("row", "all", F.explode("found").alias("f")).select(
            "row", "f.word", "f.at", F.greatest(F.col("f.at") - reach, F.lit(0)).alias("begin"), F.size("all").alias("n_words"),
            F.slice("all", F.greatest(F.col("f.at") - reach, F.lit(0)) + 1, F.lit(2 * reach + 1)).alias("around"),
        )
    )
    start, size = F.col("at") - F.col("place"), F.size("words")
    return (
        around.join(_near(prefixes, n_windows), "word")
        .where((start >= 0) & (start + size <= F.col("n_words")))
        .where(F.slice("around", start - F.col("begin") + 1, size) == F.col("words"))
        .select("row", start.alias("start"), size.alias("size"), "item_id")
    )


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document.

    n_hit counts the words inside any window, n_items the items with windows in the document; items_sha256 is the digest of
    their ids as sorted strings, comma-joined.
    """
    plain = docs.select("doc_id", plain_words(F.col("text")).alias("plain"))
    rows = staged(plain.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "plain", F.size(word_list(F.col("plain"))).cast("long").alias("n_words"),
    ), "words")
    found = staged(hits(rows.where("n_words > 0").select("row", "plain"), items, window), "hits")
    earlier = Window.partitionBy("row").orderBy("start", "size").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("size")
    covered = (
        found.select("row", "start", "size").distinct()
        .withColumn("upto", F.coalesce(F.max(end).over(earlier), F.lit(0)))
        .groupBy("row").agg(F.sum(F.greatest(end - F.greatest("start", "upto"), F.lit(0))).alias("n_hit"))
    )
    of = (
        found.select("row", "item_id").distinct().groupBy("row")
        .agg(F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("ids"))
    )
    digest = F.sha2(F.array_join(F.coalesce("ids", F.array().cast("array<string>")), ","), 256)
    return rows.select("row", "doc_id", "n_words").join(covered.join(of, "row"), "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), digest.alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
