"""Exact token counts for every context limit from one histogram of encoded lengths.

Documents are encoded once and counted by length; the histogram has at most as many rows as the longest document has tokens,
whatever the number of documents. Suffix sums over it answer how many documents and tokens lie beyond a limit, and so what a
truncation keeps. The sums are built in two levels (spans of lengths, then within a span), so no task holds all lengths.

Defined results: NULL and empty texts have length 0 and count as documents; repeated rows each count; no documents give no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from minutebook.llm.common import staged
from minutebook.llm.encoding import Encoder

SPAN = 128


def token_lengths(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``n_tokens`` of every document; nothing else is kept."""
    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            sizes = [len(encoder.ids(text.as_py())) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], ["n_tokens"])

    return docs.select("text").mapInArrow(lengths, "n_tokens long")


def length_histogram(docs: DataFrame, path: str | None = None) -> DataFrame:
    """n_tokens and n_docs, one row per length that occurs."""
    return token_lengths(docs, path).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def context_curve(histogram: DataFrame) -> DataFrame:
    """The answers for every context limit at which they change, which is every length that occurs.

    context_limit, n_docs of that length, docs_over and tokens_over (documents longer than the limit and all their tokens),
    tokens_truncated (what is left when each document is cut at the limit), tokens_total, docs_total, and share_within, the
    share of documents no longer than the limit (so the limit is that quantile of the lengths).
    """
    rows = histogram.withColumn("span", F.floor(F.col("n_tokens") / SPAN)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    spans = rows.groupBy("span").agg(F.sum("n_docs").alias("span_docs"), F.sum("tokens").alias("span_tokens"))
    later = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    spans = spans.select(
        "span",
        F.coalesce(F.sum("span_docs").over(later), F.lit(0)).alias("docs_later"),
        F.coalesce(F.sum("span_tokens").over(later), F.lit(0)).alias("tokens_later"),
        F.sum("span_docs").over(every).alias("docs_total"),
        F.sum("span_tokens").over(every).alias("tokens_total"),
    )
    longer = Window.partitionBy("span").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    docs_over = F.col("docs_later") + F.coalesce(F.sum("n_docs").over(longer), F.lit(0))
    tokens_over = F.col("tokens_later") + F.coalesce(F.sum("tokens").over(longer), F.lit(0))
    return (
        rows.join(spans, "span")
        .withColumn("docs_over", docs_over).withColumn("tokens_over", tokens_over)
        .select(
            F.col("n_tokens").alias("context_limit"), "n_docs", "docs_over", "tokens_over",
            (F.col("tokens_total") - F.col("tokens_over") + F.col("docs_over") * F.col("n_tokens")).alias("tokens_truncated"),
            "tokens_total", "docs_total",
            ((F.col("docs_total") - F.col("docs_over")) / F.col("docs_total")).alias("share_within"),
        )
    )


def totals_at(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """docs_over, tokens_over and tokens_truncated for the limits given, whether or not a document has that length."""
    limit = F.explode(F.array(*map(F.lit, limits)).cast("array<long>")).alias("context_limit")
    over, size = F.col("n_tokens") > F.col("context_limit"), F.col("n_tokens") * F.col("n_docs")
    return histogram.select("n_tokens", "n_docs", limit).groupBy("context_limit").agg(
        F.sum(F.when(over, F.col("n_docs")).otherwise(0)).alias("docs_over"),
        F.sum(F.when(over, size).otherwise(0)).alias("tokens_over"),
        F.sum(F.least("n_tokens", "context_limit") * F.col("n_docs")).alias("tokens_truncated"),
    )


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The curve of all documents; the histogram is staged, so texts are encoded once."""
    return context_curve(staged(length_histogram(docs, path), "lengths"))
