"""Fragments to the daily lake."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.functions.guards import ratio
from minutebook.functions.times import in_date_range
from minutebook.operators.profiles import day_summary
from minutebook.schema import KEY
from minutebook.sources.files import file_inventory, with_names
from minutebook.sources.fragments import FRAGMENT_GLOB, checked_files, fragment_footers, scan_fragments
from minutebook.sources.lake import scan_lake, stored_dates, stored_sizes, write_daily


def union_all(*frames: DataFrame) -> DataFrame:
    """Stack bars; a column some frame lacks is NULL there. Duplicate rows stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def drop_duplicates(bars: DataFrame) -> DataFrame:
    """Whole-row copies removed; rows that differ in any column stay."""
    return bars.distinct()


def consolidated_dates(spark: SparkSession, input_root: str, output_root: str) -> DataFrame:
    """Days already in the lake, or present as a YYYYMMDD.parquet file in the input tree."""
    loose = with_names(file_inventory(spark, input_root, pattern="[0-9]*.parquet")).filter(
        F.col("symbol").isNull() & F.col("date").isNotNull()
    )
    return stored_dates(spark, output_root).union(loose.select("date")).distinct()


def input_stats(files: DataFrame) -> DataFrame:
    """Per day: files read and failed, rows and MB going in. File rows are folded before the shuffle."""
    good = F.col("rows") > 0
    return files.groupBy("date").agg(
        F.count_if(good).alias("files_read"),
        F.count_if(F.col("error").isNotNull()).alias("files_failed"),
        F.coalesce(F.sum(F.when(good, F.col("rows"))), F.lit(0)).alias("input_rows"),
        (F.coalesce(F.sum(F.when(good, F.col("length"))), F.lit(0)) / F.lit(1024.0 * 1024.0)).alias("input_mb"),
    )


def date_stats(inputs: DataFrame, summary: DataFrame, sizes: DataFrame) -> DataFrame:
    """Per-day consolidation result."""
    # The names of the result's fields.
    out_mb = F.coalesce(F.col("bytes") / F.lit(1024.0 * 1024.0), F.lit(0.0))
    joined = inputs.join(summary, "date", "left").join(sizes.select("date", "bytes"), "date", "left")
    return joined.select(
        "date", "files_read", "files_failed", "input_rows",
        F.coalesce("symbol_count", F.lit(0)).cast("long").alias("symbols_found"),
        F.coalesce("row_count", F.lit(0)).cast("long").alias("total_rows"),
        "input_mb",
        out_mb.alias("output_mb"),
        ratio(F.col("input_mb"), out_mb).alias("compression_ratio"),
        F.coalesce(F.col("row_count") > 0, F.lit(False)).alias("success"),
    )


def overall_stats(per_date: DataFrame) -> DataFrame:
    """One row over all days."""
    ok = F.col("success")
    total = lambda c, kind="long": F.coalesce(F.sum(F.when(ok, F.col(c))), F.lit(0)).cast(kind)
    return per_date.agg(
        F.count("*").alias("dates_processed"),
        F.count_if(ok).alias("dates_successful"),
        F.count_if(~ok).alias("dates_failed"),
        total("symbols_found").alias("total_symbols"),
        total("files_read").alias("total_files_read"),
        F.coalesce(F.sum("files_failed"), F.lit(0)).alias("total_files_failed"),
        total("total_rows").alias("total_rows"),
        total("input_mb", "double").alias("total_input_mb"),
        total("output_mb", "double").alias("total_output_mb"),
    ).withColumns(
        {
            "compression_ratio": ratio(F.col("total_input_mb"), F.col("total_output_mb")),
            "avg_symbols_per_day": F.when(
                F.col("dates_successful") > 0, F.col("total_symbols") / F.col("dates_successful")
            ),
        }
    )


def consolidate_all(
    spark: SparkSession, input_root: str, output_root: str, start: str | None = None, end: str | None = None,
    overwrite: bool = False, skip_existing: bool = True, dry_run: bool = False, dedupe: bool = False,
    files_per_day: int | None = None,
) -> DataFrame:
    """Consolidate all pending days in one job and return the per-day result.

    Files are listed by their footers, and those of days that are done go no further. A dry run stops there and
    reports what would be combined.
    """
    files = fragment_footers(spark, input_root, start, end)
    if skip_existing and not overwrite:
        done = consolidated_dates(spark, input_root, output_root)
        files = files.join(F.broadcast(done), "date", "left_anti")  # one row per day
    if not dry_run:
        files = checked_files(files)
    if dry_run:
        by_symbol = files.filter(F.col("rows") > 0).groupBy(*KEY).agg(F.sum("rows").alias("n"))
        planned = by_symbol.groupBy("date").agg(F.sum("n").alias("row_count"), F.count("*").alias("symbol_count"))
        nothing = spark.createDataFrame([], "date string, bytes long")
        return date_stats(input_stats(files), planned, nothing)
    bars = scan_fragments(spark, input_root, files)
    write_daily(
        drop_duplicates(bars) if dedupe else bars, output_root,
        existing="overwrite" if overwrite else "skip", files_per_day=files_per_day,
    )
    days = [r["date"] for r in files.select("date").distinct().collect()]  # one text per day
    stored = day_summary(scan_lake(spark, output_root).filter(F.col("date").isin(days)))
    return date_stats(input_stats(files), stored, stored_sizes(spark, output_root))


def run_counts(
    spark: SparkSession, input_root: str, output_root: str, start: str | None = None, end: str | None = None,
    overwrite: bool = False, skip_existing: bool = True,
) -> dict[str, int]:
    """How many dates a run finds, would skip and has done before, from file names alone. To be asked before the run."""
    named = with_names(file_inventory(spark, input_root, pattern=FRAGMENT_GLOB)).filter(F.col("symbol").isNotNull() & F.col("date").isNotNull())
    done = consolidated_dates(spark, input_root, output_root).withColumn("done", F.lit(True))
    outside = ~in_date_range(F.col("date"), start, end) if start or end else F.lit(False)
    kept = F.col("done").isNotNull() & F.lit(skip_existing and not overwrite)
    row = named.select("date").distinct().join(done, "date", "full").withColumn("outside", outside)
    # a date of the output that the input no longer has counts as done only
    found = named.select("date").distinct().withColumn("found", F.lit(True))
    counts = row.join(found, "date", "left").agg(
        F.count("found").alias("dates_found"), F.count_if(F.col("found") & (F.col("outside") | kept)).alias("dates_skipped"),
        F.count("done").alias("dates_already_consolidated"),
    )
    # The names of the result's fields.
    return counts.first().asDict()


def consolidation_totals(spark: SparkSession, input_root: str, output_root: str, start: str | None = None, end: str | None = None, **options) -> DataFrame:
    """Consolidate all pending days; one row with the totals and what was found, skipped and done before."""
    kept = {k: v for k, v in options.items() if k in ("overwrite", "skip_existing")}
    counts = run_counts(spark, input_root, output_root, start, end, **kept)
    totals = overall_stats(consolidate_all(spark, input_root, output_root, start, end, **options))
    return totals.withColumns({name: F.lit(n).cast("long") for name, n in counts.items()})
