"""Layout audit, reorganisation, tree scans and purge of a bar store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.functions.symbols import fragment_name, is_special
from minutebook.functions.times import text_to_date
from minutebook.functions.trading_days import is_trading_day
from minutebook.operators.quality import purge_apply, purge_plan, quality_facts, quality_scan
from minutebook.schema import BAR_SCHEMA, KEY, LAKE_SCHEMA, OHLC
from minutebook.sources.files import file_inventory, remove_folder, with_names
from minutebook.sources.fragments import bars_of_files, checked_files, empty_files, file_footers, fragment_files, read_errors, scan_fragments
from minutebook.session import work_folder
from minutebook.sources.lake import PARTITIONS, scan_lake, stored_dates, with_partitions, write_daily
from minutebook.sources.versions import read_current, write_next

# --- layout -----------------------------------------------------------------------

DAY_PATH = r"(?:^|/)\d{4}/\d{2}/[^/]+$"


def audited_files(files: DataFrame, **calendar) -> DataFrame:
    """Files of a YYYY/MM tree with date, symbol and whether the date is a trading day."""
    named = with_names(files).filter(F.col("path").rlike(DAY_PATH) & F.col("date").isNotNull())
    return named.withColumn("is_valid", is_trading_day(F.col("date"), **calendar))


def layout_audit(files: DataFrame, **calendar) -> DataFrame:
    """One row of counters over a file inventory.

    Dates and symbols are folded to one row each before they are counted.
    """
    checked = with_names(files).withColumn(
        "is_valid",
        F.when(F.col("path").rlike(DAY_PATH) & F.col("date").isNotNull(), is_trading_day(F.col("date"), **calendar)),
    )
    pairs = checked.groupBy("date", "symbol", "is_valid").agg(F.count("*").alias("n"))
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_files"),
        F.coalesce(F.sum(F.when(F.col("is_valid"), F.col("n"))), F.lit(0)).alias("valid_trading_days"),
        F.coalesce(F.sum(F.when(~F.col("is_valid"), F.col("n"))), F.lit(0)).alias("invalid_trading_days"),
        F.count_distinct(F.when(F.col("is_valid"), F.col("date"))).alias("unique_dates"),
        F.count_distinct(F.when(F.col("is_valid").isNotNull(), F.col("symbol"))).alias("unique_symbols"),
    )


def layout_issues(files: DataFrame, **calendar) -> DataFrame:
    """Files that sit on non-trading days."""
    return audited_files(files, **calendar).filter(~F.col("is_valid")).select(
        "path", F.concat(F.lit("Non-trading day file: "), F.col("path")).alias("issue")
    )


def organize_plan(files: DataFrame, existing: DataFrame | None = None, **calendar) -> DataFrame:
    """What to do with each file of a flat dump.

    ``move``, ``drop_non_trading``, ``skip_invalid``, ``already_organised`` or ``skip_exists``
    (when ``existing`` holds the target path).
    """
    named = with_names(files)
    date, name = F.col("date"), F.col("name")
    target = F.concat(F.substring(date, 1, 4), F.lit("/"), F.substring(date, 5, 2), F.lit("/"), name)
    plan = named.withColumn("target", F.when(text_to_date(date).isNotNull(), target))
    if existing is not None:
        present = existing.select(F.col("path").alias("target")).distinct().withColumn("present", F.lit(True))
        plan = plan.join(present, "target", "left")
    else:
        plan = plan.withColumn("present", F.lit(None).cast("boolean"))
    action = (
        F.when(F.col("target").isNull(), "skip_invalid")
        .when(~is_trading_day(date, **calendar), "drop_non_trading")
        .when(F.col("path").endswith(F.concat(F.lit("/"), F.col("target"))), "already_organised")
        .when(F.col("present"), "skip_exists")
        .otherwise("move")
    )
    return plan.select("path", "name", "symbol", "date", "target", action.alias("action"))


def organize_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("action").agg(F.count("*").alias("files"))


def organize_apply(spark: SparkSession, source_root: str, lake_root: str, **calendar) -> DataFrame:
    """Store the files of a dump in the lake, symbol-days that it holds already left out; the dump itself is not touched.

    Returns the plan, where a file that was to be taken but does not open is ``unreadable``. What the plan moves or finds organised is
    stored, whether fragments or whole-day files, and nothing else.
    """
    held = scan_lake(spark, lake_root).select(*KEY).distinct()
    existing = held.select(fragment_name(F.col("symbol"), F.col("date")).alias("path"))
    folder = work_folder(spark, "plan")
    held.write.parquet(f"{folder}/held")
    held = spark.read.parquet(f"{folder}/held")
    files = checked_files(file_footers(spark, source_root, is_trading_day(F.col("date"), **calendar), "*.parquet"))
    plan = organize_plan(file_inventory(spark, source_root), existing, **calendar)
    broken = files.filter("error is not null").select("path", F.lit(True).alias("broken"))
    taken = F.col("action").isin("move", "already_organised")
    plan = plan.join(broken, "path", "left").withColumn("action", F.when(taken & F.col("broken"), "unreadable").otherwise(F.col("action")))
    plan.drop("broken").write.parquet(f"{folder}/plan")
    plan = spark.read.parquet(f"{folder}/plan")
    bars = bars_of_files(files.join(plan.filter(taken).select("path"), "path", "left_semi"))
    write_daily(bars.drop("path").join(held, KEY, "left_anti"), lake_root, existing="add")
    return plan


# --- scans of file trees ----------------------------------------------------------

def _lacking(files: DataFrame, required: list[str]) -> DataFrame:
    """Readable files with rows that lack columns, and which."""
    present = F.transform(F.split("columns", ","), lambda c: F.lower(F.substring_index(c, ":", 1)))
    lacks = F.array_except(F.array(*map(F.lit, required)), present)
    return files.filter("rows > 0").select("symbol", "date", "length", lacks.alias("lacks")).filter(F.size("lacks") > 0)


def _missing_text() -> Column:
    return F.concat(F.lit("Missing columns: "), F.array_join("lacks", ", "))


def scan_tree(
    spark: SparkSession, root: str, min_bars: int = 961, split_specials: bool = True,
    start: str | None = None, end: str | None = None,
) -> DataFrame:
    """All quality issues of a fragment tree, unreadable, empty and column-less files included.

    Of a file without a required column only that is reported, as its bars cannot be judged.
    """
    files = fragment_files(spark, root, start, end)
    lacking = _lacking(files, [*OHLC, "volume"])
    facts = quality_facts(scan_fragments(spark, root, files)).join(lacking.select(*KEY), KEY, "left_anti")
    issues = quality_scan(facts, min_bars, split_specials)

    def of_file(rows: DataFrame, kind: str, details: Column) -> DataFrame:
        return rows.select(
            fragment_name(F.col("symbol"), F.col("date")).alias("file"), "symbol", "date",
            F.lit(kind).alias("issue_type"), details.alias("details"),
            is_special(F.col("symbol")).alias("is_special"), F.lit(False).alias("routed_special"),
        )

    blank = of_file(empty_files(files), "all_nulls", F.lit("File is empty (0 rows)"))
    narrow = of_file(lacking, "other_issues", _missing_text())
    broken = read_errors(files).withColumn("file", fragment_name(F.col("symbol"), F.col("date")))
    return issues.unionByName(blank).unionByName(narrow).unionByName(broken)


def purge_tree_plan(spark: SparkSession, root: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Fragments of a tree that hold nothing usable, with reason and stored bytes.

    Empty files and files without a price column count; a missing ``volume`` alone does not, and says nothing about
    volumes. Unreadable files are left for a repair.
    """
    files = fragment_files(spark, root, start, end)
    narrow = _lacking(files, OHLC)
    silent = _lacking(files, ["volume"]).select(*KEY, F.lit(True).alias("silent"))
    facts = quality_facts(scan_fragments(spark, root, files)).join(narrow.select(*KEY), KEY, "left_anti")
    facts = facts.join(silent, KEY, "left").withColumn("zero_volume", F.col("zero_volume") & F.col("silent").isNull()).drop("silent")
    sizes = files.select(*KEY, F.col("length").alias("size_bytes"))

    def of_file(rows: DataFrame, reason: Column) -> DataFrame:
        return rows.select(
            fragment_name(F.col("symbol"), F.col("date")).alias("file"), *KEY, reason.alias("reason"),
            F.col("length").alias("size_bytes"), is_special(F.col("symbol")).alias("is_special"),
        )

    return (
        purge_plan(facts, sizes).unionByName(of_file(empty_files(files), F.lit("Empty file (0 rows)")))
        .unionByName(of_file(narrow, _missing_text()))
    )


# --- purge ------------------------------------------------------------------------

def purge_to_new_version(spark: SparkSession, bars: DataFrame, plan: DataFrame, root: str) -> int:
    """Write the table without the purged symbol-days as the next version of ``root``."""
    kept = with_partitions(purge_apply(bars, plan)).hint("rebalance", "date")
    return write_next(kept.sortWithinPartitions(*PARTITIONS, "symbol", "timestamp"), root, PARTITIONS)


def purge_lake(spark: SparkSession, lake_root: str, plan: DataFrame) -> list[str]:
    """Remove the planned symbol-days from a lake, rewriting only the days they are in.

    The rows that stay are staged first, then replace their days; a day that keeps nothing
    loses its folder. Running it again after a failure gives the same lake. Returns the
    emptied dates.
    """
    days = [r["date"] for r in plan.select("date").distinct().collect()]  # one text per day
    stage = work_folder(spark, "purge")
    touched = scan_lake(spark, lake_root, filled=True).filter(F.col("date").isin(days))
    write_daily(purge_apply(touched, plan), stage)
    kept = {r["date"] for r in stored_dates(spark, stage).collect()}
    if kept:
        write_daily(scan_lake(spark, stage, filled=True), lake_root, existing="overwrite")
    emptied = sorted(set(days) - kept)
    for d in emptied:
        remove_folder(spark, f"{lake_root}/year={d[:4]}/month={d[4:6]}/date={d}")
    return emptied


def read_purged(spark: SparkSession, root: str) -> DataFrame:
    return read_current(spark, root, LAKE_SCHEMA).select(*BAR_SCHEMA.names)
