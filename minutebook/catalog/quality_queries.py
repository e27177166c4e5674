"""Quality facts, screens, reports and purge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.catalog import sql as q
from minutebook.catalog import tables as t
from minutebook.catalog.bar_queries import REJECTS, dirty_rejects
from minutebook.catalog.registry import query
from minutebook.operators import layers, quality
from minutebook.plans import facts_store, maintain, snapshots
from minutebook.schema import KEY, REJECT_SCHEMA
from minutebook.session import work_folder
from minutebook.sources import landing, versions
from minutebook.sources.lake import scan_lake, write_daily

FACTS = (q.DIRTY_BARS, q.FACTS)
REGISTRY_DATE = "20240110"


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_facts(t.dirty_bars(spark, sf_dir))


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scan(facts(spark, sf_dir))


@query(
    "quality_facts",
    q.with_(*FACTS) + """
SELECT symbol, date, n, first_close, all_zeros, all_nulls, zero_volume, flat, negative, violation FROM facts""",
)
def quality_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of quality facts per symbol-day."""
    return facts(spark, sf_dir).select(
        *KEY, "n", "first_close", "all_zeros", "all_nulls", "zero_volume", "flat", "negative", "violation"
    )


@query(
    "quality_gate",
    REJECTS + """
SELECT b.symbol, b.date, b.timestamp, b.close, b.volume FROM bars b
WHERE NOT EXISTS (SELECT 1 FROM rejects r WHERE r.symbol = b.symbol AND r.date = b.date)""",
)
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of the symbol-days that pass the ingest gate."""
    return quality.quality_gate(t.dirty_bars(spark, sf_dir)).select(*KEY, "timestamp", "close", "volume")


@query("quality_rejects", REJECTS + "SELECT * FROM rejects")
def quality_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected symbol-days with the first rule they fail."""
    return dirty_rejects(spark, sf_dir)


@query("quality_scan", q.with_(*FACTS, q.ISSUES) + "SELECT * FROM issues")
def quality_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All issues of all symbol-days."""
    return issues(spark, sf_dir)


@query(
    "issue_counts",
    q.with_(*FACTS, q.ISSUES) + """
SELECT issue_type, is_special, count(*) AS issue_rows,
       count(*) FILTER (WHERE issue_type = 'all_nulls' OR (issue_type = 'all_zeros' AND NOT is_special)) AS critical
FROM issues GROUP BY issue_type, is_special""",
)
def issue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues per type and kind of security."""
    return quality.issue_counts(issues(spark, sf_dir))


@query(
    "scan_totals",
    q.with_(*FACTS, q.ISSUES) + """
SELECT (SELECT count(*) FROM facts) AS groups,
       (SELECT count(*) FROM facts) - count(DISTINCT (symbol, date)) AS valid_groups,
       count(DISTINCT (symbol, date)) AS groups_with_issues, count(*) AS issue_rows FROM issues""",
)
def scan_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol-days scanned, clean and with issues."""
    found = facts(spark, sf_dir)
    return quality.scan_totals(found)


@query(
    "issue_samples",
    q.with_(*FACTS, q.ISSUES) + """
SELECT file, issue_type, details, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY issue_type ORDER BY file, details) AS INTEGER) AS rank FROM issues)
WHERE rank <= 10""",
)
def issue_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First ten issues of each type in file order."""
    return quality.issue_samples(issues(spark, sf_dir), 10).select("file", "issue_type", "details", "rank")


@query(
    "quality_report",
    q.with_(*FACTS, q.ISSUES) + """
SELECT file AS "File", symbol AS "Symbol", issue_type || CASE WHEN routed_special THEN '_special' ELSE '' END AS "Issue Type",
       details AS "Details", CASE WHEN is_special THEN 'True' ELSE 'False' END AS "Is Special Security" FROM issues""",
)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality report as written to CSV and read back."""
    root = work_folder(spark, "report")
    landing.write_csv_report(quality.report_rows(issues(spark, sf_dir)), root)
    return spark.read.csv(root, header=True)


def plan_with_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = facts(spark, sf_dir)
    return quality.purge_plan(found, found.select(*KEY, (F.col("n") * 64).alias("size_bytes")))


PLAN = f"""
plan AS (
  SELECT {q.FILE_OF} AS file, symbol, date, {q.PURGE_REASON} AS reason, n * 64 AS size_bytes, is_special
  FROM facts WHERE {q.PURGE_REASON} IS NOT NULL)"""


@query("purge_plan", q.with_(*FACTS, PLAN) + "SELECT * FROM plan")
def purge_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol-days a purge would remove."""
    return plan_with_sizes(spark, sf_dir)


@query(
    "purge_log",
    q.with_(*FACTS, PLAN) + """
SELECT file AS "File", symbol AS "Symbol", reason AS "Reason", CAST(size_bytes AS VARCHAR) AS "Size (bytes)",
       CASE WHEN is_special THEN 'Yes' ELSE 'No' END AS "Is Special Security" FROM plan""",
)
def purge_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The purge log as written to CSV and read back."""
    root = work_folder(spark, "purge-log")
    landing.write_csv_report(quality.purge_log_rows(plan_with_sizes(spark, sf_dir)), root)
    return spark.read.csv(root, header=True)


@query(
    "purge_summary",
    q.with_(*FACTS, PLAN) + """
SELECT kind, symbol, count(*) AS files, CAST(sum(size_bytes) AS BIGINT) AS bytes
FROM (SELECT *, CASE WHEN is_special THEN 'special' ELSE 'regular' END AS kind FROM plan) GROUP BY ROLLUP (kind, symbol)""",
)
def purge_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purged symbol-days and bytes per symbol, kind of security and in total."""
    return quality.purge_summary(plan_with_sizes(spark, sf_dir))


@query(
    "purge_apply",
    q.with_(*FACTS, PLAN) + """
SELECT b.symbol, b.date, b.timestamp, b.close, b.volume FROM bars b
WHERE NOT EXISTS (SELECT 1 FROM plan p WHERE p.symbol = b.symbol AND p.date = b.date)""",
)
def purge_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next version of the table after the purge, read back."""
    root = work_folder(spark, "purged")
    maintain.purge_to_new_version(spark, t.dirty_bars(spark, sf_dir), plan_with_sizes(spark, sf_dir), root)
    return maintain.read_purged(spark, root).select(*KEY, "timestamp", "close", "volume")


@query(
    "purge_lake",
    q.with_(*FACTS, PLAN) + """
SELECT b.symbol, b.date, b.timestamp, b.close, b.volume FROM bars b
WHERE NOT EXISTS (SELECT 1 FROM plan p WHERE p.symbol = b.symbol AND p.date = b.date)""",
)
def purge_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a lake holds after a purge that rewrites only the days concerned."""
    root = t.stored_lake(spark, t.dirty_bars(spark, sf_dir))
    maintain.purge_lake(spark, root, quality.purge_plan(quality.quality_facts(scan_lake(spark, root))))
    return scan_lake(spark, root).select(*KEY, "timestamp", "close", "volume")


# Junk, empty and column-less files of the fragment tree, by day of the month.
TREE_DAYS = f"""
day_files AS (SELECT DISTINCT symbol, date, {q.DAY} % 7 AS k, {q.FILE_OF} AS file, regexp_full_match(symbol, '[A-Z]+[UWRZ]') AS is_special FROM bars)"""


def _tree_facts(kept: str) -> str:
    return q.FACTS.replace("FROM bars)", f"FROM bars WHERE {q.DAY} % 7 IN ({kept}))")


@query(
    "scan_tree",
    q.with_(q.EVENT_BARS, TREE_DAYS, _tree_facts("4, 5, 6"), q.ISSUES) + """
SELECT file, symbol, date, issue_type, details, is_special, routed_special FROM issues
UNION ALL SELECT file, symbol, date, 'read_errors', NULL, false, false FROM day_files WHERE k = 0
UNION ALL SELECT file, symbol, date, 'all_nulls', 'File is empty (0 rows)', is_special, false FROM day_files WHERE k = 1
UNION ALL SELECT file, symbol, date, 'other_issues', 'Missing columns: volume', is_special, false FROM day_files WHERE k = 2
UNION ALL SELECT file, symbol, date, 'other_issues', 'Missing columns: high, low', is_special, false FROM day_files WHERE k = 3""",
)
def scan_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All issues of a fragment tree with unreadable, empty and column-less files; the reader's own words are left out."""
    found = maintain.scan_tree(spark, t.fragment_tree(spark, sf_dir, narrow=True))
    words = F.when(F.col("issue_type") != "read_errors", F.col("details"))
    return found.select("file", *KEY, "issue_type", words.alias("details"), "is_special", "routed_special")


@query(
    "purge_tree",
    q.with_(q.EVENT_BARS, TREE_DAYS, _tree_facts("2, 4, 5, 6").replace("vz = n OR vc = 0 AS zero_volume", f"{q.DAY} % 7 <> 2 AND (vz = n OR vc = 0) AS zero_volume"))
    + f"""
SELECT {q.FILE_OF} AS file, symbol, date, {q.PURGE_REASON} AS reason, is_special, true AS has_size FROM facts WHERE {q.PURGE_REASON} IS NOT NULL
UNION ALL SELECT file, symbol, date, 'Empty file (0 rows)', is_special, true FROM day_files WHERE k = 1
UNION ALL SELECT file, symbol, date, 'Missing columns: high, low', is_special, true FROM day_files WHERE k = 3""",
)
def purge_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments that a purge would remove from a tree with empty and column-less files."""
    plan = maintain.purge_tree_plan(spark, t.fragment_tree(spark, sf_dir, narrow=True))
    return plan.select("file", *KEY, "reason", "is_special", (F.col("size_bytes") > 0).alias("has_size"))


# --- facts and snapshots ----------------------------------------------------------

STILL_DAY, GONE_DAY, FIRST_DAYS = "20240110", "20240105", "20240120"
CHANGED = f"""
changed AS (SELECT * REPLACE (CASE WHEN date = '{STILL_DAY}' THEN 0.0 ELSE volume END AS volume) FROM bars WHERE date <> '{GONE_DAY}')"""


@query(
    "facts_refresh",
    q.with_(q.DIRTY_BARS, CHANGED, q.FACTS.replace("FROM bars)", "FROM changed)")) + f"""
SELECT symbol, date, n, first_close, all_zeros, all_nulls, zero_volume, flat, negative, violation,
       CASE WHEN date = '{STILL_DAY}' OR date > '{FIRST_DAYS}' THEN 'computed' ELSE 'kept' END AS action FROM facts""",
)
def facts_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored facts after days were added, one was overwritten and one purged, and what the second refresh did with each day."""
    root, store = work_folder(spark, "lake"), work_folder(spark, "facts")
    made = t.dirty_bars(spark, sf_dir)
    write_daily(made.filter(F.col("date") <= FIRST_DAYS), root)
    facts_store.refresh_facts(spark, root, store)
    write_daily(made, root)
    write_daily(made.filter(F.col("date") == STILL_DAY).withColumn("volume", F.lit(0.0)), root, existing="overwrite")
    maintain.purge_lake(spark, root, made.filter(F.col("date") == GONE_DAY).select(*KEY).distinct())
    actions = facts_store.refresh_facts(spark, root, store)
    return facts_store.stored_facts(spark, store).join(actions, "date").select(
        *KEY, "n", "first_close", "all_zeros", "all_nulls", "zero_volume", "flat", "negative", "violation", "action"
    )


@query(
    "merged_facts",
    q.with_(*FACTS) + """
SELECT symbol, CAST(sum(n) AS BIGINT) AS n, bool_or(negative) AS negative, bool_or(violation) AS violation, bool_and(flat) AS flat,
       bool_and(all_nulls) AS all_nulls, arg_min_null(first_close, date) AS first_close FROM facts GROUP BY symbol""",
)
def merged_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts per symbol over all days, merged from stored facts of symbol-days."""
    root, store = work_folder(spark, "lake"), work_folder(spark, "facts")
    write_daily(t.dirty_bars(spark, sf_dir), root)
    facts_store.refresh_facts(spark, root, store)
    merged = facts_store.merged_facts(facts_store.stored_facts(spark, store), ["symbol"])
    return merged.select("symbol", "n", "negative", "violation", "flat", "all_nulls", "first_close")


@query(
    "purge_snapshot",
    q.with_(*FACTS) + f"""
SELECT CAST(version AS INTEGER) AS version, symbol, date, n FROM facts, (VALUES (1), (2)) AS v(version)
WHERE version = 1 OR {q.PURGE_REASON} IS NULL""",
)
def purge_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per symbol-day before and after a purge that is one commit; the earlier version stays readable."""
    root = work_folder(spark, "snapshots")
    made = t.dirty_bars(spark, sf_dir)
    before = snapshots.write_days(made, root)
    after = snapshots.purge_days(spark, root, quality.purge_plan(quality.quality_facts(made)))
    counted = lambda v: snapshots.scan_snapshot(spark, root, version=v).groupBy(*KEY).agg(F.count("*").alias("n"))
    return counted(before).withColumn("version", F.lit(1)).unionByName(counted(after).withColumn("version", F.lit(2)))


# --- reject registry --------------------------------------------------------------

@query("reject_registry", REJECTS + "SELECT * FROM rejects")
def reject_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reject registry as written to JSON per date and read back."""
    root = work_folder(spark, "registry")
    landing.write_registry(dirty_rejects(spark, sf_dir), root)
    return landing.read_registry(spark, root)


@query("rejects_for_date", REJECTS + f"SELECT * FROM rejects WHERE date = '{REGISTRY_DATE}'")
def rejects_for_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered rejects of one date."""
    return layers.rejects_for_date(dirty_rejects(spark, sf_dir), REGISTRY_DATE)


@query("reject_clear", REJECTS + f"SELECT * FROM rejects WHERE date <> '{REGISTRY_DATE}'")
def reject_clear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry's next version after one date was cleared."""
    root = work_folder(spark, "registry")
    versions.write_next(dirty_rejects(spark, sf_dir), root)
    stored = versions.read_current(spark, root, REJECT_SCHEMA)
    versions.write_next(layers.clear_rejects(stored, REGISTRY_DATE), root)
    return versions.read_current(spark, root, REJECT_SCHEMA)
