"""Scans, sinks, consolidation, layout, symbols and calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.catalog import sql as q
from minutebook.catalog import tables as t
from minutebook.catalog.bar_queries import USER_BARS
from minutebook.catalog.registry import query
from minutebook.functions import symbols, times, trading_days
from minutebook.operators import profiles
from minutebook.plans import consolidate, maintain, relocate
from minutebook.schema import INDEX_SCHEMA, KEY
from minutebook.session import work_folder
from minutebook.sources import files, fragments, lake, landing, versions, zones

DAY = "20240117"
BARS = q.with_(q.EVENT_BARS)
READABLE = f"{q.DAY} % 7 NOT IN (0, 1)"
ROW = "symbol, date, timestamp, ms_of_day, open, high, low, close, volume, count, round(vwap, 4) AS vwap"


def _row(bars: DataFrame) -> DataFrame:
    return bars.withColumn("vwap", F.round("vwap", 4))


def _sparse(bars: DataFrame) -> DataFrame:
    """``count`` has NULLs here; as a double it compares the same everywhere."""
    return _row(bars).withColumn("count", F.col("count").cast("double"))


# --- lake -------------------------------------------------------------------------

@query("write_daily", BARS + f"SELECT {ROW} FROM bars")
def write_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily lake as written and read back."""
    return _row(lake.scan_lake(spark, t.stored_lake(spark, t.bars(spark, sf_dir))))


@query("scan_day", q.with_(USER_BARS) + f"SELECT {ROW} FROM bars WHERE date = '{DAY}'")
def scan_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of the lake."""
    return _row(lake.scan_day(spark, t.stored_lake(spark, t.bars(spark, sf_dir, by_user=True)), DAY))


@query("symbol_day_lookup", BARS + f"SELECT {ROW} FROM bars WHERE date = '{DAY}' AND symbol = 'CLICK'")
def symbol_day_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One symbol-day of the lake."""
    stored = lake.scan_lake(spark, t.stored_lake(spark, t.bars(spark, sf_dir)))
    return _row(lake.symbol_day(stored, "CLICK", DAY))


@query("scan_day_files", BARS + f"SELECT {ROW} FROM bars WHERE date BETWEEN '20240110' AND '20240119'")
def scan_day_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten days from a tree of whole-day files."""
    return _row(fragments.scan_day_files(spark, t.day_file_tree(spark, sf_dir), "20240110", "20240119"))


@query("zone_lookup", q.with_(USER_BARS) + f"SELECT {ROW} FROM bars WHERE date = '{DAY}' AND symbol IN ('SCX', 'SDD', 'SZR') ")
def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three symbol-days of a lake whose files are ranges of symbols, each from the files that can hold it."""
    root, store = work_folder(spark, "lake"), work_folder(spark, "zones")
    zones.write_clustered(t.bars(spark, sf_dir, by_user=True), root)
    zones.refresh_zones(spark, root, store)
    one, two, three = (zones.lookup(spark, root, store, s, DAY) for s in ("SCX", "SDD", "SZR"))
    return _row(one.unionByName(two).unionByName(three))


@query("write_fragments", BARS + f"SELECT {ROW} FROM bars")
def write_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder per symbol-day, read back."""
    root = work_folder(spark, "per-symbol")
    lake.write_fragments(t.bars(spark, sf_dir), root)
    return _row(spark.read.parquet(root))


@query(
    "write_policy",
    BARS + """
SELECT symbol, date, count(*) AS rows,
       sum(CASE WHEN date = '20240110' THEN 3 * volume WHEN date > '20240115' THEN 2 * volume ELSE volume END) AS volume
FROM bars GROUP BY symbol, date""",
)
def write_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored days survive a second write that skips; an overwrite replaces its own day only."""
    root = work_folder(spark, "lake")
    made = t.bars(spark, sf_dir)
    times_n = lambda n: made.withColumn("volume", F.col("volume") * n)
    lake.write_daily(made.filter(F.col("date") <= "20240115"), root)
    lake.write_daily(times_n(2), root, existing="skip")
    lake.write_daily(times_n(3).filter(F.col("date") == "20240110"), root, existing="overwrite")
    stored = lake.scan_lake(spark, root)
    return stored.groupBy(*KEY).agg(F.count("*").alias("rows"), F.sum("volume").alias("volume"))


def _indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index entries of the user bars, sizes from the row counts."""
    summary = profiles.day_summary(t.bars(spark, sf_dir, by_user=True))
    sizes = summary.select("date", (F.col("row_count") * 1048576).alias("bytes"))
    return versions.index_entries(summary, sizes)


@query(
    "index_upsert",
    q.with_(USER_BARS) + """
SELECT date, count(DISTINCT symbol) AS symbol_count, CASE WHEN date <= '20240110' THEN 2 ELSE 1 END * count(*) AS row_count,
       CAST(count(*) AS DOUBLE) AS file_size_mb FROM bars GROUP BY date""",
)
def index_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata index after an insert and a second upsert that replaces ten days."""
    root = work_folder(spark, "index")
    entries = _indexed(spark, sf_dir)
    versions.upsert_index(spark, root, entries)
    again = entries.filter(F.col("date") <= "20240110").withColumn("row_count", F.col("row_count") * 2)
    versions.upsert_index(spark, root, again)
    return versions.read_current(spark, root, INDEX_SCHEMA).drop("created_at")


@query("available_dates", q.with_(USER_BARS) + "SELECT DISTINCT date FROM bars ORDER BY date")
def available_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of the metadata index."""
    root = work_folder(spark, "index")
    versions.upsert_index(spark, root, _indexed(spark, sf_dir))
    return versions.available_dates(spark, root)


# --- fragments --------------------------------------------------------------------

@query(
    "scan_fragments",
    BARS + f"""
SELECT symbol, date, timestamp, ms_of_day, open, high, low, close, volume, CAST(CASE WHEN {q.DAY} % 2 = 0 THEN count END AS DOUBLE) AS count,
       round(vwap, 4) AS vwap FROM bars WHERE {READABLE}""",
)
def scan_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All bars of a fragment tree with mixed column types, junk and empty files."""
    return _sparse(fragments.scan_fragments(spark, t.fragment_tree(spark, sf_dir)))


@query(
    "file_inventory",
    BARS + "SELECT DISTINCT symbol || '_' || date || '.parquet' AS name, symbol, date, true AS has_bytes FROM bars",
)
def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file of a fragment tree, junk and empty ones too."""
    found = files.with_names(files.file_inventory(spark, t.fragment_tree(spark, sf_dir)))
    return found.select("name", *KEY, (F.col("length") > 0).alias("has_bytes"))


@query(
    "read_errors",
    BARS + f"""
SELECT DISTINCT symbol, date, 'read_errors' AS issue_type, false AS is_special FROM bars WHERE {q.DAY} % 7 = 0""",
)
def read_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments that do not open; empty ones are not among them."""
    broken = fragments.read_errors(fragments.fragment_files(spark, t.fragment_tree(spark, sf_dir)))
    return broken.select(*KEY, "issue_type", "is_special")


@query(
    "consolidate_all",
    BARS + f"""
SELECT symbol, date, timestamp, ms_of_day, open, high, low, close, volume, CAST(CASE WHEN {q.DAY} % 2 = 0 THEN count END AS DOUBLE) AS count,
       round(vwap, 4) AS vwap FROM bars WHERE {READABLE} AND date BETWEEN '20240103' AND '20240126'""",
)
def consolidate_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lake after consolidating a date range of fragments twice."""
    tree, root = t.fragment_tree(spark, sf_dir), work_folder(spark, "lake")
    for _ in range(2):
        consolidate.consolidate_all(spark, tree, root, "20240103", "20240126")
    return _sparse(lake.scan_lake(spark, root))


def _sizes_hold(prefix: str, stored: Column) -> Column:
    """Both sizes are there where something was stored, and the ratio times the output is the input; else the ratio is 1."""
    size_in, size_out = F.col(f"{prefix}input_mb"), F.col(f"{prefix}output_mb")
    ratio_holds = F.abs(F.col("compression_ratio") * size_out - size_in) < 1e-9
    return F.when(stored, (size_in > 0) & (size_out > 0) & ratio_holds).otherwise((size_out == 0) & (F.col("compression_ratio") == 1))


@query(
    "run_summary",
    BARS + f"""
SELECT date, CAST(count(DISTINCT symbol) FILTER (WHERE {READABLE}) AS BIGINT) AS files_read,
       CAST(count(DISTINCT symbol) FILTER (WHERE {q.DAY} % 7 = 0) AS BIGINT) AS files_failed,
       count(*) FILTER (WHERE {READABLE}) AS input_rows,
       count(DISTINCT symbol) FILTER (WHERE {READABLE}) AS symbols_found,
       count(*) FILTER (WHERE {READABLE}) AS total_rows, {READABLE} AS success, true AS sizes_hold FROM bars GROUP BY date""",
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-day result of a consolidation run. Sizes depend on the writer; that they agree with the ratio is checked."""
    per_date = consolidate.consolidate_all(spark, t.fragment_tree(spark, sf_dir), work_folder(spark, "lake"))
    return per_date.withColumn("sizes_hold", _sizes_hold("", F.col("success"))).drop("input_mb", "output_mb", "compression_ratio")


@query(
    "run_totals",
    BARS + f"""
, per_date AS (
  SELECT date, {READABLE} AS ok, count(DISTINCT symbol) AS symbols, count(*) AS n, {q.DAY} % 7 = 0 AS junk FROM bars GROUP BY date)
SELECT count(*) AS dates_processed, count(*) FILTER (WHERE ok) AS dates_successful, count(*) FILTER (WHERE NOT ok) AS dates_failed,
       CAST(sum(symbols) FILTER (WHERE ok) AS BIGINT) AS total_symbols, CAST(sum(symbols) FILTER (WHERE ok) AS BIGINT) AS total_files_read,
       CAST(coalesce(sum(symbols) FILTER (WHERE junk), 0) AS BIGINT) AS total_files_failed,
       CAST(sum(n) FILTER (WHERE ok) AS BIGINT) AS total_rows,
       round(CAST(sum(symbols) FILTER (WHERE ok) AS DOUBLE) / count(*) FILTER (WHERE ok), 4) AS avg_symbols_per_day,
       true AS sizes_hold FROM per_date""",
)
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a consolidation run."""
    per_date = consolidate.consolidate_all(spark, t.fragment_tree(spark, sf_dir), work_folder(spark, "lake"))
    totals = consolidate.overall_stats(per_date).withColumn("sizes_hold", _sizes_hold("total_", F.lit(True)))
    return totals.drop("total_input_mb", "total_output_mb", "compression_ratio").withColumn(
        "avg_symbols_per_day", F.round("avg_symbols_per_day", 4)
    )


@query(
    "run_counters",
    BARS + f"""
, per_date AS (SELECT date, count(*) AS n, {READABLE} AS ok, {READABLE} AND date BETWEEN '20240103' AND '20240126' AS done FROM bars GROUP BY date)
SELECT count(*) AS dates_found, count(*) FILTER (WHERE done) AS dates_skipped, count(*) FILTER (WHERE done) AS dates_already_consolidated,
       count(*) FILTER (WHERE NOT done) AS dates_processed, count(*) FILTER (WHERE ok AND NOT done) AS dates_successful,
       CAST(coalesce(sum(n) FILTER (WHERE ok AND NOT done), 0) AS BIGINT) AS total_rows FROM per_date""",
)
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second consolidation run finds, skips and does after a first one over part of the days."""
    tree, root = t.fragment_tree(spark, sf_dir), work_folder(spark, "lake")
    consolidate.consolidate_all(spark, tree, root, "20240103", "20240126")
    totals = consolidate.consolidation_totals(spark, tree, root)
    return totals.select("dates_found", "dates_skipped", "dates_already_consolidated", "dates_processed", "dates_successful", "total_rows")


# --- layout -----------------------------------------------------------------------

DAYS = f"""
days AS (SELECT DISTINCT {q.USER_SYMBOL} AS symbol, strftime(ts, '%Y%m%d') AS date FROM events),
ruled AS (SELECT *, {q.RULE} AS rule FROM days)"""


def _ruled_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = F.substring("date", 7, 2).cast("int") + F.length("symbol")
    return t.traded_days(spark, sf_dir).withColumn("rule", rule)


@query(
    "layout_audit",
    q.with_(DAYS, q.HOLIDAYS, """
checked AS (SELECT r.*, r.rule % 9 <> 0 AS placed, c.is_trading_day AS open FROM ruled r JOIN calendar c ON c.date = r.date)""")
    + """
SELECT count(*) AS total_files, count(*) FILTER (WHERE placed AND open) AS valid_trading_days,
       count(*) FILTER (WHERE placed AND NOT open) AS invalid_trading_days,
       count(DISTINCT date) FILTER (WHERE placed AND open) AS unique_dates,
       count(DISTINCT symbol) FILTER (WHERE placed) AS unique_symbols FROM checked""",
)
def layout_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters over an inventory of symbol-day files, a ninth of them outside the date folders."""
    placed = symbols.fragment_name(F.col("symbol"), F.col("date"))
    loose = F.concat("symbol", F.lit("_"), "date", F.lit(".parquet"))
    path = F.concat(F.lit("store/"), F.when(F.col("rule") % 9 == 0, loose).otherwise(placed))
    inventory = _ruled_days(spark, sf_dir).select(path.alias("path"), F.lit(1).cast("long").alias("length"))
    return maintain.layout_audit(inventory)


@query(
    "organize_plan",
    q.with_(DAYS, q.HOLIDAYS) + """
SELECT CASE WHEN rule % 10 = 0 THEN symbol || '_20240230.parquet' WHEN rule % 10 = 1 THEN symbol || '.parquet'
            ELSE symbol || '_' || r.date || '.parquet' END AS name,
       CASE WHEN rule % 10 < 2 THEN 'skip_invalid' WHEN NOT c.is_trading_day THEN 'drop_non_trading'
            WHEN rule % 10 = 3 THEN 'already_organised' WHEN rule % 10 = 5 THEN 'skip_exists' ELSE 'move' END AS action,
       CASE WHEN rule % 10 > 1 THEN substr(r.date, 1, 4) || '/' || substr(r.date, 5, 2) || '/' || symbol || '_' || r.date || '.parquet' END AS target
FROM ruled r JOIN calendar c ON c.date = r.date""",
)
def organize_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reorganisation would do with each file of a dump."""
    rule = F.col("rule") % 10
    target = symbols.fragment_name(F.col("symbol"), F.col("date"))
    name = (
        F.when(rule == 0, F.concat("symbol", F.lit("_20240230.parquet")))
        .when(rule == 1, F.concat("symbol", F.lit(".parquet")))
        .otherwise(F.concat("symbol", F.lit("_"), "date", F.lit(".parquet")))
    )
    days = _ruled_days(spark, sf_dir)
    path = F.concat(F.lit("dump/"), F.when(rule == 3, target).otherwise(name))
    dump = days.select(path.alias("path"), F.lit(1).cast("long").alias("length"))
    existing = days.filter(rule == 5).select(target.alias("path"))
    return maintain.organize_plan(dump, existing).select("name", "action", "target")


@query(
    "organize_apply",
    q.with_(q.EVENT_BARS, q.HOLIDAYS) + f"""
SELECT b.symbol, b.date, b.timestamp, b.close, b.volume FROM bars b JOIN calendar c ON c.date = b.date
WHERE c.is_trading_day AND CAST(substr(b.date, 7, 2) AS INTEGER) % 7 NOT IN (0, 1)""",
)
def organize_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dump of fragments stored as a lake, trading days only."""
    root = work_folder(spark, "lake")
    maintain.organize_apply(spark, t.fragment_tree(spark, sf_dir), root)
    return lake.scan_lake(spark, root).select(*KEY, "timestamp", "close", "volume")


JUNK_DAYS = 3  # remainder of the day of the month: Wednesdays in the test tables


@query(
    "organize_outcome",
    q.with_(q.EVENT_BARS, q.HOLIDAYS) + f"""
, days AS (SELECT symbol, b.date, count(*) AS n, any_value(c.is_trading_day) AS open FROM bars b JOIN calendar c ON c.date = b.date GROUP BY symbol, b.date),
judged AS (SELECT *, CASE WHEN NOT open THEN 'drop_non_trading' WHEN {q.DAY} % 7 = {JUNK_DAYS} THEN 'unreadable' ELSE 'already_organised' END AS action FROM days)
SELECT symbol, date, action, CASE WHEN action = 'already_organised' AND {q.DAY} % 7 <> {JUNK_DAYS + 1} THEN n ELSE 0 END AS stored_bars FROM judged""",
)
def organize_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each file of a dump, some of it unreadable on trading days, and the bars that the lake has of it."""
    root = work_folder(spark, "lake")
    plan = maintain.organize_apply(spark, t.fragment_tree(spark, sf_dir, junk=JUNK_DAYS), root)
    stored = lake.scan_lake(spark, root).groupBy(*KEY).agg(F.count("*").alias("stored_bars"))
    return plan.join(stored, KEY, "left").select(*KEY, "action", F.coalesce("stored_bars", F.lit(0)).cast("long").alias("stored_bars"))


MOVED = f"""
days AS (SELECT symbol, b.date, count(*) AS n, any_value(c.is_trading_day) AS open FROM bars b JOIN calendar c ON c.date = b.date GROUP BY symbol, b.date),
moved AS (
  SELECT symbol, date, CASE WHEN open THEN 'move' ELSE 'drop_non_trading' END AS action,
         CASE WHEN NOT open THEN 'dropped' WHEN {q.DAY} % 2 = 0 THEN 'already_there' ELSE 'moved' END AS outcome,
         CASE WHEN open AND {q.DAY} % 7 = {JUNK_DAYS + 1} THEN 0 WHEN open AND {q.DAY} % 7 <> {JUNK_DAYS} THEN CAST(n AS DOUBLE) END AS stored_rows
  FROM days)"""


def _moved(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Manifest and target of a flat dump's move, after a run that ended when the files of even days were copied."""
    dump, root = t.fragment_tree(spark, sf_dir, junk=JUNK_DAYS, flat=True), work_folder(spark, "organised")
    plan = maintain.organize_plan(files.file_inventory(spark, dump, recursive=False))
    relocate.relocate_files(spark, plan.filter(F.substring("date", 7, 2).cast("int") % 2 == 0), root)
    return relocate.organize_files(spark, dump, root), root


@query("organize_move", q.with_(q.EVENT_BARS, q.HOLIDAYS, MOVED) + "SELECT symbol, date, action, outcome, stored_rows FROM moved")
def organize_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each file of a flat dump that was moved in two runs, the first cut short, and the rows it has where it lies now."""
    manifest, root = _moved(spark, sf_dir)
    rows = fragments.file_footers(spark, root).select(*KEY, F.col("rows").cast("double").alias("stored_rows"))  # has NULLs
    named = files.with_names(manifest.withColumnRenamed("bytes", "length"))
    return named.join(rows, KEY, "left").select(*KEY, "action", "outcome", "stored_rows")


@query(
    "organize_totals",
    q.with_(q.EVENT_BARS, q.HOLIDAYS, MOVED) + """
SELECT count(*) AS files_found, count(*) FILTER (WHERE outcome = 'moved') AS files_moved,
       count(*) FILTER (WHERE outcome = 'dropped') AS files_deleted_non_trading, CAST(0 AS BIGINT) AS files_skipped,
       count(*) FILTER (WHERE outcome = 'already_there') AS files_already_organised, CAST(0 AS BIGINT) AS errors FROM moved""",
)
def organize_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the same move."""
    return relocate.relocation_totals(_moved(spark, sf_dir)[0]).drop("bytes_moved")


# --- names and symbols ------------------------------------------------------------

@query(
    "parse_filename",
    q.with_(DAYS) + """
SELECT * FROM (
  SELECT CASE rule % 4 WHEN 0 THEN 'BRK_' || symbol || '_' || date || '.parquet' WHEN 1 THEN date || '.parquet'
              WHEN 2 THEN symbol || '.parquet' ELSE symbol || '_' || date || '.parquet' END AS name,
         CASE rule % 4 WHEN 0 THEN 'BRK_' || symbol WHEN 3 THEN symbol END AS symbol,
         CASE WHEN rule % 4 <> 2 THEN date END AS date FROM ruled)""",
)
def parse_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol and date from file names."""
    rule = F.col("rule") % 4
    suffix = F.lit(".parquet")
    name = (
        F.when(rule == 0, F.concat(F.lit("BRK_"), "symbol", F.lit("_"), "date", suffix))
        .when(rule == 1, F.concat("date", suffix))
        .when(rule == 2, F.concat("symbol", suffix))
        .otherwise(F.concat("symbol", F.lit("_"), "date", suffix))
    )
    named = _ruled_days(spark, sf_dir).select(name.alias("name"))
    n = F.col("name")
    return named.select("name", symbols.symbol_of_file(n).alias("symbol"), symbols.date_of_file(n).alias("date"))


@query(
    "path_date",
    q.with_(DAYS) + """
SELECT CASE rule % 3 WHEN 0 THEN 'lake/' || substr(date, 1, 4) || '/' || substr(date, 5, 2) || '/' || substr(date, 7, 2) || '/' || symbol || '.parquet'
            WHEN 1 THEN 'lake/2024/01/' || symbol || '_' || date || '.parquet' ELSE 'lake/2024/' || symbol || '.parquet' END AS path,
       CASE WHEN rule % 3 < 2 THEN date END AS date FROM ruled""",
)
def path_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date from a path: file name first, folders second."""
    rule = F.col("rule") % 3
    d = F.col("date")
    folders = F.concat_ws("/", F.lit("lake"), F.substring(d, 1, 4), F.substring(d, 5, 2), F.substring(d, 7, 2), "symbol")
    path = (
        F.when(rule == 0, F.concat(folders, F.lit(".parquet")))
        .when(rule == 1, F.concat(F.lit("lake/2024/01/"), "symbol", F.lit("_"), d, F.lit(".parquet")))
        .otherwise(F.concat(F.lit("lake/2024/"), "symbol", F.lit(".parquet")))
    )
    return _ruled_days(spark, sf_dir).select(path.alias("path")).withColumn("date", symbols.date_of_path(F.col("path")))


@query(
    "special_flag",
    f"SELECT symbol, regexp_full_match(symbol, '[A-Z]+[UWRZ]') AS is_special FROM (SELECT DISTINCT {q.USER_SYMBOL} AS symbol FROM events)",
)
def special_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which symbols are warrants, units or rights."""
    names = t.traded_days(spark, sf_dir).select("symbol").distinct()
    return names.withColumn("is_special", symbols.is_special(F.col("symbol")))


RAW_SYMBOLS = r"""
listed AS (
  SELECT c_custkey AS position, CASE c_custkey % 5 WHEN 0 THEN E' \t' || lower(c_mktsegment) || ' ' WHEN 1 THEN c_name WHEN 2 THEN NULL
         WHEN 3 THEN lower(c_mktsegment) || '-' || c_nationkey ELSE c_mktsegment || ' ' || c_nationkey END AS symbol FROM customer),
named AS (
  SELECT position, symbol AS raw, upper(regexp_replace(symbol, '^\s+|\s+$', '', 'g')) AS symbol FROM listed),
judged AS (SELECT *, coalesce(regexp_full_match(symbol, '[\p{L}\p{N}./-]{1,15}'), false) AS valid FROM named)"""


def _raw_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey") % 5
    nation = F.col("c_nationkey").cast("string")
    symbol = (
        F.when(k == 0, F.concat(F.lit(" \t"), F.lower("c_mktsegment"), F.lit(" ")))
        .when(k == 1, F.col("c_name"))
        .when(k == 3, F.concat(F.lower("c_mktsegment"), F.lit("-"), nation))
        .when(k == 4, F.concat("c_mktsegment", F.lit(" "), nation))
    )
    return t.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("position"), symbol.alias("symbol"))


@query("symbol_normalize", q.with_(RAW_SYMBOLS) + "SELECT position, symbol FROM named")
def symbol_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed symbols stripped and in upper case."""
    return _raw_symbols(spark, sf_dir).withColumn("symbol", symbols.normalize_symbol(F.col("symbol")))


@query("symbol_valid", q.with_(RAW_SYMBOLS) + "SELECT position, valid FROM judged")
def symbol_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each listed symbol is well formed."""
    clean = symbols.normalize_symbol(F.col("symbol"))
    return _raw_symbols(spark, sf_dir).select("position", symbols.is_valid_symbol(clean).alias("valid"))


@query(
    "symbol_universe",
    q.with_(RAW_SYMBOLS) + "SELECT symbol, min(position) AS position FROM judged WHERE valid GROUP BY symbol",
)
def symbol_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid symbols once each, at their first position."""
    return landing.symbol_universe(_raw_symbols(spark, sf_dir))


@query(
    "symbol_list_file",
    q.with_(RAW_SYMBOLS) + "SELECT symbol, count(*) AS listed FROM judged WHERE valid GROUP BY symbol",
)
def symbol_list_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid symbols of a list kept as CSV, beside another column and under a header in odd case; how often each is listed."""
    root = work_folder(spark, "symbol-list")
    listed = _raw_symbols(spark, sf_dir).select(F.col("position").alias("Rank"), F.col("symbol").alias(" SYMBOL"))
    landing.write_csv_report(listed, root)
    clean = landing.read_symbol_csv(spark, root).select(symbols.normalize_symbol(F.col("symbol")).alias("symbol"))
    return clean.filter(symbols.is_valid_symbol(F.col("symbol"))).groupBy("symbol").agg(F.count("*").alias("listed"))


@query(
    "universe_stats",
    q.with_(RAW_SYMBOLS) + """
SELECT count(*) AS raw_rows, count(*) FILTER (WHERE valid) AS valid_rows,
       count(*) FILTER (WHERE NOT valid AND symbol IS NOT NULL) AS invalid_rows,
       count(DISTINCT symbol) FILTER (WHERE valid) AS unique_symbols,
       count(*) FILTER (WHERE valid) - count(DISTINCT symbol) FILTER (WHERE valid) AS duplicates_removed FROM judged""",
)
def universe_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of loading the symbol list."""
    return landing.universe_stats(_raw_symbols(spark, sf_dir))


# --- calendar ---------------------------------------------------------------------

ORDER_DAYS = "order_days AS (SELECT strftime(o_orderdate, '%Y%m%d') AS date, count(*) AS orders FROM orders GROUP BY 1)"
CALENDAR = q.with_(ORDER_DAYS, q.HOLIDAYS)


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = times.date_text(F.col("o_orderdate"))
    return t.table(spark, sf_dir, "orders").groupBy(date.alias("date")).agg(F.count("*").alias("orders"))


@query(
    "date_convert",
    """
SELECT o_orderkey, day_text, strftime(d, '%Y-%m-%d') AS day, strftime(d, '%Y%m%d') AS back FROM (
  SELECT *, CAST(try_strptime(day_text, '%Y%m%d') AS DATE) AS d FROM (
    SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y') || '0230' WHEN 1 THEN strftime(o_orderdate, '%Y') || '1301'
           ELSE strftime(o_orderdate, '%Y%m%d') END AS day_text FROM orders))""",
)
def date_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date text to dates and back; impossible dates give NULL."""
    k, date = F.col("o_orderkey") % 5, times.date_text(F.col("o_orderdate"))
    year = F.substring(date, 1, 4)
    text = F.when(k == 0, F.concat(year, F.lit("0230"))).when(k == 1, F.concat(year, F.lit("1301"))).otherwise(date)
    days = t.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("day_text"))
    day = times.text_to_date(F.col("day_text"))
    return days.select("o_orderkey", "day_text", day.cast("string").alias("day"), times.date_text(day).alias("back"))


@query("calendar_days", CALENDAR + "SELECT o.date, o.orders, c.is_trading_day FROM order_days o JOIN calendar c ON c.date = o.date")
def calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates with whether the exchange was open."""
    return _order_days(spark, sf_dir).withColumn("is_trading_day", trading_days.is_trading_day(F.col("date")))


@query(
    "calendar_reason",
    CALENDAR + "SELECT o.date, o.orders, c.reason FROM order_days o JOIN calendar c ON c.date = o.date WHERE NOT c.is_trading_day",
)
def calendar_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates without trading, with the reason."""
    days = _order_days(spark, sf_dir).withColumn("reason", trading_days.skip_reason(F.col("date")))
    return days.filter("reason is not null")


@query(
    "calendar_split",
    CALENDAR + """
SELECT c.is_trading_day, c.reason, min(o.date) AS first_date, max(o.date) AS last_date, count(*) AS days,
       CAST(sum(o.orders) AS BIGINT) AS orders FROM order_days o JOIN calendar c ON c.date = o.date GROUP BY 1, 2""",
)
def calendar_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates split into trading days and skipped days by reason."""
    return trading_days.with_calendar(_order_days(spark, sf_dir)).groupBy("is_trading_day", "reason").agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.count("*").alias("days"), F.sum("orders").alias("orders"),
    )


@query(
    "calendar_counts",
    CALENDAR + """
SELECT substr(o.date, 1, 6) AS month, count(*) FILTER (WHERE is_trading_day) AS trading_days,
       count(*) FILTER (WHERE reason LIKE 'weekend%') AS weekends, count(*) FILTER (WHERE reason = 'market holiday') AS holidays
FROM order_days o JOIN calendar c ON c.date = o.date GROUP BY 1""",
)
def calendar_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trading days, weekend days and holidays among the order dates of each month."""
    days = trading_days.with_calendar(_order_days(spark, sf_dir))
    return days.groupBy(F.substring("date", 1, 6).alias("month")).agg(
        F.count_if("is_trading_day").alias("trading_days"),
        F.count_if(F.col("reason").startswith("weekend")).alias("weekends"),
        F.count_if(F.col("reason") == "market holiday").alias("holidays"),
    )


@query(
    "prev_trading_day",
    CALENDAR + "SELECT o.date, c.prev_trading_day FROM order_days o JOIN calendar c ON c.date = o.date",
)
def prev_trading_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trading day before each order date."""
    prev = trading_days.previous_trading_day(F.col("date"))
    return _order_days(spark, sf_dir).select("date", prev.alias("prev_trading_day"))
