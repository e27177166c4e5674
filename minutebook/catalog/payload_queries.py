"""Payloads: landing, classification, parsing, repair, rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.catalog import sql as q
from minutebook.catalog import tables as t
from minutebook.catalog.bar_queries import _filled_sql
from minutebook.catalog.registry import query
from minutebook.operators import payload_parse as parse
from minutebook.plans.daily_build import daily_build
from minutebook.schema import INDEX_SCHEMA, KEY
from minutebook.session import work_folder
from minutebook.sources import landing
from minutebook.sources.lake import scan_lake, stored_sizes
from minutebook.sources.versions import read_current
from minutebook.streaming.ingest import ingest_landing, read_ingested, read_ledger
from minutebook.streaming.waiting import retry_waiting

BAR_SQL = q.with_(q.EVENT_BARS)
COUNTS = q.with_(q.EVENT_BARS, f"days AS (SELECT symbol, date, {q.RULE} AS rule, count(*) AS n FROM bars GROUP BY symbol, date)")
MONEY = "CAST(CAST({0} AS DECIMAL(18, 6)) AS VARCHAR)"
RECORD = (
    "'{\"volume\":' || count || ',\"high\":' || " + MONEY.format("high") + " || ',\"low\":' || " + MONEY.format("low")
    + " || ',\"vwap\":' || " + MONEY.format("vwap") + " || ',\"count\":' || count || ',\"close\":' || " + MONEY.format("close")
    + " || ',\"open\":' || " + MONEY.format("open") + " || ',\"timestamp\":\"' || strftime(timestamp, '%Y-%m-%dT%H:%M:%S.000') || '\"}'"
)


def payloads_of(spark: SparkSession, sf_dir: str, text: Column) -> DataFrame:
    return t.day_texts(spark, sf_dir).select(*KEY, text.alias("payload"))


@query(
    "payload_scan",
    BAR_SQL + f"""
SELECT symbol, date, CAST(length(p) AS INTEGER) AS n_chars, md5(p) AS digest FROM (
  SELECT symbol, date, '[' || string_agg({RECORD}, ',' ORDER BY timestamp) || ']' AS p FROM bars GROUP BY symbol, date)""",
)
def payload_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads landed as JSON lines and scanned back."""
    root = work_folder(spark, "landing")
    landing.land_payloads(payloads_of(spark, sf_dir, t.json_text()), root)
    return landing.scan_payloads(spark, root).select(
        *KEY, F.length("payload").alias("n_chars"), F.md5("payload").alias("digest")
    )


KIND = """CASE rule % 11 WHEN 0 THEN 'json_array' WHEN 1 THEN 'json_wrapper' WHEN 2 THEN 'json_object' WHEN 3 THEN 'csv'
  WHEN 4 THEN 'error' WHEN 5 THEN 'error' WHEN 9 THEN 'other' ELSE 'empty' END"""


@query(
    "payload_classify",
    COUNTS + f"""
SELECT symbol, date, {KIND} AS kind,
       CASE rule % 11 WHEN 0 THEN 8 WHEN 1 THEN 8 WHEN 2 THEN 8 WHEN 3 THEN 9 WHEN 4 THEN 2 WHEN 5 THEN 2 WHEN 6 THEN 1
            WHEN 8 THEN 9 WHEN 9 THEN 2 ELSE 0 END AS csv_hints FROM days""",
)
def payload_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind of every payload, and how much its first line looks like a CSV header."""
    return parse.classify(t.mixed_payloads(spark, sf_dir)).select(*KEY, "kind", "csv_hints")


@query("payload_nonempty", COUNTS + f"SELECT symbol, date FROM days WHERE {KIND} <> 'empty'")
def payload_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads that hold anything."""
    return parse.nonempty(t.mixed_payloads(spark, sf_dir)).select(*KEY)


@query(
    "payload_errors",
    COUNTS + """
SELECT symbol, date, CASE rule % 11 WHEN 4 THEN '[472] no data for ' || symbol ELSE 'session closed' END AS reason
FROM days WHERE rule % 11 IN (4, 5)""",
)
def payload_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error envelopes as reject rows."""
    return parse.payload_errors(t.mixed_payloads(spark, sf_dir))


@query(
    "payload_text",
    r"""
WITH parts AS (
  SELECT doc_id, list_transform(string_split(text, chr(10)), lambda line, i: struct_pack(k := i % 3, line := line)) AS p FROM documents),
kept AS (
  SELECT doc_id, list_filter(p, lambda x: x.k <> 0 AND length(trim(x.line, E' \t\r\n\f\v')) > 0) AS p FROM parts)
SELECT doc_id, CASE WHEN len(p) > 0 THEN trim(array_to_string(list_transform(p, lambda x: x.line), ''), E' \t\r\n\f\v') END AS text
FROM kept""",
)
def payload_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text parts of multi-part messages joined; every third line of a document plays a non-text part."""
    lines = F.split("text", "\n")
    parts = F.transform(
        lines,
        lambda line, i: F.struct(F.when((i + 1) % 3 == 0, "image").otherwise("text").alias("type"), line.alias("text")),
    )
    return t.table(spark, sf_dir, "documents").select("doc_id", parse.joined_text(parts).alias("text"))


# --- parsing ----------------------------------------------------------------------

@query("parse_json_bars", BAR_SQL + q.parsed_bar())
def parse_json_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of JSON array payloads; some name fields in capitals: all, ``Count`` and ``VWAP`` only, or in every other record."""
    text, rule = t.json_text(), F.col("rule") % 4
    capitals = F.regexp_replace(F.regexp_replace(text, '"count":', '"Count":'), '"vwap":', '"VWAP":')
    others = F.transform("records", lambda r, i: F.when(i % 2 == 1, F.upper(r)).otherwise(r))
    mixed = F.concat(F.lit("["), F.array_join(others, ","), F.lit("]"))
    text = F.when(rule == 0, F.upper(text)).when(rule == 1, capitals).when(rule == 2, mixed).otherwise(text)
    return parse.parse_bars(payloads_of(spark, sf_dir, text))


@query("parse_json_wrapped", BAR_SQL + q.parsed_bar())
def parse_json_wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of wrapped payloads (even days) and of single-object payloads, one for each record (odd days)."""
    days, even = t.day_texts(spark, sf_dir), F.col("day") % 2 == 0
    wrapped = days.filter(even).select(*KEY, t.wrapped_text().alias("payload"))
    return parse.parse_bars(wrapped.unionByName(days.filter(~even).select(*KEY, F.explode("records").alias("payload"))))


REPAIRED = q.EVENT_BARS.replace("bars AS (", "all_bars AS (") .rstrip() + f""",
bars AS (
  SELECT * EXCLUDE (pos) FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY timestamp DESC) AS pos FROM all_bars)
  WHERE {q.RULE} % 6 <> 2 OR pos > 1)"""


@query("json_repair", q.with_(REPAIRED) + q.parsed_bar())
def json_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of damaged JSON payloads; only a record cut in half is lost."""
    return parse.parse_bars(t.damaged_payloads(spark, sf_dir))


@query("json_salvage", BAR_SQL + q.parsed_bar())
def json_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole records found in text that no repair can make valid."""
    text = F.concat(F.lit("[<<"), F.array_join("records", ";; "), F.lit(">>"))
    return parse.parse_bars(payloads_of(spark, sf_dir, text))


@query("parse_csv_bars", BAR_SQL + q.parsed_bar())
def parse_csv_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of CSV payloads; even days have an upper-case header, all end in a blank line."""
    text = t.csv_text()
    return parse.parse_bars(payloads_of(spark, sf_dir, F.when(F.col("day") % 2 == 0, F.upper(text)).otherwise(text)))


@query(
    "required_fields",
    COUNTS + """
SELECT symbol, date, CASE rule % 4 WHEN 1 THEN 'Missing columns: volume' WHEN 2 THEN 'Missing columns: high, low'
       WHEN 3 THEN 'Missing columns: open' END AS reject_reason FROM days""",
)
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads checked for the required fields; a third lacks one or two, as JSON or as CSV."""
    rule = F.col("rule") % 4
    text = (
        F.when(rule == 1, F.regexp_replace(t.json_text(), r'"volume":\d+,', ""))
        .when(rule == 2, F.regexp_replace(t.json_text(), r'"(high|low)":[\d.]+,', ""))
        .when(rule == 3, F.regexp_replace(t.csv_text(), "open", "opening"))
        .otherwise(t.json_text())
    )
    return parse.parse_payloads(payloads_of(spark, sf_dir, text)).select(*KEY, "reject_reason")


@query(
    "convert_types",
    COUNTS + """
SELECT symbol, date, CASE WHEN rule % 3 <> 0 THEN 'type_error' END AS reject_reason, n AS records FROM days""",
)
def convert_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads whose numbers or timestamps do not convert are rejected whole."""
    rule = F.col("rule") % 3
    text = (
        F.when(rule == 1, F.regexp_replace(t.json_text(), r'^(.*?"close":)[\d.]+', '$1"n.v."'))
        .when(rule == 2, F.regexp_replace(t.csv_text(), r"\n\d{4}-\d{2}-\d{2} ", "\nyesterday "))
        .otherwise(t.json_text())
    )
    parsed = parse.parse_payloads(payloads_of(spark, sf_dir, text))
    return parsed.select(*KEY, "reject_reason", F.size("records").cast("long").alias("records"))


@query(
    "payload_archive",
    COUNTS + f"""
SELECT symbol, date, {KIND} AS kind, CASE WHEN rule % 11 < 4 THEN 'intact' END AS parse_status,
       CASE WHEN rule % 11 < 4 THEN NULL WHEN rule % 11 = 4 THEN '[472] no data for ' || symbol
            WHEN rule % 11 = 5 THEN 'session closed' WHEN rule % 11 = 9 THEN 'unreadable payload' ELSE 'empty payload' END AS reject_reason
FROM days""",
)
def payload_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw payloads kept with their parse status, read back from the archive."""
    root = work_folder(spark, "archive")
    landing.archive_payloads(parse.parse_payloads(t.mixed_payloads(spark, sf_dir)), root)
    return spark.read.parquet(root).select(*KEY, "kind", "parse_status", "reject_reason")


# --- whole jobs -------------------------------------------------------------------

@query(
    "incremental_ingest",
    COUNTS + """
SELECT symbol, date, CASE WHEN rule % 6 = 5 THEN 'json_wrapper' ELSE 'json_array' END AS kind,
       CASE WHEN rule % 6 IN (0, 5) THEN 'intact' ELSE 'repaired' END AS parse_status,
       CAST(CASE WHEN rule % 6 = 2 THEN n - 1 ELSE n END AS INTEGER) AS records FROM days""",
)
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings with an overlap taken in by two runs; each symbol-day counts once."""
    landed, ledger, checkpoint = (work_folder(spark, name) for name in ("landing", "ledger", "stream"))
    made = t.damaged_payloads(spark, sf_dir)
    landing.land_payloads(made.filter(F.col("date") <= "20240115"), landed)
    ingest_landing(spark, landed, ledger, checkpoint)
    landing.land_payloads(made, landed)
    ingest_landing(spark, landed, ledger, checkpoint)
    return read_ledger(spark, ledger).select(*KEY, "kind", "parse_status", "records")


@query("incremental_bars", q.with_(REPAIRED) + q.parsed_bar())
def incremental_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bars that three runs store: errors first, then part of the days, then all; each symbol-day is stored once."""
    landed, ledger, checkpoint, stored = (work_folder(spark, name) for name in ("landing", "ledger", "stream", "bars"))
    made = t.damaged_payloads(spark, sf_dir)
    failed = made.withColumn("payload", F.lit('{"error":"try later"}'))
    for landing_rows in (failed, made.filter(F.col("date") <= "20240115"), made):
        landing.land_payloads(landing_rows, landed)
        ingest_landing(spark, landed, ledger, checkpoint, files_per_batch=5, bars_root=stored)
    return read_ingested(spark, stored)


@query("incremental_waiting", q.with_(REPAIRED.replace("OR pos > 1", "OR pos > 1 OR date <= '20240115'")) + q.parsed_bar())
def incremental_waiting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of an ingest that takes intact payloads at once; damaged ones wait in keyed state and are repaired if no intact one came."""
    landed, ledger, mark, stored, waiting, state = (
        work_folder(spark, name) for name in ("landing", "ledger", "stream", "bars", "waiting", "state")
    )
    made = t.damaged_payloads(spark, sf_dir)
    for landing_rows in (made, payloads_of(spark, sf_dir, t.json_text()).filter(F.col("date") <= "20240115")):
        landing.land_payloads(landing_rows, landed)
        ingest_landing(spark, landed, ledger, mark, bars_root=stored, accept=("intact",), waiting_root=waiting)
    for _ in range(2):  # the first run starts the clock of what waits, the second finds it run out
        retry_waiting(spark, waiting, ledger, state, wait_seconds=0, keep_seconds=86_400, bars_root=stored)
    return read_ingested(spark, stored)


TURNED = REPAIRED.replace("bars AS (", "good_bars AS (").replace("all_good_bars", "all_bars").rstrip() + f""",
bars AS (
  SELECT * REPLACE (CASE WHEN {q.DAY} % 5 = 3 THEN -open ELSE open END AS open, CASE WHEN {q.DAY} % 5 = 3 THEN -high ELSE high END AS high,
    CASE WHEN {q.DAY} % 5 = 3 THEN -low ELSE low END AS low, CASE WHEN {q.DAY} % 5 = 3 THEN -close ELSE close END AS close) FROM good_bars)
"""


def _verdicts(name: str, price: str) -> str:
    """The gate's verdict on every day, were its gaps filled with ``price``."""
    facts = q.FACTS.replace("FROM bars)", f"FROM filled_{name})")
    for part in ("ordered", "sums", "facts"):
        facts = facts.replace(f"{part} AS", f"{part}_{name} AS").replace(f"FROM {part}", f"FROM {part}_{name}")
    return (
        f"filled_{name} AS (" + _filled_sql(price) + "),\n" + facts.strip()
        + f",\nverdict_{name} AS (SELECT symbol, date, {q.GATE_REASON} AS reason FROM facts_{name})"
    )


# A day takes the close of the day before only if that day was accepted, which is known in the order of the days.
GATED = "WITH RECURSIVE " + q.with_(
    TURNED, q.HOLIDAYS, q.GRID.replace("SELECT r.symbol, r.date, r.ref_price,", "SELECT r.symbol, r.date, r.ref_price, f.first_open,")
    .replace("FROM refs r, range(961) m", "FROM refs r JOIN firsts_of_day f USING (symbol, date), range(961) m"),
    _verdicts("after", "g.ref_price"), _verdicts("alone", "g.first_open"),
    """
days AS (
  SELECT r.symbol, r.date, r.prev_date, r.ref_price, f.first_open, a.reason AS after_reason, o.reason AS alone_reason
  FROM refs r JOIN firsts_of_day f USING (symbol, date) JOIN verdict_after a USING (symbol, date) JOIN verdict_alone o USING (symbol, date)),
chain AS (
  SELECT d.symbol, d.date, d.first_open AS price, d.alone_reason IS NULL AS accepted
  FROM days d WHERE NOT EXISTS (SELECT 1 FROM days p WHERE p.symbol = d.symbol AND p.date = d.prev_date)
  UNION ALL
  SELECT d.symbol, d.date, CASE WHEN c.accepted THEN d.ref_price ELSE d.first_open END,
         CASE WHEN c.accepted THEN d.after_reason ELSE d.alone_reason END IS NULL
  FROM chain c JOIN days d ON d.symbol = c.symbol AND d.prev_date = c.date),
kept_grid AS (SELECT g.*, c.price FROM grid g JOIN chain c USING (symbol, date) WHERE c.accepted)""",
).removeprefix("WITH ") + (
    "SELECT * EXCLUDE (is_filled) FROM (" + _filled_sql("g.price").replace("FROM grid g", "FROM kept_grid g") + ")"
)


@query("daily_lake", GATED)
def daily_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lake a build from damaged payloads leaves: parsed, filled, gated, written, read back; some days are rejected."""
    root = work_folder(spark, "lake")
    daily_build(spark, t.partly_negative(t.damaged_payloads(spark, sf_dir)), root)
    return scan_lake(spark, root).withColumn("vwap", F.round("vwap", 4))


@query("daily_lake_batches", GATED)
def daily_lake_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lake, built in three batches of days."""
    root = work_folder(spark, "lake")
    landed = work_folder(spark, "landed")
    t.partly_negative(t.damaged_payloads(spark, sf_dir)).write.parquet(landed)
    payloads = spark.read.parquet(landed)
    for end in ("20240109", "20240118", "20240131"):
        daily_build(spark, payloads.filter(F.col("date") <= end), root)
    return scan_lake(spark, root).withColumn("vwap", F.round("vwap", 4))


@query("build_index", f"SELECT date, count(DISTINCT symbol) AS symbol_count, count(*) AS row_count, true AS true_size FROM ({GATED}) GROUP BY date")
def build_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata index that the build keeps by itself, in two runs with a registry of rejects; sizes are those of the stored files."""
    root, registry, index = (work_folder(spark, n) for n in ("lake", "registry", "index"))
    landed = work_folder(spark, "landed")
    t.partly_negative(t.damaged_payloads(spark, sf_dir)).write.parquet(landed)
    payloads = spark.read.parquet(landed)
    for end in ("20240118", "20240131"):
        daily_build(spark, payloads.filter(F.col("date") <= end), root, registry=registry, index=index)
    sizes = stored_sizes(spark, root).select("date", (F.col("bytes") / F.lit(1024.0 * 1024.0)).alias("mb"))
    found = read_current(spark, index, INDEX_SCHEMA).join(sizes, "date")
    return found.select("date", "symbol_count", "row_count", (F.col("file_size_mb") == F.col("mb")).alias("true_size"))
