"""Bars: gap fill, closes, profiles, filters, layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.catalog import sql as q
from minutebook.catalog import tables as t
from minutebook.catalog.registry import query
from minutebook.functions import times
from minutebook.operators import gap_fill as fill
from minutebook.operators import layers, profiles, quality
from minutebook.plans.consolidate import union_all
from minutebook.schema import BAR_TYPES, KEY

USER_BARS = q.EVENT_BARS.replace("upper(event_type)", q.USER_SYMBOL)
DONE_UNTIL = "20240110"
FIRST, LAST = "20240101", "20240130"


def _filled_sql(price: str) -> str:
    return f"""
SELECT g.symbol, g.date, g.timestamp, g.ms_of_day,
       CASE WHEN b.symbol IS NULL THEN {price} ELSE b.open END AS open,
       CASE WHEN b.symbol IS NULL THEN {price} ELSE b.high END AS high,
       CASE WHEN b.symbol IS NULL THEN {price} ELSE b.low END AS low,
       CASE WHEN b.symbol IS NULL THEN {price} ELSE b.close END AS close,
       CASE WHEN b.symbol IS NULL THEN 0.0::DOUBLE ELSE b.volume END AS volume,
       CASE WHEN b.symbol IS NULL THEN 0 ELSE b.count END AS count,
       round(CASE WHEN b.symbol IS NULL THEN {price} ELSE b.vwap END, 4) AS vwap,
       b.symbol IS NULL AS is_filled
FROM grid g LEFT JOIN session_bars b ON b.symbol = g.symbol AND b.date = g.date AND b.timestamp = g.timestamp"""


def _rounded(filled: DataFrame) -> DataFrame:
    return filled.withColumn("vwap", F.round("vwap", 4))


@query("gap_fill", q.with_(q.EVENT_BARS, q.HOLIDAYS, q.GRID) + _filled_sql("g.ref_price"))
def gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trading symbol-day on its 961-minute grid, gaps at the day's reference price."""
    return _rounded(fill.gap_fill(t.bars(spark, sf_dir)))


FFILL_SQL = q.with_(q.EVENT_BARS, q.HOLIDAYS, q.GRID) + _filled_sql(
    """coalesce(last_value(b.close IGNORE NULLS) OVER (PARTITION BY g.symbol, g.date ORDER BY g.timestamp
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), g.ref_price)"""
)


@query("gap_fill_ffill", FFILL_SQL)
def gap_fill_ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps carry the last close before them; the reference price only before the first bar."""
    return _rounded(fill.gap_fill(t.bars(spark, sf_dir), fill="ffill"))


@query(
    "gap_fill_totals",
    q.with_(USER_BARS, q.HOLIDAYS, q.GRID, "filled AS (" + _filled_sql("g.ref_price") + ")")
    + """
SELECT symbol, date, count(*) AS rows, count(*) FILTER (WHERE is_filled) AS filled_rows,
       round(sum(close), 2) AS close_sum, sum(volume) AS volume_sum FROM filled GROUP BY symbol, date""",
)
def gap_fill_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the filled grid of every user's bars."""
    return fill.gap_fill(t.bars(spark, sf_dir, by_user=True)).groupBy(*KEY).agg(
        F.count("*").alias("rows"),
        F.count_if("is_filled").alias("filled_rows"),
        F.round(F.sum("close"), 2).alias("close_sum"),
        F.sum("volume").alias("volume_sum"),
    )


@query(
    "prev_close",
    q.with_(USER_BARS, q.HOLIDAYS, q.GRID) + "SELECT symbol, date, prev_date, prev_close, ref_price FROM refs",
)
def prev_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Close of exactly the previous trading day, and the reference price that follows from it."""
    refs = fill.reference_prices(layers.trading_days_only(t.bars(spark, sf_dir, by_user=True)))
    return refs.select(*KEY, "prev_date", "prev_close", "ref_price")


STORED_SQL = "WITH RECURSIVE " + q.with_(
    USER_BARS, q.HOLIDAYS, q.GRID,
    """
days AS (
  SELECT r.symbol, r.date, r.prev_date, f.first_open, e.close AS end_close
  FROM refs r JOIN firsts_of_day f USING (symbol, date)
  LEFT JOIN session_bars e ON e.symbol = r.symbol AND e.date = r.date AND e.ms_of_day = 72000000),
chain AS (
  SELECT d.symbol, d.date, d.first_open AS ref_price, NULL::DOUBLE AS prev_close, coalesce(d.end_close, d.first_open) AS stored
  FROM days d WHERE NOT EXISTS (SELECT 1 FROM days p WHERE p.symbol = d.symbol AND p.date = d.prev_date)
  UNION ALL
  SELECT d.symbol, d.date, c.stored, c.stored, coalesce(d.end_close, c.stored)
  FROM chain c JOIN days d ON d.symbol = c.symbol AND d.prev_date = c.date)""",
).removeprefix("WITH ") + "SELECT symbol, date, prev_close, ref_price FROM chain"


@query("prev_close_stored", STORED_SQL)
def prev_close_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous close as the filled, stored days would give it (their 20:00 bar)."""
    refs = fill.reference_prices(layers.trading_days_only(t.bars(spark, sf_dir, by_user=True)), "stored")
    return refs.select(*KEY, "prev_close", "ref_price")


@query(
    "first_last_bar",
    q.with_(q.DIRTY_BARS) + """
SELECT symbol, date, arg_min_null(open, timestamp) AS first_open, arg_max_null(close, timestamp) AS last_close
FROM bars GROUP BY symbol, date""",
)
def first_last_bar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First open and last close of each symbol-day."""
    return profiles.first_last_bar(t.dirty_bars(spark, sf_dir))


# --- profiles ---------------------------------------------------------------------

@query(
    "day_summary",
    q.with_(USER_BARS) + """
SELECT date, CAST(count(*) AS BIGINT) AS row_count, count(DISTINCT symbol) AS symbol_count FROM bars GROUP BY date""",
)
def day_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and distinct symbols per day."""
    return profiles.day_summary(t.bars(spark, sf_dir, by_user=True))


@query(
    "volume_profile",
    q.with_(q.DIRTY_BARS) + """
SELECT symbol, date, count(*) AS bars, sum(volume) AS total_volume, count(*) FILTER (WHERE volume > 0) AS nonzero_bars,
       count(*) FILTER (WHERE volume = 0) AS zero_bars, count(*) FILTER (WHERE volume IS NULL) AS null_bars,
       min(volume) AS min_volume, max(volume) AS max_volume, round(avg(volume), 4) AS mean_volume,
       round(count(*) FILTER (WHERE volume > 0) * 100.0::DOUBLE / count(*), 4) AS nonzero_pct
FROM bars GROUP BY symbol, date""",
)
def volume_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume statistics of each symbol-day."""
    profile = profiles.volume_profile(t.dirty_bars(spark, sf_dir))
    return profile.withColumns({c: F.round(c, 4) for c in ("mean_volume", "nonzero_pct")})


@query(
    "price_profile",
    q.with_(q.DIRTY_BARS) + " UNION ALL ".join(
        f"""SELECT symbol, date, '{c}' AS price, min({c}) AS min_price, max({c}) AS max_price,
       round(avg({c}), 4) AS mean_price, count(*) FILTER (WHERE {c} = 0) AS zeros,
       count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM bars GROUP BY symbol, date"""
        for c in ("open", "high", "low", "close")
    ),
)
def price_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price statistics per symbol-day and column."""
    return profiles.price_profile(t.dirty_bars(spark, sf_dir)).withColumn("mean_price", F.round("mean_price", 4))


@query(
    "hourly_profile",
    q.with_(q.DIRTY_BARS) + """
SELECT symbol, date, CAST(extract(hour FROM timestamp) AS INTEGER) AS hour, count(*) AS bars,
       count(*) FILTER (WHERE volume > 0) AS traded_bars, CASE WHEN sum(volume) > 0 THEN sum(volume) END AS volume
FROM bars GROUP BY symbol, date, extract(hour FROM timestamp)""",
)
def hourly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars, traded bars and volume per hour."""
    return profiles.hourly_profile(t.dirty_bars(spark, sf_dir))


@query(
    "time_span",
    q.with_(q.DIRTY_BARS) + """
SELECT symbol, date, min(timestamp) AS first_ts, max(timestamp) AS last_ts,
       round((epoch(max(timestamp)) - epoch(min(timestamp))) / 3600.0, 4) AS hours FROM bars GROUP BY symbol, date""",
)
def time_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last bar of each symbol-day and the hours between."""
    return profiles.time_span(t.dirty_bars(spark, sf_dir)).withColumn("hours", F.round("hours", 4))


ACTIVITY = q.DIRTY_BARS.rstrip() + """,
activity AS (
  SELECT symbol, date, count(*) AS total_bars, sum(volume) AS total_volume,
         count(*) FILTER (WHERE volume > 0) AS nonzero_volume, count(*) FILTER (WHERE close <> 0) AS nonzero_price,
         coalesce(min(close) FILTER (WHERE close <> 0), 0) AS price_min,
         coalesce(max(close) FILTER (WHERE close <> 0), 0) AS price_max,
         min(timestamp) FILTER (WHERE volume > 0) AS first_trade, max(timestamp) FILTER (WHERE volume > 0) AS last_trade,
         sum(volume) > 0 OR count(*) FILTER (WHERE close <> 0) > 0 AS has_data
  FROM bars WHERE isodow(strptime(date, '%Y%m%d')) < 6 GROUP BY symbol, date)"""


@query("activity_days", q.with_(ACTIVITY) + "SELECT * FROM activity")
def activity_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What traded on each weekday of each symbol."""
    return profiles.activity_days(t.dirty_bars(spark, sf_dir))


@query(
    "activity_summary",
    q.with_(ACTIVITY) + """
SELECT symbol, count(*) AS days_checked, count(*) FILTER (WHERE has_data) AS days_with_data,
       count(*) FILTER (WHERE NOT has_data) AS days_without_data FROM activity GROUP BY symbol""",
)
def activity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with and without data per symbol."""
    return profiles.activity_summary(profiles.activity_days(t.dirty_bars(spark, sf_dir)))


@query(
    "head_tail_bars",
    q.with_(q.DIRTY_BARS) + """
SELECT symbol, date, timestamp, close, volume, CAST(rank AS INTEGER) AS rank, part FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY timestamp) AS rank, 'head' AS part FROM bars
  UNION ALL
  SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY timestamp DESC), 'tail' FROM bars
  UNION ALL
  SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY timestamp), 'traded' FROM bars WHERE volume > 0)
WHERE rank <= CASE part WHEN 'traded' THEN 20 ELSE 10 END""",
)
def head_tail_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First ten, last ten and first twenty traded bars of each symbol-day."""
    parts = profiles.head_tail_bars(t.dirty_bars(spark, sf_dir))
    return parts.select(*KEY, "timestamp", "close", "volume", "rank", "part")


# --- row expressions --------------------------------------------------------------

@query(
    "derive_time_cols",
    """SELECT event_id, strftime(ts, '%Y%m%d') AS date,
       CAST(extract(hour FROM ts) * 3600000 + extract(minute FROM ts) * 60000
            + extract(microsecond FROM ts) // 1000 AS BIGINT) AS ms_of_day FROM events""",
)
def derive_time_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date text and millisecond of the day of every event."""
    ts = F.col("ts")
    return t.table(spark, sf_dir, "events").select(
        "event_id", times.date_text(ts).alias("date"), times.ms_of_day(ts).alias("ms_of_day")
    )


@query(
    "session_label",
    """SELECT event_id, CASE WHEN CAST(ts AS TIME) < TIME '04:00:00' THEN NULL WHEN CAST(ts AS TIME) < TIME '09:30:00' THEN 'pre'
       WHEN CAST(ts AS TIME) < TIME '16:00:00' THEN 'regular' WHEN CAST(ts AS TIME) < TIME '20:00:00.001' THEN 'after' END AS session
       FROM events""",
)
def session_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session of every event."""
    label = times.session_label(times.ms_of_day(F.col("ts")))
    return t.table(spark, sf_dir, "events").select("event_id", label.alias("session"))


@query(
    "session_filter",
    q.with_(USER_BARS) + """
SELECT symbol, timestamp, close FROM bars
WHERE CAST(timestamp AS TIME) BETWEEN TIME '09:30:00' AND TIME '16:00:00'""",
)
def session_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of the regular session, both ends included."""
    regular = times.in_session(F.col("ms_of_day"), times.REGULAR_OPEN, times.REGULAR_CLOSE)
    return t.bars(spark, sf_dir, by_user=True).filter(regular).select("symbol", "timestamp", "close")


@query(
    "date_range",
    q.with_(USER_BARS) + "SELECT symbol, timestamp, close FROM bars WHERE date >= '20240108' AND date <= '20240119'",
)
def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of an inclusive date range."""
    chosen = times.in_date_range(F.col("date"), "20240108", "20240119")
    return t.bars(spark, sf_dir, by_user=True).filter(chosen).select("symbol", "timestamp", "close")


@query("traded_bars", q.with_(q.DIRTY_BARS) + "SELECT symbol, timestamp, close, volume FROM bars WHERE volume > 0")
def traded_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with volume."""
    return profiles.traded_bars(t.dirty_bars(spark, sf_dir)).select("symbol", "timestamp", "close", "volume")


@query(
    "filled_bars",
    q.with_(q.DIRTY_BARS) + "SELECT symbol, timestamp, close, volume FROM bars WHERE volume = 0 AND close > 0",
)
def filled_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars without volume that carry a price."""
    return profiles.filled_bars(t.dirty_bars(spark, sf_dir)).select("symbol", "timestamp", "close", "volume")


FLAGS = {
    "high_lt_low": "high < low", "high_lt_open": "high < open", "high_lt_close": "high < close",
    "low_gt_open": "low > open", "low_gt_close": "low > close", "negative_volume": "volume < 0",
}


@query(
    "ohlc_row_flags",
    q.with_(q.DIRTY_BARS) + "SELECT symbol, timestamp, "
    + ", ".join(f"coalesce({rule}, false) AS {name}" for name, rule in FLAGS.items()) + " FROM bars",
)
def ohlc_row_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six ordering rules tested on every bar."""
    return quality.ohlc_row_flags(t.dirty_bars(spark, sf_dir)).select("symbol", "timestamp", *FLAGS)


@query(
    "ohlc_violation_counts",
    q.with_(q.DIRTY_BARS) + "SELECT symbol, date, "
    + ", ".join(f"count(*) FILTER (WHERE {rule}) AS {name}" for name, rule in FLAGS.items())
    + " FROM bars GROUP BY symbol, date",
)
def ohlc_violation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken rules per symbol-day."""
    return quality.ohlc_violation_counts(t.dirty_bars(spark, sf_dir))


# --- joins and layers -------------------------------------------------------------

@query(
    "trading_days_only",
    q.with_(USER_BARS, q.HOLIDAYS) + """
SELECT b.symbol, b.timestamp, b.close FROM bars b JOIN calendar c ON c.date = b.date WHERE c.is_trading_day""",
)
def trading_days_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars on trading days."""
    return layers.trading_days_only(t.bars(spark, sf_dir, by_user=True)).select("symbol", "timestamp", "close")


@query(
    "non_trading_rows",
    q.with_(USER_BARS, q.HOLIDAYS) + """
SELECT b.symbol, b.timestamp, b.close FROM bars b JOIN calendar c ON c.date = b.date WHERE NOT c.is_trading_day""",
)
def non_trading_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars on weekends and holidays."""
    return layers.non_trading_rows(t.bars(spark, sf_dir, by_user=True)).select("symbol", "timestamp", "close")


@query(
    "reconcile_layers",
    q.with_(
        USER_BARS,
        """
parsed AS (
  SELECT symbol, date, CASE WHEN symbol LIKE '%U' THEN 0 ELSE volume END AS volume FROM bars
  WHERE extract(hour FROM timestamp) <> 12),
saved AS (SELECT * FROM parsed WHERE date <= '20240115'),
r AS (SELECT symbol, date, count(*) AS n, sum(volume) AS v, count(*) FILTER (WHERE volume > 0) AS k FROM bars GROUP BY ALL),
p AS (SELECT symbol, date, count(*) AS n, sum(volume) AS v, count(*) FILTER (WHERE volume > 0) AS k FROM parsed GROUP BY ALL),
s AS (SELECT symbol, date, count(*) AS n, sum(volume) AS v, count(*) FILTER (WHERE volume > 0) AS k FROM saved GROUP BY ALL),
j AS (
  SELECT symbol, date, coalesce(r.n, 0) AS raw_bars, coalesce(r.v, 0) AS raw_volume, coalesce(r.k, 0) AS raw_traded_bars,
         coalesce(p.n, 0) AS parsed_bars, coalesce(p.v, 0) AS parsed_volume, coalesce(p.k, 0) AS parsed_traded_bars,
         coalesce(s.n, 0) AS saved_bars, coalesce(s.v, 0) AS saved_volume, coalesce(s.k, 0) AS saved_traded_bars
  FROM r FULL JOIN p USING (symbol, date) FULL JOIN s USING (symbol, date))""",
    )
    + """
SELECT *, CASE WHEN raw_volume > 0 AND parsed_volume = 0 THEN 'critical_zero_after_parse'
               WHEN raw_volume > 0 AND parsed_volume < raw_volume THEN 'volume_lost'
               WHEN raw_volume = 0 THEN 'no_raw_volume' WHEN raw_volume = parsed_volume THEN 'preserved' ELSE 'none' END AS verdict,
       CASE WHEN raw_volume > 0 AND parsed_volume > 0 AND parsed_volume < raw_volume
            THEN round((raw_volume - parsed_volume) * 100.0 / raw_volume, 4) END AS lost_pct FROM j""",
)
def reconcile_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw, parsed and saved layers of every symbol-day compared by volume."""
    raw = t.bars(spark, sf_dir, by_user=True)
    parsed = raw.filter(F.hour("timestamp") != 12).withColumn(
        "volume", F.when(F.col("symbol").endswith("U"), 0.0).otherwise(F.col("volume"))
    )
    saved = parsed.filter(F.col("date") <= "20240115")
    return layers.reconcile(raw, parsed, saved).withColumn("lost_pct", F.round("lost_pct", 4))


REJECTS = q.with_(q.DIRTY_BARS, q.FACTS, f"""
rejects AS (SELECT date, symbol, {q.GATE_REASON} AS reason FROM facts WHERE {q.GATE_REASON} IS NOT NULL),
work AS (SELECT DISTINCT symbol, date FROM bars)""")


def dirty_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rejects(quality.quality_facts(t.dirty_bars(spark, sf_dir)))


@query(
    "skip_known_nulls",
    REJECTS + """
SELECT w.symbol, w.date, r.reason, r.reason IS NOT NULL AS should_skip
FROM work w LEFT JOIN rejects r ON r.symbol = w.symbol AND r.date = w.date""",
)
def skip_known_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every symbol-day with the decision whether to skip it as known empty."""
    return layers.skip_decisions(t.traded_days(spark, sf_dir), dirty_rejects(spark, sf_dir))


@query(
    "pending_dates",
    q.with_(USER_BARS) + f"SELECT DISTINCT date FROM bars WHERE date > '{DONE_UNTIL}'",
)
def pending_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates with bars that are not consolidated yet."""
    made = t.bars(spark, sf_dir, by_user=True)
    return layers.pending_dates(made, made.filter(F.col("date") <= DONE_UNTIL))


@query(
    "worklist",
    REJECTS.rstrip() + ",\n" + q.HOLIDAYS.strip() + f"""
SELECT s.symbol, c.date FROM (SELECT DISTINCT symbol FROM work) s, calendar c
WHERE c.is_trading_day AND c.date BETWEEN '{FIRST}' AND '{LAST}'
  AND c.date NOT IN (SELECT date FROM work WHERE date <= '{DONE_UNTIL}')
  AND NOT EXISTS (SELECT 1 FROM rejects r WHERE r.symbol = s.symbol AND r.date = c.date)""",
)
def worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol x trading day tasks, less finished days and known empties."""
    days = t.traded_days(spark, sf_dir)
    done = days.filter(F.col("date") <= DONE_UNTIL)
    return layers.worklist(days, FIRST, LAST, done, dirty_rejects(spark, sf_dir))


@query(
    "consolidate",
    q.with_(q.EVENT_BARS, USER_BARS.replace("bars AS", "user_bars AS")) + """
SELECT symbol, date, timestamp, close, volume, CAST(count AS DOUBLE) AS count, NULL::DOUBLE AS vwap FROM bars
UNION ALL SELECT symbol, date, timestamp, close, volume, NULL, round(vwap, 4) FROM user_bars""",
)
def consolidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of two sets of bars with different optional columns."""
    both = union_all(t.bars(spark, sf_dir).drop("vwap"), t.bars(spark, sf_dir, by_user=True).drop("count"))
    assert set(both.columns) == set(BAR_TYPES)
    return both.select(
        *KEY, "timestamp", "close", "volume", F.col("count").cast("double").alias("count"), F.round("vwap", 4).alias("vwap")
    )
