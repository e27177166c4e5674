"""SQL building blocks of the twins, written for DuckDB on the shared test tables."""

from __future__ import annotations

TS_DATE = "strftime(ts, '%Y%m%d')"

EVENT_BARS = """
bars AS (
  SELECT upper(event_type) AS symbol, strftime(date_trunc('minute', ts), '%Y%m%d') AS date,
         date_trunc('minute', ts) AS timestamp,
         CAST(extract(hour FROM min(ts)) * 3600000 + extract(minute FROM min(ts)) * 60000 AS BIGINT) AS ms_of_day,
         first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
         last(value ORDER BY ts, event_id) AS close,
         CAST(count(*) AS DOUBLE) AS volume, count(*) AS count, avg(value) AS vwap
  FROM events GROUP BY upper(event_type), date_trunc('minute', ts))
"""

USER_SYMBOL = "'S' || translate(CAST(user_id AS VARCHAR), '0123456789', 'ABCDEFUWRZ')"

DIRTY_BARS = f"""
priced AS (
  SELECT {USER_SYMBOL} AS symbol, date_trunc('minute', ts) AS timestamp, ts, event_id,
         CASE WHEN event_type = 'error' THEN 0.0::DOUBLE ELSE value END AS px,
         CASE WHEN event_type IN ('purchase', 'click') THEN CAST(json_extract_string(props, '$.k') AS DOUBLE)
              ELSE 0.0::DOUBLE END AS vol
  FROM events),
clean AS (
  SELECT symbol, strftime(timestamp, '%Y%m%d') AS date, timestamp,
         CAST(extract(hour FROM timestamp) * 3600000 + extract(minute FROM timestamp) * 60000 AS BIGINT) AS ms_of_day,
         first(px ORDER BY ts, event_id) AS o, max(px) AS h, min(px) AS l,
         last(px ORDER BY ts, event_id) AS c, sum(vol) AS volume, min(event_id) AS id
  FROM priced GROUP BY symbol, timestamp),
bars AS (
  SELECT symbol, date, timestamp, ms_of_day, volume,
         CASE WHEN id % 17 = 0 THEN NULL WHEN id % 13 = 0 THEN -o - 1 ELSE o END AS open,
         CASE WHEN id % 17 = 0 THEN NULL WHEN id % 11 = 0 THEN l - 1 WHEN id % 13 = 0 THEN -l - 1 ELSE h END AS high,
         CASE WHEN id % 17 = 0 THEN NULL WHEN id % 13 = 0 THEN -h - 1 ELSE l END AS low,
         CASE WHEN id % 17 = 0 THEN NULL WHEN id % 13 = 0 THEN -c - 1 ELSE c END AS close
  FROM clean)
"""

# Holidays of 1990-2030 from the exchange's rules, Easter by the anonymous Gregorian algorithm.
HOLIDAYS = """
years AS (SELECT CAST(range AS INTEGER) AS y FROM range(1990, 2031)),
e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
e2 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM e1),
e3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM e2),
e4 AS (SELECT *, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS t FROM e3),
firsts AS (
  SELECT y, make_date(CAST(y AS BIGINT), CAST(t // 31 AS BIGINT), CAST(t % 31 + 1 AS BIGINT)) AS easter,
         make_date(y, 1, 1) AS jan, make_date(y, 2, 1) AS feb, make_date(y, 9, 1) AS sep, make_date(y, 11, 1) AS nov,
         make_date(y, 5, 31) AS may
  FROM e4),
fixed AS (
  SELECT jan AS d, 0 AS sat FROM firsts
  UNION ALL SELECT make_date(y, 7, 4), 1 FROM years
  UNION ALL SELECT make_date(y, 12, 25), 1 FROM years
  UNION ALL SELECT make_date(y, 6, 19), 1 FROM years WHERE y >= 2022),
holidays AS (
  SELECT CASE isodow(d) WHEN 7 THEN d + 1 WHEN 6 THEN d - 1 ELSE d END AS d
  FROM fixed WHERE isodow(d) <> 6 OR sat = 1
  UNION SELECT CAST(jan + CAST((8 - isodow(jan)) % 7 + 14 AS INTEGER) AS DATE) FROM firsts WHERE y >= 1998
  UNION SELECT CAST(feb + CAST((8 - isodow(feb)) % 7 + 14 AS INTEGER) AS DATE) FROM firsts
  UNION SELECT CAST(easter - 2 AS DATE) FROM firsts
  UNION SELECT CAST(may - CAST(isodow(may) - 1 AS INTEGER) AS DATE) FROM firsts
  UNION SELECT CAST(sep + CAST((8 - isodow(sep)) % 7 AS INTEGER) AS DATE) FROM firsts
  UNION SELECT CAST(nov + CAST((11 - isodow(nov)) % 7 + 21 AS INTEGER) AS DATE) FROM firsts
  UNION SELECT CAST(x AS DATE) FROM (VALUES ('1994-04-27'), ('2001-09-11'), ('2001-09-12'), ('2001-09-13'),
    ('2001-09-14'), ('2004-06-11'), ('2007-01-02'), ('2012-10-29'), ('2012-10-30'), ('2018-12-05'),
    ('2025-01-09')) v(x)),
span AS (SELECT CAST(range AS DATE) AS d FROM range(DATE '1990-01-01', DATE '2030-12-31', INTERVAL 1 DAY)),
open_days AS (SELECT d FROM span WHERE isodow(d) < 6 AND d NOT IN (SELECT d FROM holidays)),
calendar AS (
  SELECT strftime(s.d, '%Y%m%d') AS date, any_value(o.d) IS NOT NULL AS is_trading_day,
         CASE WHEN isodow(any_value(s.d)) = 6 THEN 'weekend (Saturday)' WHEN isodow(any_value(s.d)) = 7 THEN 'weekend (Sunday)'
              WHEN any_value(o.d) IS NULL THEN 'market holiday' END AS reason,
         strftime(coalesce(max(p.d), CAST(any_value(s.d) - 1 AS DATE)), '%Y%m%d') AS prev_trading_day
  FROM span s LEFT JOIN open_days o ON o.d = s.d
  LEFT JOIN open_days p ON p.d BETWEEN s.d - 10 AND s.d - 1
  GROUP BY s.d)
"""

# Reference prices and the filled grid, from ``bars`` and ``calendar``.
GRID = """
open_bars AS (SELECT b.* FROM bars b JOIN calendar c ON c.date = b.date WHERE c.is_trading_day),
session_bars AS (
  SELECT * FROM open_bars WHERE ms_of_day BETWEEN 14400000 AND 72000000
  AND timestamp = date_trunc('minute', timestamp)),
firsts_of_day AS (SELECT symbol, date, arg_min(open, timestamp) AS first_open FROM open_bars GROUP BY symbol, date),
lasts_of_day AS (SELECT symbol, date, arg_max(close, timestamp) AS last_close FROM session_bars GROUP BY symbol, date),
refs AS (
  SELECT f.symbol, f.date, c.prev_trading_day AS prev_date, l.last_close AS prev_close,
         coalesce(l.last_close, f.first_open) AS ref_price
  FROM firsts_of_day f JOIN calendar c ON c.date = f.date
  LEFT JOIN lasts_of_day l ON l.symbol = f.symbol AND l.date = c.prev_trading_day),
grid AS (
  SELECT r.symbol, r.date, r.ref_price,
         strptime(r.date, '%Y%m%d') + to_minutes(CAST(240 + m.range AS BIGINT)) AS timestamp,
         CAST((240 + m.range) * 60000 AS BIGINT) AS ms_of_day
  FROM refs r, range(961) m)
"""

FACTS = """
ordered AS (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY timestamp) AS pos FROM bars),
sums AS (
  SELECT symbol, date, count(*) AS n, max(CASE WHEN pos = 1 THEN close END) AS first_close,
         count(*) FILTER (WHERE open = 0) AS oz, count(open) AS oc, count(*) FILTER (WHERE high = 0) AS hz, count(high) AS hc,
         count(*) FILTER (WHERE low = 0) AS lz, count(low) AS lc, count(*) FILTER (WHERE close = 0) AS cz, count(close) AS cc,
         count(*) FILTER (WHERE volume = 0) AS vz, count(volume) AS vc,
         count(*) FILTER (WHERE open = high AND high = low AND low = close) AS flats,
         count(*) FILTER (WHERE open < 0 OR high < 0 OR low < 0 OR close < 0) AS negs,
         count(*) FILTER (WHERE high < low OR high < open OR high < close OR low > open OR low > close) AS viols
  FROM ordered GROUP BY symbol, date),
facts AS (
  SELECT symbol, date, n, first_close,
         (oz = n OR oc = 0) AND (hz = n OR hc = 0) AND (lz = n OR lc = 0) AND (cz = n OR cc = 0) AS all_zeros,
         oc = 0 AND hc = 0 AND lc = 0 AND cc = 0 AS all_nulls,
         vz = n OR vc = 0 AS zero_volume, flats = n AS flat, negs > 0 AS negative, viols > 0 AS violation,
         regexp_full_match(symbol, '[A-Z]+[UWRZ]') AS is_special
  FROM sums)
"""

PURGE_REASON = """
CASE WHEN all_zeros THEN 'All OHLC zeros (' || n || ' bars)'
     WHEN flat AND coalesce(first_close = 0, false) THEN 'Constant price at $0.00 (' || n || ' bars)'
     WHEN flat AND zero_volume THEN printf('Zero volume + constant price $%.2f', first_close) || ' (' || n || ' bars)'
END"""

GATE_REASON = f"""
coalesce({PURGE_REASON},
  CASE WHEN negative THEN 'Negative prices detected' WHEN violation THEN 'OHLC violations (high<low, etc.)' END)"""

FILE_OF = "substr(date, 1, 4) || '/' || substr(date, 5, 2) || '/' || symbol || '_' || date || '.parquet'"

ISSUES = f"""
issues AS (
  SELECT {FILE_OF} AS file, symbol, date, issue_type, details, is_special,
         is_special AND issue_type IN ('all_zeros', 'zero_volume', 'constant_price') AS routed_special
  FROM (
    SELECT *, 'all_zeros' AS issue_type, n || ' bars, all zero' AS details FROM facts WHERE all_zeros
    UNION ALL SELECT *, 'zero_volume', n || ' bars, zero volume' FROM facts WHERE zero_volume
    UNION ALL SELECT *, 'constant_price', n || printf(' bars, constant at $%.2f', first_close) FROM facts
              WHERE flat AND NOT all_zeros
    UNION ALL SELECT *, 'insufficient_bars', n || '/961 bars' FROM facts WHERE n < 961 AND NOT all_zeros
    UNION ALL SELECT *, 'other_issues', 'Negative prices detected' FROM facts WHERE negative AND NOT all_zeros
    UNION ALL SELECT *, 'other_issues', 'OHLC violations (high<low, etc.)' FROM facts WHERE violation AND NOT all_zeros))
"""

# One payload's bars after a trip through six-decimal text.
def parsed_bar(source: str = "bars") -> str:
    return f"""
SELECT date, symbol, timestamp, ms_of_day, open, high, low, close, CAST(count AS DOUBLE) AS volume, count,
       CAST(CAST(vwap AS DECIMAL(18, 6)) AS DOUBLE) AS vwap FROM {source}"""


RULE = "(CAST(substr(date, 7, 2) AS INTEGER) + length(symbol))"
DAY = "CAST(substr(date, 7, 2) AS INTEGER)"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"
