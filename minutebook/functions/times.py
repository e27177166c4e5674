"""Date text, time of day and sessions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from minutebook.functions.guards import micros_of_day

HOUR_MS = 3_600_000
MINUTE_MS = 60_000

# Session bounds in milliseconds of the day.
PRE_MARKET = 4 * HOUR_MS
REGULAR_OPEN = 9 * HOUR_MS + 30 * MINUTE_MS
REGULAR_CLOSE = 16 * HOUR_MS
SESSION_END = 20 * HOUR_MS


def date_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def ms_of_day(ts: Column) -> Column:
    return F.floor(micros_of_day(ts) / F.lit(1000)).cast("long")


def text_to_date(text: Column) -> Column:
    """YYYYMMDD to DATE; NULL for text that is no calendar date."""
    return F.when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "yyyyMMdd"))


def session_label(ms: Column) -> Column:
    """pre, regular or after for a millisecond of the day; NULL outside the session."""
    return (
        F.when((ms >= PRE_MARKET) & (ms < REGULAR_OPEN), "pre")
        .when((ms >= REGULAR_OPEN) & (ms < REGULAR_CLOSE), "regular")
        .when((ms >= REGULAR_CLOSE) & (ms <= SESSION_END), "after")
    )


def in_session(ms: Column, start: int = PRE_MARKET, end: int = SESSION_END) -> Column:
    return ms.between(start, end)


def in_date_range(date: Column, start: str | None = None, end: str | None = None) -> Column:
    """Inclusive bounds on date text, either may be open; an unknown date is outside."""
    cond = date.isNotNull()
    if start:
        cond = cond & (date >= start)
    if end:
        cond = cond & (date <= end)
    return cond
