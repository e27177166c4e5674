"""Exchange calendar as column expressions.

The rules fill a constant bit set, one bit per day of 1971-2100, that a column looks up by
day number. Testing a date needs no join: on a date-partitioned table the test prunes
partitions, elsewhere it is one array access in the generated code. ``closures`` adds
one-off dates, ``holidays=False`` keeps the weekend rule only, for any year; with holidays a date outside
1971-2100 is an error.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import lru_cache

from dateutil.easter import easter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.functions.times import text_to_date

FIRST_YEAR, LAST_YEAR = 1971, 2100
EPOCH = dt.date(FIRST_YEAR, 1, 1)
LOOK_BACK_DAYS = 10

# One-off full-day closures of the exchange (elections, mourning, attacks, storms).
ONE_OFF_CLOSURES = [
    "19721107", "19721228", "19730125", "19761102", "19770714", "19801104", "19850927", "19940427", "20010911", "20010912", "20010913",
    "20010914", "20040611", "20070102", "20121029", "20121030", "20181205", "20250109",
]


def _nth_weekday(year: int, month: int, weekday: int, n: int) -> dt.date:
    first = dt.date(year, month, 1)
    return first + dt.timedelta(days=(weekday - first.weekday()) % 7 + 7 * (n - 1))


def _observed(day: dt.date) -> dt.date:
    """Sunday moves to Monday, Saturday to Friday."""
    return day + dt.timedelta(days={5: -1, 6: 1}.get(day.weekday(), 0))


def _year_holidays(year: int) -> dict[str, dt.date]:
    new_year, last_may = dt.date(year, 1, 1), dt.date(year, 5, 31)
    days = {
        "Presidents' Day": _nth_weekday(year, 2, 0, 3),
        "Good Friday": easter(year) - dt.timedelta(days=2),
        "Memorial Day": last_may - dt.timedelta(days=last_may.weekday()),
        "Independence Day": _observed(dt.date(year, 7, 4)),
        "Labor Day": _nth_weekday(year, 9, 0, 1),
        "Thanksgiving": _nth_weekday(year, 11, 3, 4),
        "Christmas": _observed(dt.date(year, 12, 25)),
    }
    if new_year.weekday() != 5:  # a Saturday New Year is not made up for
        days["New Year's Day"] = _observed(new_year)
    if year >= 1998:
        days["Martin Luther King Jr. Day"] = _nth_weekday(year, 1, 0, 3)
    if year >= 2022:
        days["Juneteenth"] = _observed(dt.date(year, 6, 19))
    return days


@lru_cache(maxsize=None)
def _closed_days() -> dict[dt.date, str]:
    closed = {_parse(d): "one-off closure" for d in ONE_OFF_CLOSURES}
    for year in range(FIRST_YEAR, LAST_YEAR + 1):
        closed |= {day: name for name, day in _year_holidays(year).items()}
    return closed


def _parse(text: str) -> dt.date:
    return dt.datetime.strptime(text, "%Y%m%d").date()


@lru_cache(maxsize=None)
def _open_words(closures: tuple[str, ...]) -> str:
    """The bit set as signed 64-bit words, comma-separated."""
    closed = set(_closed_days()) | {_parse(d) for d in closures}
    words = [0] * ((dt.date(LAST_YEAR, 12, 31) - EPOCH).days // 64 + 1)
    for n in range((dt.date(LAST_YEAR, 12, 31) - EPOCH).days + 1):
        day = EPOCH + dt.timedelta(days=n)
        if day.weekday() < 5 and day not in closed:
            words[n // 64] |= 1 << (n % 64)
    return ",".join(str(w - (1 << 64) if w >> 63 else w) for w in words)


def holiday_table(spark: SparkSession) -> DataFrame:
    """holidays(date, name) for the years of the rules."""
    rows = sorted((day.strftime("%Y%m%d"), name) for day, name in _closed_days().items())
    return spark.createDataFrame(rows, "date string, name string")


def _is_weekday(day: Column) -> Column:
    return F.weekday(day) < 5


def _is_open(day: Column, closures: Iterable[str], holidays: bool) -> Column:
    if not holidays:
        return _is_weekday(day)
    n = F.date_diff(day, F.lit(EPOCH))
    # one text literal in the plan; the optimizer folds it into a constant array
    words = F.split(F.lit(_open_words(tuple(closures))), ",").cast("array<bigint>")
    known = F.year(day).between(FIRST_YEAR, LAST_YEAR)
    outside = F.raise_error(F.lit(f"the calendar's rules cover {FIRST_YEAR} to {LAST_YEAR}; use holidays=False for other years"))
    return F.when(known, F.getbit(F.get(words, F.shiftright(n, 6)), F.pmod(n, F.lit(64))) == 1).when(
        day.isNotNull(), outside.cast("boolean")
    )


def is_trading_day(date: Column, closures: Iterable[str] = (), holidays: bool = True) -> Column:
    """Weekday and not closed; False for text that is no date."""
    return F.coalesce(_is_open(text_to_date(date), closures, holidays), F.lit(False))


def skip_reason(date: Column, closures: Iterable[str] = (), holidays: bool = True) -> Column:
    """``weekend (Saturday)``, ``market holiday`` or NULL on a trading day."""
    day = text_to_date(date)
    return F.when(
        ~_is_weekday(day), F.concat(F.lit("weekend ("), F.date_format(day, "EEEE"), F.lit(")"))
    ).when(~_is_open(day, closures, holidays), "market holiday")


def previous_trading_day(date: Column, closures: Iterable[str] = (), holidays: bool = True) -> Column:
    """Nearest open day among the ten before, else the day before."""
    day = text_to_date(date)
    before = F.sequence(F.date_sub(day, 1), F.date_sub(day, LOOK_BACK_DAYS), F.expr("interval -1 day"))
    open_days = F.filter(before, lambda d: _is_open(d, closures, holidays))
    return F.date_format(F.coalesce(F.get(open_days, F.lit(0)), F.date_sub(day, 1)), "yyyyMMdd")


def with_calendar(days: DataFrame, closures: Iterable[str] = (), holidays: bool = True) -> DataFrame:
    """Add is_trading_day, reason and prev_trading_day to any table with a ``date`` text column."""
    date = F.col("date")
    return days.withColumns(
        {
            "is_trading_day": is_trading_day(date, closures, holidays),
            "reason": skip_reason(date, closures, holidays),
            "prev_trading_day": previous_trading_day(date, closures, holidays),
        }
    )


def date_span(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from start to end (YYYYMMDD, inclusive)."""
    return spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start), "yyyyMMdd"), F.to_date(F.lit(end), "yyyyMMdd"))).alias("d")
    ).select(F.date_format("d", "yyyyMMdd").alias("date"))


def trading_days(spark: SparkSession, start: str, end: str, **rules) -> DataFrame:
    """Trading days of a range."""
    return date_span(spark, start, end).filter(is_trading_day(F.col("date"), **rules))


def skipped_days(spark: SparkSession, start: str, end: str, **rules) -> DataFrame:
    """Days of a range without trading, with the reason."""
    reason = skip_reason(F.col("date"), **rules)
    return date_span(spark, start, end).select("date", reason.alias("reason")).filter("reason is not null")
