"""Session grid and gap filling.

Observed bars never move: they pass straight through. Which minutes a symbol-day lacks is
found from one small aggregate row per symbol-day, a bit mask per session hour, and only
the missing minutes are generated from it. The shuffle therefore carries one row per
symbol-day instead of every bar, and a symbol-day with many copies of a bar is folded
into its masks before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minutebook.functions.guards import first_in_day, micros_of_day, time_rank
from minutebook.functions.times import ms_of_day
from minutebook.functions.trading_days import is_trading_day, previous_trading_day
from minutebook.schema import KEY, OHLC, SESSION_BARS, SESSION_START_MINUTE

MINUTE_MICROS = 60_000_000
HOURS = [f"_h{k}" for k in range(17)]
LAST_SLOT = SESSION_BARS - 1


def grid_slot(ts: Column) -> Column:
    """Minute number 0..960 of a bar on the session grid, NULL off the grid."""
    micros = micros_of_day(ts)
    slot = F.floor(micros / F.lit(MINUTE_MICROS)).cast("int") - SESSION_START_MINUTE
    return F.when((micros % MINUTE_MICROS == 0) & slot.between(0, LAST_SLOT), slot)


def on_grid(bars: DataFrame) -> DataFrame:
    return bars.filter(grid_slot(F.col("timestamp")).isNotNull())


def _hour_mask(slot: str, hour: int) -> Column:
    in_hour = f"{slot} BETWEEN {60 * hour} AND {60 * hour + 59}"
    return F.expr(f"bit_or(if({in_hour}, shiftleft(1L, {slot} % 60), 0L))")


def day_marks(bars: DataFrame, *more: Column) -> DataFrame:
    """One row per symbol-day: minutes present, first open, last close on the grid, 20:00 close."""
    ts, close = F.col("timestamp"), F.col("close")
    rank = time_rank(ts, close)
    slot = F.col("_slot")
    return (
        bars.withColumn("_slot", grid_slot(ts))
        .groupBy(*KEY)
        .agg(
            *[_hour_mask("_slot", k).alias(name) for k, name in enumerate(HOURS)],
            first_in_day(F.col("open"), ts).alias("first_open"),
            F.max_by(close, F.when(slot.isNotNull(), rank)).alias("last_close"),
            F.max_by(close, F.when(slot == LAST_SLOT, rank)).alias("end_close"),
            *more,
        )
    )


def previous_closes(marks: DataFrame, mode: str = "last_observed", **calendar) -> DataFrame:
    """Add ``prev_date`` and ``prev_close``: the close of exactly the previous trading day.

    ``last_observed`` takes that day's last bar on the grid. ``stored`` takes what the filled
    day ends with: its 20:00 bar, which is its own reference price unless 20:00 traded.
    ``none`` never looks back. Marks with a false ``_accepted`` column lend no price to the days after them. The windows run
    over symbol-days, a few thousand per symbol.
    """
    date = F.col("date")
    step = marks.withColumn("prev_date", previous_trading_day(date, **calendar))
    if mode == "none":
        return step.withColumn("prev_close", F.lit(None).cast("double"))
    if mode not in ("last_observed", "stored"):
        raise ValueError(f"unknown mode {mode!r}")
    earlier = Window.partitionBy("symbol").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    is_open = is_trading_day(date, **calendar)
    if "_accepted" in marks.columns:
        is_open = is_open & F.col("_accepted")
    last_open_day = F.last(F.when(is_open, F.struct("date", "last_close")), ignorenulls=True).over(earlier)
    step = step.withColumn("_back", last_open_day)
    follows = F.coalesce(F.col("_back.date") == F.col("prev_date"), F.lit(False))
    if mode == "last_observed":
        return step.withColumn("prev_close", F.when(follows, F.col("_back.last_close"))).drop("_back")

    # A run is a chain of stored days, each the previous trading day of the next.
    by_date = Window.partitionBy("symbol").orderBy("date")
    step = step.withColumns({"_follows": follows, "_open_day": is_open})
    step = step.withColumn(
        "_run", F.sum(F.when(F.col("_open_day") & ~F.col("_follows"), 1).otherwise(0)).over(by_date)
    )
    run = Window.partitionBy("symbol", "_run").orderBy("date")
    past = run.rowsBetween(Window.unboundedPreceding, -1)
    start_price = F.first(F.when(F.col("_open_day"), F.col("first_open")), ignorenulls=True).over(past)
    carried = F.last(F.when(F.col("_open_day"), F.col("end_close")), ignorenulls=True).over(past)
    return step.withColumn(
        "prev_close", F.when(F.col("_follows"), F.coalesce(carried, start_price))
    ).drop("_back", "_follows", "_open_day", "_run")


def with_reference(marks: DataFrame, mode: str = "last_observed", **calendar) -> DataFrame:
    """Add previous close and ``ref_price`` (first open where there is none)."""
    return previous_closes(marks, mode, **calendar).withColumn(
        "ref_price", F.coalesce("prev_close", "first_open")
    )


def reference_prices(bars: DataFrame, mode: str = "last_observed", **calendar) -> DataFrame:
    return with_reference(day_marks(bars), mode, **calendar)


def stored_day_marks(stored: DataFrame) -> DataFrame:
    """Marks of days that are already filled and stored, for the closes of the days after.

    The lake knows which bars were observed; for days of older builds that do not, bars with a volume count as observed. A
    day without any ends at its last bar.
    """
    ts, close = F.col("timestamp"), F.col("close")
    rank = time_rank(ts, close)
    observed = F.coalesce(~F.col("is_filled"), F.col("volume") > 0) if "is_filled" in stored.columns else F.col("volume") > 0
    traded = F.max_by(close, F.when(observed, rank))
    return stored.groupBy(*KEY).agg(
        first_in_day(F.col("open"), ts).alias("first_open"),
        F.coalesce(traded, F.max_by(close, rank)).alias("last_close"),
        F.max_by(close, F.when(grid_slot(ts) == LAST_SLOT, rank)).alias("end_close"),
    )


def missing_count() -> Column:
    return F.lit(SESSION_BARS) - reduce(lambda a, b: a + b, [F.bit_count(h) for h in HOURS])


MARKS_A_TASK = 2_000  # up to 961 rows each


def missing_minutes(marks: DataFrame, n_marks: int = 0) -> DataFrame:
    """One row per missing grid minute of every symbol-day, with its reference price.

    Hours, then minutes are unrolled, and present minutes dropped by a bit test: plain
    generators and a filter, which stay in generated code. A mark is small but yields up to
    961 rows, so marks are first spread over all shuffle partitions, or more where their number is given and asks
    for it; left alone, adaptive execution would pack them into a few tasks by their own size.
    """
    spread = max(int(marks.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_marks // MARKS_A_TASK)
    minute = F.col("_hour") * 60 + F.col("_minute")
    midnight = F.unix_micros(F.to_date("date", "yyyyMMdd").cast("timestamp"))
    hours = marks.repartition(spread, *KEY).select(
        *KEY, "ref_price", midnight.alias("_midnight"), F.posexplode(F.array(*HOURS)).alias("_hour", "_mask")
    )
    minutes = hours.select("*", F.explode(F.expr("sequence(0, 59)")).alias("_minute"))
    absent = minutes.filter((F.getbit("_mask", F.col("_minute")) == 0) & (minute <= LAST_SLOT))
    of_day = (minute + SESSION_START_MINUTE).cast("long")
    return absent.select(
        *KEY,
        F.timestamp_micros(F.col("_midnight") + of_day * MINUTE_MICROS).cast("timestamp_ntz").alias("timestamp"),
        (of_day * 60_000).alias("ms_of_day"),
        "ref_price",
    )


def _filler_rows(gaps: DataFrame, price: str, columns: list[str]) -> DataFrame:
    values = {c: F.col(price) for c in [*OHLC, "vwap"]}
    values["volume"] = F.lit(0.0)
    values["count"] = F.lit(0).cast("long")
    plain = [*KEY, "timestamp", "ms_of_day"]
    return gaps.select(
        *[F.col(c) if c in plain else values[c].alias(c) for c in columns],
        F.lit(True).alias("is_filled"),
    )


def _columns(bars: DataFrame) -> list[str]:
    known = ["date", "symbol", "timestamp", "ms_of_day", *OHLC, "volume", "count", "vwap"]
    return [c for c in known if c in bars.columns or c == "ms_of_day"]


def _observed(bars: DataFrame, columns: list[str]) -> DataFrame:
    return on_grid(bars).select(
        *[ms_of_day(F.col("timestamp")).alias(c) if c == "ms_of_day" else F.col(c) for c in columns],
        F.lit(False).alias("is_filled"),
    )


def fill_with(bars: DataFrame, marks: DataFrame, fill: str = "day_ref", n_marks: int = 0) -> DataFrame:
    """Observed grid bars plus filler rows for the symbol-days in ``marks``, of which there are ``n_marks`` if that is known."""
    columns = _columns(bars)
    if fill not in ("day_ref", "ffill"):
        raise ValueError(f"unknown fill {fill!r}")
    gaps = _carried_gaps(bars, marks, n_marks) if fill == "ffill" else missing_minutes(marks, n_marks)
    return _observed(bars, columns).unionByName(_filler_rows(gaps, "ref_price", columns))


def _slot_times(slot: Column) -> dict[str, Column]:
    """Timestamp and ms_of_day of a grid minute of ``date``."""
    of_day = (slot + SESSION_START_MINUTE).cast("long")
    midnight = F.unix_micros(F.to_date("date", "yyyyMMdd").cast("timestamp"))
    return {"timestamp": F.timestamp_micros(midnight + of_day * MINUTE_MICROS).cast("timestamp_ntz"), "ms_of_day": of_day * 60_000}


def _carried_gaps(bars: DataFrame, marks: DataFrame, n_marks: int) -> DataFrame:
    """One row per missing grid minute with the last close seen earlier that day, else the reference price.

    Only observed minutes are shuffled: copies are folded first, so a window group holds at most 961 rows, and each row yields the
    gap that follows it (the first of a day also the one before it). Days without a bar on the grid come from their marks.
    """
    ts, close, slot = F.col("timestamp"), F.col("close"), F.col("slot")
    minutes = on_grid(bars).withColumn("slot", grid_slot(ts)).groupBy(*KEY, "slot").agg(
        F.max_by(close, F.when(close.isNotNull(), time_rank(ts, close))).alias("seen")
    )
    day = Window.partitionBy(*KEY).orderBy("slot")
    rows = minutes.withColumns({
        "carried": F.last("seen", ignorenulls=True).over(day),
        "following": F.lead("slot", 1, LAST_SLOT + 1).over(day), "first": F.lag("slot").over(day).isNull(),
    }).join(marks.select(*KEY, "ref_price"), KEY)
    after = rows.filter(F.col("following") > slot + 1).select(
        *KEY, F.coalesce("carried", "ref_price").alias("ref_price"), F.explode(F.sequence(slot + 1, F.col("following") - 1)).alias("slot")
    )
    before = rows.filter(F.col("first") & (slot > 0)).select(*KEY, "ref_price", F.explode(F.sequence(F.lit(0), slot - 1)).alias("slot"))
    gaps = after.unionByName(before).select(*KEY, *[c.alias(n) for n, c in _slot_times(slot).items()], "ref_price")
    off_grid = marks.filter(reduce(lambda x, y: x & y, [F.col(h) == 0 for h in HOURS]))
    return gaps.unionByName(missing_minutes(off_grid, n_marks))


def gap_fill(
    bars: DataFrame, fill: str = "day_ref", previous: str = "last_observed",
    trading_days_only: bool = True, **calendar,
) -> DataFrame:
    """Place every symbol-day on its 961-minute grid.

    Missing minutes get the day's reference price (``fill='day_ref'``) or the last close
    before them (``'ffill'``), volume 0 and count 0. Bars off the grid are dropped, copies
    of a minute are kept, observed NULLs stay.
    """
    if trading_days_only:
        bars = bars.filter(is_trading_day(F.col("date"), **calendar))
    return fill_with(bars, reference_prices(bars, previous, **calendar), fill)
