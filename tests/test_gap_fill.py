import datetime as dt

import pytest
from bars import bar, table
from pyspark.sql import functions as F

from minutebook.operators import gap_fill as g
from minutebook.operators.filled_gate import filled_facts, marks_with_facts
from minutebook.operators.quality import gate_reason, quality_facts

TUE, WED, FRI = "2024-01-02", "2024-01-03", "2024-01-05"


def at(filled, symbol, when):
    rows = filled.filter((F.col("symbol") == symbol) & (F.col("timestamp") == F.lit(dt.datetime.fromisoformat(when)))).collect()
    return rows


def test_grid_has_961_minutes_and_keeps_observed_bars(spark):
    bars = table(spark, bar("A", f"{TUE} 09:30", 10.0, 12.0, 9.0, 11.0, 5.0), bar("A", f"{TUE} 20:00", 12.0))
    filled = g.gap_fill(bars).cache()
    assert filled.count() == 961
    assert filled.agg(F.min("timestamp"), F.max("timestamp")).first() == (
        dt.datetime(2024, 1, 2, 4), dt.datetime(2024, 1, 2, 20))
    (seen,) = at(filled, "A", f"{TUE} 09:30")
    assert (seen.open, seen.high, seen.low, seen.close, seen.volume, seen.is_filled) == (10.0, 12.0, 9.0, 11.0, 5.0, False)
    (gap,) = at(filled, "A", f"{TUE} 15:59")
    assert (gap.open, gap.close, gap.volume, gap.is_filled, gap.ms_of_day) == (10.0, 10.0, 0.0, True, 57_540_000)


def test_copies_stay_and_off_grid_bars_go(spark):
    bars = table(
        spark, bar("A", f"{TUE} 03:00", 7.0), bar("A", f"{TUE} 10:00", 8.0), bar("A", f"{TUE} 10:00", 9.0),
        bar("A", f"{TUE} 10:01:30", 99.0), bar("A", f"{TUE} 20:01", 99.0),
    )
    filled = g.gap_fill(bars).cache()
    assert filled.count() == 962
    assert filled.select("timestamp").distinct().count() == 961
    assert filled.filter("close = 99").count() == 0
    # the first bar counts for the reference price even off the grid
    assert filled.filter("is_filled").select("open").distinct().collect()[0][0] == 7.0


def test_observed_null_is_not_filled(spark):
    rows = [bar("A", f"{TUE} 10:00", 8.0), ("A", "20240102", dt.datetime(2024, 1, 2, 11), None, None, None, None, None)]
    filled = g.gap_fill(table(spark, *rows)).cache()
    (seen,) = at(filled, "A", f"{TUE} 11:00")
    assert seen.open is None and seen.volume is None and not seen.is_filled


def test_previous_close_is_of_exactly_the_previous_trading_day(spark):
    bars = table(
        spark, bar("A", f"{TUE} 10:00", 1.0), bar("A", f"{WED} 10:00", 2.0, c=2.5, h=2.5), bar("A", f"{FRI} 10:00", 3.0),
        bar("A", "2024-01-08 10:00", 4.0),
    )
    refs = {r.date: (r.prev_close, r.ref_price) for r in g.reference_prices(bars).collect()}
    assert refs == {
        "20240102": (None, 1.0), "20240103": (1.0, 1.0), "20240105": (None, 3.0), "20240108": (3.0, 3.0)}


def test_stored_mode_carries_the_end_of_the_filled_day(spark):
    bars = table(
        spark, bar("A", f"{TUE} 10:00", 1.0, c=9.0, h=9.0), bar("A", f"{WED} 10:00", 2.0), bar("A", f"{WED} 20:00", 5.0),
        bar("A", "2024-01-04 10:00", 3.0),
    )
    refs = {r.date: r.ref_price for r in g.reference_prices(bars, "stored").collect()}
    assert refs == {"20240102": 1.0, "20240103": 1.0, "20240104": 5.0}
    assert {r.date: r.prev_close for r in g.reference_prices(bars, "none").collect()} == dict.fromkeys(refs)


def test_ffill_carries_the_last_close(spark):
    bars = table(spark, bar("A", f"{TUE} 10:00", 1.0, h=4.0, c=4.0), bar("A", f"{TUE} 12:00", 6.0))
    filled = g.gap_fill(bars, fill="ffill").cache()
    assert filled.count() == 961
    assert at(filled, "A", f"{TUE} 09:00")[0].close == 1.0
    assert at(filled, "A", f"{TUE} 11:59")[0].close == 4.0
    assert at(filled, "A", f"{TUE} 12:01")[0].close == 6.0


def test_volume_is_kept_and_non_trading_days_are_left_out(spark):
    bars = table(spark, bar("A", f"{TUE} 10:00", 1.0, v=3.0), bar("A", "2024-01-06 10:00", 1.0, v=9.0))
    assert g.gap_fill(bars).agg(F.sum("volume")).first()[0] == 3.0
    assert g.gap_fill(bars, trading_days_only=False).count() == 2 * 961


def test_unknown_modes_are_refused(spark):
    bars = table(spark, bar("A", f"{TUE} 10:00", 1.0))
    with pytest.raises(ValueError):
        g.gap_fill(bars, fill="linear")
    with pytest.raises(ValueError):
        g.gap_fill(bars, previous="guess")


def test_bars_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "bars")
    table(spark, bar("A", f"{TUE} 10:00", 1.0)).write.parquet(path)
    plan = g.gap_fill(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    observed = plan.split("Union")[1].split("FileScan")[0]
    assert "Exchange" not in observed and "SortAggregate" not in plan


def full_day(symbol, date, price, volume):
    start = dt.datetime.strptime(date, "%Y%m%d") + dt.timedelta(hours=4)
    return [(symbol, date, start + dt.timedelta(minutes=i), price, price, price, price, volume) for i in range(961)]


def test_gate_before_filling_equals_gate_after(spark):
    n = None
    rows = [
        bar("ZERO", f"{TUE} 10:00", 0.0), bar("FLATIDLE", f"{TUE} 10:00", 5.0, v=0.0), bar("FLATBUSY", f"{TUE} 10:00", 5.0),
        bar("NEG", f"{TUE} 10:00", -1.0), bar("BROKEN", f"{TUE} 10:00", 5.0, h=4.0), bar("GOOD", f"{TUE} 10:00", 5.0, h=6.0),
        bar("FLATZERO", f"{TUE} 04:00", 0.0), bar("FLATZERO", f"{TUE} 05:00", 4.0),
        bar("OFFGRID", f"{TUE} 02:00", 3.0), ("NULLS", "20240102", dt.datetime(2024, 1, 2, 10), n, n, n, n, n),
        bar("LATE", f"{TUE} 10:00", 5.0), bar("LATE", f"{WED} 10:00", 0.0),
        *full_day("FULLZERO", "20240102", 0.0, 1.0), *full_day("FULLNULL", "20240102", None, None),
    ]
    bars = table(spark, *rows)
    early = filled_facts(g.with_reference(marks_with_facts(bars)))
    late = quality_facts(g.gap_fill(bars))
    names = [c for c in late.columns]
    a = sorted(early.select(*names).collect(), key=lambda r: (r.symbol, r.date))
    b = sorted(late.select(*names).collect(), key=lambda r: (r.symbol, r.date))
    assert a == b
    reasons = {(r.symbol, r.date): r.reason for r in early.select("symbol", "date", gate_reason().alias("reason")).collect()}
    assert reasons["ZERO", "20240102"].startswith("All OHLC zeros")
    assert reasons["FLATIDLE", "20240102"] == "Zero volume + constant price $5.00 (961 bars)"
    assert reasons["FLATZERO", "20240102"] == "Constant price at $0.00 (961 bars)"
    assert reasons["GOOD", "20240102"] is None and reasons["FLATBUSY", "20240102"] is None
