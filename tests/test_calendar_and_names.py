import pytest
from pyspark.sql import functions as F

from minutebook.functions import symbols, times, trading_days as cal


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "date, reason, previous",
    [
        ("20240102", None, "20231229"), ("20240101", "market holiday", "20231229"), ("20240116", None, "20240112"),
        ("20240106", "weekend (Saturday)", "20240105"), ("20240107", "weekend (Sunday)", "20240105"),
        ("20240329", "market holiday", "20240328"), ("20211231", None, "20211230"), ("20220103", None, "20211231"),
        ("20220620", "market holiday", "20220617"), ("20210618", None, "20210617"), ("20151225", "market holiday", "20151224"),
        ("20200703", "market holiday", "20200702"), ("20211224", "market holiday", "20211223"), ("20010917", None, "20010910"),
        ("20250109", "market holiday", "20250108"), ("20251127", "market holiday", "20251126"), ("19970120", None, "19970117"),
        ("20230102", "market holiday", "20221230"), ("20000421", "market holiday", "20000420"), ("19721107", "market holiday", "19721106"),
        ("19801104", "market holiday", "19801103"),
    ],
)
def test_known_days(spark, date, reason, previous):
    row = cal.with_calendar(spark.createDataFrame([(date,)], "date string")).first()
    assert (row.is_trading_day, row.reason, row.prev_trading_day) == (reason is None, reason, previous)


def test_years_without_rules(spark):
    early = spark.createDataFrame([("19600704",)], "date string")
    with pytest.raises(Exception, match="cover 1971 to 2100"):
        early.select(cal.is_trading_day(F.col("date"))).collect()
    row = cal.with_calendar(early, holidays=False).first()
    assert (row.is_trading_day, row.prev_trading_day) == (True, "19600701")


def test_default_range_has_19_trading_days(spark):
    assert cal.trading_days(spark, "20251121", "20251218").count() == 19
    assert cal.skipped_days(spark, "20251121", "20251218").count() == 9
    table = cal.holiday_table(spark).filter("date like '2024%'")
    assert table.count() == 10


def test_extra_closures_and_weekend_only(spark):
    days = ["20240102", "20240101", "20240106", "20240230", "x"]
    assert column(spark, days, lambda c: cal.is_trading_day(c, closures=["20240102"])) == [False] * 5
    assert column(spark, days, lambda c: cal.is_trading_day(c, holidays=False)) == [True, True, False, False, False]


def test_symbols(spark):
    raw = [" aapl\t", "brk.b", "BBAI-WT", "a b", "", "ÄB1", "A" * 16, None]
    clean = column(spark, raw, symbols.normalize_symbol)
    assert clean[:3] == ["AAPL", "BRK.B", "BBAI-WT"]
    assert column(spark, clean, symbols.is_valid_symbol) == [True, True, True, False, False, True, False, False]
    special = column(spark, ["ABCW", "ABCU", "ABCR", "ABCZ", "W", "BBAI-WT", "ABC", "abcw", None], symbols.is_special)
    assert special == [True] * 4 + [False] * 5


def test_file_names(spark):
    names = ["AAPL_20240102.parquet", "BRK_B_20240102.parquet", "20240102.parquet", "notes.parquet", "A_2024.parquet", "A_20240102.csv"]
    assert column(spark, names, symbols.symbol_of_file) == ["AAPL", "BRK_B", None, None, None, None]
    assert column(spark, names, symbols.date_of_file) == ["20240102"] * 3 + [None] * 3
    paths = ["x/2024/01/03/A.parquet", "x/2024/01/03/A_20240102.parquet", "2024/01/03/A.parquet", "x/2024/01/20240102.parquet"]
    assert column(spark, paths, symbols.date_of_path) == ["20240103", "20240102", "20240103", None]


def test_times(spark):
    assert column(spark, ["20240229", "20230229", "2024010", "202401021"], lambda c: times.text_to_date(c).cast("string")) == [
        "2024-02-29", None, None, None]
    stamps = ["2024-01-02 03:59:59.999", "2024-01-02 04:00:00", "2024-01-02 09:30:00", "2024-01-02 16:00:00", "2024-01-02 20:00:00", "2024-01-02 20:00:00.001"]
    ms = lambda c: times.ms_of_day(c.cast("timestamp_ntz"))
    assert column(spark, stamps, ms)[0] == 14_399_999
    assert column(spark, stamps, lambda c: times.session_label(ms(c))) == [None, "pre", "regular", "after", "after", None]
    assert column(spark, ["20240101", "20240102", None], lambda c: times.in_date_range(c, "20240102")) == [False, True, False]
