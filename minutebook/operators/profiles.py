"""Summaries of symbol-days."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minutebook.functions.guards import first_in_day, last_in_day, percent
from minutebook.functions.trading_days import is_trading_day
from minutebook.schema import KEY, OHLC


def day_summary(bars: DataFrame) -> DataFrame:
    """Rows and distinct symbols per day; symbols are folded first, so no day sits in one task."""
    per_symbol = bars.groupBy("date", "symbol").agg(F.count("*").alias("n"))
    return per_symbol.groupBy("date").agg(
        F.sum("n").alias("row_count"), F.count("symbol").alias("symbol_count")
    )


def volume_profile(bars: DataFrame) -> DataFrame:
    v = F.col("volume")
    return bars.groupBy(*KEY).agg(
        F.count("*").alias("bars"),
        F.sum(v).alias("total_volume"),
        F.count_if(v > 0).alias("nonzero_bars"),
        F.count_if(v == 0).alias("zero_bars"),
        F.count_if(v.isNull()).alias("null_bars"),
        F.min(v).alias("min_volume"),
        F.max(v).alias("max_volume"),
        F.avg(v).alias("mean_volume"),
        percent(F.count_if(v > 0), F.count("*")).alias("nonzero_pct"),
    )


def price_profile(bars: DataFrame) -> DataFrame:
    """One row per symbol-day and price column. Columns are folded side by side, then unpivoted."""
    wide = bars.groupBy(*KEY).agg(
        *[
            F.struct(
                F.lit(c).alias("price"),
                F.min(c).alias("min_price"),
                F.max(c).alias("max_price"),
                F.avg(c).alias("mean_price"),
                F.count_if(F.col(c) == 0).alias("zeros"),
                F.count_if(F.col(c).isNull()).alias("nulls"),
            ).alias(c)
            for c in OHLC
        ]
    )
    return wide.select(*KEY, F.inline(F.array(*OHLC)))


def hourly_profile(bars: DataFrame) -> DataFrame:
    """Bars, traded bars and volume per hour; volume is NULL where nothing traded."""
    v = F.col("volume")
    total = F.sum(v)
    return bars.groupBy(*KEY, F.hour("timestamp").alias("hour")).agg(
        F.count("*").alias("bars"),
        F.count_if(v > 0).alias("traded_bars"),
        F.when(total > 0, total).alias("volume"),
    )


def time_span(bars: DataFrame) -> DataFrame:
    span = bars.groupBy(*KEY).agg(F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"))
    seconds = F.timestamp_diff("SECOND", F.col("first_ts"), F.col("last_ts"))
    return span.withColumn("hours", seconds / F.lit(3600.0))


def activity_days(bars: DataFrame, weekdays_only: bool = True) -> DataFrame:
    """What traded on each symbol-day; price range over non-zero closes, 0 if there are none."""
    v, c, ts = F.col("volume"), F.col("close"), F.col("timestamp")
    if weekdays_only:
        bars = bars.filter(is_trading_day(F.col("date"), holidays=False))
    priced = F.when(c != 0, c)
    traded = F.when(v > 0, ts)
    return (
        bars.groupBy(*KEY)
        .agg(
            F.count("*").alias("total_bars"),
            F.coalesce(F.sum(v), F.lit(0.0)).alias("total_volume"),
            F.count_if(v > 0).alias("nonzero_volume"),
            F.count(priced).alias("nonzero_price"),
            F.coalesce(F.min(priced), F.lit(0.0)).alias("price_min"),
            F.coalesce(F.max(priced), F.lit(0.0)).alias("price_max"),
            F.min(traded).alias("first_trade"),
            F.max(traded).alias("last_trade"),
        )
        .withColumn("has_data", (F.col("total_volume") > 0) | (F.col("nonzero_price") > 0))
    )


def activity_summary(days: DataFrame) -> DataFrame:
    return days.groupBy("symbol").agg(
        F.count("*").alias("days_checked"),
        F.count_if("has_data").alias("days_with_data"),
        F.count_if(~F.col("has_data")).alias("days_without_data"),
    )


def first_last_bar(bars: DataFrame) -> DataFrame:
    """First open and last close of each symbol-day."""
    ts = F.col("timestamp")
    return bars.groupBy(*KEY).agg(
        first_in_day(F.col("open"), ts).alias("first_open"),
        last_in_day(F.col("close"), ts).alias("last_close"),
    )


def head_tail_bars(bars: DataFrame, n: int = 10, traded: int = 20) -> DataFrame:
    """First n, last n and first traded bars of each symbol-day, labelled.

    One scan: each bar is offered to the parts it may be in, and one ranked limit, which Spark applies before and after its
    shuffle, serves all three.
    """
    limits = {"head": n, "tail": n, "traded": traded}
    offered = F.array_compact(F.array(F.lit("head"), F.lit("tail"), F.when(F.col("volume") > 0, F.lit("traded"))))
    from_end, ts = F.col("part") == "tail", F.col("timestamp")
    by_time = Window.partitionBy(*KEY, "part").orderBy(
        F.when(~from_end, ts).asc(), F.when(from_end, ts).desc(), *[F.col(c) for c in [*OHLC, "volume"]]
    )
    return (
        bars.withColumn("part", F.explode(offered))
        .withColumn("rank", F.row_number().over(by_time))
        .filter(F.col("rank") <= max(limits.values()))
        .filter(F.col("rank") <= reduce(lambda kept, part: F.when(F.col("part") == part, limits[part]).otherwise(kept), limits, F.lit(0)))
    )


def traded_bars(bars: DataFrame) -> DataFrame:
    return bars.filter(F.col("volume") > 0)


def filled_bars(bars: DataFrame) -> DataFrame:
    """Bars without volume that carry a price: most likely filled ones."""
    return bars.filter((F.col("volume") == 0) & (F.col("close") > 0))
