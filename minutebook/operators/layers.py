"""Comparison of the raw, parsed and saved layers, and joins against registries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minutebook.functions.guards import percent
from minutebook.functions.trading_days import is_trading_day
from minutebook.schema import KEY


def reconcile(raw: DataFrame, parsed: DataFrame, saved: DataFrame | None = None) -> DataFrame:
    """Bars and volume of each symbol-day in every layer, with a verdict.

    The layers are stacked and folded in one aggregate: one shuffle of partial sums, no join.
    """
    layers = {"raw": raw, "parsed": parsed}
    if saved is not None:
        layers["saved"] = saved
    stacked = reduce(
        DataFrame.unionByName,
        [df.select(*KEY, "volume", F.lit(name).alias("layer")) for name, df in layers.items()],
    )
    sums = []
    for name in layers:
        here, v = F.col("layer") == name, F.col("volume")
        sums += [
            F.count_if(here).alias(f"{name}_bars"),
            F.coalesce(F.sum(F.when(here, v)), F.lit(0.0)).alias(f"{name}_volume"),
            F.count_if(here & (v > 0)).alias(f"{name}_traded_bars"),
        ]
    raw_v, parsed_v = F.col("raw_volume"), F.col("parsed_volume")
    lost = (raw_v > 0) & (parsed_v > 0) & (parsed_v < raw_v)
    verdict = (
        F.when((raw_v > 0) & (parsed_v == 0), "critical_zero_after_parse")
        .when(lost, "volume_lost")
        .when(raw_v == 0, "no_raw_volume")
        .when(raw_v == parsed_v, "preserved")
        .otherwise("none")
    )
    return stacked.groupBy(*KEY).agg(*sums).withColumns(
        {"verdict": verdict, "lost_pct": F.when(lost, percent(raw_v - parsed_v, raw_v))}
    )


def trading_days_only(rows: DataFrame, **calendar) -> DataFrame:
    return rows.filter(is_trading_day(F.col("date"), **calendar))


def non_trading_rows(rows: DataFrame, **calendar) -> DataFrame:
    return rows.filter(~is_trading_day(F.col("date"), **calendar))


def first_reasons(rejects: DataFrame) -> DataFrame:
    """One reason per symbol-day: the earliest entry where entries carry ``seq``, else the least text."""
    order = F.col("seq") if "seq" in rejects.columns else F.col("reason")
    return rejects.groupBy(*KEY).agg(F.min_by("reason", order).alias("reason"))


def skip_known_nulls(work: DataFrame, rejects: DataFrame) -> DataFrame:
    """Work rows whose symbol was not already found empty on that date."""
    return work.join(rejects.select(*KEY).distinct(), KEY, "left_anti")


def skip_decisions(work: DataFrame, rejects: DataFrame) -> DataFrame:
    """Every work row with ``should_skip`` and the registered reason."""
    return work.join(first_reasons(rejects), KEY, "left").withColumn(
        "should_skip", F.col("reason").isNotNull()
    )


def rejects_for_date(rejects: DataFrame, date: str) -> DataFrame:
    return rejects.filter(F.col("date") == date)


def clear_rejects(rejects: DataFrame, date: str) -> DataFrame:
    """The registry without one date."""
    return rejects.filter(F.col("date") != date)


def pending_dates(found: DataFrame, done: DataFrame) -> DataFrame:
    """Distinct dates of ``found`` that ``done`` does not have."""
    return found.select("date").distinct().join(done.select("date").distinct(), "date", "left_anti")


def worklist(symbols: DataFrame, start: str, end: str, done: DataFrame | None = None,
             rejects: DataFrame | None = None, **calendar) -> DataFrame:
    """Symbol x trading day tasks of a range, less finished days and known empties.

    Days are generated per symbol row from the calendar rule, so no product join is planned.
    """
    days = F.sequence(F.to_date(F.lit(start), "yyyyMMdd"), F.to_date(F.lit(end), "yyyyMMdd"))
    tasks = symbols.select("symbol").distinct().select("symbol", F.explode(days).alias("d")).select(
        "symbol", F.date_format("d", "yyyyMMdd").alias("date")
    ).filter(is_trading_day(F.col("date"), **calendar))
    if done is not None:
        tasks = tasks.join(done.select("date").distinct(), "date", "left_anti")
    if rejects is not None:
        tasks = skip_known_nulls(tasks, rejects)
    return tasks.select(*KEY)
