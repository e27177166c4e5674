"""Payloads to the daily lake: parse, fill, gate, write - all dates in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.functions.trading_days import is_trading_day, previous_trading_day
from minutebook.operators.filled_gate import filled_facts, marks_with_facts
from minutebook.operators.gap_fill import fill_with, stored_day_marks, with_reference
from minutebook.operators.layers import skip_known_nulls
from minutebook.operators.payload_parse import parse_payloads, to_bars
from minutebook.operators.profiles import day_summary
from minutebook.operators.quality import gate_reason, quality_facts, quality_gate, quality_rejects
from minutebook.schema import KEY
from minutebook.session import work_folder
from minutebook.sources.landing import add_to_registry, read_registry
from minutebook.sources.lake import scan_lake, stored_dates, stored_sizes, write_daily
from minutebook.sources.versions import upsert_index


def due_payloads(
    payloads: DataFrame, lake_root: str, rejects: DataFrame | None = None, overwrite: bool = False, **calendar
) -> DataFrame:
    """Payloads of trading days that are not stored yet and not known to be empty."""
    due = payloads.filter(is_trading_day(F.col("date"), **calendar))
    if not overwrite:
        due = due.join(F.broadcast(stored_dates(payloads.sparkSession, lake_root)), "date", "left_anti")
    return due if rejects is None else skip_known_nulls(due, rejects)


def _closes_before(bars: DataFrame, lake_root: str, **calendar) -> DataFrame:
    """Marks of the stored days that precede the incoming ones; only those day folders are read."""
    incoming = bars.select("date").distinct()
    before = incoming.select(previous_trading_day(F.col("date"), **calendar).alias("date")).distinct()
    wanted = [r["date"] for r in before.join(incoming, "date", "left_anti").collect()]  # one text per day
    stored = scan_lake(bars.sparkSession, lake_root, filled=True).filter(F.col("date").isin(wanted))
    return stored_day_marks(stored).withColumn("_stored", F.lit(True))


def _kept(df: DataFrame, label: str) -> DataFrame:
    folder = work_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


# Prices that stand for all of their sign: a verdict hangs on the reference price by its sign alone.
SIGNS = [None, 0.0, -1.0, 1.0]


def _sign(price: Column) -> Column:
    """The place in SIGNS of what stands for a price."""
    return F.when(price.isNull(), 0).when(price == 0, 1).when(price < 0, 2).otherwise(3)


def accepted_days(marks: DataFrame, previous: str = "last_observed", **calendar) -> DataFrame:
    """symbol, date and ``_accepted`` of every mark.

    Whether a day is accepted can hang on its reference price, so on whether the day before was. The verdict at a price of
    each sign is known beforehand, one entry each. The entries of a symbol are folded in the order of days: what is carried along is the last
    accepted trading day and the price it lends, and of a day's entries that of its price's sign counts. An array holds four small
    entries per day of a symbol, so never more than the calendar has days for.
    """
    date, verdict = F.col("date"), F.coalesce("_stored", F.lit(False)) | gate_reason().isNull()
    tried = marks.select("*", F.posexplode(F.array(*[F.lit(p).cast("double") for p in SIGNS])).alias("sign", "ref_price"))
    entry = filled_facts(tried).select("symbol", F.struct(
        "date", "sign", previous_trading_day(date, **calendar).alias("before"), is_trading_day(date, **calendar).alias("open"),
        "first_open", "last_close", "end_close", verdict.alias("ok"),
    ).alias("day"))

    def step(state: Column, day: Column) -> Column:
        lent = F.when(state["date"] == day["before"], state["price"]) if previous != "none" else F.lit(None).cast("double")
        price = F.coalesce(lent, day["first_open"])
        counts = (day["sign"] == _sign(price)) & ~F.coalesce(state["judged"] == day["date"], F.lit(False))
        lends = counts & day["open"] & day["ok"]
        ends_with = F.coalesce(day["end_close"], price) if previous == "stored" else day["last_close"]
        return F.struct(
            F.when(counts, day["date"]).otherwise(state["judged"]).alias("judged"),
            F.when(lends, day["date"]).otherwise(state["date"]).alias("date"),
            F.when(lends, ends_with).otherwise(state["price"]).alias("price"),
            F.when(counts, F.concat(state["verdicts"], F.when(day["ok"], "1").otherwise("0"))).otherwise(state["verdicts"]).alias("verdicts"),
        )

    none = F.lit(None).cast("string")
    start = F.struct(none.alias("judged"), none.alias("date"), F.lit(None).cast("double").alias("price"), F.lit("").alias("verdicts"))
    chains = entry.groupBy("symbol").agg(F.array_sort(F.collect_list("day")).alias("days"))
    told = chains.select("symbol", F.array_distinct("days.date").alias("dates"), F.aggregate("days", start, step)["verdicts"].alias("verdicts"))
    each = told.select("symbol", "verdicts", F.posexplode("dates").alias("at", "date"))
    return each.select("symbol", "date", (F.substring("verdicts", F.col("at") + 1, F.lit(1)) == "1").alias("_accepted"))


def settled_marks(marks: DataFrame, previous: str = "last_observed", **calendar) -> DataFrame:
    """Marks with ``ref_price`` and ``reason``, where only accepted days lend their close to the day after; stored once."""
    columns = marks.columns
    marks = marks.join(accepted_days(marks, previous, **calendar), KEY)
    judged = filled_facts(with_reference(marks, previous, **calendar))
    reason = F.when(F.coalesce("_stored", F.lit(False)), None).otherwise(gate_reason()).alias("reason")
    return _kept(judged.select(*columns, "ref_price", reason), "marks")


def build_days(
    bars: DataFrame, lake_root: str, fill: str = "day_ref", previous: str = "last_observed", **calendar
) -> tuple[DataFrame, DataFrame]:
    """Filled and accepted bars, and the rejects, of staged bars.

    The result is the same for one batch of days and for several in order: references come from accepted days only.
    With ``fill='ffill'`` too, verdicts about the days before are those of the day's reference price.
    """
    before = _closes_before(bars, lake_root, **calendar)
    marks = settled_marks(marks_with_facts(bars).unionByName(before, allowMissingColumns=True), previous, **calendar)
    # one row per symbol-day, kept as a table: it feeds the filler rows, the gate and the rejects
    marks = marks.filter(F.col("_stored").isNull()).drop("_stored")
    n_marks = marks.count()  # cheap, as they are stored
    if fill != "day_ref":
        filled = fill_with(bars, marks, fill, n_marks)
        facts = quality_facts(filled)
        return quality_gate(filled, facts), quality_rejects(facts)
    rejects = marks.filter("reason is not null").select("date", "symbol", "reason")
    kept = bars.join(rejects.select(*KEY), KEY, "left_anti")
    return fill_with(kept, marks.filter("reason is null"), n_marks=n_marks), rejects


def daily_build(
    spark: SparkSession, payloads: DataFrame, lake_root: str, rejects: DataFrame | None = None,
    overwrite: bool = False, fill: str = "day_ref", previous: str = "last_observed",
    files_per_day: int | None = None, registry: str | None = None, index: str | None = None, **calendar,
) -> tuple[DataFrame, DataFrame]:
    """Run the build. Returns the per-day summary and the new reject rows.

    Parsed bars are staged once in the shared work folder: payload text is read a single
    time, and the later passes start from columnar data. With ``registry``, a folder, symbol-days that earlier runs have registered as rejects are
    skipped and those of this run are added; with ``index`` the built days are entered there with their true sizes.
    """
    stage = work_folder(spark, "parsed")
    if registry is not None:
        known = read_registry(spark, registry)
        rejects = known if rejects is None else rejects.select(*known.columns).unionByName(known)
    parsed = parse_payloads(due_payloads(payloads, lake_root, rejects, overwrite, **calendar))
    to_bars(parsed, keep_rejects=True).write.parquet(stage)
    staged = spark.read.parquet(stage)
    bars = staged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    bars = bars.filter(is_trading_day(F.col("date"), **calendar))
    filled, gated = build_days(bars, lake_root, fill, previous, **calendar)
    write_daily(filled, lake_root, "overwrite" if overwrite else "skip", files_per_day)
    unread = staged.filter(F.col("reject_reason").isNotNull()).select(
        "date", "symbol", F.col("reject_reason").alias("reason")
    )
    rejected = unread.unionByName(gated)
    if registry is not None:
        rejected = _kept(rejected, "rejects")
        add_to_registry(rejected, registry)
    summary = build_summary(spark, bars, lake_root)
    if index is not None:
        summary = _kept(summary, "summary")
        created = F.current_timestamp().cast("timestamp_ntz").alias("created_at")
        upsert_index(spark, index, summary.filter("files > 0").select("date", "symbol_count", "row_count", "file_size_mb", created))
    return summary, rejected


def build_summary(spark: SparkSession, bars: DataFrame, lake_root: str) -> DataFrame:
    """Symbols, rows and MB of the days the bars cover, as stored."""
    days = [r["date"] for r in bars.select("date").distinct().collect()]  # one text per day
    stored = day_summary(scan_lake(spark, lake_root).filter(F.col("date").isin(days)))
    return stored.join(stored_sizes(spark, lake_root), "date", "left").select(
        "date", "symbol_count", "row_count", "files",
        (F.col("bytes") / F.lit(1024.0 * 1024.0)).alias("file_size_mb"),
    )
