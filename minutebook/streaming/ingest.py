"""Incremental ingest of a payload landing folder.

Each run takes the files that arrived since the last one and stops. Finished symbol-days are skipped by a join with the
ledger, of which only the batch's dates are read, so the stream itself keeps no growing state.

Of several payloads for a symbol-day the first landed that is usable counts, in one batch or over many; the result does
not depend on how files fall into batches. A payload that is empty, an error or unreadable is entered in the ledger and tried again
with whatever lands next. Usable bars are stored as observed; ``daily_build`` fills and screens whole days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from minutebook.operators.payload_parse import parse_payloads, to_bars
from minutebook.schema import BAR_SCHEMA, KEY, PAYLOAD_SCHEMA
from minutebook.session import work_folder
from minutebook.sources.files import path_exists

LEDGER_SCHEMA = "symbol string, kind string, parse_status string, reject_reason string, records int, date string, batch string"
WAITING_SCHEMA = "symbol string, date string, payload string, landed timestamp, source string, digest long"


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """Payloads taken in so far, with their outcome: per symbol-day one that is usable, and those rejected before it."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    ledger = spark.read.schema(LEDGER_SCHEMA).parquet(root)
    return ledger.select("symbol", "date", "batch", "kind", "parse_status", "reject_reason", "records")


def read_ingested(spark: SparkSession, root: str) -> DataFrame:
    """Bars stored so far."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], BAR_SCHEMA)
    stored = spark.read.schema(f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in BAR_SCHEMA.fields)}, batch string").parquet(root)
    return stored.select(*BAR_SCHEMA.names)


def first_usable(parsed: DataFrame) -> DataFrame:
    """One payload per symbol-day: the first landed that is usable, else the first; the limit also acts before the shuffle."""
    order = Window.partitionBy(*KEY).orderBy(F.col("reject_reason").isNotNull(), "landed", "source", "digest")
    return parsed.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def accepted_only(parsed: DataFrame, accept: tuple[str, ...] | None) -> DataFrame:
    """Refuse usable payloads of other parse statuses than those named."""
    if accept is None:
        return parsed
    other = F.when(~F.col("parse_status").isin(*accept), F.concat(F.lit("waits: "), "parse_status"))
    return parsed.withColumn("reject_reason", F.coalesce("reject_reason", other))


def finished(spark: SparkSession, ledger_root: str, dates: list[str], but: str | None = None) -> DataFrame:
    """Symbol-days of some dates that have a usable payload, those of batch ``but`` left out."""
    ledger = read_ledger(spark, ledger_root).filter(F.col("date").isin(dates) & F.col("reject_reason").isNull())
    return (ledger.filter(F.col("batch") != but) if but is not None else ledger).select(*KEY).distinct()


def _write(rows: DataFrame, root: str) -> None:
    """Replace the rows of a batch: one that is run again after a failure leaves the same table."""
    (
        rows.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "batch").parquet(root)
    )


def store_outcomes(
    payloads: DataFrame, name: str, ledger_root: str, bars_root: str | None, accept: tuple[str, ...] | None = None,
    waiting_root: str | None = None, keep_refused: bool = True,
) -> None:
    """Parse payloads and store bars and ledger rows as batch ``name``; one payload per symbol-day counts.

    Refused ones of symbol-days without a usable one go to ``waiting_root``; without ``keep_refused`` they leave no ledger row.
    """
    spark = payloads.sparkSession
    stage, reason = work_folder(spark, "parsed"), F.col("reject_reason")
    outcomes = accepted_only(parse_payloads(payloads), accept)
    if waiting_root:
        outcomes.withColumn("payload", F.when(reason.isNotNull(), F.col("payload"))).write.parquet(f"{stage}/all")
        every = spark.read.parquet(f"{stage}/all")
        refused = every.filter(reason.isNotNull()).join(every.filter(reason.isNull()).select(*KEY), KEY, "left_anti")
        refused.select(*[f.split()[0] for f in WAITING_SCHEMA.split(", ")]).write.mode("overwrite").json(f"{waiting_root}/batch-{name}")
        outcomes = every
    first_usable(outcomes.drop("payload")).write.parquet(f"{stage}/first")
    parsed = spark.read.parquet(f"{stage}/first")
    number = F.lit(name).alias("batch")
    if bars_root:
        _write(to_bars(parsed.filter(reason.isNull())).select(*BAR_SCHEMA.names, number), bars_root)
    # last, so that a symbol-day counts as done only when its bars are stored
    kept = parsed if keep_refused else parsed.filter(reason.isNull())
    _write(kept.select(
        "symbol", "kind", "parse_status", "reject_reason", F.coalesce(F.size("records"), F.lit(0)).alias("records"), "date", number,
    ), ledger_root)


def _take(
    batch: DataFrame, batch_id: int, ledger_root: str, bars_root: str | None, accept: tuple[str, ...] | None = None,
    waiting_root: str | None = None,
) -> None:
    spark, name = batch.sparkSession, str(batch_id)
    dates = [r["date"] for r in batch.select("date").distinct().collect()]  # one text per day
    fresh = batch.join(finished(spark, ledger_root, dates, name), KEY, "left_anti").withColumn("digest", F.xxhash64("payload"))
    store_outcomes(fresh, name, ledger_root, bars_root, accept, waiting_root)


def ingest_landing(
    spark: SparkSession, landing: str, ledger_root: str, checkpoint: str, files_per_batch: int = 1000,
    bars_root: str | None = None, accept: tuple[str, ...] | None = None, waiting_root: str | None = None,
) -> None:
    """Take in everything new below ``landing``, then return; with ``bars_root`` the bars are stored there.

    ``accept`` limits what is taken to some parse statuses. What is refused is left below ``waiting_root``, if given, for ``retry_waiting``.
    """
    stream = (
        spark.readStream.schema(PAYLOAD_SCHEMA).option("maxFilesPerTrigger", str(files_per_batch)).json(landing)
        .select("*", F.col("_metadata.file_modification_time").alias("landed"), F.col("_metadata.file_path").alias("source"))
    )
    query = (
        stream.writeStream.foreachBatch(lambda batch, batch_id: _take(batch, batch_id, ledger_root, bars_root, accept, waiting_root))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
