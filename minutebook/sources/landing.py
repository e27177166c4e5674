"""Payload landing, archive, symbol universe and report sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.functions.symbols import is_valid_symbol, normalize_symbol
from minutebook.schema import PAYLOAD_SCHEMA, REJECT_SCHEMA
from minutebook.session import work_folder
from minutebook.sources.files import path_exists


def scan_payloads(spark: SparkSession, root: str) -> DataFrame:
    """Landed payloads: JSON lines of (symbol, date, payload)."""
    return spark.read.schema(PAYLOAD_SCHEMA).json(root)


def scan_payload_files(spark: SparkSession, root: str) -> DataFrame:
    """Payloads landed as one text file per symbol-day, SYMBOL_YYYYMMDD.json or .csv."""
    name = F.col("_metadata.file_name")
    files = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(root)
    shape = r"^(.+)_(\d{8})\.(?:json|csv|txt)$"
    return files.select(
        F.regexp_extract(name, shape, 1).alias("symbol"),
        F.regexp_extract(name, shape, 2).alias("date"),
        F.col("value").alias("payload"),
    ).filter(F.col("date") != "")


def land_payloads(payloads: DataFrame, root: str) -> None:
    payloads.select(*PAYLOAD_SCHEMA.names).write.mode("append").json(root)


def archive_payloads(parsed: DataFrame, root: str) -> None:
    """Keep raw text with its parse status, partitioned by date."""
    (
        parsed.select("symbol", "date", "payload", "kind", "parse_status", "reject_reason")
        .write.mode("append").partitionBy("date").parquet(root)
    )


def read_symbol_csv(spark: SparkSession, path: str) -> DataFrame:
    """(position, symbol) of a symbol list: column ``symbol`` in any case, else the first one.

    Only an empty cell counts as missing, so a ticker such as NA survives.
    """
    raw = spark.read.csv(path, header=True, inferSchema=False)
    named = [c for c in raw.columns if c.strip().lower() == "symbol"]
    column = named[0] if named else raw.columns[0]
    # taken straight from the scan, where the id follows file order
    return raw.select(F.monotonically_increasing_id().alias("position"), F.col(f"`{column}`").alias("symbol"))


def symbol_universe(raw: DataFrame) -> DataFrame:
    """Normalised valid symbols, each once at its first position, in order."""
    symbol = normalize_symbol(F.col("symbol"))
    return (
        raw.filter(F.col("symbol").isNotNull())
        .select(symbol.alias("symbol"), "position")
        .filter(is_valid_symbol(F.col("symbol")))
        .groupBy("symbol")
        .agg(F.min("position").alias("position"))
        .orderBy("position")
    )


def universe_stats(raw: DataFrame) -> DataFrame:
    """Load counters. Copies are folded per symbol first, so the totals need no distinct pass."""
    per_symbol = (
        raw.groupBy(normalize_symbol(F.col("symbol")).alias("symbol"))
        .agg(F.count("*").alias("n"), F.count("symbol").alias("given"))
    )
    valid = is_valid_symbol(F.col("symbol"))
    given = F.col("given")
    return per_symbol.agg(
        F.sum("n").alias("raw_rows"),
        F.coalesce(F.sum(F.when(valid, given)), F.lit(0)).alias("valid_rows"),
        F.coalesce(F.sum(F.when(~valid, given)), F.lit(0)).alias("invalid_rows"),
        F.count_if(valid).alias("unique_symbols"),
        F.coalesce(F.sum(F.when(valid, given - 1)), F.lit(0)).alias("duplicates_removed"),
    )


def write_csv_report(rows: DataFrame, root: str) -> None:
    rows.write.mode("overwrite").option("header", "true").csv(root)


def write_registry(rejects: DataFrame, root: str) -> None:
    """Reject rows as JSON, one folder per date; only the given dates are replaced."""
    (
        rejects.select("date", "symbol", "reason")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").json(root)
    )


def add_to_registry(rejects: DataFrame, root: str) -> None:
    """Register further rejects; of a symbol-day that is registered already the first reason stays. Only dates with new rows are rewritten."""
    spark = rejects.sparkSession
    known, new = read_registry(spark, root), rejects.select("date", "symbol", "reason")
    new = new.groupBy("date", "symbol").agg(F.min("reason").alias("reason")).join(known.select("date", "symbol"), ["date", "symbol"], "left_anti")
    kept = known.join(new.select("date").distinct(), "date", "left_semi")
    # the dates that are replaced are read here, so the rows are stored first
    folder = work_folder(spark, "registry")
    kept.unionByName(new).write.parquet(folder)
    merged = spark.read.schema(REJECT_SCHEMA).parquet(folder)
    if merged.take(1):
        write_registry(merged, root)


def read_registry(spark: SparkSession, root: str) -> DataFrame:
    if not path_exists(spark, root):
        return spark.createDataFrame([], REJECT_SCHEMA)
    return spark.read.schema(REJECT_SCHEMA).json(root).select(*REJECT_SCHEMA.names)
