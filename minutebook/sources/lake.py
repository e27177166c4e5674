"""The daily lake: Parquet partitioned by year, month and date, sorted by symbol and time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from minutebook.functions.times import in_date_range
from minutebook.schema import BAR_SCHEMA, LAKE_SCHEMA
from minutebook.sources.files import file_inventory, matching_folders, path_exists
from minutebook.sources.fragments import checked_columns

PARTITIONS = ["year", "month", "date"]


def with_partitions(bars: DataFrame) -> DataFrame:
    date = F.col("date")
    return bars.withColumns({"year": F.substring(date, 1, 4), "month": F.substring(date, 5, 2)})


def stored_dates(spark: SparkSession, root: str) -> DataFrame:
    """Dates a lake holds, from its day folders alone (one name per day)."""
    names = [f.rsplit("=", 1)[1] for f in matching_folders(spark, f"{root}/year=*/month=*/date=*")]
    return spark.createDataFrame([(d,) for d in names], "date string")


def scan_lake(
    spark: SparkSession, root: str, start: str | None = None, end: str | None = None, filled: bool = False
) -> DataFrame:
    """Bars of a date range. The bounds act on partition folders; a missing lake is empty.

    ``filled`` adds the column ``is_filled``.
    """
    columns = [*BAR_SCHEMA.names, *(["is_filled"] if filled else [])]
    if not path_exists(spark, root):
        return spark.createDataFrame([], LAKE_SCHEMA).select(*columns)
    bars = spark.read.schema(LAKE_SCHEMA).parquet(root)
    if start or end:
        bars = bars.filter(in_date_range(F.col("date"), start, end))
    return bars.select(*columns)


def scan_day(spark: SparkSession, root: str, date: str) -> DataFrame:
    """Bars of one day; empty if the day is not stored."""
    return scan_lake(spark, root, date, date)


def scan_day_file(spark: SparkSession, root: str, date: str) -> DataFrame:
    """One day kept as a plain YYYY/MM/YYYYMMDD.parquet file; empty if absent."""
    from minutebook.sources.fragments import conform

    path = f"{root}/{date[:4]}/{date[4:6]}/{date}.parquet"
    if not path_exists(spark, path):
        return spark.createDataFrame([], BAR_SCHEMA)
    return conform(spark.read.parquet(path))


def symbol_day(bars: DataFrame, symbol: str, date: str) -> DataFrame:
    """One symbol-day: pruned on the date folder, then on the sorted symbol column."""
    return bars.filter((F.col("date") == date) & (F.col("symbol") == symbol))


def write_daily(
    bars: DataFrame, root: str, existing: str = "skip", files_per_day: int | None = None,
    block_size: int | None = None,
) -> None:
    """Write bars into the lake, each day sorted by (symbol, timestamp).

    ``existing='skip'`` leaves stored days alone, ``'overwrite'`` replaces exactly the days
    that come in, ``'add'`` adds to stored days (of symbols they do not hold yet, which is the caller's care). Without ``files_per_day`` rows are rebalanced by date, so small days share
    a task and a huge day is split by size; with it, each day gets exactly that many files (fewer only if it has fewer
    symbols), each a range of symbols.
    """
    spark = bars.sparkSession
    if existing not in ("skip", "overwrite", "add"):
        raise ValueError(f"unknown policy {existing!r}")
    known = [*checked_columns(bars), *(["is_filled"] if "is_filled" in bars.columns else [])]
    out = with_partitions(bars.select(*known))
    if existing == "skip":
        out = out.join(F.broadcast(stored_dates(spark, root)), "date", "left_anti")
    if files_per_day is None:
        out = out.hint("rebalance", "date")
    else:
        out = _one_file_a_task(out, files_per_day)
    writer = (
        out.sortWithinPartitions(*PARTITIONS, "symbol", "timestamp")
        .write.partitionBy(*PARTITIONS)
        .option("compression", "snappy")
    )
    if block_size:
        writer = writer.option("parquet.block.size", str(block_size))
    if existing == "overwrite":
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(root)
    else:
        writer.mode("append").parquet(root)


def _one_file_a_task(bars: DataFrame, files_per_day: int) -> DataFrame:
    """Deal each day's symbols, in order, to as many tasks as it shall have files; a task holds one day's share."""
    symbols = bars.select("date", "symbol").distinct()
    by_day = Window.partitionBy("date").orderBy("symbol")  # at most as many rows as symbols exist
    days = [r["date"] for r in symbols.select("date").distinct().orderBy("date").collect()]  # one text per day
    first_task = F.create_map(*[F.lit(x) for k, d in enumerate(days) for x in (d, k * files_per_day)]) if days else F.create_map()
    tasks = symbols.withColumn("_task", first_task[F.col("date")] + F.ntile(files_per_day).over(by_day) - 1)
    return bars.join(tasks, ["date", "symbol"]).repartitionById(max(1, len(days) * files_per_day), "_task").drop("_task")


def write_fragments(bars: DataFrame, root: str) -> None:
    """One folder per symbol-day. Kept for old readers; many small files, not the default."""
    out = bars.select(*checked_columns(bars))
    (
        out.repartition("date", "symbol")
        .sortWithinPartitions("date", "symbol", "timestamp")
        .write.partitionBy("date", "symbol").mode("append").option("compression", "snappy").parquet(root)
    )


def stored_sizes(spark: SparkSession, root: str) -> DataFrame:
    """Files and bytes per stored day, from the listing."""
    date = F.regexp_extract("path", r"/date=(\d{8})/", 1)
    return file_inventory(spark, root).groupBy(date.alias("date")).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes")
    )
