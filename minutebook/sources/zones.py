"""Which symbols each file of a lake can hold, so that a lookup opens only the files that matter.

A day written ``clustered`` is dealt out by ranges of symbols, so each of its files holds a few of them. The zone table has the least and greatest
symbol of every file, read from the symbol column alone, and is brought up to date by the days whose files changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from minutebook.schema import BAR_SCHEMA, LAKE_SCHEMA
from minutebook.session import work_folder
from minutebook.sources.files import path_exists
from minutebook.sources.lake import PARTITIONS, with_partitions
from minutebook.sources.fragments import checked_columns
from minutebook.sources.versions import read_current, write_next

ZONE_SCHEMA = StructType([StructField(n, StringType()) for n in ("date", "file", "least", "most")])


def write_clustered(bars: DataFrame, root: str, tasks: int | None = None) -> None:
    """Add days to a lake, each file a range of symbols with a Bloom filter on them.

    Rows are dealt to ``tasks`` (by default the shuffle partitions) in the order of date and symbol: a small day lies within one
    task, a huge one is cut between symbols, or within one that fills several tasks.
    """
    known = [*checked_columns(bars), *(["is_filled"] if "is_filled" in bars.columns else [])]
    order = [F.col("date"), F.col("symbol"), F.col("timestamp")]
    dealt = with_partitions(bars.select(*known)).repartitionByRange(*([tasks] if tasks else []), *order)
    (
        dealt.sortWithinPartitions(*PARTITIONS, "symbol", "timestamp").write.mode("append").partitionBy(*PARTITIONS)
        .option("compression", "snappy").option("parquet.bloom.filter.enabled#symbol", "true").parquet(root)
    )


def _files(spark: SparkSession, lake_root: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(lake_root)
    return files.select(F.regexp_extract("path", r"/date=(\d{8})/", 1).alias("date"), F.col("_metadata.file_path").alias("file"))


def refresh_zones(spark: SparkSession, lake_root: str, store: str) -> int:
    """Bring the zone table up to the lake; only days with files it does not know, or no longer finds, are read. Returns how many."""
    listing = work_folder(spark, "files")
    _files(spark, lake_root).write.parquet(listing)
    files = spark.read.parquet(listing)
    known = read_current(spark, store, ZONE_SCHEMA)
    named = known.select("date", "file")
    changed = files.exceptAll(named).select("date").union(named.exceptAll(files).select("date")).distinct()
    days = [r["date"] for r in changed.collect()]  # one text per day
    if days:
        bars = spark.read.schema(LAKE_SCHEMA).parquet(lake_root).filter(F.col("date").isin(days))
        zones = bars.groupBy("date", F.col("_metadata.file_path").alias("file")).agg(F.min("symbol").alias("least"), F.max("symbol").alias("most"))
        # files without rows have no zone, but are known
        zones = files.filter(F.col("date").isin(days)).join(zones, ["date", "file"], "left")
        write_next(known.filter(~F.col("date").isin(days)).unionByName(zones), store)
    return len(days)


def lookup(spark: SparkSession, lake_root: str, store: str, symbol: str, date: str) -> DataFrame:
    """The bars of one symbol-day, from those files alone whose zone has it."""
    zones = read_current(spark, store, ZONE_SCHEMA).filter((F.col("date") == date) & F.lit(symbol).between(F.col("least"), F.col("most")))
    files = [r["file"] for r in zones.select(F.try_url_decode(F.regexp_replace("file", r"\+", "%2B")).alias("file")).collect()]  # of one symbol-day
    if not files or not path_exists(spark, lake_root):
        return spark.createDataFrame([], BAR_SCHEMA)
    bars = spark.read.schema(LAKE_SCHEMA).option("basePath", lake_root).parquet(*files)
    return bars.filter((F.col("date") == date) & (F.col("symbol") == symbol)).select(*BAR_SCHEMA.names)
