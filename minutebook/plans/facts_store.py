"""Quality facts of a lake, kept up to date: a scan reads only the days that changed.

Facts are stored per symbol-day, in one folder a day, next to a versioned table of each day's fingerprint (names, lengths and times of its files).
A refresh lists the lake, computes the days whose fingerprint is new, drops those that are gone and commits the fingerprints it
listed before it read anything. A run that fails leaves the old fingerprints, so its days are computed again. Reports over
days or symbols merge the stored facts and never touch the bars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from minutebook.operators.quality import quality_facts, with_summary_flags
from minutebook.schema import BAR_SCHEMA, KEY
from minutebook.session import work_folder
from minutebook.sources.files import path_exists, remove_folder
from minutebook.sources.lake import scan_lake
from minutebook.sources.versions import read_current, write_next

PRINT_SCHEMA = StructType([StructField("date", StringType()), StructField("files", LongType()), StructField("print", LongType())])
DAY_IN_PATH = r"/date=(\d{8})/"


def day_fingerprints(spark: SparkSession, lake_root: str) -> DataFrame:
    """date, files and print of every day of a lake, from its listing alone. File rows are folded before the shuffle."""
    if not path_exists(spark, lake_root):
        return spark.createDataFrame([], PRINT_SCHEMA)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(lake_root)
    one = F.xxhash64(F.substring_index("path", "/", -1), "length", "modificationTime")
    return files.groupBy(F.regexp_extract("path", DAY_IN_PATH, 1).alias("date")).agg(
        F.count("*").alias("files"), F.bit_xor(one).alias("print")
    )


def _facts_schema(spark: SparkSession) -> StructType:
    return quality_facts(spark.createDataFrame([], BAR_SCHEMA)).schema


def stored_facts(spark: SparkSession, store: str) -> DataFrame:
    """The facts of every symbol-day of the lake as of the last refresh."""
    known = read_current(spark, f"{store}/prints", PRINT_SCHEMA)
    if not path_exists(spark, f"{store}/facts"):
        return spark.createDataFrame([], _facts_schema(spark))
    facts = spark.read.schema(_facts_schema(spark)).parquet(f"{store}/facts")
    return facts.join(F.broadcast(known.select("date")), "date", "left_semi").select(_facts_schema(spark).names)  # one row per day


def refresh_facts(spark: SparkSession, lake_root: str, store: str) -> DataFrame:
    """Bring the stored facts up to the lake. Returns date and action: ``computed``, ``kept`` or ``removed``."""
    folder = work_folder(spark, "prints")
    day_fingerprints(spark, lake_root).write.parquet(folder)
    now = spark.read.schema(PRINT_SCHEMA).parquet(folder)
    known = read_current(spark, f"{store}/prints", PRINT_SCHEMA).select("date", F.struct("files", "print").alias("was"))
    compared = now.select("date", F.struct("files", "print").alias("is")).join(known, "date", "full")
    action = F.when(F.col("is").isNull(), "removed").when(F.col("is").eqNullSafe(F.col("was")), "kept").otherwise("computed")
    actions = {r["date"]: r["action"] for r in compared.select("date", action.alias("action")).collect()}  # one per day
    days = lambda name: sorted(d for d, a in actions.items() if a == name)
    changed, gone = days("computed"), days("removed")
    if changed:
        facts = quality_facts(scan_lake(spark, lake_root).filter(F.col("date").isin(changed)))
        # facts of a day lie together, so that a later refresh replaces whole folders
        facts.repartition("date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(f"{store}/facts")
    if changed or gone:
        write_next(now.coalesce(1), f"{store}/prints")
    for d in gone:
        remove_folder(spark, f"{store}/facts/date={d}")
    return spark.createDataFrame(sorted(actions.items()), "date string, action string")


def merged_facts(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Facts of larger groups (say, of a symbol over all days) from those of symbol-days.

    Counts add up, what holds for all bars must hold in each part, what holds for some in any, and the first close is that of the first day.
    """
    names = [c for c in facts.columns if c not in KEY]
    flags = [c for c in names if c not in ("n", "first_close", "negative", "violation", "all_zeros", "all_nulls", "zero_volume")]
    parts = [F.sum("n").alias("n"), *[F.bool_and(c).alias(c) for c in flags], *[F.bool_or(c).alias(c) for c in ("negative", "violation")]]
    return with_summary_flags(facts.groupBy(*keys).agg(*parts, F.min_by("first_close", "date").alias("first_close")))
