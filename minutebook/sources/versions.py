"""Tables that are replaced as a whole: metadata index, reject registry, purged lakes, snapshots of a lake.

A version's rows are written to a folder of their own and become visible by one small commit file, named by the version's number
and made only if there is none of that name. Two writers on one version thus exclude each other: the first wins, the second reads
what the first has left and tries again. Older versions stay readable. The store must refuse to rename onto a file that exists, as HDFS does.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from minutebook.schema import INDEX_SCHEMA

TRIES = 10


class VersionConflict(Exception):
    """Another writer has committed a version on the same base."""


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed versions, ascending."""
    folder, fs = _hadoop(spark, f"{root}/commits")
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit())


def current_version(spark: SparkSession, root: str) -> int:
    """Number of the current version, 0 if there is none."""
    return max(versions(spark, root), default=0)


def read_version(spark: SparkSession, root: str, version: int, schema: StructType) -> DataFrame:
    """Rows of a version; version 0 is empty."""
    if version == 0:
        return spark.createDataFrame([], schema)
    commit, fs = _hadoop(spark, f"{root}/commits/{version:06d}")
    stream = fs.open(commit)
    try:
        folder = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return spark.read.schema(schema).parquet(f"{root}/data/{folder}")


def read_current(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    return read_version(spark, root, current_version(spark, root), schema)


def _commit(spark: SparkSession, root: str, version: int, folder: str) -> None:
    """Make the commit file of a version, whole or not at all, or raise if there is one."""
    draft, fs = _hadoop(spark, f"{root}/drafts/{folder}")
    commit, _ = _hadoop(spark, f"{root}/commits/{version:06d}")
    stream = fs.create(draft)
    stream.write(folder.encode())
    stream.close()
    fs.mkdirs(commit.getParent())
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark._sc._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(draft, commit, options)
    except Exception as e:
        fs.delete(draft, False)
        if fs.exists(commit):
            raise VersionConflict(f"{root}: version {version} is there already") from e
        raise


def write_next(df: DataFrame, root: str, partition_by: list[str] | None = None, base: int | None = None) -> int:
    """Commit the rows as the version after ``base`` (the current one, unless told); raises if that exists by then."""
    spark = df.sparkSession
    version = (current_version(spark, root) if base is None else base) + 1
    folder = f"version={version:06d}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root}/data/{folder}")
    _commit(spark, root, version, folder)
    return version


def update(spark: SparkSession, root: str, schema: StructType, change: Callable[[DataFrame], DataFrame], partition_by: list[str] | None = None) -> int:
    """Commit what ``change`` makes of the current rows, again from the newest ones whenever another writer was first."""
    for _ in range(TRIES):
        base = current_version(spark, root)
        try:
            return write_next(change(read_version(spark, root, base, schema)), root, partition_by, base)
        except VersionConflict:
            continue
    raise VersionConflict(f"{root}: {TRIES} writers in a row were first")


def upserted_index(existing: DataFrame, new: DataFrame) -> DataFrame:
    """New entries replace those of the same date; sorted by date."""
    kept = existing.join(new.select("date"), "date", "left_anti")
    return kept.unionByName(new).select(*INDEX_SCHEMA.names).orderBy("date")


def upsert_index(spark: SparkSession, root: str, new: DataFrame) -> int:
    return update(spark, root, INDEX_SCHEMA, lambda existing: upserted_index(existing, new))


def available_dates(spark: SparkSession, root: str) -> DataFrame:
    """Dates of the metadata index, sorted; empty without an index."""
    return read_current(spark, root, INDEX_SCHEMA).select("date").orderBy("date")


def index_entries(summary: DataFrame, sizes: DataFrame) -> DataFrame:
    """Index rows from a day summary and stored sizes."""
    return summary.join(sizes, "date").select(
        "date", "symbol_count", "row_count",
        (F.col("bytes") / F.lit(1024.0 * 1024.0)).alias("file_size_mb"),
        F.current_timestamp().cast("timestamp_ntz").alias("created_at"),
    )
