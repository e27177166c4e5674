"""A lake whose changes are seen all at once: a versioned list says in which folder each day lies.

Days are written to a new folder first. One commit of the list then shows all of them, and hides what they replace, so a reader sees the lake
before a change or after it, however many days it touches, and may go back to any version. The list has one row per day.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from minutebook.functions.times import in_date_range
from minutebook.operators.quality import purge_apply
from minutebook.schema import BAR_SCHEMA, LAKE_SCHEMA
from minutebook.sources.lake import scan_lake, stored_dates, write_daily
from minutebook.sources.versions import TRIES, VersionConflict, current_version, read_version, update, write_next

DAYS_SCHEMA = StructType([StructField("date", StringType()), StructField("folder", StringType())])


def snapshot_days(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """date and folder of every day of a version (the current one, unless told)."""
    return read_version(spark, root, current_version(spark, root) if version is None else version, DAYS_SCHEMA)


def _scan(spark: SparkSession, root: str, days: DataFrame, filled: bool) -> DataFrame:
    by_folder: dict[str, list[str]] = {}
    for row in days.collect():  # one per day
        by_folder.setdefault(row["folder"], []).append(row["date"])
    columns = [*BAR_SCHEMA.names, *(["is_filled"] if filled else [])]
    parts = [scan_lake(spark, f"{root}/days/{f}", filled=filled).filter(F.col("date").isin(d)) for f, d in sorted(by_folder.items())]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], LAKE_SCHEMA).select(*columns)


def scan_snapshot(
    spark: SparkSession, root: str, start: str | None = None, end: str | None = None, version: int | None = None, filled: bool = False
) -> DataFrame:
    """Bars of a date range as a version has them; only folders of those days are read."""
    days = snapshot_days(spark, root, version)
    return _scan(spark, root, days.filter(in_date_range(F.col("date"), start, end)) if start or end else days, filled)


def _written(bars: DataFrame, root: str) -> tuple[str, DataFrame]:
    """The folder that now holds the bars' days, and these days."""
    folder = uuid.uuid4().hex
    write_daily(bars, f"{root}/days/{folder}", existing="add")
    days = stored_dates(bars.sparkSession, f"{root}/days/{folder}")
    return folder, days.select("date", F.lit(folder).alias("folder"))


def write_days(bars: DataFrame, root: str) -> int:
    """Commit a version in which exactly the days of ``bars`` are replaced by them."""
    _, days = _written(bars, root)
    return update(
        bars.sparkSession, root, DAYS_SCHEMA,
        lambda now: now.join(F.broadcast(days.select("date")), "date", "left_anti").unionByName(days).coalesce(1),
    )


def purge_days(spark: SparkSession, root: str, plan: DataFrame) -> int:
    """Commit a version without the planned symbol-days; days that keep nothing are no longer listed.

    Should another writer be first, the purge is done anew on what that one has left.
    """
    planned = plan.select("date").distinct()
    for _ in range(TRIES):
        base = current_version(spark, root)
        now = read_version(spark, root, base, DAYS_SCHEMA)
        touched = now.join(planned, "date", "left_semi")
        _, kept = _written(purge_apply(_scan(spark, root, touched, filled=True), plan), root)
        rest = now.join(F.broadcast(touched.select("date")), "date", "left_anti")
        try:
            return write_next(rest.unionByName(kept).coalesce(1), root, base=base)
        except VersionConflict:
            continue
    raise VersionConflict(f"{root}: {TRIES} writers in a row were first")
