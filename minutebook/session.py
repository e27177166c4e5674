"""Session settings and shared working folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# SQL settings the operators rely on; all can be changed on a running session.
SETTINGS = {
    # files written by pandas carry nanosecond timestamps
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    # wall-clock timestamps are compared and truncated without a zone shift
    "spark.sql.session.timeZone": "UTC",
    # whole files and payloads travel in Arrow batches, which must stay small
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # partition folders such as date=20240102 stay text
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session and return it."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder for intermediate tables.

    It lies under the shared folder the cluster names in ``spark.checkpoint.dir`` or has set as its checkpoint folder. Only a
    session on one machine may go without: there a temporary folder is made. A cluster without a shared folder is an error,
    as what one executor writes to its own disk is lost to the others.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("no shared work folder: set spark.checkpoint.dir")
        base = tempfile.mkdtemp(prefix="minutebook-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
