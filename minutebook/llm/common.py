"""Helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.session import prepare, work_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Texts are long, and an Arrow batch is in memory as a whole.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1024", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def ready(spark: SparkSession) -> SparkSession:
    """The session, set up for batches of long texts."""
    for name, value in BATCHES.items():
        spark.conf.set(name, value)
    return prepare(spark)


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once into the shared work folder and read back.

    Later steps then start from files that survive a lost executor.
    """
    folder = work_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def discard(*frames: DataFrame | None) -> None:
    """Delete what ``staged`` has written for these frames, once nothing that is still to run reads them."""
    for frame in frames:
        files = frame.inputFiles() if frame is not None else []
        if files:
            jvm = frame.sparkSession._jvm
            folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the third that no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def bounded_sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` of the rows, picked by a hash of the key, so the same rows each time.

    Rows are counted first and thinned by their hash; only about as many as asked for are then ordered.
    """
    total = rows.count()
    order = F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30))
    if total > most:
        rows = rows.where(order < int((1 << 30) * min(1.0, 1.2 * most / total + 100 / total)))
    return rows.orderBy(order, key).limit(most)


def keep_rows(docs: DataFrame, decide: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """The rows, with all their columns, for whose texts ``decide`` answers true. It gets and gives whole batches."""
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(decide(batch.column("text"))))

    return docs.mapInArrow(kept, docs.schema)
