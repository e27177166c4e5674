"""File listings and path checks, through the cluster's own file system.

Where Arrow can open a store, its folders are dealt to tasks that list them, and file names never come together on the driver: it sees the
folders of the first two levels only (in a dated tree, years and months). Other stores are listed by Spark's own file index.
"""

from __future__ import annotations

from collections.abc import Iterator
from fnmatch import fnmatchcase

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.functions.guards import megabytes
from minutebook.functions.symbols import date_of_file, file_name, symbol_of_file

INVENTORY_SCHEMA = "path string, length long"
# How a path's scheme is called by Arrow, for the stores it can open.
ARROW_SCHEMES = {"": "", "file": "", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "abfs": "abfs", "abfss": "abfss"}
LISTED_AT_ONCE = 4_096  # files in a batch


def scheme_of(path: str) -> str:
    return path.split(":", 1)[0] if ":" in path.split("/", 1)[0] else ""


def arrow_place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and what it calls the path."""
    scheme = scheme_of(path)
    if ARROW_SCHEMES[scheme]:
        return fs.FileSystem.from_uri(ARROW_SCHEMES[scheme] + path.removeprefix(scheme))
    return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as tasks can open it wherever they run."""
    file_system, place = _file_system(spark, path)
    return file_system.makeQualified(place).toString().rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def matching_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders for a glob pattern, e.g. the day folders of a lake (one name per day)."""
    fs, p = _file_system(spark, pattern)
    found = fs.globStatus(p)
    return sorted(f.getPath().toString() for f in found or [] if f.isDirectory())


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def arrow_opens(spark: SparkSession, root: str) -> bool:
    """Whether tasks can open what lies below a folder by themselves."""
    if scheme_of(root) not in ARROW_SCHEMES:
        return False
    return scheme_of(_file_system(spark, root)[0].getUri().toString()) in ARROW_SCHEMES


def _folders(spark: SparkSession, root: str, recursive: bool) -> list[tuple[str, bool]]:
    """Folders to list, and whether all below them belongs to the listing: the root, its folders, and theirs."""
    file_system, place = _file_system(spark, root)
    place = file_system.makeQualified(place)

    def below(folder) -> list:
        return [f.getPath() for f in file_system.listStatus(folder) if f.isDirectory() and f.getPath().getName()[0] not in "_."]

    found = [(place.toString(), False)]
    for first in below(place) if recursive else ():
        found.append((first.toString(), False))
        found += [(second.toString(), True) for second in below(first)]
    return found


def _shown(name: str) -> bool:
    return not name.startswith(("_", "."))


def _list_folders(pattern: str):
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder, deep in zip(batch.column("folder").to_pylist(), batch.column("deep").to_pylist(), strict=True):
                system, place = arrow_place(folder)
                start = folder.removesuffix("/")
                paths, sizes = [], []
                for info in system.get_file_info(fs.FileSelector(place, recursive=deep)):
                    inner = info.path[len(place.rstrip("/")):].strip("/")
                    if info.type == fs.FileType.File and fnmatchcase(info.base_name, pattern) and all(map(_shown, inner.split("/"))):
                        paths.append(f"{start}/{inner}")
                        sizes.append(info.size)
                for at in range(0, len(paths), LISTED_AT_ONCE):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(paths[at:at + LISTED_AT_ONCE], pa.string()), pa.array(sizes[at:at + LISTED_AT_ONCE], pa.int64())], ["path", "length"]
                    )

    return listed


def file_inventory(spark: SparkSession, root: str, recursive: bool = True, pattern: str = "*.parquet") -> DataFrame:
    """(path, length) of the files below a folder; contents are not read. Names that begin with ``_`` or ``.`` are left out."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], INVENTORY_SCHEMA)
    if arrow_opens(spark, root):
        folders = _folders(spark, root, recursive)
        dealt = spark.createDataFrame(folders, "folder string, deep boolean").repartition(min(len(folders), 10_000))
        return dealt.mapInArrow(_list_folders(pattern), INVENTORY_SCHEMA)
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(root).select("path", "length")


def with_names(files: DataFrame) -> DataFrame:
    """Add file name, symbol and date as its name tells them, and MB."""
    name = file_name(F.col("path"))
    return files.withColumns(
        {
            "name": name,
            "symbol": symbol_of_file(name),
            "date": date_of_file(name),
            "size_mb": megabytes(F.col("length")),
        }
    )


def inventory_totals(files: DataFrame) -> DataFrame:
    return files.agg(
        F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("bytes")
    )
