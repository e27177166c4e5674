"""Reorganisation of a dump as a move of whole files, bytes unchanged.

Files are copied by tasks, each to a hidden name that is renamed when all its bytes are there, so a reader of the target sees whole files only. The
outcome of every file is written down before any source is removed, and sources go by that manifest. A run that ended early, a task that
was tried twice or a whole run that is repeated leaves the same folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.plans.maintain import organize_plan
from minutebook.session import work_folder
from minutebook.sources.files import arrow_opens, arrow_place, file_inventory, qualified

MANIFEST_SCHEMA = "path string, action string, target string, outcome string, bytes long, error string"
CHUNK = 8 << 20
FILES_A_TASK = 256
GONE = ("moved", "already_there", "dropped")


def _size(system: fs.FileSystem, place: str) -> int | None:
    info = system.get_file_info(place)
    if info.type == fs.FileType.NotFound:
        return None
    if info.type != fs.FileType.File:
        raise IsADirectoryError(place)
    return info.size


def _same(one: tuple[fs.FileSystem, str], other: tuple[fs.FileSystem, str]) -> bool:
    """Whether two files of one size hold the same bytes."""
    with one[0].open_input_stream(one[1]) as left, other[0].open_input_stream(other[1]) as right:
        while True:
            # streams fill a read unless they end, so equal sizes keep both in step
            a, b = left.read(CHUNK), right.read(CHUNK)
            if a != b:
                return False
            if not a:
                return True


def _copy(source: tuple[fs.FileSystem, str], target: tuple[fs.FileSystem, str], size: int) -> None:
    system, place = target
    folder, name = place.rsplit("/", 1)
    hidden = f"{folder}/.{name}.{uuid.uuid4().hex}"
    system.create_dir(folder)
    try:
        with source[0].open_input_stream(source[1]) as data, system.open_output_stream(hidden) as out:
            while chunk := data.read(CHUNK):
                out.write(chunk)
        if _size(system, hidden) != size:
            raise OSError(f"copied {_size(system, hidden)} of {size} bytes")
        system.move(hidden, place)
    except BaseException:
        if system.get_file_info(hidden).type == fs.FileType.File:
            system.delete_file(hidden)
        raise


def _move(path: str, target: str) -> tuple[str, int | None]:
    source, place = arrow_place(path), arrow_place(target)
    size, there = _size(*source), _size(*place)
    if size is None:
        if there is None:
            raise FileNotFoundError(path)
        return "already_there", there
    if there is None:
        _copy(source, place, size)
        return "moved", size
    if there == size and _same(source, place):
        return "already_there", size
    return "target_differs", size


def _remove(path: str) -> None:
    system, place = arrow_place(path)
    if _size(system, place) is not None:
        system.delete_file(place)


def _outcome(path: str, action: str, target: str | None) -> tuple[str, int | None, str | None]:
    """What became of a file, its bytes, and what went wrong; one file's failure is no other's."""
    try:
        if action == "move":
            return (*_move(path, target), None)
        return {"drop_non_trading": "dropped"}.get(action, action), None, None
    except OSError as failure:  # Arrow's errors of files are among them
        return "failed", None, f"{type(failure).__name__}: {failure}"


def _mover(root: str):
    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, FILES_A_TASK):
                rows = batch.slice(at, FILES_A_TASK).to_pylist()
                found = [_outcome(r["path"], r["action"], r["target"] and f"{root}/{r['target']}") for r in rows]
                columns = [[r[c] for r in rows] for c in ("path", "action", "target")] + [list(c) for c in zip(*found, strict=True)]
                kinds = [pa.string()] * 4 + [pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["path", "action", "target", "outcome", "bytes", "error"]
                )

    return move


def _remover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        failures = []
        for path in batch.column("path").to_pylist():
            try:
                _remove(path)
            except OSError as failure:
                failures.append((path, f"{type(failure).__name__}: {failure}"))
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in failures], pa.string()) for i in (0, 1)], ["path", "kept"])


def _dealt(rows: DataFrame) -> DataFrame:
    """The rows of a stored table, so many files to a task."""
    return rows.repartition(max(1, min(100_000, -(-rows.count() // FILES_A_TASK))))


def _stored(rows: DataFrame, label: str) -> DataFrame:
    folder = work_folder(rows.sparkSession, label)
    rows.write.parquet(folder)
    return rows.sparkSession.read.parquet(folder)


def _one_per_target(plan: DataFrame) -> DataFrame:
    """Of files that want one place the first path gets it; the others are ``skip_exists``. Only those that move count."""
    first = plan.filter("action = 'move'").groupBy("target").agg(F.min("path").alias("path")).select("path", F.lit(True).alias("_first"))
    late = (F.col("action") == "move") & F.col("_first").isNull()
    return plan.join(first, "path", "left").withColumn("action", F.when(late, "skip_exists").otherwise(F.col("action"))).drop("_first")


def relocate_files(spark: SparkSession, plan: DataFrame, target_root: str, remove: bool = False) -> DataFrame:
    """Carry out a plan of ``organize_plan``: (path, action, target) to the manifest, which is returned as stored.

    Outcomes: ``moved``; ``already_there``, when the target has the same bytes, or the source is gone and the target stands; ``target_differs``,
    when it has others, which stay; ``dropped``; ``failed``, with the error; for any other file its action. With ``remove`` the sources of
    the first two and of ``dropped`` are deleted when the manifest is stored; one that cannot be is ``failed``, too. A path NULL or repeated is
    one the plan must not have; an empty plan gives an empty manifest. Stores that Arrow cannot open are an error.
    """
    if not arrow_opens(spark, target_root):
        raise ValueError(f"files cannot be moved in {target_root}")
    plan = _stored(_one_per_target(plan.select("path", "action", "target")), "plan")
    manifest = _stored(_dealt(plan).mapInArrow(_mover(qualified(spark, target_root)), MANIFEST_SCHEMA), "manifest")
    if not remove:
        return manifest
    gone = _dealt(manifest.filter(F.col("outcome").isin(*GONE)).select("path"))
    kept = gone.mapInArrow(_remover, "path string, kept string")
    settled = manifest.join(kept, "path", "left").select(
        "path", "action", "target", F.when(F.col("kept").isNotNull(), "failed").otherwise(F.col("outcome")).alias("outcome"),
        "bytes", F.coalesce("kept", "error").alias("error"),
    )
    return _stored(settled, "manifest")


def organize_files(spark: SparkSession, source_root: str, target_root: str | None = None, remove: bool = True, **calendar) -> DataFrame:
    """Sort the files of a flat dump into YYYY/MM folders, of the same root unless another is given; returns the manifest.

    Only what lies directly in the dump is taken; files of non-trading days are deleted with ``remove``.
    """
    plan = organize_plan(file_inventory(spark, source_root, recursive=False), **calendar)
    return relocate_files(spark, plan, target_root or source_root, remove)


def relocation_totals(manifest: DataFrame) -> DataFrame:
    """One row of counters over a manifest."""
    outcome = F.col("outcome")
    return manifest.agg(
        F.count("*").alias("files_found"),
        F.count_if(outcome == "moved").alias("files_moved"),
        F.count_if(outcome == "dropped").alias("files_deleted_non_trading"),
        F.count_if(outcome.isin("skip_invalid", "skip_exists", "target_differs")).alias("files_skipped"),
        F.count_if(outcome.isin("already_organised", "already_there")).alias("files_already_organised"),
        F.count_if(outcome == "failed").alias("errors"),
        F.coalesce(F.sum(F.when(outcome == "moved", F.col("bytes"))), F.lit(0)).alias("bytes_moved"),
    )
