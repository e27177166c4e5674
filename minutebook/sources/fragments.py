"""Symbol-day fragment files: any layout, unreadable and empty files.

A listing opens each file by seek and reads its footer alone: rows, columns and physical layout. Files of one layout are then read together by
Spark's own reader under that layout's schema, so pages are decoded by the JVM, and only what Spark cannot read (a layout
of its own kind, a file whose pages turn out damaged) goes through Python, one file at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import parquet
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from minutebook.functions.guards import nan_to_null
from minutebook.functions.symbols import date_of_file, symbol_of_file
from minutebook.functions.times import date_text, in_date_range, ms_of_day
from minutebook.schema import BAR_OPTIONAL, BAR_REQUIRED, BAR_SCHEMA, BAR_TYPES
from minutebook.session import work_folder
from minutebook.sources.files import arrow_opens, arrow_place, file_inventory, path_exists

FRAGMENT_GLOB = "*_*.parquet"
FILES_SCHEMA = (
    "path string, length long, symbol string, date string, rows long, columns string, layout string, error string"
)
ARROW_TYPES = {
    "timestamp": pa.timestamp("us"), "date": pa.string(), "symbol": pa.string(), "ms_of_day": pa.int64(), "count": pa.int64(),
}
MAGIC = b"PAR1"
PLAIN_TYPES = {"INT32", "INT64", "INT96", "FLOAT", "DOUBLE"}
MOST_LAYOUTS = 64  # read by Spark in one go; the files of rarer ones go through Python


# --- footers ----------------------------------------------------------------------

def _opened(path: str) -> pa.NativeFile:
    system, place = arrow_place(path)
    return system.open_input_file(place)


def _footer(file: pa.NativeFile) -> parquet.FileMetaData:
    """The metadata of a Parquet file, by two reads from its end."""
    size = file.size()
    if size < 12:
        raise ValueError(f"Not a Parquet file: {size} bytes")
    tail = file.read_at(8, size - 8)
    length = int.from_bytes(tail[:4], "little")
    if tail[4:] != MAGIC or length > size - 12:
        raise ValueError("Not a Parquet file: no footer at its end")
    return parquet.read_metadata(pa.BufferReader(MAGIC + file.read_at(length, size - 8 - length) + tail))


def _layout(metadata: parquet.FileMetaData) -> str | None:
    """Names and physical types of the bar columns; NULL if Spark's reader cannot be given them."""
    found: dict[str, str] = {}
    for k in range(metadata.num_columns):
        column = metadata.schema.column(k)
        name = column.path.lower()
        if name not in BAR_TYPES:
            continue
        logical = str(column.logical_type)
        text = column.physical_type == "BYTE_ARRAY" and logical == "String" and name in ("date", "symbol")
        plain = column.physical_type in PLAIN_TYPES and not logical.startswith(("Time(", "Decimal"))
        if name in found or column.max_repetition_level or not (text or plain):
            return None
        found[name] = f"{column.name}:{column.physical_type}:{logical}"
    return ",".join(found[n] for n in sorted(found))


def _described(file: pa.NativeFile) -> tuple:
    """rows, columns, layout and error of a file that could be opened."""
    try:
        metadata = _footer(file)
        columns = ",".join(sorted(f"{f.name}:{f.type}" for f in metadata.schema.to_arrow_schema()))
        return metadata.num_rows, columns, _layout(metadata), None
    except (pa.ArrowException, ValueError) as e:  # an unreadable file becomes a row; a store that fails ends the job
        return None, None, None, str(e).split("\n")[0]


def _listed(batch: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
    kept = [batch.column(c) for c in ("path", "length", "symbol", "date")]
    rows, columns, layout, error = zip(*found, strict=True) if found else ((), (), (), ())
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string()]
    made = [pa.array(v, k) for v, k in zip((rows, columns, layout, error), kinds, strict=True)]
    return pa.RecordBatch.from_arrays([*kept, *made], ["path", "length", "symbol", "date", "rows", "columns", "layout", "error"])


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for path in batch.column("path").to_pylist():
            with _opened(path) as file:
                found.append(_described(file))
        yield _listed(batch, found)


def _footers_of_contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _listed(batch, [_described(pa.BufferReader(content.as_py())) for content in batch.column("content")])


def _named(files: DataFrame, keep: Column | None) -> DataFrame:
    name = F.element_at(F.split("path", "/"), -1)
    named = files.withColumns({"symbol": symbol_of_file(name), "date": date_of_file(name)})
    return named if keep is None else named.filter(keep)


def file_footers(spark: SparkSession, root: str, keep: Column | None = None, pattern: str = FRAGMENT_GLOB) -> DataFrame:
    """A row per file below a folder: rows, column types and layout by its footer, or why it has none. No page is read.

    ``keep`` is a condition on the file name's ``symbol`` and ``date``; it leaves files out before they are opened.
    """
    if not path_exists(spark, root):
        return spark.createDataFrame([], FILES_SCHEMA)
    if arrow_opens(spark, root):
        files = _named(file_inventory(spark, root, pattern=pattern), keep)
        # a folder of many files is listed by one task and opened by many
        return files.select("path", "length", "symbol", "date").repartition("path").mapInArrow(_footers, FILES_SCHEMA)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return _named(files, keep).select("path", "length", "symbol", "date", "content").mapInArrow(_footers_of_contents, FILES_SCHEMA)


# --- files that only Python reads -------------------------------------------------

def _bar_column(table: pa.Table, name: str) -> pa.ChunkedArray:
    """A column in its bar type, whatever number type the file was written with; NULL if absent."""
    found = {c.lower(): c for c in table.column_names}
    kind = ARROW_TYPES.get(name, pa.float64())
    if name not in found:
        return pa.chunked_array([pa.nulls(len(table), kind)])
    column = table[found[name]]
    if pa.types.is_floating(column.type):
        column = pc.if_else(pc.is_nan(column), pa.scalar(None, column.type), column)
    if name == "timestamp" and pa.types.is_integer(column.type):  # nanoseconds since the epoch
        column = column.cast(pa.timestamp("ns"))
    return column.cast(kind, safe=False)


def _read_bars(content: bytes) -> pa.Table:
    """All bars of one file in the bar layout."""
    table = parquet.read_table(pa.BufferReader(content))
    return pa.table({c: _bar_column(table, c) for c in BAR_TYPES})


def _tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """path and the reason why a file cannot be read, NULL if it can."""
    for batch in batches:
        errors = []
        for content in batch.column("content"):
            try:
                _read_bars(content.as_py())
                errors.append(None)
            except Exception as e:  # whatever the reader says of damaged bytes
                errors.append(str(e).split("\n")[0])
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(errors, pa.string())], ["path", "words"])


def _bars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            bars = _read_bars(content.as_py())
            bars = bars.append_column("path", pa.array([path.as_py()] * len(bars), pa.string()))
            yield from bars.combine_chunks().to_batches()


# --- files by layout --------------------------------------------------------------

def _unquoted(uri: Column) -> Column:
    """A path of ``_metadata``, which is encoded as a URI, as other listings have it."""
    return F.try_url_decode(F.regexp_replace(uri, r"\+", "%2B"))


def _place(path: Column) -> Column:
    """A path in one spelling: some listings have an empty authority."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def _plain(path: Column) -> Column:
    """A path whose signs mean nothing to a file listing."""
    return F.regexp_replace(path, r"([*?\[\]{}\\])", r"\\$1")


def _load(spark: SparkSession, paths: DataFrame, kind: str, schema: StructType | None = None, **options: str) -> DataFrame:
    """A reader over exactly the files listed in ``path``. The list goes from job to reader inside the JVM."""
    reader = spark.read.format(kind).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    listed = getattr(paths.select(_plain(F.col("path")))._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING()).collectAsList()
    return DataFrame(reader._jreader.load(spark._jvm.PythonUtils.toSeq(listed)), spark)


def _layouts(files: DataFrame) -> list[tuple[str, StructType]]:
    """The layouts of the listed files, the most frequent ones first, with the schema that Spark has for each."""
    spark = files.sparkSession
    found = files.filter("error is null and rows > 0 and layout <> ''").groupBy("layout").agg(F.count("*").alias("n"), F.min(_plain(F.col("path"))).alias("path"))
    named = []
    for row in found.orderBy(F.desc("n"), "layout").limit(MOST_LAYOUTS).collect():
        whole = spark.read.parquet(row["path"]).schema
        named.append((row["layout"], StructType([f for f in whole.fields if f.name.lower() in BAR_TYPES])))
    return named


def _of_layout(files: DataFrame, layout: str) -> DataFrame:
    return files.filter((F.col("layout") == layout) & F.col("error").isNull() & (F.col("rows") > 0))


def _decoded_rows(files: DataFrame, layouts: list[tuple[str, StructType]]) -> DataFrame:
    """``place`` and how many rows Spark gets out of each file, all their columns decoded; a file stops where its pages are damaged."""
    counts = [files.sparkSession.createDataFrame([], "place string, decoded long")]
    for layout, schema in layouts:
        rows = _load(files.sparkSession, _of_layout(files, layout), "parquet", schema, ignoreCorruptFiles="true")
        whole = F.xxhash64(*[F.col(f"`{f.name}`") for f in schema.fields])
        counts.append(rows.groupBy(F.col("_metadata.file_path").alias("place")).agg(
            F.count("*").alias("decoded"), F.bit_xor(whole).alias("seen")
        ).filter(F.col("seen").isNotNull()).drop("seen"))  # asked for, so that no column is left out
    return reduce(DataFrame.unionByName, counts)


def _kept(df: DataFrame, label: str) -> DataFrame:
    folder = work_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def checked_files(footers: DataFrame) -> DataFrame:
    """The listing, stored, where files whose pages do not decode have an error too.

    Spark decodes each file once. Those that gave it fewer rows than their footer has, and layouts it is not given, are tried in
    Python: they end with an error, or without a layout if Python can read them.
    """
    spark = footers.sparkSession
    files = _kept(footers, "footers")
    decoded = _decoded_rows(files, _layouts(files)).select(_place(_unquoted(F.col("place"))).alias("place"), "decoded")
    files = files.withColumn("place", _place(F.col("path"))).join(decoded, "place", "left").drop("place")
    unsure = F.col("error").isNull() & (F.col("rows") > 0) & (F.coalesce("decoded", F.lit(-1)) != F.col("rows"))
    files = _kept(files.withColumn("unsure", unsure).drop("decoded"), "decoded")
    suspects = files.filter("unsure")
    if not suspects.take(1):
        return files.drop("unsure")
    tried = _load(spark, suspects, "binaryFile").select("path", "content").mapInArrow(_tried, "path string, words string")
    judged = files.join(tried, "path", "left").withColumns({
        "layout": F.when(~F.col("unsure"), F.col("layout")), "error": F.coalesce("error", "words"),
        "rows": F.when(F.col("words").isNull(), F.col("rows")),
    })
    return _kept(judged.select(*[f.strip().split()[0] for f in FILES_SCHEMA.split(",")]), "files")


def fragment_footers(spark: SparkSession, root: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """One row per SYMBOL_YYYYMMDD.parquet as its footer tells it. Files outside the date range are left out by name."""
    keep = F.col("symbol").isNotNull() & in_date_range(F.col("date"), start, end)
    return file_footers(spark, root, keep)


def fragment_files(
    spark: SparkSession, root: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """One row per SYMBOL_YYYYMMDD.parquet: row count and column types, or why it cannot be read.

    Files outside the date range are left out by name. A file counts as readable only if all its pages decode.
    """
    return checked_files(fragment_footers(spark, root, start, end))


def read_errors(files: DataFrame) -> DataFrame:
    """Fragments that do not open, as issue rows; valid files without rows are not among them."""
    return files.filter(F.col("error").isNotNull()).select(
        F.col("path").alias("file"), "symbol", "date",
        F.lit("read_errors").alias("issue_type"), F.col("error").alias("details"),
        F.lit(False).alias("is_special"), F.lit(False).alias("routed_special"),
    )


def empty_files(files: DataFrame) -> DataFrame:
    return files.filter(F.col("rows") == 0)


def _to_bar_column(df: DataFrame, name: str) -> Column:
    found = {c.lower(): c for c in df.columns}
    if name not in found:
        return F.lit(None).cast(BAR_TYPES[name])
    col, kind = F.col(f"`{found[name]}`"), df.schema[found[name]].dataType.typeName()
    if name == "timestamp" and kind == "long":  # nanoseconds since the epoch
        return F.timestamp_micros(F.floor(col / F.lit(1000)).cast("long")).cast("timestamp_ntz")
    if kind in ("double", "float"):
        col = nan_to_null(col)
    return col.cast(BAR_TYPES[name])


def conform(df: DataFrame, *more: str) -> DataFrame:
    """Cast a stored layout to the bar schema; keys missing in a row come from its timestamp. ``more`` columns stay as they are."""
    bars = df.select(*[_to_bar_column(df, c).alias(c) for c in BAR_TYPES], *more)
    ts = F.col("timestamp")
    keyed = {"ms_of_day": F.coalesce("ms_of_day", ms_of_day(ts)), "date": F.coalesce("date", date_text(ts))}
    return bars.withColumns(keyed).select(*BAR_TYPES, *more)


def scan_fragments(spark: SparkSession, root: str, files: DataFrame | None = None) -> DataFrame:
    """All bars of a fragment tree, whatever columns and numeric types each file was written with.

    ``files`` is a listing by ``fragment_files``, or part of one; without it the whole tree is listed. Each layout is
    brought to the bar layout by itself, so no file's layout bears on another's; keys missing in a row come from the file name.
    Files that cannot be read give no bars here and a row in ``read_errors``.
    """
    return bars_of_files(fragment_files(spark, root) if files is None else files).drop("path")


def scan_day_files(spark: SparkSession, root: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The bars of a date range from whole-day files YYYY/MM/YYYYMMDD.parquet; only files of those days are opened.

    A file that cannot be read ends the scan.
    """
    keep = F.col("symbol").isNull() & in_date_range(F.col("date"), start, end)
    files = _kept(file_footers(spark, root, keep, "[0-9]*.parquet"), "footers")
    broken = files.filter("error is not null").take(1)
    if broken:
        raise ValueError(f"{broken[0]['path']}: {broken[0]['error']}")
    return bars_of_files(files).drop("path")


def bars_of_files(files: DataFrame) -> DataFrame:
    """The bars of the readable files of a listing, with the ``path`` they come from."""
    spark = files.sparkSession
    layouts = _layouts(files)
    parts = [spark.createDataFrame([], StructType(BAR_SCHEMA.fields)).withColumn("path", F.lit(""))]
    for layout, schema in layouts:
        rows = _load(spark, _of_layout(files, layout), "parquet", schema)
        place = _unquoted(F.col("_metadata.file_path")).alias("path")
        parts.append(conform(rows.select("*", place), "path"))
    others = files.filter("error is null and rows > 0").filter(F.coalesce(~F.col("layout").isin([n for n, _ in layouts]), F.lit(True)))
    if others.take(1):
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BAR_SCHEMA.fields)
        rows = _load(spark, others, "binaryFile").select("path", "content").mapInArrow(_bars, f"{kinds}, path string")
        parts.append(conform(rows, "path"))
    bars = reduce(DataFrame.unionByName, parts[1:] or parts)
    name = F.element_at(F.split("path", "/"), -1)
    return bars.withColumn("symbol", F.coalesce("symbol", symbol_of_file(name)))


def checked_columns(bars: DataFrame) -> list[str]:
    """Columns of the stored layout in order; raises if a required one is absent."""
    missing = [c for c in BAR_REQUIRED if c not in bars.columns]
    if missing:
        raise ValueError("Missing columns: " + ", ".join(missing))
    return BAR_REQUIRED + [c for c in BAR_OPTIONAL if c in bars.columns]
