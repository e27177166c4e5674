"""Bars, damaged bars, payloads and file trees derived from the shared test tables."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.functions.symbols import fragment_name
from minutebook.functions.times import date_text, ms_of_day
from minutebook.schema import BAR_TYPES, KEY, OHLC
from minutebook.session import work_folder
from minutebook.sources.lake import write_daily

BAR_COLUMNS = list(BAR_TYPES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Folders of made tables that are stored already, by table and source; only the bench fills it.
STORED: dict[tuple, str] = {}


def _made(build):
    """Take the table from its stored copy, if there is one."""
    @wraps(build)
    def get(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
        folder = STORED.get((build.__name__, sf_dir, *sorted(options.items())))
        return spark.read.parquet(folder) if folder else build(spark, sf_dir, **options)

    return get


def store_inputs(spark: SparkSession, sf_dir: str) -> None:
    """Make and store the tables that the queries start from."""
    for build, options in ((bars, {}), (bars, {"by_user": True}), (dirty_bars, {}), (day_texts, {})):
        folder = work_folder(spark, "inputs")
        build(spark, sf_dir, **options).write.parquet(folder)
        STORED[(build.__name__, sf_dir, *sorted(options.items()))] = folder


def _event_order() -> Column:
    """(ts, event_id) as one exact fixed-width number, so first and last stay in a hash aggregate."""
    shift = F.lit("10000000000000000000").cast("decimal(20,0)")
    micros = F.unix_micros(F.col("ts").cast("timestamp")).cast("decimal(17,0)")
    return micros * shift + F.col("event_id").cast("decimal(19,0)")


def _minute() -> Column:
    return F.date_trunc("minute", F.col("ts").cast("timestamp")).cast("timestamp_ntz")


def _user_symbol() -> Column:
    """S and the user id in letters; ids ending in 6 to 9 become special securities."""
    return F.concat(F.lit("S"), F.translate(F.col("user_id").cast("string"), "0123456789", "ABCDEFUWRZ"))


def _to_bars(events: DataFrame, symbol: Column, price: str, volume: Column, *more: Column) -> DataFrame:
    order = _event_order()
    bars = events.groupBy(symbol.alias("symbol"), _minute().alias("timestamp")).agg(
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        volume.alias("volume"),
        F.count("*").alias("count"),
        F.avg(price).alias("vwap"),
        *more,
    )
    ts = F.col("timestamp")
    return bars.withColumns({"date": date_text(ts), "ms_of_day": ms_of_day(ts)})


@_made
def bars(spark: SparkSession, sf_dir: str, by_user: bool = False) -> DataFrame:
    """One-minute bars of ``events``; the symbol is the event type, or the user."""
    symbol = _user_symbol() if by_user else F.upper("event_type")
    made = _to_bars(table(spark, sf_dir, "events"), symbol, "value", F.count("*").cast("double"))
    return made.select(*BAR_COLUMNS)


@_made
def dirty_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars per user with zero prices, zero volume, NULLs, negatives and broken order."""
    kind = F.col("event_type")
    events = table(spark, sf_dir, "events").withColumns(
        {
            "px": F.when(kind == "error", 0.0).otherwise(F.col("value")),
            "vol": F.when(
                kind.isin("purchase", "click"), F.get_json_object("props", "$.k").cast("double")
            ).otherwise(0.0),
        }
    )
    made = _to_bars(events, _user_symbol(), "px", F.sum("vol"), F.min("event_id").alias("id"))
    i = F.col("id")
    low, high = F.col("low"), F.col("high")
    negated = {"open": -F.col("open") - 1, "high": -low - 1, "low": -high - 1, "close": -F.col("close") - 1}
    damaged = {}
    for c in OHLC:
        value = F.when(i % 17 == 0, F.lit(None).cast("double"))
        if c == "high":
            value = value.when(i % 11 == 0, low - 1)
        damaged[c] = value.when(i % 13 == 0, negated[c]).otherwise(F.col(c))
    return made.select("symbol", "date", "timestamp", "ms_of_day", "volume", *[damaged[c].alias(c) for c in OHLC])


def traded_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, date) pairs of the users' bars."""
    events = table(spark, sf_dir, "events")
    return events.select(_user_symbol().alias("symbol"), date_text(F.col("ts")).alias("date")).distinct()


# --- payload texts ----------------------------------------------------------------

def _money(name: str) -> Column:
    return F.col(name).cast("decimal(18,6)").cast("string")


def _record() -> Column:
    ts = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    return F.concat(
        F.lit('{"volume":'), F.col("count").cast("string"),
        F.lit(',"high":'), _money("high"), F.lit(',"low":'), _money("low"),
        F.lit(',"vwap":'), _money("vwap"), F.lit(',"count":'), F.col("count").cast("string"),
        F.lit(',"close":'), _money("close"), F.lit(',"open":'), _money("open"),
        F.lit(',"timestamp":"'), ts, F.lit('"}'),
    )


def _csv_line() -> Column:
    ts = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    return F.concat_ws(
        ",", ts, *[_money(c) for c in OHLC], F.col("count").cast("string"), F.col("count").cast("string"), _money("vwap")
    )


@_made
def day_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per symbol-day the JSON records and CSV lines in time order (at most one per minute), and a rule number."""
    rows = bars(spark, sf_dir).select(*KEY, "timestamp", _record().alias("record"), _csv_line().alias("line"))
    days = rows.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("timestamp", "record", "line"))).alias("r"))
    return days.select(
        *KEY,
        F.transform("r", lambda x: x["record"]).alias("records"),
        F.transform("r", lambda x: x["line"]).alias("lines"),
        F.substring("date", 7, 2).cast("int").alias("day"),
        (F.substring("date", 7, 2).cast("int") + F.length("symbol")).alias("rule"),
    )


def json_text() -> Column:
    return F.concat(F.lit("["), F.array_join("records", ","), F.lit("]"))


def wrapped_text() -> Column:
    return F.concat(F.lit('{"data":'), json_text(), F.lit("}"))


def csv_text() -> Column:
    header = F.lit("timestamp,open,high,low,close,volume,count,vwap\n")
    return F.concat(header, F.array_join("lines", "\n"), F.lit("\n"))


def damaged_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON payloads, five in six of them damaged or wrapped."""
    text = json_text()
    rule = F.col("rule") % 6
    length = F.length(text)
    return day_texts(spark, sf_dir).select(
        *KEY,
        F.when(rule == 1, F.substring(text, F.lit(1), length - 1))
        .when(rule == 2, F.substring(text, F.lit(1), length - 20))
        .when(rule == 3, F.regexp_replace(text, r"^([^}]*\}),\{", "$1 {"))
        .when(rule == 4, F.concat(F.substring(text, F.lit(1), length - 1), F.lit(",]")))
        .when(rule == 5, wrapped_text())
        .otherwise(text)
        .alias("payload"),
    )


def partly_negative(payloads: DataFrame) -> DataFrame:
    """The same payloads; on every fifth day of a month all prices are negative, which the gate rejects."""
    turned = F.regexp_replace("payload", r'"(open|high|low|close)":', '"$1":-')
    bad = F.substring("date", 7, 2).cast("int") % 5 == 3
    return payloads.withColumn("payload", F.when(bad, turned).otherwise(F.col("payload")))


def mixed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of every kind: intact, wrapped, single object, CSV, error, empty shapes, plain text."""
    rule = F.col("rule") % 11
    return day_texts(spark, sf_dir).select(
        *KEY,
        "rule",
        F.when(rule == 0, json_text())
        .when(rule == 1, wrapped_text())
        .when(rule == 2, F.get("records", F.lit(0)))
        .when(rule == 3, csv_text())
        .when(rule == 4, F.concat(F.lit('{"error":{"code":472,"message":"no data for '), F.col("symbol"), F.lit('"}}')))
        .when(rule == 5, F.lit('{"error":"session closed"}'))
        .when(rule == 6, F.when(F.col("day") % 2 == 0, "[]").otherwise("[" + " " * 20 + "]"))
        .when(rule == 7, F.lit(" \n\t"))
        .when(rule == 8, F.lit("timestamp,open,high,low,close,volume\n"))
        .when(rule == 9, F.lit("service restarted"))
        .alias("payload"),
    )


# --- stored tables ----------------------------------------------------------------

def stored_lake(spark: SparkSession, made: DataFrame) -> str:
    root = work_folder(spark, "lake")
    write_daily(made, root)
    return root


def write_named_fragments(made: DataFrame, root: str, narrow: bool = False, junk: int = 0, flat: bool = False) -> None:
    """Write each symbol-day as YYYY/MM/SYMBOL_YYYYMMDD.parquet, or ``flat`` without the folders, as an older collector would.

    Every seventh day (by ``junk``, the remainder of the day of the month) is junk and the day after it an empty file; even days keep ``volume``
    as integers and odd days have no ``count``. ``narrow`` drops ``volume`` two days after the junk, ``high`` and
    ``low`` three days after it.
    """
    def write(day):
        import pyarrow as pa
        from pyarrow import fs, parquet

        name, number = day["name"].iloc[0], int(day["date"].iloc[0][6:])
        plain = root.removeprefix("file://").removeprefix("file:")
        system, base = fs.FileSystem.from_uri(root) if "://" in plain else (fs.LocalFileSystem(), plain)
        path = f"{base}/{name}"
        system.create_dir(path.rsplit("/", 1)[0])
        frame = day.drop(columns=["name"]).sort_values("timestamp")
        if number % 2 == 0:
            frame["volume"] = frame["volume"].astype("int64")
        else:
            frame = frame.drop(columns=["count"])
        if (number - junk) % 7 == 1:
            frame = frame.iloc[:0]
        if narrow:
            frame = frame.drop(columns={2: ["volume"], 3: ["high", "low"]}.get((number - junk) % 7, []))
        with system.open_output_stream(path) as out:
            if (number - junk) % 7 == 0:
                out.write(b"not a parquet file")
            else:
                parquet.write_table(pa.Table.from_pandas(frame, preserve_index=False), out)
        return day[["name"]].iloc[:1]

    name = fragment_name(F.col("symbol"), F.col("date"))
    named = made.withColumn("name", F.substring_index(name, "/", -1) if flat else name)
    named.groupBy("symbol", "date").applyInPandas(write, "name string").write.format("noop").mode("overwrite").save()


def fragment_tree(spark: SparkSession, sf_dir: str, narrow: bool = False, junk: int = 0, flat: bool = False) -> str:
    root = work_folder(spark, "fragments")
    write_named_fragments(bars(spark, sf_dir), root, narrow, junk, flat)
    return root


def day_file_tree(spark: SparkSession, sf_dir: str) -> str:
    """Each day as one file YYYY/MM/YYYYMMDD.parquet, as an older collector would."""
    root = work_folder(spark, "day-files")

    def write(day):
        import pyarrow as pa
        from pyarrow import fs, parquet

        date = day["date"].iloc[0]
        plain = root.removeprefix("file://").removeprefix("file:")
        system, base = fs.FileSystem.from_uri(root) if "://" in plain else (fs.LocalFileSystem(), plain)
        system.create_dir(f"{base}/{date[:4]}/{date[4:6]}")
        with system.open_output_stream(f"{base}/{date[:4]}/{date[4:6]}/{date}.parquet") as out:
            parquet.write_table(pa.Table.from_pandas(day.sort_values(["symbol", "timestamp"]), preserve_index=False), out)
        return day[["date"]].iloc[:1]

    bars(spark, sf_dir).groupBy("date").applyInPandas(write, "date string").write.format("noop").mode("overwrite").save()
    return root
