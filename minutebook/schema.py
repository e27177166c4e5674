"""Table layouts and the values that fix their meaning."""

from __future__ import annotations

from pyspark.sql import types as T

OHLC = ["open", "high", "low", "close"]
KEY = ["symbol", "date"]

# One trading session is 04:00 to 20:00 inclusive, one bar a minute.
SESSION_START_MINUTE = 4 * 60
SESSION_BARS = 961

BAR_REQUIRED = ["date", "symbol", "timestamp", "ms_of_day", *OHLC, "volume"]
BAR_OPTIONAL = ["count", "vwap"]

BAR_TYPES = {
    "date": T.StringType(),
    "symbol": T.StringType(),
    "timestamp": T.TimestampNTZType(),
    "ms_of_day": T.LongType(),
    "open": T.DoubleType(),
    "high": T.DoubleType(),
    "low": T.DoubleType(),
    "close": T.DoubleType(),
    "volume": T.DoubleType(),
    "count": T.LongType(),
    "vwap": T.DoubleType(),
}

BAR_SCHEMA = T.StructType([T.StructField(n, t) for n, t in BAR_TYPES.items()])

# The stored daily table adds which rows were filled in (NULL in tables of older builds) and its two outer partition columns.
LAKE_SCHEMA = T.StructType(
    [*BAR_SCHEMA.fields, T.StructField("is_filled", T.BooleanType()), T.StructField("year", T.StringType()), T.StructField("month", T.StringType())]
)

PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("payload", T.StringType()),
    ]
)

INDEX_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("symbol_count", T.LongType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("file_size_mb", T.DoubleType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

REJECT_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)
