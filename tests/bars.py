"""Small bar tables."""

import datetime as dt

SCHEMA = "symbol string, date string, timestamp timestamp_ntz, open double, high double, low double, close double, volume double"


def bar(symbol, when, o, h=None, l=None, c=None, v=1.0):
    """A bar; high, low and close default to the open."""
    ts = dt.datetime.fromisoformat(when)
    return (symbol, ts.strftime("%Y%m%d"), ts, o, o if h is None else h, o if l is None else l, o if c is None else c, v)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)
