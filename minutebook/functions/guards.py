"""NULL rules, group tests and small arithmetic used by every operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIE_BITS = 26
DAY_MICROS = 86_400_000_000


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def nan_to_null(col: Column) -> Column:
    """Spark calls NaN equal to itself and larger than any number; bars use NULL only."""
    return F.when(~F.isnan(col), col)


def clean_numbers(bars: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column."""
    floats = [f.name for f in bars.schema.fields if f.dataType.typeName() in ("double", "float")]
    return bars.withColumns({c: nan_to_null(F.col(c)) for c in floats})


def every(pred: Column) -> Column:
    """All rows of the group satisfy the predicate; an unknown row does not."""
    return F.bool_and(F.coalesce(pred, F.lit(False)))


def some(pred: Column) -> Column:
    """At least one row of the group satisfies the predicate."""
    return F.bool_or(F.coalesce(pred, F.lit(False)))


def micros_of_day(ts: Column) -> Column:
    return F.pmod(F.unix_micros(ts.cast("timestamp")), F.lit(DAY_MICROS))


def time_rank(ts: Column, value: Column) -> Column:
    """Order of bars within one day as a single long.

    The low bits settle bars that share a timestamp by a hash of the value, so that a
    recomputed task picks the same one. A fixed-width key keeps ``min_by`` and
    ``max_by`` in a hash aggregate; a struct key would sort all bars first.
    """
    tie = F.xxhash64(value).bitwiseAND(F.lit((1 << TIE_BITS) - 1))
    return F.shiftleft(micros_of_day(ts), TIE_BITS).bitwiseOR(tie)


def first_in_day(value: Column, ts: Column) -> Column:
    return F.min_by(value, time_rank(ts, value))


def last_in_day(value: Column, ts: Column) -> Column:
    return F.max_by(value, time_rank(ts, value))


def megabytes(size: Column) -> Column:
    return size / F.lit(1024.0 * 1024.0)


def ratio(size_in: Column, size_out: Column) -> Column:
    """Compression ratio; 1.0 where nothing was written."""
    return F.when(size_out > 0, size_in / size_out).otherwise(F.lit(1.0))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, part * F.lit(100.0) / whole)
