"""The ingest gate for gap-filled days, decided before the filler rows exist.

Filler rows of a day are all alike (flat at the reference price, volume 0), so the facts of
the filled day follow from the facts of its observed bars, the number of gaps and the
reference price. One aggregate over the bars gives marks and facts together, and rows are
generated only for days that pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minutebook.functions.guards import time_rank
from minutebook.operators.gap_fill import HOURS, day_marks, missing_count
from minutebook.operators.quality import broken_order, is_flat, with_summary_flags
from minutebook.schema import KEY, OHLC


def _grid_every(pred: Column) -> Column:
    return F.coalesce(F.bool_and(F.when(_observed(), F.coalesce(pred, F.lit(False)))), F.lit(True))


def _grid_some(pred: Column) -> Column:
    return F.coalesce(F.bool_or(F.when(_observed(), F.coalesce(pred, F.lit(False)))), F.lit(False))


def _observed() -> Column:
    return F.col("_slot").isNotNull()


def marks_with_facts(bars: DataFrame) -> DataFrame:
    """Day marks plus facts of the observed grid bars, in one pass."""
    facts = [F.count("_slot").alias("o_n")]
    for c in OHLC:
        facts += [
            _grid_every(F.col(c) == 0).alias(f"o_{c}_zero"),
            _grid_every(F.col(c).isNull()).alias(f"o_{c}_null"),
        ]
    negative = F.lit(False)
    for c in OHLC:
        negative = negative | F.coalesce(F.col(c) < 0, F.lit(False))
    close = F.col("close")
    return day_marks(
        bars,
        *facts,
        _grid_every(F.col("volume") == 0).alias("o_volume_zero"),
        _grid_every(F.col("volume").isNull()).alias("o_volume_null"),
        _grid_every(is_flat()).alias("o_flat"),
        _grid_some(negative).alias("o_negative"),
        _grid_some(broken_order()).alias("o_violation"),
        F.min_by(close, F.when(_observed(), time_rank(F.col("timestamp"), close))).alias("o_first_close"),
    )


def filled_facts(marks: DataFrame) -> DataFrame:
    """Marks (with observed facts and ``ref_price``) plus the facts of the filled days."""
    ref = F.col("ref_price")
    no_gap = F.col("gaps") == 0
    ref_is = lambda pred: no_gap | F.coalesce(pred, F.lit(False))
    facts = {"n": F.col("o_n") + F.col("gaps")}
    for c in OHLC:
        facts[f"{c}_zero"] = F.col(f"o_{c}_zero") & ref_is(ref == 0)
        facts[f"{c}_null"] = F.col(f"o_{c}_null") & ref_is(ref.isNull())
    starts_with_gap = F.col(HOURS[0]).bitwiseAND(F.lit(1)) == 0
    facts |= {
        "volume_zero": F.col("o_volume_zero"),
        "volume_null": F.col("o_volume_null") & no_gap,
        "flat": F.col("o_flat") & ref_is(ref.isNotNull()),
        "negative": F.col("o_negative") | (~no_gap & F.coalesce(ref < 0, F.lit(False))),
        "violation": F.col("o_violation"),
        "first_close": F.when(starts_with_gap, ref).otherwise(F.col("o_first_close")),
    }
    return with_summary_flags(marks.withColumn("gaps", missing_count().cast("long")).withColumns(facts))
