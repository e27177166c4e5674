"""Quality facts of a group of bars and the three screens over them.

All facts come from one hash aggregate with fixed-width state, so they combine before the
shuffle whatever the size of a group. Text is made only in the verdict step.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minutebook.functions.guards import every, first_in_day, some
from minutebook.functions.symbols import fragment_name, is_special
from minutebook.schema import KEY, OHLC

MIN_BARS = 961
# Issue types that special securities are expected to show.
SPECIAL_ISSUES = ["all_zeros", "zero_volume", "constant_price"]


def _any_of(cols) -> Column:
    return reduce(lambda a, b: a | b, cols)


def _all_of(cols) -> Column:
    return reduce(lambda a, b: a & b, cols)


def is_flat() -> Column:
    o, h, l, c = (F.col(x) for x in OHLC)
    return (o == h) & (h == l) & (l == c)


def row_flags() -> dict[str, Column]:
    """The six ordering rules a bar can break."""
    o, h, l, c = (F.col(x) for x in OHLC)
    false = F.lit(False)
    rules = {
        "high_lt_low": h < l,
        "high_lt_open": h < o,
        "high_lt_close": h < c,
        "low_gt_open": l > o,
        "low_gt_close": l > c,
        "negative_volume": F.col("volume") < 0,
    }
    return {name: F.coalesce(rule, false) for name, rule in rules.items()}


def ohlc_row_flags(bars: DataFrame) -> DataFrame:
    return bars.withColumns(row_flags())


def ohlc_violation_counts(bars: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Rows per broken rule and group."""
    return bars.groupBy(*keys).agg(*[F.count_if(f).alias(name) for name, f in row_flags().items()])


def broken_order() -> Column:
    return _any_of([f for name, f in row_flags().items() if name != "negative_volume"])


def fact_columns(columns: list[str]) -> list[Column]:
    """Aggregates behind every screen."""
    volume = F.col("volume") if "volume" in columns else F.lit(None).cast("double")
    facts = [F.count("*").alias("n")]
    for c in OHLC:
        facts += [every(F.col(c) == 0).alias(f"{c}_zero"), every(F.col(c).isNull()).alias(f"{c}_null")]
    return facts + [
        every(volume == 0).alias("volume_zero"),
        every(volume.isNull()).alias("volume_null"),
        every(is_flat()).alias("flat"),
        some(_any_of([F.col(c) < 0 for c in OHLC])).alias("negative"),
        some(broken_order()).alias("violation"),
        first_in_day(F.col("close"), F.col("timestamp")).alias("first_close"),
    ]


def with_summary_flags(facts: DataFrame) -> DataFrame:
    """Add the per-group flags that combine column facts."""
    return facts.withColumns(
        {
            "all_zeros": _all_of([F.col(f"{c}_zero") | F.col(f"{c}_null") for c in OHLC]),
            "all_nulls": _all_of([F.col(f"{c}_null") for c in OHLC]),
            "zero_volume": F.col("volume_zero") | F.col("volume_null"),
        }
    )


def quality_facts(bars: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """One row of facts per group (symbol-day unless told otherwise)."""
    return with_summary_flags(bars.groupBy(*keys).agg(*fact_columns(bars.columns)))


# --- verdicts ---------------------------------------------------------------------

def purge_reason() -> Column:
    """Why a symbol-day holds nothing usable, NULL if it does."""
    # The texts of the reasons.
    bars = F.concat(F.lit(" ("), F.col("n").cast("string"), F.lit(" bars)"))
    flat_zero = F.col("flat") & F.coalesce(F.col("first_close") == 0, F.lit(False))
    flat_idle = F.col("flat") & F.col("zero_volume")
    return (
        F.when(F.col("n") == 0, "Empty file (0 rows)")
        .when(F.col("all_zeros"), F.concat(F.lit("All OHLC zeros"), bars))
        .when(flat_zero, F.concat(F.lit("Constant price at $0.00"), bars))
        .when(
            flat_idle,
            F.concat(F.format_string("Zero volume + constant price $%.2f", F.col("first_close")), bars),
        )
    )


def gate_reason() -> Column:
    """First rule a symbol-day fails at ingest, NULL if it passes."""
    return F.coalesce(
        purge_reason(),
        F.when(F.col("negative"), "Negative prices detected").when(
            F.col("violation"), "OHLC violations (high<low, etc.)"
        ),
    )


def quality_rejects(facts: DataFrame) -> DataFrame:
    """Reject rows (date, symbol, reason) of the ingest gate."""
    return facts.select("date", "symbol", gate_reason().alias("reason")).filter("reason is not null")


def quality_gate(bars: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Bars of the symbol-days that pass. Rejected keys are the smaller side of the join."""
    rejects = quality_rejects(quality_facts(bars) if facts is None else facts)
    return bars.join(rejects.select(*KEY), KEY, "left_anti")


def _issue(cond: Column, kind: str, details: Column) -> Column:
    return F.when(cond, F.struct(F.lit(kind).alias("issue_type"), details.alias("details")))


def _found(min_bars: int, missing: list[str] | None) -> Column:
    """All issues of a symbol-day as an array."""
    # The texts of the report.
    if missing:
        return F.array(_issue(F.lit(True), "other_issues", F.lit("Missing columns: " + ", ".join(missing))))
    n, usable, some_rows = F.col("n").cast("string"), ~F.col("all_zeros"), F.col("n") > 0
    constant = F.format_string(" bars, constant at $%.2f", F.col("first_close"))
    return F.array_compact(F.array(
        _issue(~some_rows, "all_nulls", F.lit("File is empty (0 rows)")),
        _issue(some_rows & ~usable, "all_zeros", F.concat(n, F.lit(" bars, all zero"))),
        _issue(some_rows & F.col("zero_volume"), "zero_volume", F.concat(n, F.lit(" bars, zero volume"))),
        _issue(some_rows & usable & F.col("flat"), "constant_price", F.concat(n, constant)),
        _issue(some_rows & usable & (F.col("n") < min_bars), "insufficient_bars", F.concat(n, F.lit(f"/{min_bars} bars"))),
        _issue(some_rows & usable & F.col("negative"), "other_issues", F.lit("Negative prices detected")),
        _issue(some_rows & usable & F.col("violation"), "other_issues", F.lit("OHLC violations (high<low, etc.)")),
    ))


def quality_scan(
    facts: DataFrame, min_bars: int = MIN_BARS, split_specials: bool = True,
    missing: list[str] | None = None,
) -> DataFrame:
    """One row per issue of a stored symbol-day; a symbol-day can have several.

    ``routed_special`` marks the issues expected of warrants, units and rights.
    """
    special = is_special(F.col("symbol"))
    routed = special & F.col("i.issue_type").isin(SPECIAL_ISSUES) if split_specials else F.lit(False)
    file = F.col("file") if "file" in facts.columns else fragment_name(F.col("symbol"), F.col("date"))
    return facts.select("symbol", "date", file.alias("file"), F.explode(_found(min_bars, missing)).alias("i")).select(
        "file", "symbol", "date", "i.issue_type", "i.details",
        special.alias("is_special"), routed.alias("routed_special"),
    )


def report_rows(issues: DataFrame) -> DataFrame:
    """The five columns of the quality report; routed special issues carry a suffix."""
    kind = F.when(F.col("routed_special"), F.concat("issue_type", F.lit("_special"))).otherwise(F.col("issue_type"))
    return issues.select(
        F.col("file").alias("File"),
        F.col("symbol").alias("Symbol"),
        kind.alias("Issue Type"),
        F.col("details").alias("Details"),
        F.when(F.col("is_special"), "True").otherwise("False").alias("Is Special Security"),
    )


def issue_counts(issues: DataFrame) -> DataFrame:
    """Issues per type and kind of security; ``critical`` counts symbol-days without any data."""
    critical = F.col("issue_type").isin("all_nulls", "read_errors") | (
        (F.col("issue_type") == "all_zeros") & ~F.col("is_special")
    )
    return issues.groupBy("issue_type", "is_special").agg(
        F.count("*").alias("issue_rows"),
        F.count_if(critical).alias("critical"),
    )


def scan_totals(facts: DataFrame, min_bars: int = MIN_BARS) -> DataFrame:
    """One row: symbol-days scanned, clean, with issues, and issue rows (the two differ). The facts are read once."""
    n = F.col("issues")
    return facts.select(F.size(_found(min_bars, None)).alias("issues")).agg(
        F.count("*").alias("groups"), F.count_if(n == 0).alias("valid_groups"), F.count_if(n > 0).alias("groups_with_issues"),
        F.coalesce(F.sum("issues"), F.lit(0)).cast("long").alias("issue_rows"),
    )


def issue_samples(issues: DataFrame, n: int = 10, by: str = "issue_type") -> DataFrame:
    """First n issues per category in file order. The limit is applied before the shuffle too."""
    order = Window.partitionBy(by).orderBy("file", "issue_type", "details")
    return issues.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


# --- purge ------------------------------------------------------------------------

def purge_plan(facts: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Symbol-days to remove with reason and stored bytes (NULL where sizes are not given)."""
    plan = facts.select(*KEY, purge_reason().alias("reason")).filter("reason is not null")
    if sizes is not None:
        plan = plan.join(sizes.select(*KEY, "size_bytes"), KEY, "left")
    else:
        plan = plan.withColumn("size_bytes", F.lit(None).cast("long"))
    return plan.select(
        fragment_name(F.col("symbol"), F.col("date")).alias("file"),
        *KEY, "reason", "size_bytes", is_special(F.col("symbol")).alias("is_special"),
    )


def purge_log_rows(plan: DataFrame) -> DataFrame:
    return plan.select(
        F.col("file").alias("File"),
        F.col("symbol").alias("Symbol"),
        F.col("reason").alias("Reason"),
        F.col("size_bytes").alias("Size (bytes)"),
        F.when(F.col("is_special"), "Yes").otherwise("No").alias("Is Special Security"),
    )


def purge_summary(plan: DataFrame) -> DataFrame:
    """Symbol-days and bytes per symbol, per kind of security (symbol NULL) and in all (both NULL)."""
    kind = F.when(F.col("is_special"), "special").otherwise("regular")
    return plan.withColumn("kind", kind).rollup("kind", "symbol").agg(
        F.count("*").alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("long").alias("bytes")
    )


def purge_apply(bars: DataFrame, plan: DataFrame) -> DataFrame:
    """Bars without the planned symbol-days."""
    return bars.join(plan.select(*KEY).distinct(), KEY, "left_anti")
