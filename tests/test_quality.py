import datetime as dt

from bars import bar, table

from minutebook.operators import layers, quality as q

DAY = "2024-01-02"


def verdicts(spark, *rows):
    facts = q.quality_facts(table(spark, *rows))
    gate = {r.symbol: r.reason for r in q.quality_rejects(facts).collect()}
    purge = {r.symbol: r.reason for r in q.purge_plan(facts).collect()}
    scan = {}
    for r in q.quality_scan(facts, min_bars=2).collect():
        scan.setdefault(r.symbol, set()).add((r.issue_type, r.details, r.routed_special))
    return gate, purge, scan


def null_bar(symbol, when, **known):
    ts = dt.datetime.fromisoformat(when)
    return (symbol, ts.strftime("%Y%m%d"), ts, *(known.get(c) for c in ("o", "h", "l", "c", "v")))


def test_each_rule(spark):
    two = lambda s, *a, **k: [bar(s, f"{DAY} 10:00", *a, **k), bar(s, f"{DAY} 10:01", *a, **k)]
    gate, purge, scan = verdicts(
        spark,
        *two("ZERO", 0.0), *two("IDLEW", 0.0, v=0.0),
        null_bar("NULLS", f"{DAY} 10:00", v=1.0), null_bar("NULLS", f"{DAY} 10:01"),
        null_bar("MIX", f"{DAY} 10:00", o=0.0, h=0.0, l=0.0, v=1.0), null_bar("MIX", f"{DAY} 10:01", o=0.0, h=0.0, l=0.0, v=1.0),
        bar("FLATA", f"{DAY} 10:00", 0.0), bar("FLATA", f"{DAY} 10:01", 3.0),
        *two("FLATB", 3.0, v=0.0), *two("FLATC", 3.0), *two("NEGX", -2.0, h=4.0, l=-2.0),
        *two("BROKE", 3.0, h=2.0), *two("FINE", 3.0, h=4.0), bar("SHORT", f"{DAY} 10:00", 3.0, h=4.0),
        bar("HALF", f"{DAY} 10:00", 3.0), null_bar("HALF", f"{DAY} 10:01", v=0.0),
    )
    assert gate == {
        "ZERO": "All OHLC zeros (2 bars)", "IDLEW": "All OHLC zeros (2 bars)", "NULLS": "All OHLC zeros (2 bars)",
        "MIX": "All OHLC zeros (2 bars)", "FLATA": "Constant price at $0.00 (2 bars)",
        "FLATB": "Zero volume + constant price $3.00 (2 bars)", "NEGX": "Negative prices detected",
        "BROKE": "OHLC violations (high<low, etc.)",
    }
    assert set(purge) == {"ZERO", "IDLEW", "NULLS", "MIX", "FLATA", "FLATB"}
    assert scan["ZERO"] == {("all_zeros", "2 bars, all zero", False)}
    assert scan["IDLEW"] == {("all_zeros", "2 bars, all zero", True), ("zero_volume", "2 bars, zero volume", True)}
    assert scan["FLATA"] == {("constant_price", "2 bars, constant at $0.00", False)}
    assert scan["FLATC"] == {("constant_price", "2 bars, constant at $3.00", False)}
    assert scan["FLATB"] == {("constant_price", "2 bars, constant at $3.00", False), ("zero_volume", "2 bars, zero volume", False)}
    assert scan["NEGX"] == {("other_issues", "Negative prices detected", False)}
    assert scan["BROKE"] == {("other_issues", "OHLC violations (high<low, etc.)", False)}
    assert scan["SHORT"] == {("insufficient_bars", "1/2 bars", False)}
    assert "FINE" not in scan and "HALF" not in gate


def test_gate_splits_bars(spark):
    bars = table(spark, bar("A", f"{DAY} 10:00", 0.0), bar("B", f"{DAY} 10:00", 3.0))
    assert [r.symbol for r in q.quality_gate(bars).collect()] == ["B"]


def test_missing_columns_flag_every_group(spark):
    bars = table(spark, bar("A", f"{DAY} 10:00", 3.0)).drop("volume")
    facts = q.quality_facts(bars)
    (issue,) = q.quality_scan(facts, missing=["volume"]).collect()
    assert (issue.issue_type, issue.details) == ("other_issues", "Missing columns: volume")


def test_reconcile_verdicts(spark):
    day = lambda s, v: bar(s, f"{DAY} 10:00", 1.0, v=v)
    raw = table(spark, day("CRIT", 5.0), day("LOST", 5.0), day("NONE", 0.0), day("SAME", 5.0), day("GAIN", 5.0))
    parsed = table(spark, day("CRIT", 0.0), day("LOST", 4.0), day("NONE", 3.0), day("SAME", 5.0), day("GAIN", 6.0), day("NEW", 1.0))
    got = {r.symbol: (r.verdict, r.lost_pct) for r in layers.reconcile(raw, parsed).collect()}
    assert got == {
        "CRIT": ("critical_zero_after_parse", None), "LOST": ("volume_lost", 20.0), "NONE": ("no_raw_volume", None),
        "SAME": ("preserved", None), "GAIN": ("none", None), "NEW": ("no_raw_volume", None)}


def test_first_registered_reason_wins(spark):
    rejects = spark.createDataFrame([("20240102", "A", "b", 1), ("20240102", "A", "a", 2)], "date string, symbol string, reason string, seq int")
    work = spark.createDataFrame([("A", "20240102"), ("A", "20240103")], "symbol string, date string")
    got = {r.date: (r.should_skip, r.reason) for r in layers.skip_decisions(work, rejects).collect()}
    assert got == {"20240102": (True, "b"), "20240103": (False, None)}
    assert layers.skip_known_nulls(work, rejects).count() == 1
