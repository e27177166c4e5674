"""What must not depend on batches, layouts of other files, or the place a job runs in."""

import datetime as dt

import pandas as pd
import pytest
from bars import bar, table
from pyspark.sql import functions as F
from test_payloads import R1, R2
from test_store import day_frame

from minutebook.functions.trading_days import date_span, with_calendar
from minutebook.operators import payload_parse as parse
from minutebook.operators.filled_gate import marks_with_facts
from minutebook.plans import daily_build as build_plan
from minutebook.plans.daily_build import daily_build, settled_marks
from minutebook.plans.maintain import organize_apply
from minutebook.session import work_folder
from minutebook.sources import files, fragments, lake

RECORD = '{{"volume":{v},"high":{h},"low":{l},"vwap":1.0,"count":1,"close":{c},"open":{o},"timestamp":"{t}:00.000"}}'


def payload(symbol, day, *bars):
    """Bars as (minute, open, high, low, close, volume)."""
    text = ",".join(RECORD.format(t=f"{day}T{t}", o=o, h=h, l=l, c=c, v=v) for t, o, h, l, c, v in bars)
    return (symbol, day.replace("-", ""), f"[{text}]")


def stored(spark, root):
    return sorted(map(tuple, lake.scan_lake(spark, root, filled=True).collect()), key=str)


@pytest.mark.parametrize("days", [
    # a rejected day lends no price: all prices of the first are negative
    [payload("A", "2024-01-02", ("10:00", -1, -1, -2, -2, 5)), payload("A", "2024-01-03", ("10:00", 5, 6, 5, 6, 5))],
    # the last bar of the first day has no volume, but it was observed
    [payload("A", "2024-01-02", ("10:00", 5, 6, 5, 5, 3), ("11:00", 6, 6, 6, 6, 0)), payload("A", "2024-01-03", ("10:00", 7, 8, 7, 8, 1))],
    # whether the second day is accepted hangs on the first: its gaps are flat at 0, as are its bars
    [payload("A", "2024-01-02", ("10:00", 1, 1, 0, 0, 3)), payload("A", "2024-01-03", ("10:00", 0, 0, 0, 0, 3)),
     payload("A", "2024-01-04", ("10:00", 2, 3, 2, 3, 3)), payload("B", "2024-01-04", ("10:00", 2, 3, 2, 3, 3))],
])
@pytest.mark.parametrize("previous", ["last_observed", "stored"])
def test_days_one_by_one_equal_all_at_once(spark, tmp_path, days, previous):
    frame = lambda rows: spark.createDataFrame(rows, "symbol string, date string, payload string")
    daily_build(spark, frame(days), str(tmp_path / "once"), previous=previous)
    for date in sorted({d for _, d, _ in days}):
        daily_build(spark, frame([d for d in days if d[1] == date]), str(tmp_path / "each"), previous=previous)
    assert stored(spark, str(tmp_path / "once")) == stored(spark, str(tmp_path / "each")) != []


@pytest.mark.parametrize("previous", ["last_observed", "stored", "none"])
def test_long_chains_are_settled_in_one_pass(spark, monkeypatch, previous):
    """Each day is accepted only if the day before was not: it starts flat at the price lent, and ends at 0."""
    calendar = with_calendar(date_span(spark, "20200102", "20211130")).orderBy("date").collect()
    days = [dt.datetime.strptime(r.date, "%Y%m%d").date() for r in calendar]
    rows = [bar(s, f"{d} 1{h}:00", p) for s in "AB" for d in days for h, p in ((0, 5.0), (1, 0.0))]
    marks = marks_with_facts(table(spark, *rows)).withColumn("_stored", F.lit(None).cast("boolean"))
    folders = []
    monkeypatch.setattr(build_plan, "work_folder", lambda spark, label: folders.append(work_folder(spark, label)) or folders[-1])
    settled = settled_marks(marks, previous)
    found = {(r.symbol, r.date): (r.reason, r.ref_price) for r in settled.collect()}
    assert len(folders) == 1 and len(found) == 2 * len(days)
    state = None  # the last accepted trading day and what it lends
    for day in calendar:
        text = day.date
        lent = state[1] if previous != "none" and state and state[0] == day.prev_trading_day else None
        price = 5.0 if lent is None else lent
        want = None if price else "Constant price at $0.00 (961 bars)"
        assert found[("A", text)] == found[("B", text)] == (want, price)
        if day.is_trading_day and want is None:
            state = (text, 0.0 if previous == "last_observed" else price)
    if previous == "last_observed":
        assert 400 < sum(reason is not None for reason, _ in found.values()) < 1_000


def test_rejected_day_lends_no_price(spark, tmp_path):
    root = str(tmp_path / "lake")
    days = [payload("A", "2024-01-02", ("10:00", -1, -1, -2, -2, 5)), payload("A", "2024-01-03", ("10:00", 5, 6, 5, 6, 5))]
    daily_build(spark, spark.createDataFrame(days, "symbol string, date string, payload string"), root)
    found = lake.scan_lake(spark, root)
    assert found.count() == 961 and {r.open for r in found.filter("volume = 0").select("open").distinct().collect()} == {5.0}


def test_other_files_layouts_do_not_matter(spark, tmp_path):
    month = tmp_path / "tree" / "2024" / "01"
    month.mkdir(parents=True)
    day_frame("A", "20240102", count=4, vwap=1.5).to_parquet(month / "A_20240102.parquet", index=False)
    day_frame("B", "20240102", count=4, vwap=1.5).to_parquet(month / "B_20240102.parquet", index=False)
    day_frame("C", "20240110", volume="int64").to_parquet(month / "C_20240110.parquet", index=False)  # out of range
    day_frame("D", "20240102")[["timestamp", "open"]].iloc[:0].to_parquet(month / "D_20240102.parquet", index=False)  # narrow and empty
    day_frame("E", "20240102", n=500, count=4, vwap=1.5).to_parquet(month / "E_20240102.parquet", index=False, compression="gzip")
    data = bytearray((month / "E_20240102.parquet").read_bytes())
    data[40:400] = b"\xff" * 360  # the footer still opens
    (month / "E_20240102.parquet").write_bytes(bytes(data))
    root = str(tmp_path / "tree")
    listed = fragments.fragment_files(spark, root, "20240101", "20240105")
    assert [r.symbol for r in fragments.read_errors(listed).collect()] == ["E"]
    got = {r.symbol: (r.n, r.c, r.v) for r in fragments.scan_fragments(spark, root, listed).groupBy("symbol").agg(
        F.count("*").alias("n"), F.sum("count").alias("c"), F.max("vwap").alias("v")).collect()}
    assert got == {"A": (3, 12, 1.5), "B": (3, 12, 1.5)}


@pytest.mark.parametrize("n", [1, 4, 8])
def test_files_per_day_are_ranges_of_symbols(spark, tmp_path, n):
    root = str(tmp_path / "lake")
    rows = spark.range(400).select(
        F.format_string("S%03d", F.col("id") % 100).alias("symbol"), F.concat(F.lit("2024010"), 2 + F.col("id") % 2).alias("date"),
        F.lit("2024-01-02 10:00").cast("timestamp_ntz").alias("timestamp"), F.lit(36_000_000).cast("long").alias("ms_of_day"),
        *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close", "volume")],
    )
    lake.write_daily(rows, root, files_per_day=n)
    paths = [r.path for r in files.file_inventory(spark, root).collect()]
    for day in ("20240102", "20240103"):
        own = [p for p in paths if f"date={day}" in p]
        assert len(own) == n
        spans = sorted((f["symbol"].min(), f["symbol"].max()) for f in (pd.read_parquet(p.removeprefix("file:")) for p in own))
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_two_dumps_of_one_day_both_arrive(spark, tmp_path):
    root = str(tmp_path / "lake")
    for k, symbols in enumerate((["A"], ["A", "B"])):
        dump = tmp_path / f"dump{k}"
        dump.mkdir()
        for s in symbols:
            day_frame(s, "20240102", n=3 + k).to_parquet(dump / f"{s}_20240102.parquet", index=False)
        if k:
            pd.concat([day_frame("A", "20240103"), day_frame("Z", "20240103")]).to_parquet(dump / "20240103.parquet", index=False)
        plan = organize_apply(spark, str(dump), root)
    assert {(r.name, r.action) for r in plan.collect()} == {
        ("A_20240102.parquet", "skip_exists"), ("B_20240102.parquet", "move"), ("20240103.parquet", "move")}
    got = {(r.symbol, r.date): r["count"] for r in lake.scan_lake(spark, root).groupBy("symbol", "date").count().collect()}
    assert got == {("A", "20240102"): 3, ("B", "20240102"): 4, ("A", "20240103"): 3, ("Z", "20240103"): 3}


def test_names_in_any_case_in_any_record(spark):
    shout = R2.replace('"volume"', '"VOLUME"').replace('"open"', '"Open"')
    texts = [f"[{R1},{shout}]", f"[{R1.replace('count', 'Count').replace('vwap', 'VWAP')}]"]
    rows = spark.createDataFrame([("A", str(k), t) for k, t in enumerate(texts)], "symbol string, date string, payload string")
    got = parse.parse_payloads(rows).orderBy("date").collect()
    assert [len(r.records) for r in got] == [2, 1] and [r.reject_reason for r in got] == [None, None]
    assert [x.volume for x in got[0].records] == [1, 2] and (got[1].records[0]["count"], got[1].records[0].vwap) == (4, 10.3)


@pytest.mark.parametrize("blanks", [0, 13, 14, 15, 200])
def test_blank_payloads_of_any_length(spark, blanks):
    rows = spark.createDataFrame([(f"[{' ' * blanks}]",), (f"{{\n{' ' * blanks}}}",), (f"[{' ' * blanks}1]",)], "payload string")
    assert [r[0] for r in rows.select(parse.payload_kind(F.col("payload"))).collect()] == ["empty", "empty", "json_array"]


def test_work_folder_needs_a_shared_place():
    class Session:
        def __init__(self, master, conf=None, checkpoint=None):
            self.conf = type("C", (), {"get": staticmethod(lambda k, d: conf)})
            self.sparkContext = type("S", (), {"master": master, "getCheckpointDir": staticmethod(lambda: checkpoint)})

    with pytest.raises(RuntimeError):
        work_folder(Session("spark://host:7077"), "x")
    assert work_folder(Session("yarn", "hdfs://a/b/"), "x").startswith("hdfs://a/b/x-")
    assert work_folder(Session("yarn", None, "hdfs://c"), "x").startswith("hdfs://c/x-")
    assert "minutebook-" in work_folder(Session("local[4]"), "x")
