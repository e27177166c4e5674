import datetime as dt
import os
import random
import time

import pandas as pd
import pytest
from bars import bar, table
from pyspark.sql import functions as F

from minutebook.functions.times import ms_of_day
from minutebook.operators.quality import purge_plan, quality_facts
from minutebook.plans import facts_store, snapshots
from minutebook.plans.consolidate import consolidate_all, overall_stats, run_counts
from minutebook.plans.daily_build import daily_build
from minutebook.plans.maintain import organize_apply, organize_counts, organize_plan, purge_lake, purge_tree_plan, scan_tree
from minutebook.plans.relocate import organize_files, relocate_files, relocation_totals
from minutebook.schema import INDEX_SCHEMA
from minutebook.sources import files, fragments, lake, landing, versions, zones
from minutebook.streaming.ingest import ingest_landing, read_ingested, read_ledger
from minutebook.streaming.waiting import retry_waiting


def day_frame(symbol, day, n=3, volume=float, stamp="us", **extra):
    start = pd.Timestamp(day) + pd.Timedelta(hours=10)
    ts = pd.Series(pd.date_range(start, periods=n, freq="min")).astype(f"datetime64[{stamp}]")
    price = [10.0 + i for i in range(n)]
    frame = pd.DataFrame({
        "timestamp": ts, "open": price, "high": price, "low": price, "close": price,
        "volume": pd.Series(range(1, n + 1)).astype(volume), "date": ts.dt.strftime("%Y%m%d"), "symbol": symbol,
        "ms_of_day": [36_000_000 + 60_000 * i for i in range(n)],
    })
    return frame.assign(**extra)


@pytest.fixture()
def tree(tmp_path):
    root = tmp_path / "tree"
    month = root / "2024" / "01"
    month.mkdir(parents=True)
    put = lambda frame, name: frame.to_parquet(month / name, index=False)
    put(day_frame("AAPL", "20240102", count=4, vwap=1.5), "AAPL_20240102.parquet")
    put(day_frame("BRK_B", "20240102", volume="int64"), "BRK_B_20240102.parquet")
    put(day_frame("NANO", "20240103", stamp="ns"), "NANO_20240103.parquet")
    put(day_frame("KEYLESS", "20240103").assign(symbol=None, ms_of_day=None), "KEYLESS_20240103.parquet")
    put(day_frame("EMPTY", "20240103").iloc[:0], "EMPTY_20240103.parquet")
    put(day_frame("SAT", "20240106"), "SAT_20240106.parquet")
    put(day_frame("X", "20240102"), "X_20240230.parquet")
    put(day_frame("X", "20240102"), "notes.parquet")
    (month / "JUNK_20240103.parquet").write_bytes(b"no parquet at all")
    return str(root)


def test_fragments_of_any_layout(spark, tree):
    found = {r.symbol: (r.rows, r.error is None) for r in fragments.fragment_files(spark, tree).collect()}
    assert found["JUNK"] == (None, False) and found["EMPTY"] == (0, True) and "notes" not in found
    bars = fragments.scan_fragments(spark, tree, fragments.fragment_files(spark, tree, "20240101", "20240105"))
    got = {r.symbol: (r.n, r.v, r.t, r.ms) for r in bars.groupBy("symbol").agg(
        F.count("*").alias("n"), F.sum("volume").alias("v"), F.min("timestamp").alias("t"), F.min("ms_of_day").alias("ms")).collect()}
    assert set(got) == {"AAPL", "BRK_B", "NANO", "KEYLESS"}
    assert got["BRK_B"] == (3, 6.0, dt.datetime(2024, 1, 2, 10), 36_000_000)
    assert got["NANO"] == (3, 6.0, dt.datetime(2024, 1, 3, 10), 36_000_000)
    assert got["KEYLESS"] == got["NANO"]


def test_read_errors_are_not_empty_files(spark, tree):
    listed = fragments.fragment_files(spark, tree)
    assert [r.symbol for r in fragments.read_errors(listed).collect()] == ["JUNK"]
    assert [r.symbol for r in fragments.empty_files(listed).collect()] == ["EMPTY"]
    issues = {(r.symbol, r.issue_type) for r in scan_tree(spark, tree, min_bars=3, start="20240103", end="20240103").collect()}
    assert issues == {("JUNK", "read_errors"), ("EMPTY", "all_nulls"), ("NANO", "constant_price"), ("KEYLESS", "constant_price")}


def test_consolidation_keeps_rows_and_is_idempotent(spark, tree, tmp_path):
    root = str(tmp_path / "lake")
    dry = consolidate_all(spark, tree, root, "20240101", "20240105", dry_run=True)
    assert {r.date: (r.files_read, r.total_rows, r.symbols_found) for r in dry.collect()} == {
        "20240102": (2, 6, 2), "20240103": (2, 6, 2)}
    assert not files.path_exists(spark, root)
    stats = {r.date: r for r in consolidate_all(spark, tree, root, "20240101", "20240105").collect()}
    assert (stats["20240103"].files_read, stats["20240103"].files_failed, stats["20240103"].total_rows) == (2, 1, 6)
    assert stats["20240102"].success and stats["20240102"].output_mb > 0
    before = sorted(map(tuple, lake.scan_lake(spark, root).collect()), key=str)
    assert consolidate_all(spark, tree, root, "20240101", "20240105").count() == 0
    assert sorted(map(tuple, lake.scan_lake(spark, root).collect()), key=str) == before and len(before) == 12
    again = consolidate_all(spark, tree, root, "20240101", "20240105", overwrite=True)
    assert overall_stats(again).first().total_rows == 12 and lake.scan_lake(spark, root).count() == 12


def test_day_files_are_sorted_and_split(spark, tmp_path):
    root = str(tmp_path / "lake")
    rows = [bar(s, f"2024-01-02 10:0{m}", 1.0) for m in (2, 0, 1) for s in ("B", "A", "C", "D")]
    bars = table(spark, *rows).withColumn("ms_of_day", ms_of_day(F.col("timestamp")))
    lake.write_daily(bars, root, files_per_day=1)
    (name,) = [r.path for r in files.file_inventory(spark, root).collect()]
    stored = pd.read_parquet(name.removeprefix("file:"))
    assert stored[["symbol", "timestamp"]].values.tolist() == stored[["symbol", "timestamp"]].sort_values(["symbol", "timestamp"]).values.tolist()
    assert lake.scan_day(spark, root, "20240103").count() == 0
    plan = lake.scan_day(spark, root, "20240102")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    with pytest.raises(ValueError, match="Missing columns: volume"):
        lake.write_daily(bars.drop("volume"), root)
    with pytest.raises(ValueError):
        lake.write_daily(bars, root, existing="merge")


def test_plain_day_file(spark, tmp_path):
    folder = tmp_path / "2024" / "01"
    folder.mkdir(parents=True)
    day_frame("A", "20240102", stamp="ns").to_parquet(folder / "20240102.parquet", index=False)
    assert lake.scan_day_file(spark, str(tmp_path), "20240102").first().timestamp == dt.datetime(2024, 1, 2, 10)
    assert lake.scan_day_file(spark, str(tmp_path), "20240103").count() == 0


def test_index_versions(spark, tmp_path):
    root = str(tmp_path / "index")
    assert versions.available_dates(spark, root).count() == 0
    entry = lambda d, n: spark.createDataFrame([(d, 1, n, 0.5, dt.datetime(2024, 1, 1))], INDEX_SCHEMA)
    for d, n in (("20240103", 1), ("20240102", 2), ("20240103", 9), ("20240103", 9)):
        versions.upsert_index(spark, root, entry(d, n))
    got = [(r.date, r.row_count) for r in versions.read_current(spark, root, INDEX_SCHEMA).orderBy("date").collect()]
    assert got == [("20240102", 2), ("20240103", 9)] and versions.current_version(spark, root) == 4
    assert [r.date for r in versions.available_dates(spark, root).collect()] == ["20240102", "20240103"]


def test_purge_rewrites_only_touched_days(spark, tmp_path):
    root = str(tmp_path / "lake")
    bars = table(
        spark, bar("A", "2024-01-02 10:00", 0.0), bar("B", "2024-01-02 10:00", 1.0, h=2.0), bar("A", "2024-01-03 10:00", 0.0),
        bar("B", "2024-01-04 10:00", 1.0, h=2.0),
    ).withColumn("ms_of_day", ms_of_day(F.col("timestamp")))
    lake.write_daily(bars, root)
    untouched = {r.path for r in files.file_inventory(spark, root).collect() if "date=20240104" in r.path}
    plan = purge_plan(quality_facts(lake.scan_lake(spark, root)))
    assert purge_lake(spark, root, plan) == ["20240103"]
    assert sorted((r.symbol, r.date) for r in lake.scan_lake(spark, root).collect()) == [("B", "20240102"), ("B", "20240104")]
    assert {r.path for r in files.file_inventory(spark, root).collect()} >= untouched
    assert [r.date for r in lake.stored_dates(spark, root).collect()] == ["20240102", "20240104"]


def test_organise_a_flat_dump(spark, tree, tmp_path):
    root = str(tmp_path / "lake")
    plan = organize_apply(spark, f"{tree}/2024/01", root)
    assert {r.action: r.files for r in organize_counts(plan).collect()} == {"already_organised": 5, "unreadable": 1, "drop_non_trading": 1, "skip_invalid": 2}
    assert lake.scan_lake(spark, root).select("symbol").distinct().count() == 4


def test_symbol_list(spark, tmp_path):
    path = tmp_path / "tickers.csv"
    path.write_text("Rank,Symbol\n1,nic\n2,ACHC\n3,NIC \n4,\n5,NA\n6,bad one\n")
    raw = landing.read_symbol_csv(spark, str(path))
    assert [r.symbol for r in landing.symbol_universe(raw).collect()] == ["NIC", "ACHC", "NA"]
    assert landing.universe_stats(raw).first().asDict() == {
        "raw_rows": 6, "valid_rows": 4, "invalid_rows": 1, "unique_symbols": 3, "duplicates_removed": 1}


def test_registry_dates_are_replaced_one_by_one(spark, tmp_path):
    root = str(tmp_path / "registry")
    rows = lambda *r: spark.createDataFrame(list(r), "date string, symbol string, reason string")
    assert landing.read_registry(spark, root).count() == 0
    landing.write_registry(rows(("20240102", "A", "x"), ("20240103", "B", "y")), root)
    landing.write_registry(rows(("20240103", "C", "z")), root)
    assert sorted(map(tuple, landing.read_registry(spark, root).collect())) == [("20240102", "A", "x"), ("20240103", "C", "z")]


REC = '{"open":%s,"high":%s,"low":%s,"close":%s,"volume":%s,"timestamp":"%sT10:00:00"}'


def payload(symbol, day, price, volume=5, high=None):
    text = "[" + REC % (price, price if high is None else high, price, price, volume, day) + "]"
    return (symbol, day.replace("-", ""), text)


def test_daily_build_over_two_runs(spark, tmp_path):
    root = str(tmp_path / "lake")
    frame = lambda *r: spark.createDataFrame(list(r), "symbol string, date string, payload string")
    first = frame(payload("A", "2024-01-02", 7.0, high=8.0), payload("Z", "2024-01-02", 0.0), payload("A", "2024-01-06", 3.0), ("N", "20240102", "[]"))
    summary, rejects = daily_build(spark, first, root)
    assert [(r.date, r.symbol_count, r.row_count) for r in summary.collect()] == [("20240102", 1, 961)]
    assert {(r.symbol, r.reason) for r in rejects.collect()} == {("N", "empty payload"), ("Z", "All OHLC zeros (961 bars)")}
    second = frame(payload("A", "2024-01-02", 9.0, high=10.0), payload("A", "2024-01-03", 5.0, high=6.0))
    daily_build(spark, second, root)
    stored = lake.scan_lake(spark, root)
    assert stored.count() == 2 * 961
    # the stored day was not touched, and its close is the next day's reference price
    assert stored.filter("date = '20240102' and volume > 0").first().open == 7.0
    assert {r.open for r in stored.filter("date = '20240103' and volume = 0").select("open").distinct().collect()} == {7.0}


def test_ingest_takes_each_symbol_day_once(spark, tmp_path):
    landed, ledger, mark = (str(tmp_path / n) for n in ("landing", "ledger", "mark"))
    frame = lambda *r: spark.createDataFrame(list(r), "symbol string, date string, payload string")
    landing.land_payloads(frame(payload("A", "2024-01-02", 1.0)), landed)
    ingest_landing(spark, landed, ledger, mark)
    landing.land_payloads(frame(payload("A", "2024-01-02", 2.0), payload("B", "2024-01-02", 2.0), ("C", "20240102", "oops")), landed)
    ingest_landing(spark, landed, ledger, mark)
    ingest_landing(spark, landed, ledger, mark)
    got = {(r.symbol, r.date): (r.kind, r.records) for r in read_ledger(spark, ledger).collect()}
    assert read_ledger(spark, ledger).count() == 3
    assert got == {("A", "20240102"): ("json_array", 1), ("B", "20240102"): ("json_array", 1), ("C", "20240102"): ("other", 0)}


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_ingest_stores_the_same_bars_however_files_fall(spark, tmp_path, files_per_batch):
    landed, ledger, mark, stored = (str(tmp_path / n) for n in ("landing", "ledger", "mark", "bars"))
    frame = lambda *r: spark.createDataFrame(list(r), "symbol string, date string, payload string").coalesce(1)
    for rows in (
        [("A", "20240102", "oops"), payload("B", "2024-01-02", 3.0)],
        [payload("A", "2024-01-02", 1.0), payload("B", "2024-01-02", 4.0)],
        [payload("A", "2024-01-02", 2.0), ("B", "20240102", "[]"), ("C", "20240102", "[]")],
    ):
        landing.land_payloads(frame(*rows), landed)
        time.sleep(1.1)  # landing times of files tell which came first
    ingest_landing(spark, landed, ledger, mark, files_per_batch, stored)
    assert sorted((r.symbol, r.open) for r in read_ingested(spark, stored).collect()) == [("A", 1.0), ("B", 3.0)]
    usable = read_ledger(spark, ledger).filter("reject_reason is null")
    assert sorted((r.symbol, r.records) for r in usable.collect()) == [("A", 1), ("B", 1)]


class Counted:
    """A file that counts the bytes read from it."""

    def __init__(self, file):
        self.file, self.n = file, 0

    def size(self):
        return self.file.size()

    def read_at(self, n, at):
        self.n += n
        return self.file.read_at(n, at)


def test_listing_reads_footers_only(spark, tmp_path):
    rng = random.Random(1)
    month = tmp_path / "2024" / "01"
    month.mkdir(parents=True)
    for k in range(6):
        frame = day_frame(f"S{k}", "20240102", n=961, count=1, vwap=1.0)
        for c in ("open", "high", "low", "close", "volume", "vwap"):
            frame[c] = [rng.random() for _ in range(961)]
        frame.to_parquet(month / f"S{k}_20240102.parquet", index=False)
    read = size = 0
    for path in month.iterdir():
        with fragments._opened(f"file:{path}") as file:
            counted = Counted(file)
            rows, columns, layout, error = fragments._described(counted)
            assert (rows, error) == (961, None) and "vwap:double" in columns and "vwap:DOUBLE" in layout
            read, size = read + counted.n, size + file.size()
    assert 0 < read < size / 10
    listed = fragments.fragment_footers(spark, f"file://{tmp_path}")
    assert listed.agg(F.sum("rows")).first()[0] == 6 * 961
    bars = fragments.scan_fragments(spark, str(tmp_path), fragments.fragment_files(spark, str(tmp_path)))
    plan = bars._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "binaryFile" not in plan and "Batched: true" in bars._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert bars.groupBy("symbol").count().filter("count = 961").count() == 6


def test_names_that_are_no_plain_paths(spark, tmp_path):
    """Signs that mean something in globs or URIs, and stores that Arrow does not open."""
    month = tmp_path / "a b%41" / "2024" / "01"
    month.mkdir(parents=True)
    for name in ("A+B", "A B", "A[1]", "A%20B", "A{x}"):
        day_frame(name, "20240102").assign(symbol=None).to_parquet(month / f"{name}_20240102.parquet", index=False)
    root = str(tmp_path / "a b%41")
    listed = fragments.fragment_files(spark, root)
    assert listed.filter("error is null and rows = 3").count() == 5
    got = {(r.symbol, r["count"]) for r in fragments.scan_fragments(spark, root, listed).groupBy("symbol").count().collect()}
    assert got == {(n, 3) for n in ("A+B", "A B", "A[1]", "A%20B", "A{x}")}


def test_stores_that_arrow_does_not_open(spark, tree, monkeypatch):
    want = sorted(map(str, fragments.fragment_files(spark, tree).collect()))
    monkeypatch.setattr(files, "ARROW_SCHEMES", {})
    assert files.file_inventory(spark, tree).filter("path like '%.parquet' and length > 0").count() == 9
    assert sorted(map(str, fragments.fragment_files(spark, tree).collect())) == want


def test_rare_layouts_go_through_python(spark, tree, monkeypatch):
    want = sorted(map(str, fragments.scan_fragments(spark, tree).collect()))
    monkeypatch.setattr(fragments, "MOST_LAYOUTS", 1)
    bars = fragments.scan_fragments(spark, tree)
    assert "MapInArrow" in bars._jdf.queryExecution().toString()
    assert sorted(map(str, bars.collect())) == want


def test_tree_screens_read_files_once(spark, tree):
    for made in (scan_tree(spark, tree), purge_tree_plan(spark, tree)):
        plan = made._jdf.queryExecution().toString()
        assert "binaryFile" not in plan and made.count() > 0


def test_two_writers_on_one_version(spark, tmp_path):
    """The second reads what the first has left; nothing is lost, and older versions stay."""
    root = str(tmp_path / "index")
    entry = lambda d: spark.createDataFrame([(d, 1, 1, 0.5, dt.datetime(2024, 1, 1))], INDEX_SCHEMA)
    versions.upsert_index(spark, root, entry("20240102"))
    calls = []

    def slow(existing):
        rows = versions.upserted_index(existing, entry("20240104"))
        if not calls:
            versions.upsert_index(spark, root, entry("20240103"))  # another writer, between this one's reading and its commit
        calls.append(rows.count())
        return rows

    assert versions.update(spark, root, INDEX_SCHEMA, slow) == 3 and calls == [2, 3]
    dates = lambda v: [r.date for r in versions.read_version(spark, root, v, INDEX_SCHEMA).orderBy("date").collect()]
    assert [dates(v) for v in range(4)] == [[], ["20240102"], ["20240102", "20240103"], ["20240102", "20240103", "20240104"]]
    with pytest.raises(versions.VersionConflict):
        versions.write_next(entry("20240105"), root, base=2)
    assert versions.versions(spark, root) == [1, 2, 3]


def test_readers_see_one_version_of_a_purge(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    bars = table(spark, *[bar(s, f"2024-01-0{d} 10:00", p, h=2 * p) for d in (2, 3, 4) for s, p in (("A", 0.0), ("B", 1.0))], bar("A", "2024-01-05 10:00", 0.0))
    bars = bars.withColumn("ms_of_day", ms_of_day(F.col("timestamp")))
    first = snapshots.write_days(bars, root)
    counts = lambda **v: {(r.symbol, r.date): r["count"] for r in snapshots.scan_snapshot(spark, root, **v).groupBy("symbol", "date").count().collect()}
    whole, seen = counts(), []
    write_next = snapshots.write_next

    def watched(*args, **options):
        seen.append(counts())  # all files of the purge are written by now
        if len(seen) == 1:
            snapshots.write_days(bars.filter("date = '20240104' and symbol = 'B'").unionByName(bars.filter("date = '20240104' and symbol = 'B'")), root)
        return write_next(*args, **options)

    monkeypatch.setattr(snapshots, "write_next", watched)
    done = snapshots.purge_days(spark, root, purge_plan(quality_facts(bars)))
    assert seen[0] == whole and len(seen) == 2 and done == 3
    assert counts() == {("B", "20240102"): 1, ("B", "20240103"): 1, ("B", "20240104"): 2}
    assert counts(version=first) == whole
    assert [r.date for r in snapshots.snapshot_days(spark, root).orderBy("date").collect()] == ["20240102", "20240103", "20240104"]
    assert snapshots.scan_snapshot(spark, root, "20240103", "20240103").count() == 1
    assert snapshots.scan_snapshot(spark, str(tmp_path / "none")).count() == 0


def test_refresh_reads_changed_days_only(spark, tmp_path):
    root, store = str(tmp_path / "lake"), str(tmp_path / "facts")
    day = lambda d, p: table(spark, bar("A", f"2024-01-0{d} 10:00", p), bar("B", f"2024-01-0{d} 10:01", 1.0)).withColumn("ms_of_day", ms_of_day(F.col("timestamp")))
    assert facts_store.refresh_facts(spark, root, store).count() == 0 and facts_store.stored_facts(spark, store).count() == 0
    for d in (2, 3, 4):
        lake.write_daily(day(d, 1.0), root)
    actions = lambda: {r.date[-1]: r.action for r in facts_store.refresh_facts(spark, root, store).collect()}
    assert actions() == {"2": "computed", "3": "computed", "4": "computed"}
    assert actions() == {"2": "kept", "3": "kept", "4": "kept"}
    for name in (tmp_path / "lake").rglob("*=20240102/*.parquet"):  # whoever reads this day now fails
        was = name.stat()
        name.write_bytes(b"x" * was.st_size)
        os.utime(name, ns=(was.st_atime_ns, was.st_mtime_ns))
    lake.write_daily(day(3, 0.0), root, existing="overwrite")
    lake.write_daily(day(5, 2.0), root)
    files.remove_folder(spark, f"{root}/year=2024/month=01/date=20240104")
    assert actions() == {"2": "kept", "3": "computed", "4": "removed", "5": "computed"}
    got = {(r.symbol, r.date[-1]): (r.n, r.all_zeros) for r in facts_store.stored_facts(spark, store).collect()}
    assert got == {(s, d): (1, (s, d) == ("A", "3")) for s in "AB" for d in "235"}


def test_build_keeps_registry_and_index(spark, tmp_path):
    root, registry, index = (str(tmp_path / n) for n in ("lake", "registry", "index"))
    frame = lambda *r: spark.createDataFrame(list(r), "symbol string, date string, payload string")
    rows = [payload("A", "2024-01-02", 7.0, high=8.0), payload("Z", "2024-01-02", 0.0), ("N", "20240103", "[]")]
    run = lambda *r, **o: daily_build(spark, frame(*r), root, registry=registry, index=index, **o)
    run(*rows)
    registered = {(r.symbol, r.date, r.reason) for r in landing.read_registry(spark, registry).collect()}
    assert registered == {("Z", "20240102", "All OHLC zeros (961 bars)"), ("N", "20240103", "empty payload")}
    # known rejects are not parsed again, whatever they hold now; new ones of the same date join them
    _, rejects = run(payload("N", "2024-01-03", 7.0, high=8.0), payload("B", "2024-01-03", 0.0), payload("C", "2024-01-03", 7.0, high=8.0))
    assert [r.symbol for r in rejects.collect()] == ["B"]
    registered = {(r.symbol, r.date) for r in landing.read_registry(spark, registry).collect()}
    assert registered == {("Z", "20240102"), ("N", "20240103"), ("B", "20240103")}
    assert {r.symbol for r in lake.scan_lake(spark, root).select("symbol").distinct().collect()} == {"A", "C"}
    sizes = {r.date: r.bytes / 1048576 for r in lake.stored_sizes(spark, root).collect()}
    entries = versions.read_current(spark, index, INDEX_SCHEMA).collect()
    assert {(r.date, r.symbol_count, r.row_count, r.file_size_mb) for r in entries} == {(d, 1, 961, mb) for d, mb in sizes.items()} and len(sizes) == 2


def test_run_counts(spark, tree, tmp_path):
    root = str(tmp_path / "lake")
    assert run_counts(spark, tree, root, "20240103", "20240105") == {"dates_found": 4, "dates_skipped": 3, "dates_already_consolidated": 0}
    consolidate_all(spark, tree, root, "20240102", "20240102")
    assert run_counts(spark, tree, root) == {"dates_found": 4, "dates_skipped": 1, "dates_already_consolidated": 1}
    assert run_counts(spark, tree, root, overwrite=True)["dates_skipped"] == 0


def test_lookup_on_a_huge_day_reads_one_file(spark, tmp_path):
    root, store = str(tmp_path / "a lake"), str(tmp_path / "zones")
    bars = spark.range(400 * 30).select(
        F.format_string("S%03d", F.col("id") % 400).alias("symbol"), F.lit("20240102").alias("date"),
        (F.lit("2024-01-02 10:00").cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") / 400).cast("int"))).alias("timestamp"),
        F.lit(36_000_000).cast("long").alias("ms_of_day"), *[F.col("id").cast("double").alias(c) for c in ("open", "high", "low", "close", "volume")],
    )
    zones.write_clustered(bars, root, tasks=8)
    zones.write_clustered(bars.filter("symbol < 'S010'").withColumn("date", F.lit("20240103")), root)
    assert zones.refresh_zones(spark, root, store) == 2 and zones.refresh_zones(spark, root, store) == 0
    assert len([r for r in files.file_inventory(spark, root).collect() if "date=20240102" in r.path]) == 8
    opened = 0
    for symbol in ("S000", "S123", "S399"):
        found = zones.lookup(spark, root, store, symbol, "20240102")
        opened += len(found.inputFiles())
        got = sorted(map(tuple, found.collect()))
        assert len(got) == 30 and got == sorted(map(tuple, lake.symbol_day(lake.scan_lake(spark, root), symbol, "20240102").collect()))
    assert opened <= 4  # a symbol may lie across two files
    assert zones.lookup(spark, root, store, "T", "20240102").count() == zones.lookup(spark, root, store, "S001", "20240104").count() == 0
    zones.write_clustered(bars.filter("symbol = 'S123'").withColumns({"symbol": F.lit("S500"), "date": F.lit("20240103")}), root)
    assert zones.lookup(spark, root, store, "S500", "20240103").count() == 0  # not known yet
    assert zones.refresh_zones(spark, root, store) == 1
    assert zones.lookup(spark, root, store, "S500", "20240103").count() == 30


def test_inventory_is_listed_by_tasks(spark, tmp_path):
    """Folders of any depth; hidden files and folders stay out; both ways list the same."""
    for place in ("a", "2024/b", "2024/01/c", "2024/01/x/y/d", "2024/_tmp/e", ".h/f", "2024/01/_g", "2024/02/x y%20+/i"):
        path = tmp_path / f"{place}.parquet"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"12345")
    (tmp_path / "2024" / "01" / "z.txt").write_bytes(b"1")
    listed = files.file_inventory(spark, str(tmp_path))
    assert "binaryFile" not in listed._jdf.queryExecution().toString()
    got = sorted(map(tuple, listed.collect()))
    by_index = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(str(tmp_path))
    assert got == sorted(map(tuple, by_index.select("path", "length").collect())) and len(got) == 5
    flat = files.file_inventory(spark, f"file://{tmp_path}/2024", recursive=False)
    assert [r.path.rsplit("/", 1)[1] for r in flat.collect()] == ["b.parquet"]


def test_day_files_of_a_range(spark, tmp_path):
    for day in ("20231229", "20240102", "20240103", "20240201"):
        folder = tmp_path / day[:4] / day[4:6]
        folder.mkdir(parents=True, exist_ok=True)
        frame = pd.concat([day_frame("A", day, stamp="ns"), day_frame("B", day, stamp="ns")])
        (frame.assign(volume=frame["volume"].astype("int64")) if day == "20240103" else frame).to_parquet(folder / f"{day}.parquet", index=False)
    (tmp_path / "2024" / "02" / "20240202.parquet").write_bytes(b"junk outside the range")
    found = fragments.scan_day_files(spark, str(tmp_path), "20240101", "20240131")
    assert sorted(f.rsplit("/", 1)[1] for f in found.inputFiles()) == ["20240102.parquet", "20240103.parquet"]
    assert {(r.date, r.symbol): r.v for r in found.groupBy("date", "symbol").agg(F.sum("volume").alias("v")).collect()} == {
        (d, s): 6.0 for d in ("20240102", "20240103") for s in "AB"}
    with pytest.raises(ValueError, match="20240202"):
        fragments.scan_day_files(spark, str(tmp_path), "20240101")
    assert fragments.scan_day_files(spark, str(tmp_path / "none")).count() == 0


def _flat_dump(root, **files):
    root.mkdir(exist_ok=True)
    for name, content in files.items():
        (root / f"{name}.parquet").write_bytes(content)
    return str(root)


def _outcomes(manifest):
    return {r.path.rsplit("/", 1)[1].removesuffix(".parquet"): r.outcome for r in manifest.collect()}


def test_files_of_a_dump_are_moved_whole(spark, tmp_path):
    big = bytes(range(256)) * 40_000
    dump = _flat_dump(
        tmp_path / "dump", AAA_20240102=b"one", BIG_20240103=big, BBB_20240101=b"holiday", CCC=b"no date", DDD_20240230=b"no such day",
        EEE_20240104=b"mine", FFF_20240104=b"blocked", GGG_20240104=b"same", **{"20240105": b""},
    )
    month = tmp_path / "dump" / "2024" / "01"
    (month / "FFF_20240104.parquet").mkdir(parents=True)  # the place of a file is taken by a folder
    (month / "EEE_20240104.parquet").write_bytes(b"yours")
    (month / "GGG_20240104.parquet").write_bytes(b"same")
    (month / ".AAA_20240102.parquet.0").write_bytes(b"on")  # left by a task that was lost
    want = {
        "AAA_20240102": "moved", "BIG_20240103": "moved", "BBB_20240101": "dropped", "CCC": "skip_invalid", "DDD_20240230": "skip_invalid",
        "EEE_20240104": "target_differs", "FFF_20240104": "failed", "GGG_20240104": "already_there", "20240105": "moved",
    }
    copied = organize_files(spark, dump, remove=False)
    assert _outcomes(copied) == want
    assert len([p for p in (tmp_path / "dump").iterdir() if p.is_file()]) == len(want)
    again = organize_files(spark, dump)
    assert _outcomes(again) == want | {n: "already_there" for n, o in want.items() if o == "moved"}
    left = {p.name.removesuffix(".parquet") for p in (tmp_path / "dump").iterdir() if p.is_file() and p.suffix == ".parquet"}
    assert left == {"CCC", "DDD_20240230", "EEE_20240104", "FFF_20240104"}
    assert (month / "BIG_20240103.parquet").read_bytes() == big
    assert (month / "20240105.parquet").read_bytes() == b""
    assert (month / "EEE_20240104.parquet").read_bytes() == b"yours"
    # the plan of the first run carried out once more: sources are gone, targets stand
    once_more = relocate_files(spark, copied.select("path", "action", "target"), dump, remove=True)
    assert _outcomes(once_more) == _outcomes(again)
    totals = relocation_totals(copied).collect()[0].asDict()
    assert totals == {
        "files_found": 9, "files_moved": 3, "files_deleted_non_trading": 1, "files_skipped": 3, "files_already_organised": 1, "errors": 1,
        "bytes_moved": 3 + len(big),
    }


def test_files_that_want_one_place(spark, tmp_path):
    one, two = _flat_dump(tmp_path / "a", AAA_20240102=b"first"), _flat_dump(tmp_path / "b", AAA_20240102=b"other")
    listing = files.file_inventory(spark, one).unionByName(files.file_inventory(spark, two))
    plan = organize_plan(listing)
    target = tmp_path / "out"
    rows = {r.path.rsplit("/", 2)[1]: r.outcome for r in relocate_files(spark, plan, str(target), remove=True).collect()}
    assert rows == {"a": "moved", "b": "skip_exists"}
    assert (target / "2024" / "01" / "AAA_20240102.parquet").read_bytes() == b"first"
    assert not (tmp_path / "a" / "AAA_20240102.parquet").exists() and (tmp_path / "b" / "AAA_20240102.parquet").exists()


def test_nothing_to_move_and_lost_sources(spark, tmp_path):
    empty = tmp_path / "empty"
    empty.mkdir()
    assert organize_files(spark, str(empty)).collect() == []
    assert relocation_totals(organize_files(spark, str(empty))).collect()[0].files_found == 0
    dump = _flat_dump(tmp_path / "dump", AAA_20240102=b"one")
    plan = organize_plan(files.file_inventory(spark, dump)).select("path", "action", "target")
    plan = spark.createDataFrame(plan.collect(), plan.schema)
    (tmp_path / "dump" / "AAA_20240102.parquet").unlink()
    row = relocate_files(spark, plan, str(tmp_path / "out")).collect()[0]
    assert row.outcome == "failed" and "FileNotFoundError" in row.error


def test_refused_payloads_wait_and_are_offered_again(spark, tmp_path):
    landed, ledger, mark, stored, waiting, state = (str(tmp_path / n) for n in ("landing", "ledger", "mark", "bars", "waiting", "state"))
    frame = lambda *r: spark.createDataFrame(list(r), "symbol string, date string, payload string").coalesce(1)
    cut = lambda symbol, price: (symbol, "20240102", payload(symbol, "2024-01-02", price)[2][:-1])  # the closing bracket is lost
    take = lambda: ingest_landing(spark, landed, ledger, mark, bars_root=stored, accept=("intact",), waiting_root=waiting)
    retry = lambda seconds, **how: retry_waiting(spark, waiting, ledger, state, seconds, 3600, bars_root=stored, **how)
    opens = lambda: sorted((r.symbol, r.open) for r in read_ingested(spark, stored).collect())

    landing.land_payloads(frame(cut("A", 1.0), cut("B", 2.0), cut("B", 2.0), payload("C", "2024-01-02", 3.0), ("D", "20240102", "oops")), landed)
    take()
    retry(0, accept=("intact",))
    retry(0, accept=("intact",))  # offered, but still not taken
    assert opens() == [("C", 3.0)]
    landing.land_payloads(frame(payload("A", "2024-01-02", 4.0)), landed)
    take()  # an intact one came in between
    retry(0)
    retry(0)  # without a new landing
    assert opens() == [("A", 4.0), ("B", 2.0), ("C", 3.0)]
    usable = read_ledger(spark, ledger).filter("reject_reason is null")
    assert sorted((r.symbol, r.parse_status) for r in usable.collect()) == [("A", "intact"), ("B", "repaired"), ("C", "intact")]
    before = opens()
    retry(0)
    assert opens() == before and read_ledger(spark, ledger).filter("reject_reason is null").count() == 3


def test_waiting_payloads_expire(spark, tmp_path):
    landed, ledger, mark, stored, waiting, state = (str(tmp_path / n) for n in ("landing", "ledger", "mark", "bars", "waiting", "state"))
    cut = ("A", "20240102", payload("A", "2024-01-02", 1.0)[2][:-1])
    landing.land_payloads(spark.createDataFrame([cut], "symbol string, date string, payload string"), landed)
    ingest_landing(spark, landed, ledger, mark, bars_root=stored, accept=("intact",), waiting_root=waiting)
    retry_waiting(spark, waiting, ledger, state, 0, 1, bars_root=stored, accept=("intact",))
    time.sleep(1.5)
    for _ in range(2):
        retry_waiting(spark, waiting, ledger, state, 0, 1, bars_root=stored)
    assert read_ingested(spark, stored).count() == 0
