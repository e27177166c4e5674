"""HTML text, URL rules and WARC archives."""

import base64
import gzip
import hashlib
from pathlib import Path

import compare
import pytest
from pyspark.sql import functions as F

from minutebook.llm import html_text, queries, url_filter, warc

SF = "/root/testdata/sf0.01"
shared = pytest.mark.skipif(not Path(SF).exists(), reason="shared tables absent")

LONG = "This is the first paragraph of the text, and it is long enough to be decided by the stop words in it."


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("<", ""), ("<p", ""), ("<!-- x", ""), ("<script>var a = '<p>';", ""),
    (f"<article><h1>Title&amp;</h1><p>{LONG}<p>Short &lt;one&gt;.</article>", f"Title&\n\n{LONG}\n\nShort <one>."),
    (f"<nav><p>{LONG}</p></nav><article><p>a <b>b</b>\n c<br>d</p></article><footer>{LONG}</footer>", "a b c d"),
    (f"<main><aside>{LONG}</aside><p>{LONG}</p><div class='reader-comments'><article>{LONG} No.</article></div></main>", LONG),
    (f"<div class='with-sidebar'><article><p>{LONG}</p></article></div><div class=ad>{LONG}</div>", LONG),
    (f"<div><a href=1>Home</a></div><h1>Head</h1><div>{LONG}</div><p>End.</p><div>Legal</div>", f"Head\n\n{LONG}\n\nEnd."),
    (f"<form>{LONG}</form><style>p{{}}</style><article><p>one<br><br>two</p><p hidden>x</p></article>", "one\n\ntwo"),
    (f"<article><ul><li><a href=1>{LONG}</a></li></ul><p>kept</p></article>", "kept"),
    # inside an article too: a line of links goes, and an unmarked notice between two of them, short or without stop words
    (f"<article><p>{LONG}</p><p><a>One</a> <a>Two</a></p><p>{LONG}</p></article>", f"{LONG}\n\n{LONG}"),
    (f"<article><p>{LONG}</p><p><a>One</a></p><p>Subscribe today!</p><p><a>Two</a></p><p>{LONG}</p></article>", f"{LONG}\n\n{LONG}"),
    (f"<article><p>{LONG}</p><p><a>One</a></p><p>{'Buy cheap tickets today! ' * 5}</p><p><a>Two</a></p><p>End.</p></article>", f"{LONG}\n\nEnd."),
    (f"<article><p>{LONG}</p><p>{'Verse without such words, ' * 5}</p><p>Short.</p></article>", f"{LONG}\n\n{('Verse without such words, ' * 5).strip()}\n\nShort."),
    ("<article><p>İ<script>x</SCRIPT>y</p></article>", "İy"),
])
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_hostile_pages_end():
    for page in ("<div class=\"" * 3_000, "<p>" * 50_000, "<a b='" * 5_000 + "x", "&" * 100_000, "<div>" * 20_000 + "</p>" * 2_000):
        html_text.main_text(page)


def test_extract_keeps_rows(spark):
    rows = [(1, "u", f"<article>{LONG}</article>", "x"), (1, "u", f"<article>{LONG}</article>", "x"), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(html_text.extract_text(pages).collect(), key=str)
    assert [r["n_chars"] for r in got] == [len(LONG), len(LONG), 0]
    assert html_text.extract_text(pages.limit(0)).count() == 0


@shared
@pytest.mark.parametrize("name", ["op5_url_filters"])
def test_twin(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert compare.difference(got, compare.duck(SF).execute(queries.SQL[name]).df()) is None


WARC_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
named AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_id FROM payloads)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
  translate(array_to_string(list_transform([1, 11, 21, 31], lambda i: to_base(CAST('0x' || substr(hex, i, 10) AS BIGINT), 32, 8)), ''),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM named
"""


def test_archives_against_sql(spark, tmp_path):
    """Query and SQL agree, copies and NULL payloads among the pages."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    more = pages.selectExpr("page_id + 100000 AS page_id", "url", "CASE WHEN page_id % 5 = 0 THEN html WHEN page_id % 5 = 1 THEN 'one' WHEN page_id % 5 = 2 THEN NULL ELSE concat(page_id, html) END AS html")
    pages.union(more).coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = queries.QUERIES["op8_warc"](spark, str(tmp_path)).toPandas()
    con = compare.duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = con.execute(WARC_SQL).df()
    for frame in (got, want):
        frame["refers_to"] = frame["refers_to"].astype("float64")
    assert compare.difference(got, want) is None and (got["record_type"] == "revisit").sum() > 100


def test_url_rules(spark):
    urls = [
        None, "", "no scheme", "http://", "http://com", "http://com/", "HTTP://A.ExAmPlE.CoM/en/x?y#z", "x://www.example.com/en/",
        "x://notexample.com/en/", "a://b://c.net/es/", "http://example.net/fr", "http://x.net:80/fr/", "http://x.net/fr/#a/", "http://É.net/es/\n",
    ]
    pages = spark.createDataFrame([(k, u, "q") for k, u in enumerate(urls)] + [(6, urls[6], "q")], "page_id long, url string, host string")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    got = url_filter.judge_urls(pages, rules).collect()
    assert len(got) == len(urls) + 1
    by = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got}
    assert by[0] == by[1] == by[2] == by[3] == ("", "", None, "allow")
    assert by[4] == ("com", "", None, "allow") and by[5] == ("com", "/", "com/", "allow")
    assert by[6] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert by[7][2:] == ("www.example.com/en/", "allow") and by[8][2:] == ("com/", "allow")
    assert by[9] == ("b:", "//c.net/es/", None, "allow")
    assert by[10][2:] == (None, "allow") and by[11][:3] == ("x.net:80", "/fr/", None)
    assert by[12][2:] == ("net/fr/", "block") and by[13] == ("É.net", "/es/\n", "net/es/", "block")
    assert {r["verdict"] for r in url_filter.judge_urls(pages, rules.limit(0), "block").collect()} == {"block"}
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0


def test_many_rules_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BROADCAST_ROWS", 10)
    rules = spark.range(2_000).select(
        F.concat(F.lit("h"), F.col("id") % 50, F.lit(".org")).alias("host"), F.concat(F.lit("/p"), "id").alias("path"), F.lit("block").alias("verdict"),
    )
    pages = spark.range(400).select(
        F.col("id").alias("page_id"), F.concat(F.lit("http://www.h"), F.col("id") % 50, F.lit(".org/p"), F.col("id") * 3, F.lit("/x")).alias("url"),
    )
    got = {r["page_id"]: r["rule"] for r in url_filter.judge_urls(pages, rules).collect()}
    listed = {(f"h{i % 50}.org", f"/p{i}") for i in range(2_000)}
    for k in range(400):
        fits = [h + p for h, p in listed if h == f"h{k % 50}.org" and f"/p{k * 3}/x".startswith(p)]
        assert got[k] == max(fits, key=len, default=None)


def test_warc_round_trip(spark, tmp_path):
    tricky = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nz\n"
    rows = [
        (1, "http://a/", "same"), (2, "http://b/é", "same"), (3, None, None), (4, "http://c/", ""), (5, "http://d/", tricky), (6, "x\r\ny", "ü" * 70_000),
        (7, "http://e/", "twice"), (7, "http://e/", "twice"), (None, "http://f/", "none"),
    ]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, payload string")
    warc.write_archives(pages, str(tmp_path / "w"))
    got = warc.assemble(warc.read_records(spark, str(tmp_path / "w"))).collect()
    assert len(got) == len(rows)
    assert all(r["request"] is not None and r["metadata"] is not None for r in got)
    by = {}
    for r in got:
        about = dict(x.split(": ", 1) for x in bytes(r["metadata"]["payload"]).decode().split("\r\n") if ": " in x)
        by[about.get("page-id", "")] = r
    for page_id, url, html in rows:
        r = by["" if page_id is None else str(page_id)]
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert r["response"]["fields"]["warc-payload-digest"] == f"sha1:{digest}"
        assert r["kind"] == ("revisit" if page_id in (2, 4) else "response")
        assert bytes(r["response"]["payload"]) == (b"" if page_id in (2, 4) else data)
    assert by["2"]["response"]["fields"]["warc-refers-to"] == by["1"]["record_id"]
    warc.write_archives(pages.where("page_id < 3"), str(tmp_path / "large"), min_bytes=5)
    kinds = {r["kind"] for r in warc.assemble(warc.read_records(spark, str(tmp_path / "large"))).collect()}
    assert kinds == {"response"}


def test_warc_empty_and_foreign(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "none"))
    assert warc.assemble(warc.read_records(spark, str(tmp_path / "none"))).count() == 0

    def record(kind, ident, block, *more):
        head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{ident}>", *more, f"Content-Length: {len(block)}"]
        return b"WARC/1.0\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    # one gzip member a record, other order, two metadata records, one request that names nothing
    other = [
        record("warcinfo", "i", b"software: x"), record("metadata", "m2", b"b", "WARC-Concurrent-To: <r>"),
        record("metadata", "m1", b"a", "WARC-Concurrent-To: <r>"), record("request", "q", b"GET"), record("response", "r", b"\xff\x00"),
    ]
    folder = tmp_path / "other"
    folder.mkdir()
    (folder / "part-0.warc.gz").write_bytes(b"".join(map(gzip.compress, other)))
    one, = warc.assemble(warc.read_records(spark, str(folder))).collect()
    assert one["request"] is None and one["metadata"]["record_id"] == "<m1>" and bytes(one["response"]["payload"]) == b"\xff\x00"


@shared
def test_op8_against_brute_force(spark):
    pages = [(r["page_id"], (r["html"] or "").encode()) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    first = {}
    for page_id, data in sorted(pages):
        first.setdefault(data, page_id)
    want = {
        (p, len(d), base64.b32encode(hashlib.sha1(d).digest()).decode(), *(("response", None) if first[d] == p else ("revisit", first[d]))) for p, d in pages
    }
    got = queries.QUERIES["op8_warc"](spark, SF).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(pages)


def test_filter_of_many_rules_is_sent_round(spark):
    """Beyond the rules that may be broadcast the filter still is, and only keys that pass it are shuffled."""
    rules = spark.range(300_000).selectExpr("concat('h', id, '.com') AS host", "'/a/' AS path", "'block' AS verdict")
    urls = [f"http://{h}.h{k}.com/{p}/x" for k in range(0, 600_000, 60_001) for h in ("a", "b") for p in ("a", "b")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    judged = url_filter.judge_urls(pages, rules)
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [block" in plan and "BroadcastHashJoin [key" not in plan
    assert {r["page_id"] for r in judged.collect() if r["verdict"] == "block"} == {
        n for n, u in enumerate(urls) if "/a/" in u and int(u.split(".h")[1].split(".")[0]) < 300_000}


def test_long_urls(spark):
    pages = spark.createDataFrame([(1, "http://" + "a." * 3_000 + "net/es/" + "x/" * 50_000), (2, "http://net/" + "es/" * 100_000)], "page_id long, url string")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    got = {r["page_id"]: (r["rule"], len(r["host"]), len(r["path"])) for r in url_filter.judge_urls(pages, rules).collect()}
    assert got == {1: ("net/es/", 6_003, 100_004), 2: ("net/es/", 3, 300_001)}


def test_archives_of_large_payloads(spark, tmp_path, monkeypatch):
    """40 payloads of 10 MB: no file holds more than the bytes allowed, small ones lie apart."""
    pages = spark.range(60).selectExpr("id AS page_id", "'http://a/' AS url", "CASE WHEN id < 40 THEN concat(id, repeat('x', 10000000)) ELSE string(id) END AS html")
    folder = tmp_path / "w"
    warc.write_archives(pages, str(folder))
    sizes = []
    for file in folder.glob("part-*"):
        blocks = [len(block) for _, block in warc.walk_records(file.read_bytes())]
        sizes.append(sum(blocks))
    assert sum(sizes) > 400_000_000 and max(sizes) <= warc.FILE_BYTES
    got = warc.read_records(spark, str(folder)).where("record_type = 'response'").selectExpr("octet_length(payload) AS n").groupBy("n").count().collect()
    assert sorted(map(tuple, got)) == [(2, 20), (10_000_001, 10), (10_000_002, 30)]


def test_cut_archives_raise():
    whole = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    assert [block for _, block in warc.walk_records(whole * 2)] == [b"hello"] * 2
    for cut in (whole[:-6], whole[:-4].replace(b"Content-Length", b"Length")):
        with pytest.raises((ValueError, KeyError)):
            list(warc.walk_records(cut))
