import datetime as dt

import pytest

from minutebook.operators import payload_parse as p
from pyspark.sql import functions as F

REC = '{"volume":%d,"high":10.5,"low":10.1,"vwap":10.3,"count":4,"close":10.4,"open":10.2,"timestamp":"2024-01-02T%s:00.000"}'
R1, R2, R3 = (REC % (i, t) for i, t in ((1, "04:00"), (2, "04:01"), (3, "04:02")))
HEAD = "timestamp,open,high,low,close,volume,count,vwap"
LINE = "2024-01-02 04:00:00,10.2,10.5,10.1,10.4,120,4,10.3"


@pytest.fixture(scope="module")
def outcome(spark):
    def run(text):
        df = spark.createDataFrame([("A", "20240102", text)], "symbol string, date string, payload string")
        parsed = p.parse_payloads(df)
        row = parsed.first()
        return row.kind, row.parse_status, row.reject_reason, sorted(p.to_bars(parsed).collect(), key=lambda r: r.timestamp)

    return run


@pytest.mark.parametrize(
    "text, kind, status, volumes",
    [
        (f"[{R1},{R2}]", "json_array", "intact", [1, 2]),
        (f" [{R1}, {R2}]\n", "json_array", "intact", [1, 2]),
        (f'{{"data":[{R1},{R2}]}}', "json_wrapper", "intact", [1, 2]),
        (R1, "json_object", "intact", [1]),
        (f"[{R1},{R2}", "json_array", "repaired", [1, 2]),
        (f"[{R1},{R2},{R3[:-30]}", "json_array", "repaired", [1, 2]),
        (f"[{R1} {R2}]", "json_array", "repaired", [1, 2]),
        (f"[{R1}\n\t{R2}]", "json_array", "repaired", [1, 2]),
        (f"[{R1},,{R2}]", "json_array", "repaired", [1, 2]),
        (f"[{R1},{R2},]", "json_array", "repaired", [1, 2]),
        (f"[{R1}{R2}]", "json_array", "salvaged", [1, 2]),
        (f"[<{R1}##{R2}>]", "json_array", "salvaged", [1, 2]),
        (f"[{R1},{R2},{{broken}}]", "json_array", "salvaged", [1, 2]),
        (f"[{R1.upper()}]", "json_array", "intact", [1]),
        (f"{HEAD}\n{LINE}\n\n", "csv", "intact", [120]),
        (f"{HEAD.upper()}\r\n{LINE}\r\n", "csv", "intact", [120]),
        ("volume,close,low,high,open,timestamp\n7,1,1,1,1,2024-01-02 04:00:00", "csv", "intact", [7]),
    ],
)
def test_readable_payloads(outcome, text, kind, status, volumes):
    got_kind, got_status, reason, bars = outcome(text)
    assert (got_kind, got_status, reason) == (kind, status, None)
    assert [b.volume for b in bars] == volumes
    assert {b.symbol for b in bars} == {"A"} and bars[0].timestamp == dt.datetime(2024, 1, 2, 4)


@pytest.mark.parametrize(
    "text, kind, reason",
    [
        (None, "empty", "empty payload"), ("", "empty", "empty payload"), ("[ ]", "empty", "empty payload"),
        ("{}", "empty", "empty payload"), (HEAD, "empty", "empty payload"), (f"{HEAD}\n", "empty", "empty payload"),
        ("gateway timeout", "other", "unreadable payload"), ("[nothing here", "json_array", "unreadable payload"),
        ('{"error":{"code":472,"message":"no data"}}', "error", "[472] no data"),
        ('{"error":{"code":500}}', "error", "[500] Unknown error"), ('{"error":"down"}', "error", "down"),
        ('{"isError":true,"content":[{"type":"text","text":"bad symbol"}]}', "error", "bad symbol"),
        ('{"status":"ok"}', "json_object", "Missing columns: timestamp, open, high, low, close, volume"),
        ('[{"open":1,"high":1,"low":1,"timestamp":"2024-01-02T04:00:00"}]', "json_array", "Missing columns: close, volume"),
        ("timestamp,open,high,low,close\n2024-01-02 04:00:00,1,1,1,1", "csv", "Missing columns: volume"),
        (f"[{R1},{R2}]".replace("10.4", '"ten"'), "json_array", "type_error"),
        (f"{HEAD}\n{LINE}".replace("10.4", "ten"), "csv", "type_error"),
        (f"[{R1}]".replace("2024-01-02T", "day "), "json_array", "type_error"),
    ],
)
def test_rejected_payloads(outcome, text, kind, reason):
    got_kind, _, got_reason, bars = outcome(text)
    assert (got_kind, got_reason, bars) == (kind, reason, [])


def test_field_in_any_record_counts_and_nulls_stay(outcome):
    other = R2.replace('"volume":2,', "").replace('"open":10.2', '"open":null')
    *_, reason, bars = outcome(f"[{R1},{other}]")
    assert reason is None and [b.volume for b in bars] == [1, None] and bars[1].open is None


def test_field_null_in_every_record_is_not_missing(outcome):
    *_, reason, bars = outcome(f"[{R1}]".replace('"volume":1', '"volume":null'))
    assert reason is None and bars[0].volume is None


def test_nan_becomes_null(outcome):
    *_, reason, bars = outcome(f"[{R1}]".replace('"open":10.2', '"open":NaN'))
    assert reason is None and bars[0].open is None
    *_, reason, bars = outcome(f"{HEAD}\n{LINE}".replace("10.2", "NaN"))
    assert reason is None and bars[0].open is None


def test_wrapped_nan_and_odd_names_are_read(outcome):
    """A wrapper is read by one typed parse, or as text where a value or a name asks for it."""
    nan = R2.replace('"high":10.5', '"high":NaN')
    kind, _, reason, bars = outcome(f'{{"status":"ok","data":[{R1},{nan}]}}')
    assert (kind, reason, [b.high for b in bars]) == ("json_wrapper", None, [10.5, None])
    kind, _, reason, bars = outcome(f'{{"data":[{R1.replace("vwap", "VWAP")}]}}')
    assert (kind, reason, [b.vwap for b in bars]) == ("json_wrapper", None, [10.3])
    kind, _, reason, bars = outcome(f'{{"data":[{R1}],"error":{{"code":4,"message":"late"}}}}')
    assert (kind, reason, bars) == ("error", "[4] late", [])
    kind, _, reason, bars = outcome(f'{{"data":[{nan}],"error":"late"}}')
    assert (kind, reason, bars) == ("error", "unreadable payload", [])


def test_whole_wrappers_are_parsed_once(spark):
    rows = spark.createDataFrame([("A", "20240102", f'{{"data":[{R1}]}}')], "symbol string, date string, payload string")
    parsed = p.read_records(rows)
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    envelope = [line for line in plan.splitlines() if "isError,StringType" in line]
    assert len(envelope) == 1 and envelope[0].count("from_json") == 1
    assert parsed.first().records[0].close == 10.4


def test_offsets_move_to_exchange_time(outcome):
    *_, bars = outcome(f"[{R1}]".replace("T04:00:00.000", "T14:30:00Z"))
    assert bars[0].timestamp == dt.datetime(2024, 1, 2, 9, 30)
    *_, bars = outcome(f"[{R1}]".replace("2024-01-02T04:00:00.000", "2024-07-02T14:30:00+00:00"))
    assert bars[0].timestamp == dt.datetime(2024, 7, 2, 10, 30) and bars[0].date == "20240702"


def test_text_parts_are_joined(spark):
    parts = "array<struct<type: string, text: string>>"
    rows = [([("text", " a"), ("image", "x"), ("text", "  "), ("text", "b \n")],), ([("text", " ")],), ([],)]
    df = spark.createDataFrame(rows, f"parts {parts}")
    assert [r[0] for r in df.select(p.joined_text(F.col("parts"))).collect()] == ["ab", None, None]


def test_csv_hints(spark):
    texts = [HEAD + "\n", f"[{R1}]", "hello", " ", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, payload string")
    got = [r[0] for r in df.orderBy("i").select(p.csv_hints(F.col("payload"))).collect()]
    assert got[:4] == [9, 8, 2, 0]
