"""Raw payloads to bars.

A payload row is (symbol, date, payload text) and holds one symbol-day. All work is
row-local: no shuffle before the bars are exploded, and the repair and salvage branches
are evaluated only on rows whose text does not parse.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minutebook.functions.guards import bind, nan_to_null
from minutebook.functions.times import date_text, ms_of_day

REQUIRED = ["timestamp", "open", "high", "low", "close", "volume"]
NUMERIC = ["open", "high", "low", "close", "volume"]
FIELDS = [*REQUIRED, "count", "vwap"]
TYPED = ", ".join(f"{f}: {'timestamp_ntz' if f == 'timestamp' else 'double'}" for f in FIELDS)
TYPED_RECORDS = f"array<struct<{TYPED}>>"
TEXT_RECORDS = "array<struct<" + ", ".join(f"{f}: string" for f in FIELDS) + ">>"
# An object payload read once for its shape and its bars; ``broken`` is set where the text or any value in it does not convert.
ENVELOPE = f"struct<error: string, isError: string, data: {TYPED_RECORDS}, broken: string>"
EXCHANGE_ZONE = "America/New_York"

# Fixed value: shape of one whole record as the data service writes it.
RECORD_PATTERN = r'\{"volume":\d+,"high":[\d.]+,"low":[\d.]+,"vwap":[\d.]+,"count":\d+,"close":[\d.]+,"open":[\d.]+,"timestamp":"[^"]+"\}'


# CSV cells that mean "no value".
CSV_NULLS = ["", "NA", "N/A", "NULL", "NAN", "NONE", "<NA>", "#N/A"]


def _edge_trim(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\r\n\f\x0b"))


# --- classification ---------------------------------------------------------------

def csv_hints(payload: Column) -> Column:
    """How many of nine signs of a CSV header the first line shows."""
    return bind(F.lower(_edge_trim(F.substring_index(payload, "\n", 1))), _header_signs)


def _header_signs(line: Column) -> Column:
    signs = [line.contains(w) for w in REQUIRED]
    signs += [line.contains(","), ~line.startswith("["), ~line.startswith("{")]
    hints = reduce(lambda a, b: a + b, [s.cast("int") for s in signs])
    return F.when(F.length(line) > 0, hints).otherwise(F.lit(0))


def read_envelope(payload: Column) -> Column:
    """Error marks and typed records of an object payload, from one parse; NULL for other payloads."""
    options = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "broken"}
    return F.when(_edge_trim(payload).startswith("{"), F.from_json(payload, ENVELOPE, options))


def _object_kind(text: Column, envelope: Column) -> Column:
    """Shape of an object: by its envelope, or field by field where that did not convert whole."""
    def by(error: Column, flag: Column, data: Column) -> Column:
        return (
            F.when(error.isNotNull() | F.coalesce(flag == "true", F.lit(False)), "error")
            .when(data.isNotNull(), "json_wrapper").otherwise("json_object")
        )

    fields = by(*[F.get_json_object(text, f"$.{f}") for f in ("error", "isError", "data")])
    converted = envelope.isNotNull() & envelope["broken"].isNull()
    return F.when(converted, by(envelope["error"], envelope["isError"], envelope["data"])).otherwise(fields)


def payload_kind(payload: Column, envelope: Column | None = None) -> Column:
    """csv, json_array, json_object, json_wrapper, error, empty or other.

    JSON prefixes are tested before the CSV hints, which a one-line JSON array also meets. ``envelope`` is that of
    ``read_envelope``, if it is at hand.
    """
    def kind(text: Column) -> Column:
        blank = text.rlike(r"^(?:\[\s*\]|\{\s*\}|null)?$")
        has_header = csv_hints(text) >= 5
        of_object = _object_kind(text, envelope) if envelope is not None else bind(read_envelope(text), lambda e: _object_kind(text, e))
        return (
            F.when(text.isNull() | blank, "empty")
            .when(text.startswith("["), "json_array")
            .when(text.startswith("{"), of_object)
            .when(has_header & ~text.contains("\n"), "empty")
            .when(has_header, "csv")
            .otherwise("other")
        )

    return bind(_edge_trim(payload), kind)


def classify(payloads: DataFrame) -> DataFrame:
    """Add ``kind`` and the raw hint count."""
    p = F.col("payload")
    return payloads.withColumns({"kind": payload_kind(p), "csv_hints": csv_hints(p)})


def nonempty(payloads: DataFrame) -> DataFrame:
    """Payloads that hold anything: no NULL, blank, [], {} or a lone CSV header."""
    return payloads.filter(payload_kind(F.col("payload")) != "empty")


# --- messages ---------------------------------------------------------------------

def error_message(payload: Column) -> Column:
    """``[code] message`` of an error envelope, its plain text, or NULL."""
    error = F.get_json_object(payload, "$.error")
    code = F.coalesce(F.get_json_object(payload, "$.error.code"), F.lit("None"))
    message = F.coalesce(F.get_json_object(payload, "$.error.message"), F.lit("Unknown error"))
    structured = F.concat(F.lit("["), code, F.lit("] "), message)
    flagged = F.get_json_object(payload, "$.isError") == "true"
    flag_text = F.coalesce(F.get_json_object(payload, "$.content[0].text"), F.lit(""))
    return F.when(
        _edge_trim(payload).startswith("{"),
        F.when(flagged, flag_text).when(error.startswith("{"), structured).otherwise(error),
    )


def payload_errors(payloads: DataFrame) -> DataFrame:
    """Error envelopes as reject rows."""
    return (
        payloads.select("symbol", "date", error_message(F.col("payload")).alias("reason"))
        .filter(F.col("reason").isNotNull())
    )


def joined_text(parts: Column) -> Column:
    """Text parts of a multi-part message, blank ones skipped, joined and stripped."""
    texts = F.filter(parts, lambda p: (p["type"] == "text") & (F.length(_edge_trim(p["text"])) > 0))
    joined = F.array_join(F.transform(texts, lambda p: p["text"]), "")
    return F.when(F.size(texts) > 0, _edge_trim(joined))


# --- JSON -------------------------------------------------------------------------

# A field name that is not in lower case, in any record.
ODD_CASE = rf'"(?!(?:{"|".join(FIELDS)})")(?i:{"|".join(FIELDS)})"\s*:'


def _lower_keys(text: Column) -> Column:
    for f in FIELDS:
        text = F.regexp_replace(text, rf'(?i)"{f}"(\s*:)', f'"{f}"$1')
    return text


def _typed_records(text: Column) -> Column:
    """Records in their final types; a value that does not convert is NULL here."""
    return F.from_json(text, TYPED_RECORDS, {"allowSingleQuotes": "false"})


def _text_records(text: Column) -> Column:
    """Records as text, to tell a wrong value from a missing one."""
    return F.from_json(text, TEXT_RECORDS, {"allowSingleQuotes": "false"})


def _whole(records: str) -> Column:
    """There are records, and every required field of each has a value."""
    lacking = lambda r: reduce(lambda a, b: a | b, [r[f].isNull() for f in REQUIRED])
    return F.coalesce((F.size(records) > 0) & ~F.exists(records, lacking), F.lit(False))


def repair_json(payload: Column) -> Column:
    """Close an open array, cut a broken tail, add or drop commas."""
    text = _edge_trim(payload)
    cut = F.concat(F.regexp_extract(text, r"(?s)^(.*\})", 1), F.lit("]"))
    closed = (
        F.when(~text.startswith("["), text)
        .when(text.endswith("}"), F.concat(text, F.lit("]")))
        .when(~text.endswith("]") & text.contains("}"), cut)
        .otherwise(text)
    )
    # The four patterns say which damage is mended, in this order.
    fixed = F.regexp_replace(closed, r"\}(\s+)\{", r"},$1{")
    fixed = F.regexp_replace(fixed, r",\s*,", ",")
    fixed = F.regexp_replace(fixed, r",(\s*\])", "$1")
    return F.regexp_replace(fixed, r",(\s*\})", "$1")


def salvage_json(payload: Column) -> Column:
    """All whole records found in the text, as a JSON array; NULL if there are none."""
    found = F.regexp_extract_all(payload, F.lit(RECORD_PATTERN), F.lit(0))
    return F.when(F.size(found) > 0, F.concat(F.lit("["), F.array_join(found, ","), F.lit("]")))


def missing_fields(records: Column, payload: Column) -> Column:
    """Required fields that no record of a JSON payload has.

    A field with a value somewhere is present; one that is null throughout is looked up by name.
    """
    def absent(f: str) -> Column:
        valued = F.coalesce(F.exists(records, lambda r: r[f].isNotNull()), F.lit(False))
        return F.when(~valued & ~payload.rlike(rf'(?i)"{f}"\s*:'), F.lit(f))

    return F.array_compact(F.array(*[absent(f) for f in REQUIRED]))


# --- CSV --------------------------------------------------------------------------

def _data_lines(payload: Column) -> Column:
    lines = F.split(_edge_trim(payload), "\n")
    return F.filter(lines, lambda line, i: (i > 0) & (F.length(F.btrim(line)) > 0))


def _csv_header(payload: Column) -> Column:
    return F.lower(_edge_trim(F.substring_index(_edge_trim(payload), "\n", 1)))


def _typed_csv(payload: Column) -> Column:
    return F.transform(_data_lines(payload), lambda line: F.from_csv(line, TYPED.replace(":", "")))


def _text_csv(payload: Column, header: Column) -> Column:
    """Cells looked up by header name, in any order and case."""
    def cell(cells: Column, name: str) -> Column:
        at = F.array_position(header, name)
        value = _edge_trim(F.get(cells, (at - 1).cast("int")))
        return F.when((at > 0) & ~F.upper(value).isin(CSV_NULLS), value).alias(name)

    return F.transform(
        F.transform(_data_lines(payload), lambda line: F.split(line, ",")),
        lambda cells: F.struct(*[cell(cells, f) for f in FIELDS]),
    )


# --- reading ----------------------------------------------------------------------

def read_records(payloads: DataFrame) -> DataFrame:
    """Add ``kind``, ``records`` (array of typed structs), ``parse_status``, ``missing`` and ``bad_types``.

    Status: intact, repaired, salvaged or unreadable; NULL for payloads without bars by kind.
    Whole payloads are read straight into their types. Only those with gaps, odd values or
    broken text are read again, as text; each attempt is evaluated only where the one before failed.
    """
    p, kind = F.col("payload"), F.col("kind")
    wrapped = F.col("_envelope.data")
    text = (
        F.when(kind == "json_array", p)
        .when(kind == "json_wrapper", F.when(~F.col("_unwrapped"), F.get_json_object(p, "$.data")))
        .when(kind == "json_object", F.concat(F.lit("["), p, F.lit("]")))
    )
    is_json, is_csv = kind.isin("json_array", "json_wrapper", "json_object"), kind == "csv"
    usable = lambda name: F.coalesce(F.size(name) > 0, F.lit(False))
    whole, again = F.col("_whole"), ~F.col("_whole")

    step = payloads.withColumn("_envelope", read_envelope(p))
    step = step.withColumn("kind", payload_kind(p, F.col("_envelope")))
    # the records of a whole wrapper are at hand already; all others are taken from their text
    at_hand = (kind == "json_wrapper") & F.col("_envelope.broken").isNull() & _whole("_envelope.data") & ~p.rlike(ODD_CASE)
    step = step.withColumn("_unwrapped", F.coalesce(at_hand, F.lit(False)))
    step = step.withColumn("_text", text)
    step = step.withColumn("_text", F.when(F.col("_text").rlike(ODD_CASE), _lower_keys(F.col("_text"))).otherwise(F.col("_text")))
    plain_order = is_csv & (_csv_header(p) == ",".join(FIELDS))
    step = step.withColumn("_typed", F.when(F.col("_unwrapped"), wrapped).when(plain_order, _typed_csv(p)).otherwise(_typed_records(F.col("_text"))))
    step = step.withColumn("_repaired", F.when(is_json & F.col("_typed").isNull(), _lower_keys(repair_json(p))))
    step = step.withColumn("_retyped", _typed_records(F.col("_repaired")))
    step = step.withColumns({"_first": _whole("_typed"), "_second": _whole("_retyped")})
    step = step.withColumn("_whole", F.col("_first") | F.col("_second"))
    step = step.withColumns(
        {
            "_plain": F.when(again & is_json, _text_records(F.col("_text"))),
            "_header": F.when(again & is_csv, F.transform(F.split(_csv_header(p), ","), F.trim)),
        }
    )
    plain_failed = again & is_json & F.col("_plain").isNull()
    step = step.withColumns(
        {
            "_fixed": F.when(plain_failed, _text_records(F.col("_repaired"))),
            "_cells": F.when(F.col("_header").isNotNull(), _text_csv(p, F.col("_header"))),
        }
    )
    step = step.withColumn("_found", F.when(plain_failed & ~usable("_fixed"), _text_records(salvage_json(p))))
    texts = F.coalesce(
        "_cells", "_plain", F.when(usable("_fixed"), F.col("_fixed")), F.col("_found")
    )
    step = step.withColumn("_texts", F.when(again, texts))
    named = F.array(*map(F.lit, REQUIRED))
    return step.select(
        *payloads.columns,
        "kind",
        F.when(F.col("_first"), F.col("_typed")).when(F.col("_second"), F.col("_retyped"))
        .otherwise(F.transform("_texts", _convert)).alias("records"),
        F.when(is_csv | F.col("_first") | F.col("_plain").isNotNull(), "intact")
        .when(F.col("_second") | usable("_fixed"), "repaired")
        .when(usable("_found"), "salvaged")
        .when(is_json, "unreadable")
        .alias("parse_status"),
        F.when(again & is_csv, F.array_except(named, F.col("_header")))
        .when(usable("_texts"), missing_fields(F.col("_texts"), p))
        .alias("missing"),
        F.when(again, bad_types(F.col("_texts"))).otherwise(F.lit(False)).alias("bad_types"),
    )


# --- checks and typing ------------------------------------------------------------

def _as_double(text: Column) -> Column:
    # a bare NaN or Infinity token of JSON reaches us in quotes
    return F.coalesce(text.try_cast("double"), F.btrim(text, F.lit('"')).try_cast("double"))


def to_bar_time(text: Column) -> Column:
    """Wall-clock exchange time; text with an offset is moved to the exchange's zone."""
    zoned = text.rlike(r"\d{2}:\d{2}.*(?:Z|[+-]\d{2}:?\d{2})$")
    local = F.convert_timezone(
        F.lit("UTC"), F.lit(EXCHANGE_ZONE), text.try_cast("timestamp").cast("timestamp_ntz")
    )
    return F.when(zoned, local).otherwise(text.try_cast("timestamp_ntz"))


def _convert(r: Column) -> Column:
    """A text record in its final types."""
    return F.struct(*[(to_bar_time(r[f]) if f == "timestamp" else _as_double(r[f])).alias(f) for f in FIELDS])


def bad_types(records: Column) -> Column:
    """Some non-null number or timestamp of the payload does not convert."""
    def bad(r: Column) -> Column:
        cond = r["timestamp"].isNotNull() & to_bar_time(r["timestamp"]).isNull()
        for f in NUMERIC:
            cond = cond | (r[f].isNotNull() & _as_double(r[f]).isNull())
        return cond

    return F.coalesce(F.exists(records, bad), F.lit(False))


def parse_payloads(payloads: DataFrame) -> DataFrame:
    """Read every payload and add ``reject_reason``; NULL means its bars are usable.

    The outcome leaves as the row of a generator: filters on it then stay above the parsing
    steps, where pushing them down would copy each step into the filter.
    """
    kind = F.col("kind")
    reason = (
        F.when(kind == "error", F.coalesce(error_message(F.col("payload")), F.lit("unreadable payload")))
        .when(kind == "empty", "empty payload")
        .when(F.coalesce(F.size("records"), F.lit(0)) <= 0, "unreadable payload")
        .when(F.size("missing") > 0, F.concat(F.lit("Missing columns: "), F.array_join("missing", ", ")))
        .when(F.col("bad_types"), "type_error")
    )
    outcome = F.struct("kind", "records", "parse_status", reason.alias("reject_reason"))
    return read_records(payloads).select(*payloads.columns, F.inline(F.array(outcome)))


def to_bars(parsed: DataFrame, keep_rejects: bool = False) -> DataFrame:
    """Typed bars of all accepted payloads; the symbol is the requested one.

    With ``keep_rejects`` a rejected payload stays as one row that has its requested date,
    its ``reject_reason`` and no bar.
    """
    r = F.col("r")
    reason = F.col("reject_reason")
    usable = F.when(reason.isNull(), F.col("records"))
    rows = parsed.select("symbol", "date", "reject_reason", F.explode_outer(usable).alias("r"))
    typed = rows.select(
        "symbol",
        F.col("date").alias("_requested"),
        "reject_reason",
        r["timestamp"].alias("timestamp"),
        *[nan_to_null(r[f]).alias(f) for f in NUMERIC],
        nan_to_null(r["count"]).try_cast("long").alias("count"),
        nan_to_null(r["vwap"]).alias("vwap"),
    )
    typed = typed.filter(
        F.col("timestamp").isNotNull() | F.col("reject_reason").isNotNull() if keep_rejects
        else F.col("timestamp").isNotNull()
    )
    return typed.select(
        F.coalesce(date_text(F.col("timestamp")), F.col("_requested")).alias("date"),
        "symbol",
        "timestamp",
        ms_of_day(F.col("timestamp")).alias("ms_of_day"),
        *NUMERIC,
        "count",
        "vwap",
        *(["reject_reason"] if keep_rejects else []),
    )


def parse_bars(payloads: DataFrame) -> DataFrame:
    """Payloads to bars in one step."""
    return to_bars(parse_payloads(payloads))


def parse_rejects(payloads: DataFrame) -> DataFrame:
    """Payloads without usable bars, as reject rows."""
    return (
        parse_payloads(payloads)
        .filter(F.col("reject_reason").isNotNull())
        .select("date", "symbol", F.col("reject_reason").alias("reason"))
    )
