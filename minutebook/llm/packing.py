"""Packing of documents into sequences of one window by minimum bin slack.

A document's ids (and an end id) are cut into full windows and one remaining piece. How many pieces have each length is a
histogram of at most ``window`` rows, whatever the number of documents, and packing is planned on it alone: the longest length
left opens a sequence, and a dynamic program over a bit set of reachable sums picks the multiset of the other lengths that
comes closest to the room left; backtracking through the stored bit sets gives the count of each length. The multiset is then used as
often as the counts allow, so each step exhausts a length and the plan has a few thousand steps at most. Pieces take their places by
their rank among the pieces of their length. Ranks are counted in buckets of hashed pieces, so that a length which many pieces
share is dealt over many tasks.

Defined results: NULL and empty texts are the end id alone; repeated rows are packed one by one; no documents give no rows;
further columns of the pieces are carried, those of the documents are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from minutebook.llm.encoding import Encoder

WINDOW = 2048
END_ID = 1
BUCKET_ROWS = 50_000

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"
PLACE = "sequence_id long, offset long"


def cut_documents(docs: DataFrame, path: str | None = None, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, doc_tokens and ids (little-endian, unsigned, 32 bits) of every piece of every document."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        schema = pa.schema([
            ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary()),
        ])
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.append(np.frombuffer(encoder.ids(text.as_py()), "<u4"), np.uint32(end_id)).astype("<u4")
                key, total = doc_id.as_py(), len(ids)
                for start in range(0, total, window):
                    piece = ids[start:start + window]
                    for column, value in zip(rows, (key, start, len(piece), total, piece.tobytes()), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def closest_multiset(room: int, counts: np.ndarray) -> dict[int, int]:
    """Lengths and how many of each, whose sum is the largest that fits the room. ``counts[n]`` pieces have length n."""
    reached, mask = 1, (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []  # a length, how many of it at once, the sums reached before
    for length in np.flatnonzero(counts[:room + 1])[::-1].tolist():
        left, part = min(int(counts[length]), room // length), 1
        while left:
            part = min(part, left)
            steps.append((length, part, reached))
            reached |= (reached << (length * part)) & mask
            left -= part
            part *= 2
            if reached >> room:
                break
        if reached >> room:
            break
    at, picked = reached.bit_length() - 1, {}
    for length, part, before in reversed(steps):
        if not before >> at & 1:
            picked[length] = picked.get(length, 0) + part
            at -= length * part
    return picked


def plan(histogram: dict[int, int], window: int = WINDOW) -> np.ndarray:
    """Places for the pieces of each length, as rows (length, first rank, copies a sequence, first sequence, first offset).

    Rows are sorted by length and first rank; a row holds until the next of its length.
    """
    counts = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    used, sequence, rows = np.zeros(window + 1, np.int64), 0, []
    for longest in range(window, 0, -1):
        while counts[longest]:
            counts[longest] -= 1
            picked = closest_multiset(window - longest, counts)
            counts[longest] += 1
            picked[longest] = picked.get(longest, 0) + 1
            times = min(int(counts[n]) // k for n, k in picked.items())
            offset = 0
            for length in sorted(picked, reverse=True):
                copies = picked[length]
                rows.append((length, used[length], copies, sequence, offset))
                used[length] += copies * times
                counts[length] -= copies * times
                offset += copies * length
            sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """The pieces (doc_id, start, length, and any other columns) with their sequence_id and offset.

    ``pieces`` is read several times and must be stored (see ``common.staged``).
    """
    columns = pieces.columns
    by_length = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in by_length.collect()}  # one row per length: at most ``window``
    places = plan(histogram, window)
    buckets = max(8, sum(histogram.values()) // BUCKET_ROWS)
    others = [c for c in columns if c not in ("doc_id", "start", "length")]
    bucketed = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    ranks = bucketed.withColumn(
        "_rank", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("doc_id", "start", *others)) - 1
    )
    earlier = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = bucketed.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n")).select(
        "length", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first")
    )
    ranked = ranks.join(first, ["length", "_bucket"]).select(*columns, (F.col("_first") + F.col("_rank")).alias("_rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one sortable number for (length, first rank)
        wide = int(places[:, 1].max(initial=0)) + 1
        starts = places[:, 0] * wide + places[:, 1]
        for batch in batches:
            length = np.asarray(batch.column("length"))
            rank = np.asarray(batch.column("_rank"))
            row = places[np.searchsorted(starts, length * wide + np.minimum(rank, wide - 1), side="right") - 1]
            ahead = rank - row[:, 1]
            sequence = row[:, 3] + ahead // row[:, 2]
            offset = row[:, 4] + ahead % row[:, 2] * length
            kept = batch.select(columns)
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], [*columns, "sequence_id", "offset"]
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(place, f"{kinds}, {PLACE}")
