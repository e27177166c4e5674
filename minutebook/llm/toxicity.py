"""Toxicity scores from FTRL-proximal logistic regression over hashed word features.

Features of a text: its words, their beginnings (so that endings not met in training still count), word pairs, and pairs
that skip one word, each hashed to one of 2**20 coordinates and taken as present or absent; what a text has more than once sets a
second coordinate. Every coordinate has its own learning rate, and the
L1 term leaves all but a few at exactly zero; only those weights travel with the job that scores. Hashing works on whole
batches of bytes in numpy; a text's features are looked up first and only those with a weight are made unique.

Defined results: NULL, empty and wordless texts score by the bias alone; without labelled documents every score is 0; of several
labels of a document the highest counts; repeated documents are each scored; other columns play no part; no documents give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minutebook.llm.common import bounded_sample, held_out

BITS = 20
SAMPLE_DOCS = 12_000  # labelled documents to learn from, at most
ALPHA, BETA, L1, L2 = 2.0, 1.0, 5.0, 0.01
PASSES = 5
CHUNK = 1 << 20  # bytes hashed at once (or one text, if longer)
BEGINNINGS = (4, 5)  # bytes
THRESHOLD = 0.7

ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


@dataclass(frozen=True)
class Model:
    """Coordinates with a weight, and the bias."""

    index: np.ndarray
    weight: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << BITS, np.float32)
        table[self.index] = self.weight
        return table


class Hasher:
    """Feature coordinates of batches of texts."""

    def __init__(self):
        self._powers = self._inverses = np.ones(1, np.uint64)
        # letters, digits and all bytes of non-ASCII characters make words
        self._in_word = np.array([chr(b).isalnum() or b > 127 for b in range(256)])

    def _grow(self, n: int) -> None:
        if n > len(self._powers):
            base = np.uint64(ODD[0])
            inverse = np.uint64(pow(ODD[0], -1, 1 << 64))
            self._powers = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, base)], dtype=np.uint64)
            self._inverses = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, inverse)], dtype=np.uint64)

    def features(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Coordinates, and the text each belongs to. ``offsets`` are the texts' borders in the bytes."""
        n = len(data)
        if not n:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        self._grow(n)
        word = np.r_[False, self._in_word[data], False]
        border = np.zeros(n + 1, bool)
        border[offsets] = True
        begin = np.flatnonzero(word[1:-1] & (~word[:-2] | border[:-1]))
        end = np.flatnonzero(word[1:-1] & (~word[2:] | border[1:])) + 1
        owner = np.searchsorted(offsets, begin, side="right") - 1
        sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._powers[:n], dtype=np.uint64)]
        shift = self._inverses[begin]
        words = (sums[end] - sums[begin]) * shift
        kinds, owners = [words * np.uint64(ODD[1])], [owner]
        for k, size in enumerate(BEGINNINGS):
            longer = end - begin > size
            at = begin[longer]
            kinds.append(((sums[at + size] - sums[at]) * shift[longer] + np.uint64(k + 1)) * np.uint64(ODD[2]))
            owners.append(owner[longer])
        for k, step in enumerate((1, 2)):
            same = owner[step:] == owner[:-step]
            kinds.append((words[:-step][same] * np.uint64(ODD[3 + k]) + words[step:][same]) * np.uint64(ODD[5]))
            owners.append(owner[:-step][same])
        mixed = np.concatenate(kinds)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(ODD[4])
        return (mixed >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(owners)

    def batches(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """First and last text of each chunk, coordinates, and the text each belongs to."""
        texts = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
        if not len(texts):
            return
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        group = (offsets[:-1] - offsets[0]) // CHUNK
        cuts = np.r_[0, np.flatnonzero(np.diff(group)) + 1, len(texts)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            index, owner = self.features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            yield int(a), int(b), index, owner


def _repeated(index: np.ndarray) -> np.ndarray:
    """The coordinates that say a feature occurs more than once."""
    return (index * 0x2545F491 + 0x1B873) & ((1 << BITS) - 1)


def _distinct(owner: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts, ascending, and the coordinates each has, also those of what repeats."""
    pairs, counts = np.unique(owner << BITS | index, return_counts=True)
    again = pairs[counts > 1]
    again = (again >> BITS) << BITS | _repeated(again & ((1 << BITS) - 1))
    pairs = np.union1d(pairs, again)
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def train(texts: pa.Array, labels: np.ndarray) -> Model:
    """FTRL-proximal over the texts in a fixed mixed order, several passes."""
    hasher, docs = Hasher(), []
    for a, b, index, owner in hasher.batches(texts):
        owner, index = _distinct(owner, index)
        docs += np.split(index.astype(np.int32), np.searchsorted(owner, np.arange(1, b - a)))
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_z = bias_n = 0.0
    order = np.random.default_rng(5).permutation(len(docs))
    for _ in range(PASSES):
        for d in order:
            index = docs[d]
            zi, ni = z[index], n[index]
            w = np.where(np.abs(zi) > L1, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2), 0.0)
            bias = -bias_z / ((BETA + np.sqrt(bias_n)) / ALPHA)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - labels[d]
            z[index] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[index] = ni + g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / ALPHA * bias
            bias_n += g * g
    index = np.flatnonzero(np.abs(z) > L1)
    zi = z[index]
    weight = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[index])) / ALPHA + L2)
    return Model(index.astype(np.int32), weight.astype(np.float32), float(-bias_z / ((BETA + np.sqrt(bias_n)) / ALPHA)))


def scorer(model: Model | None) -> Callable[[pa.Array], np.ndarray]:
    """Scores of batches of texts."""
    if model is None:
        return lambda texts: np.zeros(len(texts))
    hasher, table = Hasher(), model.dense()

    def scores(texts: pa.Array) -> np.ndarray:
        sums = np.full(len(texts), model.bias)
        for a, b, index, owner in hasher.batches(texts):
            weighted = (table[index] != 0) | (table[_repeated(index)] != 0)
            owner, index = _distinct(owner[weighted], index[weighted])
            sums[a:b] += np.bincount(owner, table[index], b - a)
        return 1 / (1 + np.exp(-np.clip(sums, -35, 35)))

    return scores


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """A model learned from the labelled documents that are not held out; None if there are none."""
    marks = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = bounded_sample(marks.where(~held_out(F.col("doc_id"))), "doc_id", sample_docs)
    # The sample is bounded; the documents that it names are found by a join, and duplicates of an id thin out to one.
    rows = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id").groupBy("doc_id", "toxic").agg(F.max("text").alias("text"))
    rows = rows.repartition(1).sortWithinPartitions("doc_id")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is not None and len(table):
            model = train(table["text"].cast(pa.large_string()).combine_chunks(), np.asarray(table["toxic"]).astype(float))
            yield pa.RecordBatch.from_arrays(
                [pa.array([model.index.tobytes()]), pa.array([model.weight.tobytes()]), pa.array([model.bias])], ["index", "weight", "bias"]
            )

    found = rows.mapInArrow(learn, "index binary, weight binary, bias double").first()
    if found is None:
        return None
    return Model(np.frombuffer(bytes(found["index"]), np.int32), np.frombuffer(bytes(found["weight"]), np.float32), found["bias"])


def predict(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = scorer(model)
        for batch in batches:
            found = scores(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scored, f"doc_id {kind}, held_out boolean, score double, predicted int")


def tolerable(model: Model | None, threshold: float = THRESHOLD) -> Callable[[pa.Array], np.ndarray]:
    """A decision over batches of texts: whether they stay below the threshold."""
    state: list[Callable[[pa.Array], np.ndarray]] = []

    def decide(texts: pa.Array) -> np.ndarray:
        if not state:
            state.append(scorer(model))
        return state[0](texts) < threshold

    return decide
