"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads UTF-8 bytes in windows, forwards and backwards, and gives every byte a probability for each language; the
mean over a document's bytes is the document's. Gates are hard sigmoids and the candidate is clipped to [-1, 1], so a step is a
handful of array operations over thousands of windows at once. It is trained in numpy by backpropagation through time, in
one task, on a bounded sample of labelled documents; the weights (some 50 KB) travel with the job that applies them.

Defined results: a text that is NULL, empty or without a letter is ``und`` with score 0, as is every text if no labelled
document exists to learn from; ties go to the language first in the alphabet; repeated rows are each labelled;
other columns play no part; no rows give no rows.
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

UNDETERMINED = "und"
SAMPLE_DOCS = 2_000  # documents to learn from, at most
HIDDEN = 8
STEPS, BATCH, SPAN = 300, 192, 64  # training: updates, windows an update, bytes a window
WINDOW, WINDOWS = 128, 4_096  # applying: bytes a window, windows at once
SEED = 7


@dataclass(frozen=True)
class Model:
    """Languages and weights: for each direction the input table, the recurrent matrix and the candidate's bias; then the output's."""

    languages: tuple[str, ...]
    forward: tuple[np.ndarray, np.ndarray, np.ndarray]
    backward: tuple[np.ndarray, np.ndarray, np.ndarray]
    output: np.ndarray
    bias: np.ndarray


def _run(x: np.ndarray, cell: tuple[np.ndarray, ...], trace: bool = False) -> tuple[np.ndarray, list]:
    """States (T, H, B) after each byte of x (T, B), and per step what the way back needs."""
    table, recurrent, bias = cell
    hidden = recurrent.shape[1]
    columns = np.ascontiguousarray(table.T)
    states = np.empty((len(x), hidden, x.shape[1]), np.float32)
    h, seen = np.zeros((hidden, x.shape[1]), np.float32), []
    given, mixed = np.empty((3 * hidden, x.shape[1]), np.float32), np.empty((3 * hidden, x.shape[1]), np.float32)
    for t in range(len(x)):
        np.take(columns, x[t], axis=1, out=given, mode="clip")
        np.matmul(recurrent, h, out=mixed)
        gates, inner = mixed[:2 * hidden], mixed[2 * hidden:]
        gates += given[:2 * hidden]
        np.clip(gates, 0, 1, out=gates)
        update, reset = gates[:hidden], gates[hidden:]
        inner += bias
        before = inner.copy() if trace else None
        inner *= reset
        inner += given[2 * hidden:]
        raw = inner.copy() if trace else None
        np.clip(inner, -1, 1, out=inner)
        if trace:
            seen.append((h.copy(), update.copy(), reset.copy(), before, raw, inner.copy()))
        inner -= h
        inner *= update
        h = np.add(h, inner, out=states[t])
    return states, seen


def _back(x: np.ndarray, cell: tuple[np.ndarray, ...], seen: list, slope: np.ndarray) -> list[np.ndarray]:
    """Gradients of the cell's weights, given those of its states."""
    table, recurrent, bias = cell
    hidden = recurrent.shape[1]
    to_recurrent, to_bias = np.zeros_like(recurrent), np.zeros_like(bias)
    to_given = np.empty((len(x), 3 * hidden, x.shape[1]), np.float32)
    carried = np.zeros_like(slope[0])
    for t in range(len(x) - 1, -1, -1):
        h, update, reset, before, raw, inner = seen[t]
        d = slope[t] + carried
        d_inner = d * update * (np.abs(raw) < 1)
        d_mixed = np.concatenate([
            d * (inner - h) * ((update > 0) & (update < 1)), d_inner * before * ((reset > 0) & (reset < 1)), d_inner * reset,
        ])
        to_given[t] = d_mixed
        to_given[t, 2 * hidden:] = d_inner
        to_recurrent += d_mixed @ h.T
        to_bias += d_mixed[2 * hidden:].sum(1, keepdims=True)
        carried = d * (1 - update) + recurrent.T @ d_mixed
    flat = x.ravel()
    to_table = np.stack([np.bincount(flat, to_given[:, k].ravel(), 256) for k in range(3 * hidden)], 1).astype(np.float32)
    return [to_table, to_recurrent, to_bias]


def _softmax(logits: np.ndarray) -> np.ndarray:
    p = np.exp(logits - logits.max(-2, keepdims=True))
    return p / p.sum(-2, keepdims=True)


def train(texts: list[str], languages: list[str], steps: int = STEPS, hidden: int = HIDDEN) -> Model:
    """Fit a model; each update takes windows from random places of random texts, as many from each language."""
    rng = np.random.default_rng(SEED)
    names = tuple(sorted(set(languages)))
    pools = [[np.frombuffer(t.encode(), np.uint8) for t, l in zip(texts, languages, strict=True) if l == name and t] for name in names]
    pools = [pool or [np.frombuffer(b" ", np.uint8)] for pool in pools]
    n = len(names)

    def cell() -> list[np.ndarray]:
        table = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
        table[:, :2 * hidden] = 0.25 * table[:, :2 * hidden] + 0.4
        recurrent = rng.normal(0, 1 / np.sqrt(hidden), (3 * hidden, hidden)).astype(np.float32)
        recurrent[:2 * hidden] *= 0.25
        return [table, recurrent, np.zeros((hidden, 1), np.float32)]

    weights = [*cell(), *cell(), rng.normal(0, 0.3, (n, 2 * hidden)).astype(np.float32), np.zeros((n, 1), np.float32)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    y = np.arange(BATCH) % n
    for step in range(1, steps + 1):
        x = np.full((SPAN, BATCH), 32, np.intp)
        for b in range(BATCH):
            text = pools[y[b]][rng.integers(len(pools[y[b]]))]
            at = rng.integers(max(1, len(text) - SPAN + 1))
            x[:min(SPAN, len(text) - at), b] = text[at:at + SPAN]
        ahead, seen_a = _run(x, tuple(weights[:3]), True)
        behind, seen_b = _run(x[::-1], tuple(weights[3:6]), True)
        both = np.concatenate([ahead, behind[::-1]], 1)  # (T, 2H, B)
        slope = _softmax(weights[6] @ both + weights[7])
        slope[:, y, np.arange(BATCH)] -= 1
        slope /= SPAN * BATCH
        to_states = weights[6].T @ slope
        grads = [
            *_back(x, tuple(weights[:3]), seen_a, to_states[:, :hidden]),
            *_back(x[::-1], tuple(weights[3:6]), seen_b, to_states[::-1, hidden:]),
            np.einsum("tkb,thb->kh", slope, both), slope.sum((0, 2))[:, None],
        ]
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for w, g, m, v in zip(weights, grads, first, second, strict=True):
            g = g * min(1.0, 1 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return Model(names, tuple(weights[:3]), tuple(weights[3:6]), weights[6], weights[7])


def position_probabilities(model: Model, windows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Position and probabilities (languages, windows), from the last byte of the windows (B, T) to the first."""
    x = np.ascontiguousarray(windows.T).astype(np.intp)
    ahead, _ = _run(x, model.forward)
    behind, _ = _run(x[::-1], model.backward)
    hidden = ahead.shape[1]
    left, right = np.ascontiguousarray(model.output[:, :hidden]), np.ascontiguousarray(model.output[:, hidden:])
    for t in range(len(x) - 1, -1, -1):
        p = left @ ahead[t]
        p += right @ behind[len(x) - 1 - t]
        p += model.bias
        np.exp(p, out=p)  # states lie in [-1, 1], so the exponent is bounded by the weights
        p /= p.sum(0)
        yield t, p


def _windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window rows padded with spaces, the bytes that count in each, and the document of each."""
    counts = -(-(ends - starts) // WINDOW)
    owner = np.repeat(np.arange(len(starts)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = starts[owner] + place * WINDOW
    size = np.minimum(ends[owner] - begin, WINDOW)
    at = begin[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < size[:, None]
    rows = np.where(inside, data[np.minimum(at, len(data) - 1)], 32).astype(np.uint8)
    return rows, size, owner


def document_probabilities(model: Model, texts: pa.Array) -> np.ndarray:
    """Mean probabilities (documents, languages) over all bytes of each text; zeros where there are none."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    total = np.zeros((len(texts), len(model.languages)))
    if not len(texts) or offsets[-1] == offsets[0]:
        return total
    # A few documents at a time: about as many bytes as the windows held at once, or one document.
    group = (offsets[:-1] - offsets[0]) // (WINDOW * WINDOWS)
    for span in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(group)) + 1):
        rows, size, owner = _windows(data, offsets[span], offsets[span + 1])
        for begin in range(0, len(rows), WINDOWS):
            part = slice(begin, begin + WINDOWS)
            pooled = np.zeros((len(model.languages), len(rows[part])), np.float32)
            cut = size[part]
            full = int(cut.min()) if len(cut) else 0
            for t, p in position_probabilities(model, rows[part]):
                pooled += p if t < full else p * (t < cut)
            for k in range(len(model.languages)):
                total[span[0]:span[-1] + 1, k] += np.bincount(owner[part], pooled[k], len(span))
    return total / np.maximum(np.diff(offsets), 1)[:, None]


def label(model: Model | None, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    if model is None:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    lettered = np.asarray(pc.match_substring_regex(texts, r"\pL").fill_null(False))
    p = document_probabilities(model, texts)
    best = p.argmax(1)
    names = [model.languages[k] if ok else UNDETERMINED for k, ok in zip(best, lettered, strict=True)]
    return names, np.where(lettered, np.clip(p[np.arange(len(p)), best], 0, 1), 0.0)


def position_labels(model: Model, text: str) -> list[tuple[int, int, str]]:
    """Runs of equal labels over the bytes of a text: first byte, end, language."""
    data = np.frombuffer(text.encode(), np.uint8)
    if not len(data):
        return []
    rows, size, _ = _windows(data, np.array([0]), np.array([len(data)]))
    marks = np.zeros(rows.shape, np.intp)
    for t, p in position_probabilities(model, rows):
        marks[:, t] = p.argmax(0)
    marks = marks.ravel()[:len(data)]
    cuts = np.flatnonzero(np.diff(marks)) + 1
    return [(int(a), int(b), model.languages[marks[a]]) for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(data)], strict=True)]


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """A model learned from text and non-NULL lang of the documents that are not held out; None if there are none."""
    labelled = docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.col("text") != ""))
    sample = bounded_sample(labelled, "doc_id", sample_docs).repartition(1).sortWithinPartitions("doc_id", "lang", "text")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, languages = [], []
        for batch in batches:
            texts += batch.column("text").to_pylist()
            languages += batch.column("lang").to_pylist()
        if texts:
            model = train(texts, languages)
            arrays = [*model.forward, *model.backward, model.output, model.bias]
            yield pa.RecordBatch.from_arrays(
                [pa.array([list(model.languages)]), pa.array([[a.tobytes() for a in arrays]], pa.list_(pa.binary()))], ["languages", "weights"]
            )

    found = sample.mapInArrow(learn, "languages array<string>, weights array<binary>").first()
    if found is None:
        return None
    names, h = tuple(found["languages"]), HIDDEN
    shapes = [(256, 3 * h), (3 * h, h), (h, 1)] * 2 + [(len(names), 2 * h), (len(names), 1)]
    w = [np.frombuffer(bytes(b), np.float32).reshape(s) for b, s in zip(found["weights"], shapes, strict=True)]
    return Model(names, tuple(w[:3]), tuple(w[3:6]), w[6], w[7])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    def labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = label(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(labels, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def known_language(model: Model | None, least: float) -> Callable[[pa.Array], np.ndarray]:
    """A decision over batches of texts: whether a language is found with at least that score. Without a model all stay."""
    def decide(texts: pa.Array) -> np.ndarray:
        if model is None:
            return np.ones(len(texts), bool)
        names, scores = label(model, texts)
        return (np.array(names, object) != UNDETERMINED) & (scores >= least)

    return decide
