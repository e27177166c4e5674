"""Language ID and toxicity: held-out accuracy on the shared tables, and odd rows."""

import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from minutebook.llm import language_gru, toxicity
from minutebook.llm.common import bounded_sample, keep_rows

SF = "/root/testdata/sf0.1"
shared = pytest.mark.skipif(not Path(SF).exists(), reason="shared tables absent")

GERMAN, ENGLISH = "der die und das nicht ein ist mit auf schön", "the and of with this that from was for are"
ODD = "doc_id long, text string, lang string, score string, held_out string, lang_pred int, toxic string"


def odd_rows(spark):
    texts = [None, "", " \n\t", "12345 --- !!", ENGLISH, ENGLISH, ENGLISH, "wort " * 60_000, "\x00\x01 é ß 漢字", GERMAN]
    ids = [None, 2, 3, 4, 5, 5, 6, 7, 8, 9]
    return spark.createDataFrame([(i, t, None, "x", "y", 1, "z") for i, t in zip(ids, texts, strict=True)], ODD)


def trained():
    return language_gru.train([(GERMAN + ' ') * 3] * 20 + [(ENGLISH + ' ') * 3] * 20, ["de"] * 20 + ["en"] * 20, steps=200)


def test_gradients_follow_the_loss():
    rng = np.random.default_rng(1)
    cell = [rng.normal(0, 0.3, s).astype(np.float32) for s in ((256, 9), (9, 3), (3, 1))]
    cell[0][:, :6] = 0.25 * cell[0][:, :6] + 0.5
    x, slope = rng.integers(97, 100, (5, 2)), rng.normal(size=(5, 3, 2)).astype(np.float32)
    _, seen = language_gru._run(x, tuple(cell), True)
    for k, gradient in enumerate(language_gru._back(x, tuple(cell), seen, slope)):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        loss = []
        for step in (1e-3, -1e-3):
            moved = [w.copy() for w in cell]
            moved[k][at] += step
            loss.append(float((language_gru._run(x, tuple(moved))[0] * slope).sum()))
        assert (loss[0] - loss[1]) / 2e-3 == pytest.approx(float(gradient[at]), rel=0.02)


def test_language_of_odd_rows(spark):
    model = trained()
    got = language_gru.predict(odd_rows(spark), model).collect()
    assert len(got) == 10
    assert [r["lang_pred"] for r in got[:7]] == ["und"] * 4 + ["en"] * 3
    assert got[9]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in got) and got[3]["score"] == 0
    assert [r["held_out"] for r in got] == [False] + [zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in got[1:]]
    assert language_gru.predict(odd_rows(spark).limit(0), model).count() == 0


def test_language_without_labels(spark):
    docs = odd_rows(spark)
    assert language_gru.fit(docs) is None
    assert {r["lang_pred"] for r in language_gru.predict(docs, None).collect()} == {"und"}
    assert keep_rows(docs, language_gru.known_language(None, 0.5)).count() == 10


def test_window_borders_do_not_change_what_is_counted():
    model = trained()
    text = (GERMAN * 40)[:language_gru.WINDOW * 3 + 5]
    alone = language_gru.document_probabilities(model, pa.array([text]))
    among = language_gru.document_probabilities(model, pa.array([ENGLISH, None, text, ""]))
    assert among[2] == pytest.approx(alone[0], abs=1e-6)
    assert alone.sum() == pytest.approx(1, abs=1e-4) and among[1].sum() == 0
    runs = language_gru.position_labels(model, text)
    assert runs[0][0] == 0 and runs[-1][1] == len(text.encode())
    assert all(a[1] == b[0] for a, b in zip(runs, runs[1:], strict=False))


@shared
def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language_gru.predict(docs, language_gru.fit(docs)).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right = found.where("lang_pred = lang").count()
    assert right / found.where("lang is not null").count() > 0.97


@shared
def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    assert len(model.index) < 5_000
    found = toxicity.predict(docs, model).where("held_out").join(labels, "doc_id").toPandas()
    hit = found["predicted"] == 1
    assert found["toxic"][hit].mean() > 0.95 and hit[found["toxic"] == 1].mean() > 0.85


def test_toxicity_of_odd_rows(spark):
    words = ["good fine nice well", "vile foul nasty"]
    rows = [(i, words[i % 2] + f" w{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(300)] + [(0, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.predict(odd_rows(spark).union(odd_rows(spark).limit(1).selectExpr("doc_id", "'so vile and foul, nasty' AS text", "lang", "score", "held_out", "lang_pred", "toxic")), model).collect()
    assert [r["predicted"] for r in got] == [0] * 10 + [1]
    bias = 1 / (1 + np.exp(-model.bias))
    assert all(r["score"] == pytest.approx(bias) for r in got[:3])
    assert toxicity.fit(docs, labels.limit(0)) is None
    assert {r["score"] for r in toxicity.predict(docs, None).collect()} == {0.0}
    assert toxicity.predict(docs.limit(0), model).count() == 0
    assert keep_rows(docs, toxicity.tolerable(model)).count() == 150


def test_features_do_not_cross_texts():
    hasher = toxicity.Hasher()
    (_, _, index, owner), = hasher.batches(pa.array(["alpha beta", None, "gamma delta epsilon", ""]))
    for k, text in ((0, "alpha beta"), (2, "gamma delta epsilon")):
        (_, _, alone, _), = toxicity.Hasher().batches(pa.array([text]))
        assert set(index[owner == k]) == set(alone)
    assert set(owner) == {0, 2}


def test_bounded_sample_repeats(spark):
    rows = spark.range(5_000).withColumnRenamed("id", "doc_id")
    a, b = (sorted(r[0] for r in bounded_sample(rows.repartition(n), "doc_id", 100).collect()) for n in (3, 7))
    assert a == b and len(a) == 100


def test_scores_of_whole_texts_against_a_plain_network():
    """Byte by byte, state by state: the mean over all bytes of what a window's two directions say."""
    rng = np.random.default_rng(2)
    h, names = 3, ("a", "b", "c")
    cell = lambda: (rng.normal(0, 0.6, (256, 3 * h)).astype(np.float32), rng.normal(0, 0.6, (3 * h, h)).astype(np.float32), rng.normal(0, 0.3, (h, 1)).astype(np.float32))
    model = language_gru.Model(names, cell(), cell(), rng.normal(0, 1, (3, 2 * h)).astype(np.float32), rng.normal(0, 0.5, (3, 1)).astype(np.float32))

    def states(data, weights):
        table, recurrent, bias = (w.astype(float) for w in weights)
        state, out = [0.0] * h, []
        for byte in data:
            mixed = [sum(recurrent[k][j] * state[j] for j in range(h)) for k in range(3 * h)]
            gate = [min(1.0, max(0.0, mixed[k] + table[byte][k])) for k in range(2 * h)]
            new = [min(1.0, max(-1.0, (mixed[2 * h + k] + bias[k][0]) * gate[h + k] + table[byte][2 * h + k])) for k in range(h)]
            state = [state[k] + gate[k] * (new[k] - state[k]) for k in range(h)]
            out.append(state)
        return out

    def plain(text):
        data, total = text.encode(), [0.0] * 3
        for at in range(0, len(data), language_gru.WINDOW):
            window = data[at:at + language_gru.WINDOW]
            padded = window.ljust(language_gru.WINDOW, b" ")
            ahead, behind = states(padded, model.forward), states(padded[::-1], model.backward)[::-1]
            for t in range(len(window)):
                both = ahead[t] + behind[t]
                raw = [np.exp(sum(float(model.output[k][j]) * both[j] for j in range(2 * h)) + float(model.bias[k][0])) for k in range(3)]
                total = [a + b / sum(raw) for a, b in zip(total, raw, strict=True)]
        return [x / max(1, len(data)) for x in total]

    texts = ["", "x", "Über die Brücke.", "the quick brown fox " * 20, "y" * 128, "z " * 64 + "é"]
    got = language_gru.document_probabilities(model, pa.array(texts + [None]))
    assert np.allclose(got, [plain(t) for t in texts] + [[0.0] * 3], atol=1e-5)


def test_weights_and_scores_against_plain_ftrl():
    """One coordinate at a time, by the update rule."""
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(12)]
    texts = [" ".join(rng.choice(words[:6] if k % 3 else words[4:], 8)) for k in range(90)] + ["", "w1"]
    labels = np.array([float(k % 3 == 0) for k in range(len(texts))])
    hasher = toxicity.Hasher()

    def features(text):
        counts = {}
        for _, _, index, _ in hasher.batches(pa.array([text])):
            for i in index.tolist():
                counts[i] = counts.get(i, 0) + 1
        return set(counts) | {int(toxicity._repeated(np.int64(i))) for i, n in counts.items() if n > 1}

    sets, z, n, bias = [features(t) for t in texts], {}, {}, [0.0, 0.0]

    def weight(i):
        at = z.get(i, 0.0)
        if abs(at) <= toxicity.L1:
            return 0.0
        return -(at - np.sign(at) * toxicity.L1) / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    base = lambda: -bias[0] / ((toxicity.BETA + bias[1] ** 0.5) / toxicity.ALPHA)
    chance = lambda s: 1 / (1 + np.exp(-(sum(map(weight, s)) + base())))
    for _ in range(toxicity.PASSES):
        for d in np.random.default_rng(5).permutation(len(texts)):
            g = chance(sets[d]) - labels[d]
            for i, w in [(i, weight(i)) for i in sets[d]]:
                z[i] = z.get(i, 0.0) + g - ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / toxicity.ALPHA * w
                n[i] = n.get(i, 0.0) + g * g
            was = base()
            bias = [bias[0] + g - ((bias[1] + g * g) ** 0.5 - bias[1] ** 0.5) / toxicity.ALPHA * was, bias[1] + g * g]
    model = toxicity.train(pa.array(texts, pa.large_string()), labels)
    want = {i: weight(i) for i in z if weight(i)}
    assert len(want) > 5 and dict(zip(model.index.tolist(), model.weight.tolist(), strict=True)) == pytest.approx(want, rel=1e-4)
    fresh = [*texts[:20], "w0 w0 w11", "never met"]
    assert toxicity.scorer(model)(pa.array(fresh)).tolist() == pytest.approx([chance(features(t)) for t in fresh], abs=1e-5)
