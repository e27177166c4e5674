"""Phrase collocations against plain counting."""

import random
import re
from collections import Counter

import compare
import numpy as np
import pytest

from minutebook.llm import phrases, queries

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, longest=4, top=2_000):
    out, rows = [], [("und" if lang is None else lang, t) for lang, t in rows]
    for lang in {lang for lang, _ in rows}:
        f, n = Counter(), 0
        for text in (t or "" for of, t in rows if of == lang):
            for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text.translate(LOWER)):
                words = re.findall("[^ \t]+", piece)
                n += len(words)
                f.update(tuple(words[i:j]) for i in range(len(words)) for j in range(i + 1, min(i + longest, len(words)) + 1))
        often = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        inside = {}
        for p, a in often.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        inside[p[i:j]] = max(a, inside.get(p[i:j], 0))
        scored = []
        for p, a in often.items():
            if 100 * inside.get(p, 0) < 80 * a:
                score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, k, p.decode(), -a, l, r, n, -s) for k, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def mined(spark, rows, **more):
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "lang string, text string, score double").repartition(5)
    got = phrases.collocations(docs, **more)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, got.collect()))


def made(seed, docs=150):
    rng = random.Random(seed)
    words = ["the", "The", "of", "a\x01", "the\x01", "é", "É", "\xa0", "\x1c", "x" * 3_000, *[f"w{k}" for k in range(30)]]
    rows = []
    for _ in range(docs):
        picked = [rng.choice(words[: rng.choice([3, 12, 40])]) for _ in range(rng.randrange(60))]
        rows.append((rng.choice(["en", "en", "de", None, "und", ""]), "".join(w + rng.choice([" ", " ", "\t", "  ", ", ", "\r\n", ".", "? "]) for w in picked)))
    return rows + [("en", "once upon a time. " * 40)] * 3 + [("fr", None), ("fr", ""), (None, " .,\n")]


def test_twin(spark):
    got = queries.QUERIES["op12_phrases"](spark, SF).toPandas()
    assert compare.difference(got, compare.duck(SF).execute(queries.SQL["op12_phrases"]).df()) is None


@pytest.mark.parametrize(("group", "least", "longest", "top"), [(10, 4, 4, 2_000), (100, 4, 4, 25), (1_000_000, 4, 4, 2_000), (40, 30, 3, 2_000), (40, 2, 5, 2_000)])
def test_against_plain_counting(spark, monkeypatch, group, least, longest, top):
    """Groups of any size give the same counts: with small ones, prefixes of up to all words are extended."""
    monkeypatch.setattr(phrases, "GROUP_SUFFIXES", group)
    rows = made(least)
    got = mined(spark, rows, least=least, longest=longest, top=top)
    assert got == plain(rows, least, longest, top) and len(got) > 5


def test_prefixes_are_extended(spark, monkeypatch):
    monkeypatch.setattr(phrases, "GROUP_SUFFIXES", 50)
    docs = spark.createDataFrame([("en", "a b c d e. a b. a b c x. " * 40)], "lang string, text string")
    words = phrases.staged(phrases.word_counts(docs), "words")
    parts = phrases.partition(docs, words, phrases.frequent_bits(words, 30), 30, 4)
    assert [len(h) for h in parts.heavy] == [3, 2, 1, 0]  # a, b and c; a b and b c; a b c


def test_empty(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert mined(spark, [("en", None), (None, ""), ("de", "..."), ("en", "word")]) == []


def test_words_that_only_look_frequent(spark, monkeypatch):
    """A full bit set keeps every word and changes nothing."""
    rows = made(9)
    monkeypatch.setattr(phrases, "frequent_bits", lambda words, least: np.full(8, 255, np.uint8))
    assert mined(spark, rows, least=5) == plain(rows, 5)


def test_counts_past_32_and_64_bits(spark):
    """Scores are whole numbers whatever the counts."""
    big = 9_000_000_000_000_000
    found = spark.createDataFrame([("en", "a b", 2, big), ("en", "a b c", 3, big // 2 + 1)], "lang string, phrase string, size int, f long")
    words = spark.createDataFrame([("en", "a", big + 2), ("en", "b", big + 1), ("en", "c", big)], "lang string, word string, f long")
    found = found.union(spark.createDataFrame([("en", "b c", 2, big // 2 + 1)], found.schema))
    got = {r["phrase"]: r["score"] for r in phrases.scored(found, words, 30, 10, 80).collect()}
    half = big // 2 + 1
    assert got == {"a b": 2_000_000 * big // (2 * big + 3), "a b c": min(2_000_000 * half // (big + 2 + half), 2_000_000 * half // (2 * big))}


def test_first_fit():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 33, 500):
        sizes = rng.integers(1, 101, n)
        where, bins = phrases.fit_first(sizes, 100)
        load = np.bincount(where, sizes, minlength=bins)
        assert len(load) == bins and (load <= 100).all() and (load > 0).all()
        assert (np.sort(load)[:2].sum() > 100) or bins < 2  # no two bins would fit into one
