"""Phrase collocations by vertical partitioning of truncated suffixes.

A suffix is a word and what follows it in its piece, up to the length of the longest phrase. Suffixes are parted by the prefixes they begin with: a word that
begins more suffixes than a group may hold is extended by the next word, and again, until each prefix fits. Prefixes that need much of a
group are packed into groups first fit decreasing, all others share groups by hash. Each group then gets its suffixes as sorted blocks, sorts
them together and reads the count of every phrase from the leaves below it; groups know nothing of each other.

Words that are themselves too rare for a phrase end a suffix. Which words those are is told by a bit set hashed from the
frequent ones: a rare word that passes for a frequent one costs work, but changes no count. Blocks carry words as numbers, with
the words of the block beside them, so that a long word travels once.

Phrases are then screened and scored by joins on the frequent ones alone, in whole numbers.

Defined results: a NULL text is empty, a NULL language is ``und``; languages that only have empty texts give no rows; repeated documents each
count; words may hold any character but space, tab and the marks that end a piece; equal scores are ordered by count, then by the phrase's
bytes; no documents give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from minutebook.llm.common import staged

LONGEST = 4  # words in a phrase
LEAST = 30  # occurrences of a phrase
SWALLOWED = 80  # percent of a phrase's occurrences, that lie in one longer phrase
SCALE = 2_000_000
TOP = 2_000  # phrases of a language

GROUP_SUFFIXES = 1_000_000  # in a group; more only if there would be over MOST_GROUPS
MOST_GROUPS = 50_000
LISTED = 8  # prefixes that need a LISTED-th of a group are packed one by one: at most LISTED * MOST_GROUPS
MOST_BITS = 1 << 27  # of the set of frequent words

ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)
BLOCKS = "group int, depth int, lang string, words binary, codes binary, counts binary"


def pieces(text: str) -> Iterator[list[bytes]]:
    """The words of each piece of a text, A-Z lower-cased."""
    for piece in text.encode().lower().translate(ENDS).split(b"\n"):
        words = piece.split()  # no other ASCII white space is left in a piece
        if words:
            yield words


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(28))


class Suffixes:
    """The suffixes of the texts of one language in a batch: ``codes`` (a row each, 0 past the end) into ``words``."""

    def __init__(self, lang: str, texts: list[str], frequent: np.ndarray | None, longest: int):
        import xxhash

        flat: list[bytes] = []
        lengths: list[int] = []
        for text in texts:
            for words in pieces(text):
                flat += words
                lengths.append(len(words))
        coded = pa.array(flat, pa.binary()).dictionary_encode()
        self.words = coded.dictionary.to_pylist()
        code = np.asarray(coded.indices).astype(np.int32) + 1
        seed = xxhash.xxh64_intdigest(lang.encode())
        self.hashes = np.array([0] + [xxhash.xxh64_intdigest(w, seed) for w in self.words], np.uint64)
        self.counts = np.bincount(code, minlength=len(self.words) + 1)[1:]
        if frequent is not None:
            known = np.r_[False, has_bit(frequent, self.hashes[1:])]
        else:
            known = np.r_[False, np.ones(len(self.words), bool)]
        piece = np.repeat(np.arange(len(lengths)), lengths)
        columns = [np.where(known[code], code, 0)]
        for k in range(1, longest):
            later = np.zeros_like(code)
            if len(code) > k:
                same = piece[k:] == piece[:-k]
                later[:-k] = np.where(same, columns[0][k:], 0)
            columns.append(np.where(columns[-1] > 0, later, 0))
        self.codes = np.stack(columns, 1)[columns[0] > 0]

    def prefix(self, depth: int) -> np.ndarray:
        """A hash of the first ``depth`` words of each suffix."""
        total = np.zeros(len(self.codes), np.uint64)
        for k in range(depth):
            total = _mixed(total + self.hashes[self.codes[:, k]] + np.uint64(k + 1))
        return total


def has_bit(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(8 * len(bits) - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[str]]]:
    texts: dict[str, list[str]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        texts.setdefault(lang, []).append(text.as_py())
    yield from texts.items()


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, hash and f of every word. ``docs`` has lang and text, neither of them NULL."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, texts in _by_language(batch):
                found = Suffixes(lang, texts, None, 1)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(found.words), pa.string()), pa.array(found.words, pa.binary()).cast(pa.string()),
                    pa.array(found.hashes[1:].view(np.int64)), pa.array(found.counts, pa.int64()),
                ], ["lang", "word", "hash", "f"])

    counted = docs.mapInArrow(count, "lang string, word string, hash long, f long")
    return counted.groupBy("lang", "word").agg(F.first("hash").alias("hash"), F.sum("f").alias("f"))


def frequent_bits(words: DataFrame, least: int) -> np.ndarray:
    """A bit set that holds the hash of every word with ``least`` occurrences: eight bits or more a word, up to MOST_BITS."""
    often = words.where(F.col("f") >= least)
    size = min(MOST_BITS, max(1 << 16, 1 << (8 * often.count()).bit_length()))
    at = F.col("hash").bitwiseAND(F.lit(size - 1))
    # no more rows than words of the bit set
    parts = often.groupBy(F.shiftright(at, 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(hash & 63 as int))")).alias("bits"))
    table = np.zeros(size // 64, np.uint64)
    for part in parts.toLocalIterator():
        table[part["at"]] = np.uint64(part["bits"] & 0xFFFFFFFFFFFFFFFF)
    return table.view(np.uint8)


def fit_first(sizes: np.ndarray, room: int) -> tuple[np.ndarray, int]:
    """A bin for each size, largest first into the first bin with room, and the number of bins. No size is larger than the room.

    A tree over the bins tells the first with room, so each size takes a few steps.
    """
    bins = 1 << max(0, len(sizes) - 1).bit_length()
    tree = np.full(2 * bins, room, np.int64)
    where = np.zeros(len(sizes), np.int32)
    for k in np.argsort(-sizes, kind="stable").tolist():
        node = 1
        while node < bins:
            node *= 2
            node += tree[node] < sizes[k]
        where[k] = node - bins
        tree[node] -= sizes[k]
        while node > 1:
            node //= 2
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
    return where, int(where.max(initial=-1)) + 1


class Partition:
    """Which group a suffix belongs to.

    ``heavy[d]`` (ascending) are the hashes of the prefixes of d words that are extended, ``listed[d]`` those with a group of their own
    choosing, ``bins[d]``. The others of a depth share ``shared[d]`` groups. Groups are numbered from ``first[d]`` on.
    """

    def __init__(self):
        self.heavy: list[np.ndarray] = []
        self.listed: list[np.ndarray] = []
        self.bins: list[np.ndarray] = []
        self.shared: list[int] = []
        self.first: list[int] = [0]

    def add(self, hashes: np.ndarray, sizes: np.ndarray, total: int, room: int, last: bool) -> None:
        """The next depth: its prefixes of a LISTED-th of the room or more, and how many suffixes there are in all."""
        heavy = (sizes > room) & (not last)
        self.heavy.append(np.sort(hashes[heavy]))
        bins, n = fit_first(np.minimum(sizes[~heavy], room), room)
        order = np.argsort(hashes[~heavy])
        self.listed.append(hashes[~heavy][order])
        self.bins.append(bins[order])
        self.shared.append(max(1, -(-(total - int(sizes.sum())) // room)))
        self.first.append(self.first[-1] + n + self.shared[-1])

    def groups(self, found: Suffixes) -> tuple[np.ndarray, np.ndarray]:
        """Group and depth of each suffix."""
        group = np.zeros(len(found.codes), np.int32)
        depth = np.zeros(len(found.codes), np.int32)
        open_ = np.ones(len(found.codes), bool)
        for d, (heavy, listed) in enumerate(zip(self.heavy, self.listed, strict=True)):
            prefix = found.prefix(d + 1)
            spread = (_mixed(prefix) % np.uint64(self.shared[d])).astype(np.int32)
            here = spread + self.first[d + 1] - self.shared[d]
            if len(listed):
                at = np.minimum(np.searchsorted(listed, prefix), len(listed) - 1)
                here = np.where(listed[at] == prefix, self.bins[d][at] + self.first[d], here)
            group[open_], depth[open_] = here[open_], d + 1
            # a suffix that ends with a heavy prefix goes on too, its end in place of a word
            open_ &= np.isin(prefix, heavy)
        return group, depth


def partition(docs: DataFrame, words: DataFrame, bits: np.ndarray, least: int, longest: int) -> Partition:
    """Groups of at most GROUP_SUFFIXES suffixes (or a MOST_GROUPS-th of all)."""
    often = words.where(F.col("f") >= least)
    total = often.agg(F.sum("f")).first()[0] or 0
    room = max(GROUP_SUFFIXES, -(-total // MOST_GROUPS))
    parts = Partition()
    counted = often.select("hash", "f")
    for depth in range(1, longest + 1):
        if depth == 1:
            # the hash of a word as the prefix of a suffix
            rows = counted.where(F.col("f") >= room // LISTED).collect()
            hashes = _mixed(np.array([r["hash"] for r in rows], np.int64).view(np.uint64) + np.uint64(1))
        else:
            rows = _extended(docs, parts, bits, longest).where(F.col("f") >= room // LISTED).collect()
            hashes = np.array([r["hash"] for r in rows], np.int64).view(np.uint64)
        sizes = np.array([r["f"] for r in rows], np.int64)
        parts.add(hashes, sizes, total, room, depth == longest)
        total = int(sizes[sizes > room].sum())
        if not len(parts.heavy[-1]):
            break
    return parts


def _extended(docs: DataFrame, parts: Partition, bits: np.ndarray, longest: int) -> DataFrame:
    """hash and f of the prefixes one word longer than the heavy ones known so far."""
    depth = len(parts.heavy)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, texts in _by_language(batch):
                found = Suffixes(lang, texts, bits, longest)
                prefix = found.prefix(depth + 1)[np.isin(found.prefix(depth), parts.heavy[-1])]
                hashes, f = np.unique(prefix, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(f, pa.int64())], ["hash", "f"])

    return docs.mapInArrow(count, "hash long, f long").groupBy("hash").agg(F.sum("f").alias("f"))


def runs(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes sorted, equal ones as one with their counts added."""
    order = np.lexsort(codes.T[::-1])
    codes, counts = codes[order], counts[order]
    begin = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]).any(1)][:len(codes)])
    return codes[begin], np.add.reduceat(counts, begin) if len(begin) else counts


def suffix_blocks(docs: DataFrame, bits: np.ndarray, parts: Partition, longest: int) -> DataFrame:
    """The suffixes of two words or more as a block per batch, language and group."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, texts in _by_language(batch):
                found = Suffixes(lang, texts, bits, longest)
                found.codes = found.codes[found.codes[:, 1] > 0]
                group, depth = parts.groups(found)
                order = np.argsort(group, kind="stable")
                begin = np.flatnonzero(np.r_[True, np.diff(group[order]) != 0][:len(order)])
                rows: list[tuple] = []
                for rows_of in np.split(order, begin[1:]) if len(begin) else ():
                    used, codes = np.unique(found.codes[rows_of], return_inverse=True)
                    # 0 stays 0, whether or not a suffix ends early
                    codes = codes.reshape(-1, longest) + (used[0] > 0)
                    codes, counts = runs(codes.astype(np.int32), np.ones(len(codes), np.int64))
                    names = b"\n".join(found.words[c - 1] for c in used[used > 0].tolist())
                    narrow = np.uint16 if len(used) < 1 << 16 else np.uint32
                    data = bytes([narrow().itemsize]) + np.ascontiguousarray(codes.T).astype(narrow).tobytes()
                    k = rows_of[0]
                    rows.append((int(group[k]), int(depth[k]), lang, names, data, counts.astype(np.uint32).tobytes()))
                kinds = (pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary())
                for at in range(0, len(rows), 64):
                    columns = zip(*rows[at:at + 64], strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["group", "depth", "lang", "words", "codes", "counts"]
                    )

    return docs.mapInArrow(cut, BLOCKS)


class Subtree:
    """The suffixes of one group and language, block by block."""

    def __init__(self, longest: int):
        self.longest, self.names, self.known = longest, [b""], {}
        self.codes, self.counts, self.waiting, self.folded = [], [], 0, 0

    def add(self, names: bytes, codes: bytes, counts: bytes) -> None:
        words = names.split(b"\n")
        place = [0]
        for word in words:
            code = self.known.get(word)
            if code is None:
                code = self.known[word] = len(self.names)
                self.names.append(word)
            place.append(code)
        narrow = np.uint16 if codes[0] == 2 else np.uint32
        self.codes.append(np.array(place, np.int32)[np.frombuffer(codes, narrow, offset=1).reshape(self.longest, -1).T])
        self.counts.append(np.frombuffer(counts, np.uint32).astype(np.int64))
        self.waiting += len(self.counts[-1])
        if self.waiting > max(GROUP_SUFFIXES, self.folded):
            self._fold()

    def _fold(self) -> None:
        codes, counts = runs(np.concatenate(self.codes), np.concatenate(self.counts))
        self.codes, self.counts, self.waiting, self.folded = [codes], [counts], 0, len(codes)

    def totals(self, depth: int, least: int) -> Iterator[tuple[bytes, int, int]]:
        """Phrase, size and count of every node from two words on. Nodes above ``depth`` hang in other groups as well and are all told."""
        self._fold()
        codes, counts = self.codes[0], self.counts[0]
        new = np.zeros(len(codes), bool)
        new[:1] = True
        for size in range(1, self.longest + 1):
            new[1:] |= codes[1:, size - 1] != codes[:-1, size - 1]
            begin = np.flatnonzero(new)
            total = np.add.reduceat(counts, begin) if len(begin) else counts
            if size > 1:
                told = (codes[begin, size - 1] > 0) & ((total >= least) | (size < depth))
                for row, f in zip(codes[begin[told], :size].tolist(), total[told].tolist(), strict=True):
                    yield b" ".join(self.names[c] for c in row), size, f


def phrase_counts(blocks: DataFrame, least: int, longest: int) -> DataFrame:
    """lang, phrase, size and f of every phrase of two words or more with ``least`` occurrences."""
    dealt = blocks.repartition("group").sortWithinPartitions("group", "lang")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tree = None, None
        for batch in batches:
            for group, depth, lang, words, codes, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != (group, depth, lang):
                    yield from told(key, tree)
                    key, tree = (group, depth, lang), Subtree(longest)
                tree.add(words, codes, counts)
        yield from told(key, tree)

    def told(key, tree) -> Iterator[pa.RecordBatch]:
        rows = list(tree.totals(key[1], least)) if tree else []
        for at in range(0, len(rows), 50_000):
            phrase, size, f = zip(*rows[at:at + 50_000], strict=True)
            yield pa.RecordBatch.from_arrays([
                pa.array([key[2]] * len(f), pa.string()), pa.array(phrase, pa.binary()).cast(pa.string()), pa.array(size, pa.int32()), pa.array(f, pa.int64()),
            ], ["lang", "phrase", "size", "f"])

    found = dealt.mapInArrow(build, "lang string, phrase string, size int, f long")
    return found.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, swallowed: int = SWALLOWED) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the first phrases of each language."""
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where("text is not null")
    words = staged(word_counts(docs), "words")
    bits = frequent_bits(words, least)
    parts = partition(docs, words, bits, least, longest)
    phrases = staged(phrase_counts(suffix_blocks(docs, bits, parts, longest), least, longest), "phrases")
    return scored(phrases, words, least, top, swallowed)


def scored(phrases: DataFrame, words: DataFrame, least: int, top: int, swallowed: int) -> DataFrame:
    """The phrases no longer one swallows, by the score of their worst cut."""
    split = F.split("phrase", " ", -1)
    part = lambda at, n: F.array_join(F.slice(F.col("w"), at, n), " ")
    longer = phrases.where("size > 2").select("lang", "size", "f", split.alias("w")).select(
        "lang", "f", "w", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("n")
    ).select("lang", "f", "w", "n", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("n") + 1)).alias("at"))
    inside = longer.groupBy("lang", part(F.col("at"), F.col("n")).alias("phrase")).agg(F.max("f").alias("most"))
    left = phrases.join(inside, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (F.col("most").cast("decimal(20,0)") * 100 < F.col("f").cast("decimal(20,0)") * swallowed)
    )
    cuts = left.select("lang", "phrase", F.col("f").alias("a"), "size", split.alias("w")).select(
        "lang", "phrase", "a", "size", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    ).select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    counts = phrases.select("lang", "phrase", "f").union(words.where(F.col("f") >= least).select("lang", "word", "f"))
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    # decimals, as products may pass 64 bits
    score = F.expr(f"cast(cast(a as decimal(20,0)) * {SCALE} div (cast(l as decimal(20,0)) + r) as long)")
    worst = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r")).alias("cut")
    ).select("lang", "phrase", "cut.score", "cut.a", "cut.l", "cut.r")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = worst.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
