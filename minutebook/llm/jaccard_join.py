"""Near-duplicate documents: an exact Jaccard self-join of word n-gram sets by universe partition and pigeonhole.

Sets are taken apart by size band. In a band, two similar sets differ in at most H tokens, and tokens are hashed into
segments. A segment is indexed either by its exact subset of tokens (worth one difference) or by the subset and all its
one-deletion neighbours (worth two). If the worths add up to more than H, two similar sets must meet in some segment. How many segments
of either kind a band gets is a matter of cost: signatures to store against chance meetings of (nearly) empty segments.
A set also probes the band below, as far as sets there can be similar to it.

``near_duplicates_by_segments`` is the same for lower limits, at which so many tokens may differ that segments hold few of them: there a band gets
more segments than two similar sets can differ in. They then agree in more than one, and each set leaves out as many as that allows, those without tokens
or with common ones first, in an order that depends on nothing but the segment: of the segments that two sets agree in, both leave out the last ones, so
one always remains. A sample tells which tokens are common. Any order is exact; the sample only keeps buckets small.

Signatures with the same members are one bucket. Members are compared by parity sketches, which grow with the sets: the number of
differing bits never exceeds the number of differing
tokens, so the comparison loses nothing. Of a bucket only a spanning forest of the pairs that pass is emitted, never all
pairs. The forest's edges are verified on the texts' word sets themselves. Where an edge fails, its buckets are taken up again without it, and each node brings
up its nearest others besides, four times as many in each round, until every forest stands. Links thus stay complete as far as connection goes, which is
all that components need.

Equal sets are one node throughout, so copies, however many, cost one row each and one signature row per task.

Defined results: NULL, empty and wordless texts have an empty set and are linked with nothing; texts with fewer words than a shingle have
one shingle, all words; rows that share a doc_id are one document for the component's name but each returned; a NULL doc_id
takes part and gives no name; other columns are ignored; no documents give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from minutebook.llm.common import discard, staged

WORDS = 3  # words in a shingle, unless the caller asks for another length
PERCENT = 90  # 100 * intersection >= PERCENT * union
SKETCH_WORDS = 16  # 64-bit words of a parity sketch, at least
TOKEN_BITS = 0.5  # of a sketch, rounded up to a power of two
BAND_RATIO = 1.25
WIDE_BAND_RATIO = 3.0  # where segments are left out: fewer sets then probe the band below
SEGMENT_TOKENS = 2.75  # in the largest sets of such a band; those kept then seldom hold fewer than two
BAND_SHARE = 1 / 16  # share of all sets supposed in one band when costs are weighed
MEETING_COST = 3.0  # of a chance meeting, in signatures
TILE = 4_096  # members compared in one group; larger buckets are compared tile by tile
SAMPLE_DOCS = 4_000  # about as many documents tell which tokens are common
COMMON_DOCS = 3  # of the sample, that a common token is in
COMMON_TOKENS = 100_000  # most tokens kept as common
BROADCAST_IDS = 1_000_000  # ids (8 bytes each) that may be broadcast

MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[2])
    return x ^ (x >> np.uint64(31))


def split_words(text: str) -> list[bytes]:
    """Words of a text, A-Z lower-cased: what stands between spaces and the controls 9 to 13."""
    return text.encode().lower().split()  # of bytes, these are exactly the ASCII white space and letters


def shingles(words: list[bytes], size: int = WORDS) -> set[tuple[bytes, ...]]:
    """The set of a document."""
    if not words:
        return set()
    return set(zip(*(words[i:] for i in range(size)), strict=False)) if len(words) >= size else {tuple(words)}


def hashed_shingles(words: list[bytes], kept: dict[bytes, int], size: int = WORDS) -> np.ndarray:
    """The set as sorted distinct 64-bit hashes. ``kept`` has the hashes of words met before."""
    if not words:
        return np.empty(0, np.uint64)
    codes = np.array([kept.get(w) or _word_code(w, kept) for w in words], np.uint64)
    span = min(size, len(codes))
    total = np.zeros(len(codes) - span + 1, np.uint64)
    for i in range(span):
        total = _mixed(total * np.uint64(MIX[0]) + codes[i:len(codes) - span + 1 + i])
    return np.unique(total)


def _word_code(word: bytes, kept: dict[bytes, int]) -> int:
    import xxhash

    if len(kept) > 500_000:
        kept.clear()
    code = kept[word] = xxhash.xxh64_intdigest(word) or 1
    return code


def bands(highest: int, percent: int, ratio: float = BAND_RATIO) -> list[int]:
    """First sizes of the bands up to a size. A partner of a set is in its own band or the next."""
    starts = [1]
    while starts[-1] <= highest:
        start = starts[-1]
        starts.append(max(start * 100 // percent + 1, int(start * ratio)))
    return starts


def allocation(start: int, end: int, percent: int, sets: int) -> tuple[int, int]:
    """Exact and one-deletion segments for sets of a band [start, end)."""
    largest = end - 1
    differing = (largest + largest * 100 // percent) * (100 - percent) // (100 + percent)
    size, crowd, best = (start + end) / 2, sets * BAND_SHARE, None
    for deletions in range((differing + 2) // 2 + 1):
        exact = max(0, differing + 1 - 2 * deletions)
        parts = exact + deletions
        none = (1 - 1 / parts) ** size
        few = none + size / parts * (1 - 1 / parts) ** (size - 1)
        stored = exact + deletions * (1 + size / parts)
        cost = stored + MEETING_COST * crowd * (exact * none**2 + deletions * few**2)
        if best is None or cost < best[0]:
            best = (cost, exact, deletions)
        if deletions > 64 and cost > 4 * best[0]:
            break
    return best[1], best[2]


def signatures(tokens: np.ndarray, percent: int, sets: int, plans: dict[int, tuple[int, int]]) -> np.ndarray:
    """Signatures of a set: those of its own band, and of the band below if a partner can be there.

    ``plans`` keeps the allocations of bands met before; they are the same for every set.
    """
    size = len(tokens)
    if not size:
        return np.empty(0, np.int64)
    starts = bands(size, percent)
    own = int(np.searchsorted(starts, size, side="right")) - 1
    sums = np.r_[np.uint64(0), np.cumsum(_mixed(tokens), dtype=np.uint64)]
    found = []
    for band in (own, own - 1):
        if band < 0 or (band < own and size * percent > (starts[own] - 1) * 100):
            continue
        if band not in plans:
            plans[band] = allocation(starts[band], starts[band + 1], percent, sets)
        exact, deletions = plans[band]
        parts = exact + deletions
        # tokens are sorted, and segments are ranges of the hash
        cuts = np.searchsorted(tokens, (np.arange(1, parts, dtype=np.uint64) * np.uint64(((1 << 64) - 1) // parts)))
        cuts = np.r_[0, cuts, size]
        whole = sums[cuts[1:]] - sums[cuts[:-1]]
        place = _mixed(np.arange(parts, dtype=np.uint64) + np.uint64(band << 32))
        found.append(_mixed(whole + place))
        if deletions:
            part = np.repeat(np.arange(parts), np.diff(cuts))
            part = part[cuts[exact]:]
            found.append(_mixed(whole[part] - _mixed(tokens[cuts[exact]:]) + place[part]))
    return np.unique(np.concatenate(found)).astype(np.int64)


def first_tokens(tokens: np.ndarray, percent: int, common: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Signatures of a set: its first tokens, of which any two similar sets share one.

    ``common`` (ascending) come last, by their ``ranks``; before them tokens are ordered as they are.
    """
    size = len(tokens)
    if not size:
        return np.empty(0, np.int64)
    least = -(-size * percent // 100)  # tokens that a similar set has at least
    rank = _ranks_of(tokens, common, ranks)
    return tokens[np.argsort(rank, kind="stable")[:size - least + 1]].view(np.int64)


def _ranks_of(tokens: np.ndarray, common: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The rank of each token, 0 if it is not common."""
    if not len(common):
        return np.zeros(len(tokens), np.int64)
    at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
    return np.where(common[at] == tokens, ranks[at], 0)


def spare_allocation(start: int, end: int, percent: int, sets: int) -> tuple[int, int]:
    """Exact and one-deletion segments for sets of a band [start, end), of which sets leave out what their sizes allow."""
    largest = end - 1
    differing = most_differing(largest, largest * 100 // percent, percent)
    size, crowd, best = (start + end) / 2, sets * BAND_SHARE, None
    for deletions in range((differing + 2) // 2 + 1):
        parts = max(differing + 1 - deletions, int(largest / SEGMENT_TOKENS), 1)
        exact = parts - deletions
        spare = exact + 2 * deletions - differing - 1
        none = (1 - 1 / parts) ** size
        few = none + size / parts * (1 - 1 / parts) ** (size - 1)
        stored = max(0, exact - spare) + deletions * (1 + size / parts)
        cost = stored + MEETING_COST * crowd * (max(0, exact * none - spare) * none + deletions * few**2)
        if best is None or cost < best[0]:
            best = (cost, exact, deletions)
        if deletions > 64 and cost > 4 * best[0]:
            break
    return best[1], best[2]


def kept_segments(
    tokens: np.ndarray, percent: int, sets: int, plans: dict[int, tuple[int, int]], common: np.ndarray, ranks: np.ndarray
) -> np.ndarray:
    """Signatures of a set like those of ``signatures``, but for the exact segments that it may leave out.

    Two similar sets that differ in at most H tokens agree in segments worth more than all less H. Segments with the fewest tokens that are not common
    come last, then those whose rarest token is the most common (``common`` and ``ranks``, as in ``first_tokens``), then those with the fewest.
    """
    size = len(tokens)
    if not size:
        return np.empty(0, np.int64)
    starts = bands(size, percent, WIDE_BAND_RATIO)
    own = int(np.searchsorted(starts, size, side="right")) - 1
    sums = np.r_[np.uint64(0), np.cumsum(_mixed(tokens), dtype=np.uint64)]
    rank = _ranks_of(tokens, common, ranks)
    rare = np.r_[0, np.cumsum(rank == 0)]
    found = []
    for band, partner in ((own, size * 100 // percent), (own - 1, starts[own] - 1)):  # the largest partner that meets it there
        if band < 0 or (band < own and size * percent > partner * 100):
            continue
        if band not in plans:
            plans[band] = spare_allocation(starts[band], starts[band + 1], percent, sets)
        exact, deletions = plans[band]
        parts = exact + deletions
        cuts = np.searchsorted(tokens, (np.arange(1, parts, dtype=np.uint64) * np.uint64(((1 << 64) - 1) // parts)))
        cuts = np.r_[0, cuts, size]
        held = np.diff(cuts)
        whole = sums[cuts[1:]] - sums[cuts[:-1]]
        place = _mixed(np.arange(parts, dtype=np.uint64) + np.uint64(band << 32))
        rarest = np.zeros(parts, np.int64)
        rarest[held > 0] = np.minimum.reduceat(rank, cuts[:-1][held > 0])
        order = np.lexsort((-held[:exact], rarest[:exact], -(rare[cuts[1:]] - rare[cuts[:-1]])[:exact]))
        spare = exact + 2 * deletions - 1 - most_differing(size, partner, percent)
        kept = order[:max(0, exact - spare)]
        found.append(_mixed(whole[kept] + place[kept]))
        if deletions:
            part = np.repeat(np.arange(parts), held)
            part = part[cuts[exact]:]
            found.append(_mixed(whole[exact:] + place[exact:]))
            found.append(_mixed(whole[part] - _mixed(tokens[cuts[exact]:]) + place[part]))
    return np.unique(np.concatenate(found)).astype(np.int64)


def common_tokens(docs: DataFrame, n_docs: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens that are common in a sample, ascending, and their ranks from 1, the most common last."""
    share = min(1.0, SAMPLE_DOCS / max(1, n_docs))
    sample = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int((1 << 30) * share))

    def tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, int] = {}
        for batch in batches:
            for text in batch.column(0):
                tokens = hashed_shingles(split_words(text.as_py() or ""), kept, words)
                yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64))], ["token"])

    counts = sample.select("text").mapInArrow(tokens_of, "token long").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.where(F.col("n") >= COMMON_DOCS).orderBy(F.desc("n"), "token").limit(COMMON_TOKENS).collect()
    tokens = np.array([r["token"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], (len(rows) - np.arange(len(rows)))[order]


def sketch(tokens: np.ndarray) -> bytes:
    """One bit of parity for each class of tokens: a power of two of classes, about as many as there are tokens or half of that."""
    bits = max(64 * SKETCH_WORDS, 1 << max(6, int(len(tokens) * TOKEN_BITS)).bit_length())
    classes = (_mixed(tokens ^ np.uint64(MIX[3])) >> np.uint64(32)) % np.uint64(bits)
    return np.packbits((np.bincount(classes.astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def node_of(tokens: np.ndarray) -> int | None:
    """The number of a set; equal sets have the same."""
    if not len(tokens):
        return None
    return int(_mixed(_mixed(tokens).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(tokens))).astype(np.int64)[0])


SETS = "doc_id long, n_shingles long, node long, sketch binary, signatures array<long>"


def document_sets(docs: DataFrame, index: Callable[[np.ndarray], np.ndarray], words: int = WORDS) -> DataFrame:
    """A row per document; signatures (by ``index``) and sketch only with the first of equal sets that a task meets."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, int] = {}
        met: set[int] = set()
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens = hashed_shingles(split_words(text.as_py() or ""), kept, words)
                node = node_of(tokens)
                first = node is not None and node not in met
                if first:
                    met.add(node)
                values = (doc_id, len(tokens), node, sketch(tokens) if first else None, index(tokens) if first else None)
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["doc_id", "n_shingles", "node", "sketch", "signatures"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, SETS)


def shared_buckets(sets: DataFrame) -> DataFrame:
    """bucket, node and size (members) for every signature that two nodes or more have.

    Copies with few changes share hundreds of signatures. Signatures with the same members are one bucket.
    """
    one = Window.partitionBy("signature")
    pairs = sets.where("signatures is not null").select(F.explode("signatures").alias("signature"), "node")
    pairs = pairs.withColumn("least", F.min("node").over(one)).withColumn("most", F.max("node").over(one)).where("least <> most")
    pairs = pairs.select("signature", "node").distinct()
    members = [F.bit_xor(F.xxhash64("node", F.lit(k))).over(one) for k in range(2)]
    named = pairs.select("node", F.count(F.lit(1)).over(one).alias("size"), *[m.alias(f"of_{k}") for k, m in enumerate(members)])
    return named.select(F.xxhash64("size", "of_0", "of_1").alias("bucket"), "node", "size").distinct()


def _then_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def most_differing(a, b, percent: int):
    """Tokens in which two sets of these sizes may differ at most."""
    return (a + b) * (100 - percent) // (100 + percent)


class Members:
    """Sizes, components and sketches of the members of some buckets.

    Sketches of two lengths are compared at the shorter one: the longer is folded, as its classes are parts of the other's.
    """

    def __init__(self, sizes: np.ndarray, sketches: list[bytes], joined: np.ndarray, percent: int):
        self.sizes, self.joined, self.percent = sizes, joined, percent
        self.flat = np.frombuffer(b"".join(sketches), np.uint64)
        self.width = np.array([len(s) // 8 for s in sketches], np.int64)
        self.start = np.cumsum(self.width) - self.width

    def _folded(self, rows: np.ndarray, width: int) -> np.ndarray:
        out = np.empty((len(rows), width), np.uint64)
        own = self.width[rows]
        for w in np.unique(own).tolist():
            at = np.flatnonzero(own == w)
            words = self.flat[self.start[rows[at], None] + np.arange(w)]
            out[at] = words if w == width else np.bitwise_xor.reduce(words.reshape(len(at), w // width, width), axis=1)
        return out

    def over(self, a: np.ndarray, b: np.ndarray, surely: bool = False) -> np.ndarray:
        """How far each pair of rows lies over its limit, in bits; links are at 0 or below, but so may be others.

        ``surely`` takes the limit that a pair just similar enough can be expected to reach, and a tenth off.
        """
        x, y = self.sizes[a], self.sizes[b]
        out = np.full(len(a), np.iinfo(np.int64).max)
        limit = most_differing(x, y, self.percent)
        width = np.minimum(self.width[a], self.width[b])
        near = 100 * np.minimum(x, y) >= self.percent * np.maximum(x, y)
        for w in np.unique(width[near]).tolist():
            at = np.flatnonzero(near & (width == w))
            most = limit[at]
            if surely:
                most = 0.9 * 32 * w * (1 - np.exp(-most / (32 * w)))
            out[at] = np.bitwise_count(self._folded(a[at], w) ^ self._folded(b[at], w)).sum(1) - np.int64(1) * np.floor(most).astype(np.int64)
        return out

    def forest(self, rows: np.ndarray, apart: Apart) -> list[tuple[int, int]]:
        """Pairs of rows that connect whatever the sketches allow to be connected, the surest pairs first.

        What is joined already needs no pair; pairs in ``apart`` are known not to be linked.
        """
        edges, joined = [], self.joined[rows].copy()
        for surely in (True, False):
            waiting = np.arange(len(rows))
            found = []
            while len(waiting) and len(np.unique(joined[waiting])) > 1:
                reach, waiting = [int(waiting[0])], waiting[1:]
                while reach and len(waiting):
                    k = reach.pop()
                    same = joined[waiting] == joined[k]
                    near = same.copy()
                    other = np.flatnonzero(~same)
                    if len(other):
                        to = waiting[other]
                        near[other] = self.over(np.full(len(to), rows[k]), rows[to], surely) <= 0
                        for j in other[near[other]].tolist() if apart else ():
                            near[j] = (rows[k], rows[waiting[j]]) not in apart
                    found += [(k, j) for j in waiting[near & ~same].tolist()]
                    reach += waiting[near].tolist()
                    waiting = waiting[~near]
            for k, j in found:
                joined[joined == joined[j]] = joined[k]
            edges += [(int(rows[k]), int(rows[j])) for k, j in found]
        return edges

    def nearest(self, rows: np.ndarray, apart: Apart, n: int) -> list[tuple[int, int]]:
        """For each row the ``n`` pairs that look most alike of those that may be linked, and are not known to be."""
        found = []
        for k in rows.tolist():
            to = rows[self.joined[rows] != self.joined[k]]
            over = self.over(np.full(len(to), k), to)
            to = to[np.argsort(over, kind="stable")][: int((over <= 0).sum())]
            found += [(k, j) for j in [j for j in to.tolist() if (k, j) not in apart][:n]]
        return found


class Apart(set):
    """Pairs of rows in either order."""

    def __contains__(self, pair) -> bool:
        return super().__contains__((min(pair), max(pair)))


def candidate_edges(members: DataFrame, nodes: DataFrame, percent: int, nearest: int = 0) -> DataFrame:
    """Pairs (a, b) that connect every bucket as far as sketches allow, and besides the ``nearest`` of each node.

    ``nodes`` has node, n_shingles, sketch, joined, and apart (nodes known to be no links, or NULL).
    """
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    own = F.pmod(F.xxhash64("node"), tiles).cast("int")
    rows = members.join(nodes, "node").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
    tile = ["bucket", "low", "high"]
    rows = rows.select(
        "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        "node", "n_shingles", "joined", "sketch", "apart",
    ).repartition(*map(F.col, tile)).sortWithinPartitions(*tile, "node")

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        told: set[tuple[int, int]] = set()
        for batch in _then_end(batches):
            if batch is not None:
                now = pa.Table.from_batches([batch])
                rest = now if rest is None else pa.concat_tables([rest, now])
            if rest is None or not len(rest):
                continue
            keys = np.stack([np.asarray(rest[c]) for c in tile])
            begin = np.flatnonzero(np.r_[True, (np.diff(keys) != 0).any(0)])
            end = np.r_[begin[1:], len(rest)]
            if batch is not None:  # the last bucket may go on
                begin, end = begin[:-1], end[:-1]
            found = set(_edges(rest, begin, end, percent, nearest)) - told
            rest = rest.slice(end[-1] if len(end) else 0)
            if found:
                told = found | (told if len(told) < 100_000 else set())
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])

    return rows.mapInArrow(connect, "a long, b long").distinct()


def _edges(rows: pa.Table, begin: np.ndarray, end: np.ndarray, percent: int, nearest: int) -> Iterator[tuple[int, int]]:
    """Pairs of nodes of each bucket, the smaller first; buckets of two are compared all at once."""
    if not len(begin):
        return
    node, sizes, joined = (np.asarray(rows[c]) for c in ("node", "n_shingles", "joined"))
    members = Members(sizes, rows["sketch"].to_pylist(), joined, percent)
    known = rows["apart"].to_pylist() if rows["apart"].null_count < len(rows) else None
    two = begin[(end - begin == 2) & (joined[begin] != joined[np.minimum(begin + 1, len(joined) - 1)])]
    pairs = two[members.over(two, two + 1) <= 0].tolist()
    found = [(i, i + 1) for i in pairs if known is None or int(node[i + 1]) not in (known[i] or ())]
    for i, j in zip(begin.tolist(), end.tolist(), strict=True):
        if j - i > 2:
            apart = Apart()
            if known is not None:
                at = {n: i + k for k, n in enumerate(node[i:j].tolist())}
                apart.update((min(k, at[n]), max(k, at[n])) for k in range(i, j) for n in known[k] or () if n in at)
            inside = np.arange(i, j)
            found += members.forest(inside, apart)
            if nearest:
                found += members.nearest(inside, apart, nearest)
    for x, y in found:
        yield min(int(node[x]), int(node[y])), max(int(node[x]), int(node[y]))


def verified(edges: DataFrame, texts: DataFrame, percent: int, words: int = WORDS) -> DataFrame:
    """a, b and linked: whether the word sets of two nodes are similar. ``texts`` has node and text."""
    sides = [texts.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}")) for side in "ab"]
    pairs = edges.join(sides[0], "a").join(sides[1], "b").select("a", "b", "text_a", "text_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for text_a, text_b in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (shingles(split_words(t.as_py()), words) for t in (text_a, text_b))
                both = len(x & y)
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    return pairs.mapInArrow(compare, "a long, b long, linked boolean")


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node that it is connected with) of every node in ``edges`` (a, b).

    Stars are joined in turn: each node hangs its larger neighbours, then itself and its smaller ones, on the smallest it knows. Each round is
    stored, so nothing is recomputed; their number grows with the logarithm of the longest path.
    """
    pairs, before = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(lowest, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        older, pairs = pairs if before else None, staged(small.union(lowest.select("u", F.col("low").alias("v"))).distinct(), "stars")
        discard(older)
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    found = staged(roots.union(roots.select(F.col("root").alias("node"), "root").distinct()), "roots")
    discard(pairs)
    return found


def near_duplicates(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id of every document, by universe partition. ``words`` is the length of a shingle."""
    plans: dict[int, tuple[int, int]] = {}
    sets = docs.count()
    return _connected(docs, lambda tokens: signatures(tokens, percent, sets, plans), percent, words)


def near_duplicates_by_segments(docs: DataFrame, percent: int, words: int) -> DataFrame:
    """The same rows, by universe partition with segments to spare: for limits at which ``near_duplicates`` would store every token twice or more."""
    plans: dict[int, tuple[int, int]] = {}
    sets = docs.count()
    common = common_tokens(docs, sets, words)
    return _connected(docs, lambda tokens: kept_segments(tokens, percent, sets, plans, *common), percent, words)


def _connected(docs: DataFrame, index: Callable[[np.ndarray], np.ndarray], percent: int, words: int) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = staged(document_sets(docs, index, words), "sets")
    ids = staged(sets.select("doc_id", "n_shingles", "node"), "ids")
    named = ids.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first_id"))
    work = staged(shared_buckets(sets), "members")
    shared = work.select("node").distinct()
    known = sets.where("sketch is not null").select("node", "n_shingles", "sketch").join(shared, "node", "left_semi").dropDuplicates(["node"])
    known = staged(known.join(named, "node"), "nodes")
    discard(sets)  # signatures take more room than all else
    stars, apart, texts, nearest = None, None, None, 0
    while True:
        state = known.select("node", "n_shingles", "sketch")
        if stars is None:
            state = state.withColumn("joined", F.col("node"))
        else:
            state = state.join(stars, "node", "left").withColumn("joined", F.coalesce("root", "node")).drop("root")
        if apart is None:
            state = state.withColumn("apart", F.lit(None).cast("array<long>"))
        else:
            state = state.join(apart.groupBy(F.col("a").alias("node")).agg(F.collect_set("b").alias("apart")), "node", "left")
        edges = staged(candidate_edges(work, state, percent, nearest), "edges")
        if texts is None:
            # a node that may be linked with any other has an edge in this first round
            ends = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            texts = _texts_of(docs, known.join(ends, "node", "left_semi").select("node", F.col("first_id").alias("doc_id")), words)
        judged = staged(verified(edges, texts, percent, words), "judged")
        good, bad = judged.where("linked").select("a", "b"), judged.where("not linked").select("a", "b")
        if good.take(1):
            before, stars = stars, components(good if stars is None else good.union(stars.select(F.col("root").alias("a"), F.col("node").alias("b"))))
            discard(before)
        # Only buckets with a pair that failed have more to find.
        if not bad.take(1):
            break
        before, apart = apart, staged(bad if apart is None else apart.union(bad), "apart")
        again = work.select("bucket", F.col("node").alias("a")).join(bad, "a").join(work.select("bucket", F.col("node").alias("b")), ["bucket", "b"])
        older, work = work, staged(work.join(again.select("bucket").distinct(), "bucket", "left_semi"), "members")
        discard(before, older, edges, judged)
        nearest = 4 * nearest or 4
    if stars is not None:
        named = named.join(stars, "node", "left").withColumn("root", F.coalesce("root", "node"))
        lowest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
        named = named.join(lowest, "root").select("node", "component_id")
    else:
        named = named.withColumnRenamed("first_id", "component_id")
    discard(texts, work, known)
    return ids.join(named, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _texts_of(docs: DataFrame, wanted: DataFrame, words: int = WORDS) -> DataFrame:
    """node and text of the documents wanted (node, doc_id), stored. A doc_id may name several texts: the node tells which is meant."""
    wanted = staged(wanted.select("node", F.col("doc_id").alias("named")), "wanted")
    small = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    rows = docs.where("text is not null").join(small, F.col("doc_id").eqNullSafe(F.col("named"))).select("node", "text")

    def meant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, int] = {}
        for batch in batches:
            same = [
                node_of(hashed_shingles(split_words(text.as_py()), kept, words)) == node
                for node, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
            ]
            yield batch.filter(pa.array(same, pa.bool_()))

    return staged(rows.mapInArrow(meant, "node long, text string").dropDuplicates(["node"]), "texts")
