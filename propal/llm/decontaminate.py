"""Benchmark decontamination: q-gram lemma filtering.

Each run of 13 words of a benchmark item is a window, and an item of fewer is
one window, so a passage of 13 words is found wherever it lies in its item.  A
window of w characters and a document region within e edits share at least
w - q + 1 - q*e character q-grams, whose diagonals (document place less window
place) span at most e.  Shared q-grams are therefore counted in diagonal bands
of width 2(e+1) that overlap by half, first by item and then, where an item
has enough for one of its windows, by window; bands that meet the bound are
verified by banded alignment.

The benchmark is a stated query set: its q-gram index is broadcast while it
holds at most ``INDEX_CHARS`` characters, and a larger benchmark is taken in
shards of that size, each against all documents.  Documents are read once per
shard and never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text, slices, table

Q = 8
#: Words of a window; a longer word than LONG counts as one for each PIECE
#: characters, and a character of scripts without spaces as half a word.
WORDS, LONG, PIECE = 13, 24, 8
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x9FFF), (0xA000, 0xA4CF), (0xF900, 0xFAFF),
            (0x1B000, 0x1B16F), (0x20000, 0x3FFFF))
#: Edits allowed per character of a window.
EDIT_RATE = 0.1
#: Characters of the benchmark in one broadcast index (about 60 bytes each).
INDEX_CHARS = 1 << 20
#: Between texts in one array; no text has it.
EDGE = 0x110000
MULTIPLIER = 0x9E3779B97F4A7C15
BITS = 22
#: Keeps the cells of different items apart.
SPREAD = 0x9E3779B1


@cache
def folding() -> np.ndarray:
    """Lower case of every letter and digit as a code point; a space for the rest."""
    out = np.full(0x110000, 32, np.uint32)
    for p in range(0x110000):
        c = chr(p)
        if c.isalnum():
            low = c.lower()
            out[p] = ord(low) if len(low) == 1 else p
    return out


def normalised(text: str) -> np.ndarray:
    """Code points in lower case; runs of anything but letters and digits are
    one space, and none at the ends."""
    chars = folding()[np.frombuffer(text.encode("utf-32-le"), "<u4")]
    space = chars == 32
    if not len(chars) or space.all():
        return chars[:0]
    keep = ~space
    keep[1:] |= ~space[:-1]
    chars = chars[keep]
    return chars[int(chars[0] == 32):len(chars) - int(chars[-1] == 32)]


def qgrams(chars: np.ndarray) -> np.ndarray:
    """64-bit hashes of all 8-grams, by doubling."""
    h, factor = chars.astype(np.uint64) + np.uint64(1), MULTIPLIER
    for step in (1, 2, 4):
        if len(h) <= step:
            return np.empty(0, np.uint64)
        h = h[:-step] * np.uint64(factor) + h[step:]
        factor = factor * factor & 0xFFFFFFFFFFFFFFFF
    return h


def _slot(h: np.ndarray) -> np.ndarray:
    return ((h ^ h >> np.uint64(29)) * np.uint64(MULTIPLIER)) >> np.uint64(64 - BITS)


def edits_of(w: int) -> int:
    """Edit budget of a window, with which the lemma's bound stays positive."""
    return max(0, min(int(w * EDIT_RATE), (w - Q) // Q))


def spans(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the windows of a normalised text; both ascend."""
    space = chars == 32
    alone = np.logical_or.reduce([(chars >= a) & (chars <= b) for a, b in UNSPACED])
    first = ~space & (np.r_[True, space[:-1] | alone[:-1]] | alone)
    starts = np.flatnonzero(first)
    begun = starts[np.cumsum(first) - 1]                # start of the word at each place
    own = np.cumsum(first) - 1
    long = np.bincount(own[~space], minlength=len(starts)) > LONG
    place = np.arange(len(chars))
    starts = np.flatnonzero(first | ~space & long[own] & ((place - begun) % PIECE == 0))
    ends = np.r_[starts[1:], len(chars)]
    ends -= space[ends - 1]
    words = np.r_[0, np.cumsum(np.where(alone[starts], 0.5, 1.0))]
    if words[-1] <= WORDS:
        return np.array([0]), np.array([len(chars)])
    whole = np.flatnonzero(words[-1] - words[:-1] >= WORDS)
    return starts[whole], ends[np.searchsorted(words, words[whole] + WORDS) - 1]


#: Stands for a null item_id in an index.
NO_ID = -(1 << 63)


class Index:
    """Items and their windows with a sorted array of the items' q-grams."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        texts = [(item, chars) for item, text in items if len(chars := normalised(text)) >= Q]
        starts, ends, owner, number, base, gram, place = [], [], [], [], [], [], []
        low, high, at, many = [], [], 0, 0
        for k, (item, chars) in enumerate(texts):
            a, b = spans(chars)
            fits = b - a >= Q
            a, b = a[fits], b[fits]
            h = qgrams(chars)
            p = np.arange(len(h))
            # the windows that hold the q-gram at each place
            low.append(many + np.searchsorted(b, p + Q))
            high.append(np.maximum(many + np.searchsorted(a, p, "right"), low[-1]))
            starts.append(a + at)
            ends.append(b + at)
            owner.append(np.full(len(a), NO_ID if item is None else item, np.int64))
            number.append(np.full(len(h), k))
            base.append(np.full(len(h), at))
            gram.append(h)
            place.append(p + at)
            at, many = at + len(chars), many + len(a)

        def flat(parts: list[np.ndarray], kind: type) -> np.ndarray:
            return np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)
        self.chars = flat([c for _, c in texts], np.uint32)
        self.start, ends, self.owner = flat(starts, np.int64), flat(ends, np.int64), flat(owner, np.int64)
        self.windows = [self.chars[a:b] for a, b in zip(self.start, ends)]
        self.length = ends - self.start
        self.edits = np.array([edits_of(int(w)) for w in self.length], np.int64)
        self.least = self.length - Q + 1 - Q * self.edits
        # postings of gram k: many[k] from first[k]
        grams = flat(gram, np.uint64)
        order = np.argsort(grams, kind="stable")
        self.gram, self.many = np.unique(grams, return_counts=True)
        self.first = np.cumsum(self.many) - self.many
        self.item, self.base, self.place, self.low, self.high = (
            flat(x, np.int32)[order] for x in (number, base, place, low, high))
        self.seen = np.zeros(1 << BITS, bool)
        self.seen[_slot(self.gram)] = True
        # of an item: most edits and least shared q-grams of its windows
        of = np.repeat(np.arange(len(texts)), [len(a) for a in starts])
        self.most_edits = np.zeros(len(texts), np.int64)
        self.fewest = np.full(len(texts), 1 << 40, np.int64)
        np.maximum.at(self.most_edits, of, self.edits)
        np.minimum.at(self.fewest, of, self.least)
        self.longest = max([len(c) for _, c in texts], default=0)

    def hits(self, at: np.ndarray, k: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(place in the text, posting)`` in blocks of about a million."""
        lo, n = self.first[k], self.many[k]
        first, total = 0, np.cumsum(n)
        while first < len(at):
            last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + (1 << 20), "right")))
            m = n[first:last]
            yield np.repeat(at[first:last], m), np.repeat(lo[first:last] - (np.cumsum(m) - m), m) + np.arange(m.sum())
            first = last

    def bands(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(window, first diagonal of the band)`` that meet the bound."""
        h = qgrams(text)
        at = np.flatnonzero(self.seen[_slot(h)]) if len(h) else np.empty(0, int)
        k = np.minimum(np.searchsorted(self.gram, h[at]), len(self.gram) - 1)
        hit = self.gram[k] == h[at] if len(at) else np.empty(0, bool)
        at, k = at[hit], k[hit]

        def cell(where: np.ndarray, post: np.ndarray, item: np.ndarray) -> np.ndarray:
            diagonal = where - (self.place[post] - self.base[post]) + self.longest
            return (item * SPREAD + diagonal // (self.most_edits[item] + 1)) & (1 << BITS) - 1

        # hits by half band; a band is two neighbours.  Different bands may share a cell: more is kept, never less
        cells = np.zeros(1 << BITS, np.int64)
        for where, post in self.hits(at, k):
            cells += np.bincount(cell(where, post, self.item[post].astype(np.int64)), minlength=1 << BITS)
        pairs = cells + np.roll(cells, -1)
        most = np.maximum(pairs, np.roll(pairs, 1))
        counted = _Counts()
        for where, post in self.hits(at, k):
            item = self.item[post].astype(np.int64)
            kept = most[cell(where, post, item)] >= self.fewest[item]
            where, post = where[kept], post[kept]
            # each hit for all windows that hold it
            first, total = 0, np.cumsum(n := self.high[post] - self.low[post])
            while first < len(where):
                last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + (1 << 20), "right")))
                m = n[first:last]
                window = (np.repeat(self.low[post[first:last]] - (np.cumsum(m) - m), m) + np.arange(m.sum())).astype(np.int64)
                diagonal = np.repeat(where[first:last] - self.place[post[first:last]], m) + self.start[window] + self.longest
                counted.add((window << 40) + diagonal // (self.edits[window] + 1))
                first = last
        keys, counts = counted.bands()
        # a band number of -1 borrows from the window's bits; the shift by one undoes it
        window = keys + 1 >> 40
        keep = counts >= self.least[window]
        window, band = window[keep], (keys - (window << 40))[keep]
        return window, band * (self.edits[window] + 1) - self.longest

    def verify(self, text: np.ndarray, window: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least edits of each window in its band, and where that alignment ends."""
        least, ends = np.full(len(window), 1 << 20), np.zeros(len(window), np.int64)
        order = np.argsort(-self.length[window], kind="stable")
        for part in np.array_split(order, len(order) // 4096 + 1):
            own = window[part]
            length, budget = self.length[own], self.edits[own]      # length descends: the columns still at work come first
            e = int(budget.max())
            low = diagonal[part] - e                                # the band, and e more on both sides
            width = 4 * e + 3
            lane = np.arange(width, dtype=np.int16)[:, None]
            j = low + np.arange(int(length[0]) + width)[:, None]
            char = np.where((j >= 0) & (j < len(text)), text[np.clip(j, 0, len(text) - 1)], np.uint32(EDGE))
            of = np.minimum(self.start[own] + np.arange(int(length[0]))[:, None], len(self.chars) - 1)
            mine = self.chars[of]
            cost = np.zeros((width, len(part)), np.int16)
            for i in range(int(length[0]) + 1):
                n = int(np.searchsorted(-length, -i))
                if n < len(part):                                   # windows that end here
                    best = cost[:, n:].argmin(axis=0)
                    least[part[n:]] = cost[best, np.arange(n, len(part))]
                    ends[part[n:]] = low[n:] + best + length[n:]
                if i % 8 == 0 or n < len(part):
                    # costs never fall: a window above its budget in all lanes stays so
                    keep = np.flatnonzero(cost[:, :n].min(axis=0) <= budget[:n]) if i else np.arange(n)
                    if len(keep) < len(part):
                        part, length, budget, low = part[keep], length[keep], budget[keep], low[keep]
                        char, mine, cost = char[:, keep], mine[:, keep], cost[:, keep]
                if not len(part):
                    break
                step = cost + (char[i:i + width] != mine[i])
                np.minimum(step[:-1], cost[1:] + 1, out=step[:-1])
                cost = np.minimum.accumulate(step - lane, axis=0) + lane
        return least, ends

    def matches(self, text: np.ndarray) -> list[tuple[int, int, int, int]]:
        """``(window, start, end, edits)`` of the regions within the budget."""
        window, diagonal = self.bands(text)
        if not len(window):
            return []
        edits, end = self.verify(text, window, diagonal)
        good = edits <= self.edits[window]
        return [(int(w), int(e - self.length[w]), int(e), int(d))
                for w, e, d in zip(window[good], end[good], edits[good])]


class _Counts:
    """Exact counts of half bands; a band is a half band and the next one."""

    def __init__(self) -> None:
        self.keys, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, key: np.ndarray) -> None:
        key, own = np.unique(key, return_counts=True)
        if len(self.keys):
            keys, inverse = np.unique(np.concatenate([self.keys, key]), return_inverse=True)
            own = np.bincount(inverse, np.concatenate([self.counts, own]), len(keys)).astype(np.int64)
            key = keys
        self.keys, self.counts = key, own

    def bands(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys and counts of all bands that hold a hit."""
        keys, ends = self.keys, np.append(self.counts, 0)
        follows = np.append(keys[1:] == keys[:-1] + 1, False)
        alone = np.flatnonzero(~np.r_[False, follows[:-1]]) if len(keys) else np.empty(0, int)
        own = ends[:-1] + np.where(follows, ends[1:], 0)
        return np.concatenate([keys, keys[alone] - 1]), np.concatenate([own, ends[alone]])


def shards(benchmark: DataFrame, most: int = INDEX_CHARS) -> Iterator[Index]:
    """Indexes over the benchmark, each of about ``most`` characters."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-size // most) or 1
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text")
        yield Index([(r["item_id"], r["text"]) for r in part.collect()])


def _found(index: Index, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """Per text: ``(item, edits, windows)`` with the least edits and the number
    of windows found."""
    chars = [normalised(t) for t in texts]
    edge = np.array([EDGE], np.uint32)
    starts = np.cumsum([0] + [len(c) + 1 for c in chars])
    whole = np.concatenate([x for c in chars for x in (c, edge)]) if chars else edge
    found: list[dict[int, list]] = [{} for _ in texts]
    for w, start, end, edits in index.matches(whole):
        row = int(np.searchsorted(starts, max(end - 1, 0), "right")) - 1
        if not 0 <= row < len(texts):
            continue
        item = int(index.owner[w])
        best = found[row].setdefault(item, [edits, set()])
        best[0] = min(best[0], edits)
        best[1].add(w)
    return [[(i, b[0], len(b[1])) for i, b in sorted(f.items())] for f in found]


def contaminated(docs: DataFrame, benchmark: DataFrame, index_chars: int = INDEX_CHARS) -> DataFrame:
    """``(doc_id, item_id, edits, windows)``: one row per row of ``docs`` and
    item of which a window lies in its text within the edit budget.

    ``edits`` is the least number of edits of a window, ``windows`` how many
    were found.  Items of fewer than 8 letters, digits and single spaces have
    no q-gram and match nothing, like null and empty texts on either side.
    Items without an id are one item with a null ``item_id``."""
    spark = docs.sparkSession

    def task(shared) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in slices(batches, most=1 << 20):
                found = _found(index, batch.column("text").to_pylist())
                rows = [(d, None if f[0] == NO_ID else f[0], *f[1:])
                        for d, fs in zip(batch.column("doc_id").to_pylist(), found) for f in fs]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                     names=["doc_id", "item_id", "edits", "windows"])
        return run

    rows = [id_text(docs).mapInArrow(task(spark.sparkContext.broadcast(index)),
                                     "doc_id long, item_id long, edits long, windows long")
            for index in shards(benchmark, index_chars)]
    return reduce(DataFrame.unionByName, rows)


def keep_clean(docs: DataFrame, benchmark: DataFrame, index_chars: int = INDEX_CHARS) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item was found.  Rows
    are filtered where they are read."""
    spark = docs.sparkSession

    def task(shared) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in slices(batches, most=1 << 20):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                yield batch.filter(pa.array([not f for f in _found(index, texts)]))
        return run

    for index in shards(benchmark, index_chars):
        docs = docs.mapInArrow(task(spark.sparkContext.broadcast(index)), docs.schema)
    return docs


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` with an item of ``benchmark``."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
