"""SimHash near-dedup: segment-popcount embedding and grid range-join.

A fingerprint is the bitwise majority of the XXH64 hashes of a document's
3-word shingles.  Fingerprints at 3 or fewer differing bits are linked; linked
documents form groups.

The embedding counts the set bits in each of 32 two-bit segments.  Flipping a
bit moves one count by one, so the Manhattan distance of two embeddings is at
most the number of differing bits.  The 32 counts lie in 6 groups of segments;
3 differing bits touch at most 3 groups, so linked fingerprints agree in all
counts of some 3 groups: these are the grid's cells (20 choices of 3 groups).
Pairs in a cell are filtered by the Manhattan bound and then by the bits.
A cell passes on a spanning forest of its links, not the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from ..session import cut_lineage
from .common import id_text, slices, table, without
from .graph import components

SHINGLE, MOST_BITS, SEED = 3, 3, 42
#: Two-bit segments in each group of the grid.
GROUPS = (6, 6, 5, 5, 5, 5)
LANES = 0x5555555555555555
#: Cells above this many fingerprints are cut by their exact 16-bit blocks first.
CELL = 2048


def fingerprint(text: bytes, words_each: int = SHINGLE) -> int:
    """Unsigned fingerprint of one text (UTF-8)."""
    words = text.lower().split()            # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    if len(words) < words_each:
        words, size = [b" ".join(words)], 1
    else:
        size = words_each
    n = len(words) - size + 1
    parts = [words[k:] for k in range(size)]
    shingles = map(b" ".join, zip(*parts)) if size > 1 else iter(words)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        m = min(1 << 16, n - at)
        hashes = np.fromiter((xxh64_intdigest(s, SEED) for s, _ in zip(shingles, range(m))), np.uint64, m)
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(m, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words_each: int = SHINGLE) -> DataFrame:
    """``(doc_id, bits long)``, one row per row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").cast(pa.binary())
            found = np.fromiter((fingerprint(t.as_py(), words_each) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))],
                                             names=["doc_id", "bits"])
    return id_text(docs).mapInArrow(run, "doc_id long, bits long")


def group_masks() -> list[int]:
    masks, at = [], 0
    for n in GROUPS:
        masks.append(((1 << 2 * n) - 1) << at)
        at += 2 * n
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def cell_masks(most_bits: int) -> list[int]:
    """Masks of the embedding, one per choice of groups without a differing bit."""
    masks = group_masks()
    if not 0 <= most_bits < len(masks):
        raise ValueError(f"most_bits must be below {len(masks)}")
    return [_signed(sum(c)) for c in combinations(masks, len(masks) - most_bits)]


def embedding(bits):
    """Column: the 32 segment counts, two bits each (a half adder in each
    segment, as a plain sum would overflow a signed long)."""
    lanes = F.lit(LANES)
    low, high = bits.bitwiseAND(lanes), F.shiftrightunsigned(bits, 1).bitwiseAND(lanes)
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def embed(bits: np.ndarray) -> np.ndarray:
    return (bits & np.uint64(LANES)) + ((bits >> np.uint64(1)) & np.uint64(LANES))


def _byte_distances() -> np.ndarray:
    counts = np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3
    return np.abs(counts[:, None, :] - counts[None, :, :]).sum(axis=2).astype(np.uint8)


DISTANCE = _byte_distances()


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of embeddings."""
    x, y = (np.ascontiguousarray(v).view(np.uint8).reshape(-1, 8) for v in (a, b))
    return DISTANCE[x, y].sum(axis=1)


class Forest:
    """Union-find over 0..n-1 in arrays; links are joined in bulk."""

    def __init__(self, n: int) -> None:
        self.root, self.waiting, self.count = np.arange(n), [], 0

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        if len(i):
            self.waiting.append((i, j))
            self.count += len(i)
            if self.count > 1 << 20:
                self.join()

    def join(self) -> None:
        if not self.waiting:
            return
        i, j = (np.concatenate(x) for x in zip(*self.waiting))
        self.waiting, self.count = [], 0
        while True:
            a, b = self.root[i], self.root[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


def _linked(bits: np.ndarray, emb: np.ndarray, i: np.ndarray, j: np.ndarray, most: int) -> np.ndarray:
    """Which pairs pass the Manhattan bound and then the bits."""
    near = manhattan(emb[i], emb[j]) <= most
    near[near] = np.bitwise_count(bits[i[near]] ^ bits[j[near]]) <= most
    return near


def _pairs_in_runs(key: np.ndarray, rows: np.ndarray, check, deep: bool) -> None:
    """``check(i, j)`` for pairs of ``rows`` with equal keys.  Runs above CELL
    go to ``check`` whole where ``deep`` (as ``check(run)``), else in blocks."""
    order = np.argsort(key, kind="stable")
    key, rows = key[order], rows[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, int)
    sizes = np.diff(np.r_[starts, len(key)])
    for s, n in zip(starts[sizes > CELL], sizes[sizes > CELL]):
        run = rows[s:s + n]
        if deep:
            check(run)
            continue
        step = max(1, (1 << 20) // n)
        for at in range(0, n, step):
            i, j = np.meshgrid(np.arange(at, min(at + step, n)), np.arange(at, n), indexing="ij")
            above = j > i
            check(run[i[above]], run[j[above]])
    small = (sizes > 1) & (sizes <= CELL)
    left = np.repeat(np.where(small, sizes, 0), sizes) - (np.arange(len(key)) - np.repeat(starts, sizes)) - 1
    at = np.flatnonzero(left > 0)
    shift = 1
    while len(at):
        for k in range(0, len(at), 1 << 18):
            part = at[k:k + (1 << 18)]
            check(rows[part], rows[part + shift])
        shift += 1
        at = at[left[at] >= shift]


def cell_links(cells: np.ndarray, bits: np.ndarray, most: int = MOST_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links inside equal ``cells``: pairs of bits."""
    fps, node = np.unique(bits, return_inverse=True)
    emb, forest = embed(fps), Forest(len(fps))

    def check(i: np.ndarray, j: np.ndarray | None = None) -> None:
        if j is None:       # a large cell: at most 3 differing bits leave one 16-bit block equal
            for shift in (0, 16, 32, 48):
                _pairs_in_runs(fps[i] >> np.uint64(shift) & np.uint64(0xFFFF), i, check, False)
            return
        near = _linked(fps, emb, i, j, most)
        forest.link(i[near], j[near])

    _pairs_in_runs(cells, node, check, most <= 3)
    forest.join()
    child = np.flatnonzero(forest.root != np.arange(len(fps)))
    return fps[forest.root[child]], fps[child]


def links(bits: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """``(a, b)``: links of distinct ``bits`` that connect what is linked."""
    emb = embedding(F.col("bits"))
    cells = bits.select("bits", F.explode(F.array(*[
        F.xxhash64(F.lit(k), emb.bitwiseAND(F.lit(m))) for k, m in enumerate(cell_masks(most_bits))])).alias("cell"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column("cell").to_numpy(), b.column("bits").to_numpy()) for b in batches]
        if held:
            cell, fps = (np.concatenate(x) for x in zip(*held))
            a, b = cell_links(cell, fps.view(np.uint64), most_bits)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return cells.repartition("cell").mapInArrow(run, "a long, b long")


def simhash_groups(docs: DataFrame, words_each: int = SHINGLE, most_bits: int = MOST_BITS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, bits, component_id``, the
    smallest doc_id reachable over links.  Texts without words have the
    fingerprint zero and are linked like any other.  Null doc_ids are never a
    component_id unless a group has no other."""
    of = cut_lineage(fingerprints(docs, words_each))
    nodes = of.groupBy("bits").agg(F.min("doc_id").alias("least"))
    labels = components(links(nodes.select("bits"), most_bits))
    placed = (nodes.withColumn("node_key", F.xxhash64("bits")).join(labels, "node_key", "left")
              .select("bits", "least", F.coalesce("component", "node_key").alias("component")))
    group = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    by_bits = placed.join(group, "component").select("bits", "component_id")
    return of.join(by_bits, "bits").select("doc_id", "bits", "component_id")


def keep_first(docs: DataFrame, words_each: int = SHINGLE, most_bits: int = MOST_BITS) -> DataFrame:
    """The rows of ``docs``, all columns, with the smallest doc_id of their group."""
    groups = simhash_groups(docs, words_each, most_bits)
    return without(docs, groups.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns of SimHash near-dedup over the whole ``documents``."""
    return simhash_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")
