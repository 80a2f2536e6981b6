"""Exact dedup: Patricia-trie owners.

Texts are equal when identical after lower-casing A-Z only.  Rows are dealt by
(byte length, content hash); each task inserts the full byte strings into
compressed radix tries whose terminal nodes hold the owner, here the largest
doc_id (or the smallest), and the number of rows.  Each map task merges its
own rows in a trie first, so a text with a third of all rows crosses the
shuffle once per task.  A trie over its memory budget writes its largest
subtree to a temporary file of the task and merges it when the rest is done.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of keys and nodes that a task's trie holds before it spills a subtree.
TRIE_BYTES = 48 << 20
#: What a node is taken to cost beside its label.
NODE_BYTES = 300


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving slices."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class RadixTrie:
    """Compressed trie; a node is ``[children by first byte, value]`` and a
    child is ``(label, node)``."""

    def __init__(self) -> None:
        self.root: list = [{}, None]
        self.held = 0

    def node(self, key: bytes) -> list:
        """The node of ``key``, made where missing."""
        at, i, n = self.root, 0, len(key)
        while i < n:
            edge = at[0].get(key[i])
            if edge is None:
                leaf: list = [{}, None]
                at[0][key[i]] = (key[i:], leaf)
                self.held += n - i + NODE_BYTES
                return leaf
            label, child = edge
            if not key.startswith(label, i):
                k = common_prefix(label, key[i:i + len(label)])
                child = [{label[k]: (label[k:], child)}, None]
                at[0][key[i]] = (label[:k], child)
                label = label[:k]
                self.held += NODE_BYTES
            at, i = child, i + len(label)
        return at

    def items(self) -> Iterator[tuple[bytes, object]]:
        stack = [(b"", self.root)]
        while stack:
            key, (children, value) = stack.pop()
            if value is not None:
                yield key, value
            for label, child in children.values():
                stack.append((key + label, child))


class SpillingTrie:
    """Radix tries by the byte at ``depth``; ``merge(old, new)`` joins the
    values of equal keys."""

    def __init__(self, merge: Callable, budget: int = TRIE_BYTES, depth: int = 0) -> None:
        self.merge, self.budget, self.depth = merge, budget, depth
        self.subtrees: dict[bytes, RadixTrie] = {}
        self.spilled: dict[bytes, list] = {}   # byte -> [file, a key of it, common prefix of its keys]
        self.held = 0

    def add(self, key: bytes, value: object) -> None:
        first = key[self.depth:self.depth + 1]
        trie = self.subtrees.get(first)
        if trie is None:
            trie = self.subtrees[first] = RadixTrie()
        before = trie.held
        node = trie.node(key)
        node[1] = value if node[1] is None else self.merge(node[1], value)
        self.held += trie.held - before
        if self.held > self.budget and (len(self.subtrees) > 1 or first):
            self.spill(max(self.subtrees, key=lambda b: self.subtrees[b].held))

    def spill(self, first: bytes) -> None:
        trie = self.subtrees.pop(first)
        self.held -= trie.held
        run = self.spilled.get(first)
        for key, value in trie.items():
            if run is None:
                run = self.spilled[first] = [tempfile.TemporaryFile(), key, len(key)]
            run[2] = common_prefix(run[1][:run[2]], key)
            pickle.dump((key, value), run[0], protocol=5)

    def items(self) -> Iterator[tuple[bytes, object]]:
        """All keys with their merged values; spilled subtrees one at a time."""
        for first in [b for b in self.subtrees if b in self.spilled]:
            self.spill(first)
        for trie in self.subtrees.values():
            yield from trie.items()
        self.subtrees, self.held = {}, 0
        for file, _, depth in self.spilled.values():
            rest = SpillingTrie(self.merge, self.budget, depth)
            with file:
                file.seek(0)
                while True:
                    try:
                        rest.add(*pickle.load(file))
                    except EOFError:
                        break
            yield from rest.items()


def _merger(largest: bool) -> Callable:
    def merge(a: tuple, b: tuple) -> tuple:
        x, y = a[0], b[0]
        if x is None or y is None:     # below every integer, for either order
            owner = y if x is None else x
        else:
            owner = max(x, y) if largest else min(x, y)
        return owner, a[1] + b[1], a[2], a[3]
    return merge


def _trie_task(largest: bool, budget: int) -> Callable:
    """mapInArrow function: equal byte strings of the task's rows merge."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = SpillingTrie(_merger(largest), budget)
        schema = None
        for batch in batches:
            schema = batch.schema
            lengths, hashes, shas, keys, owners, counts = (batch.column(c) for c in COLUMNS)
            for row in zip(keys, owners.to_pylist(), counts.to_pylist(), hashes.to_pylist(), shas.to_pylist()):
                trie.add(row[0].as_py(), row[1:])
        if schema is None:
            return
        out, size = [], 0
        for key, (owner, count, content, sha) in trie.items():
            out.append((len(key), content, sha, key, owner, count))
            size += len(key) + 100
            if size > 4 << 20:
                yield _batch(out, schema)
                out, size = [], 0
        if out:
            yield _batch(out, schema)
    return run


COLUMNS = ("n_bytes", "content", "text_sha256", "key", "owner", "rows")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=schema.field(n).type) for n, c in zip(COLUMNS, zip(*rows))],
        schema=pa.schema([schema.field(n) for n in COLUMNS]))


def _keyed(docs: DataFrame) -> DataFrame:
    norm = F.translate("text", UPPER, LOWER)
    return id_text(docs).select("doc_id", norm.alias("norm")).select(
        "doc_id", F.octet_length("norm").cast("long").alias("n_bytes"), F.xxhash64("norm").alias("content"),
        F.sha2("norm", 256).alias("text_sha256"), F.col("norm").cast("binary").alias("key"))


def owners(docs: DataFrame, owner: str = "largest", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per distinct normalised text: ``n_bytes, content, text_sha256,
    owner, rows``.  A null doc_id owns a text only if all its doc_ids are null."""
    task = _trie_task(owner == "largest", trie_bytes)
    rows = _keyed(docs).select("n_bytes", "content", "text_sha256", "key", F.col("doc_id").alias("owner"),
                               F.lit(1).cast("long").alias("rows"))
    schema = "n_bytes long, content long, text_sha256 string, key binary, owner long, rows long"
    merged = (rows.mapInArrow(task, schema).repartition("n_bytes", "content").mapInArrow(task, schema))
    return merged.drop("key")


def exact_dedup(docs: DataFrame, owner: str = "largest", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept,
    text_sha256``.

    ``keep_id`` is the owner of the row's text and ``group_size`` its number
    of rows, repeats included.  Null texts are empty texts; empty texts are
    equal to each other.  Rows that repeat the owner's doc_id are all kept,
    being the same document; a null doc_id is kept only where a text has no
    other."""
    of = owners(docs, owner, trie_bytes).select("n_bytes", "content", "text_sha256",
                                                F.col("owner").alias("keep_id"), F.col("rows").alias("group_size"))
    return (_keyed(docs).drop("key").join(of, ["n_bytes", "content", "text_sha256"])
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    "text_sha256"))


def keep_owners(docs: DataFrame, owner: str = "largest") -> DataFrame:
    """The rows of ``docs``, all columns, that own their text.

    A row goes with its own text, not with its doc_id: of rows that repeat a
    doc_id, one may own its text and another not.  A row without a doc_id stays."""
    gone = (exact_dedup(docs, owner).where(~F.col("kept") & F.col("doc_id").isNotNull())
            .select("doc_id", "text_sha256").distinct())
    norm = F.translate(F.coalesce(docs["text"].cast("string"), F.lit("")), UPPER, LOWER)
    own = (docs["doc_id"].cast("long") == gone["doc_id"]) & (F.sha2(norm, 256) == gone["text_sha256"])
    return docs.join(gone, own, "left_anti")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns of exact dedup over the whole ``documents``."""
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm)
"""
