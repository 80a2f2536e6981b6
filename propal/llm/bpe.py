"""Byte-level BPE encoding and decoding.

A text is split by the tokenizer's pattern; each piece is looked up in two
tiers.  A minimal perfect hash over the vocabulary resolves pieces that are
tokens themselves.  For the rest, the piece's bytes form a linked list and a
heap yields the adjacent pair of lowest rank (leftmost among equals) until no
pair is a token.

The vocabulary file is a parameter.  Its tables (a few MB, bounded by the
file) are built on the driver and broadcast; documents are read once and never
shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from xxhash import xxh64_intdigest

from .common import id_text, slices, table

#: Pieces that a worker remembers; the memory is emptied when full.
REMEMBERED = 600_000
#: Multipliers of the perfect hash: 2^64 over the golden ratio, and another odd number.
GOLDEN, ODD = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
#: Texts above this many characters are taken in runs of pieces.
LONG = 1 << 20


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file (base64 token, rank on each line) by rank."""
    tokens: dict[int, bytes] = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                tokens[int(rank)] = base64.b64decode(token)
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without gaps")
    return [tokens[k] for k in range(len(tokens))]


class PerfectHash:
    """Minimal perfect hash of ``keys`` by displacement: keys fall in buckets,
    and each bucket, largest first, takes the first displacement that moves
    its keys to free slots; a single key names its slot outright."""

    def __init__(self, keys: list[bytes]) -> None:
        self.n = n = max(len(keys), 1)
        self.buckets = max(1, n // 3)
        groups: list[list[tuple[int, int]]] = [[] for _ in range(self.buckets)]
        for k, key in enumerate(keys):
            h = xxh64_intdigest(key)
            groups[h % self.buckets].append((h, k))
        self.shift = [0] * self.buckets
        self.at = [-1] * n
        free: list[int] | None = None
        for b in sorted(range(self.buckets), key=lambda b: -len(groups[b])):
            group = groups[b]
            if not group:
                break
            if len(group) == 1:
                if free is None:
                    free = [s for s in range(n) if self.at[s] < 0]
                slot = free.pop()
                self.shift[b], self.at[slot] = -slot - 1, group[0][1]
                continue
            d = 0
            while True:
                slots = {self._slot(h, d) for h, _ in group}
                if len(slots) == len(group) and all(self.at[s] < 0 for s in slots):
                    break
                d += 1
            self.shift[b] = d
            for h, k in group:
                self.at[self._slot(h, d)] = k

    def _slot(self, h: int, d: int) -> int:
        mixed = (h ^ d * GOLDEN) * ODD & 0xFFFFFFFFFFFFFFFF
        return (mixed >> 32) % self.n

    def slot(self, key: bytes) -> int:
        """Number of the key that ``key`` is, if it is one (to be compared)."""
        h = xxh64_intdigest(key)
        d = self.shift[h % self.buckets]
        return self.at[-d - 1 if d < 0 else self._slot(h, d)]


class Vocabulary:
    """Tokens by rank with both tiers."""

    def __init__(self, tokens: list[bytes], pattern: str) -> None:
        self.tokens, self.pattern = tokens, pattern
        self.ranks = {t: k for k, t in enumerate(tokens)}
        if len(self.ranks) != len(tokens) or any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("tokens must differ and hold every single byte")
        self.whole = PerfectHash(tokens)

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        if not piece:
            return ()
        rank = self.whole.slot(piece)
        return (rank,) if self.tokens[rank] == piece else self.merge(piece)

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Heap over linked bytes.  An entry is (rank, start, end); it is stale
        when its left part is gone or its right part has grown."""
        n, rank = len(piece), self.ranks.get
        end = list(range(1, n + 1))          # end of the part that starts here; 0: merged away
        before = list(range(-1, n))          # start of the part that ends where this one starts
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i:i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, stop = heappop(heap)
            mid = end[i]
            if not mid or mid >= stop or end[mid] != stop:
                continue
            end[i], end[mid] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := rank(piece[i:end[stop]])) is not None:
                    heappush(heap, (r, i, end[stop]))
            if i:
                j = before[i]
                if (r := rank(piece[j:stop])) is not None:
                    heappush(heap, (r, j, stop))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i:end[i]]])
            i = end[i]
        return tuple(ids)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Pieces(dict):
    """Ids of pieces seen before; others go through both tiers."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = self[piece] = self.vocabulary.encode_piece(piece.encode())
        return ids


class Codec:
    """Encoder and decoder of a worker."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.pieces, self.find = Pieces(vocabulary), regex.compile(vocabulary.pattern)
        self.decode = vocabulary.decode
        self.names = [str(k) for k in range(len(vocabulary.tokens))]

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.find.findall(text))))

    def runs(self, text: str) -> Iterator[list[int]]:
        """The text's ids; a long text in runs, to bound what is held."""
        if len(text) <= LONG:
            yield self.encode(text)
            return
        found = self.find.finditer(text)
        while run := list(islice(found, 1 << 16)):
            yield list(chain.from_iterable(self.pieces[m.group()] for m in run))

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, hash of the ids, hash of the decoded bytes."""
        n, ids_hash, bytes_hash = 0, hashlib.sha256(), hashlib.sha256()
        for ids in self.runs(text):
            if ids:
                ids_hash.update((" " * bool(n) + " ".join(map(self.names.__getitem__, ids))).encode())
                bytes_hash.update(self.decode(ids))
                n += len(ids)
        return n, ids_hash.hexdigest(), bytes_hash.hexdigest()


#: The codec that a worker process made last, by the name of its vocabulary's broadcast.
_codec: dict[str, Codec] = {}


def _codec_of(shared) -> Codec:
    if shared.id not in _codec:
        _codec.clear()
        _codec[shared.id] = Codec(shared.value)
    return _codec[shared.id]


class _Shared:
    """A broadcast vocabulary with a name that is the same in all tasks and
    that no other broadcast ever has (an object's address would come back)."""

    def __init__(self, spark: SparkSession, vocabulary: Vocabulary) -> None:
        self.id, self.sent = uuid.uuid4().hex, spark.sparkContext.broadcast(vocabulary)

    @property
    def value(self) -> Vocabulary:
        return self.sent.value


def share(spark: SparkSession, path: str, pattern: str) -> _Shared:
    return _Shared(spark, Vocabulary(read_ranks(path), pattern))


def encode(docs: DataFrame, vocabulary: _Shared) -> DataFrame:
    """``(doc_id, ids array<int>)``, one row per row of ``docs``; an empty or
    null text has no ids.  Special tokens are ordinary text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec_of(vocabulary)
        for batch in slices(batches, most=1 << 20):
            ids = [list(chain.from_iterable(codec.runs(t.as_py()))) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))],
                                             names=["doc_id", "ids"])
    return id_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(ids: DataFrame, vocabulary: _Shared) -> DataFrame:
    """``(doc_id, text)`` of ``(doc_id, ids)``; null ids give a null text.
    Bytes that are not UTF-8 become U+FFFD, as ids may be cut anywhere."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec_of(vocabulary)
        for batch in slices(batches, "ids", 1 << 20):
            texts = [None if (x := r.as_py()) is None else codec.decode(x).decode("utf-8", "replace")
                     for r in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])
    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, vocabulary: _Shared) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: each text encoded
    and its ids decoded, without keeping them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec_of(vocabulary)
        for batch in slices(batches, most=1 << 20):
            found = [codec.digests(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c) for c in zip(*found))],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return id_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def public_vocabulary(spark: SparkSession, name: str = "byte_bpe_50k.tiktoken") -> _Shared:
    import public_tokenizers

    return share(spark, public_tokenizers.path(name), public_tokenizers.PATTERN)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns of the byte-level BPE round trip over the whole ``documents``."""
    return round_trip(table(spark, sf_dir, "documents"), public_vocabulary(spark))
