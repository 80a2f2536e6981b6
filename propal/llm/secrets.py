"""Secret scans: Aho-Corasick prefilter, anchored patterns, checksums.

One automaton finds all keywords in a text; a kind's pattern is tried only at
its keyword's hits, anchored there.  Kinds that embed a checksum or have a
checkable structure are verified before they are reported.  Documents are read
once and never shuffled.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text, slices, table

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc_base62(match: re.Match) -> bool:
    """The last 6 characters are the CRC32 of the characters between the
    prefix and them, in base 62."""
    body = match.group().split("_", 1)[1]
    value, digits = zlib.crc32(body[:-6].encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits == body[-6:]


def _unpadded(part: str) -> bytes:
    return base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))


def signed_token(match: re.Match) -> bool:
    """Header and claims are JSON objects; the header names an algorithm."""
    try:
        head, claims = (json.loads(_unpadded(p)) for p in match.group().split(".")[:2])
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(claims, dict) and "alg" in head


def key_block(match: re.Match) -> bool:
    """The body is base64 of a DER sequence, or of the key format that starts
    with its own name."""
    try:
        raw = base64.b64decode("".join(match.group(1).split()), validate=True)
    except binascii.Error:
        return False
    return raw[:1] == b"\x30" or raw.startswith(b"openssh-key-v1\0")


@dataclass(frozen=True)
class Kind:
    """``keywords`` are matched without regard to ASCII case; ``pattern`` must
    match at a hit.  Where it does not, it matches at no other hit in the run
    of ``run`` there either, so a long run is read once."""
    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    valid: Callable[[re.Match], bool]
    run: re.Pattern | None = None


#: Base kinds in the order of the contract; "hex" has no keyword and is found by its own pattern.
ASSIGN = Kind("assign", ("password", "passwd", "secret", "token", "apikey", "api_key"),
              re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                         re.IGNORECASE | re.ASCII), lambda m: len(m.group(2)) >= 12)
ACCESS = Kind("access", ("akia",), re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 18)
#: Runs of 16 and more are the whole runs of [0-9a-f]+ that are long enough.
HEX = re.compile(r"[0-9a-f]{16,}")
MORE = (
    Kind("forge", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
         crc_base62),
    Kind("package", ("npm_",), re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), crc_base62),
    Kind("jwt", ("eyj",), re.compile(r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"), signed_token,
         re.compile(r"eyJ[A-Za-z0-9_-]*")),
    Kind("key", ("-----begin ",), re.compile(
        r"-----BEGIN [A-Z ]*PRIVATE KEY-----([A-Za-z0-9+/=\s]+)-----END [A-Z ]*PRIVATE KEY-----"), key_block),
)
NAMES = ("assign", "access", "hex", *(k.name for k in MORE))


def automaton(kinds: tuple[Kind, ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind in kinds:
        for word in kind.keywords:
            found.add_word(word, (len(word), kind))
    found.make_automaton()
    return found


def folded(text: str) -> str:
    """A-Z lower-cased, every character at its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def scan(text: str, prefilter: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` in code points by start, then in the order of
    NAMES; per kind leftmost first and without overlap."""
    hits: dict[str, list] = {}
    for last, (size, kind) in prefilter.iter(folded(text)):
        hits.setdefault(kind.name, []).append((last + 1 - size, kind))
    spans = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    for name, places in hits.items():
        free = 0
        for start, kind in sorted(places, key=lambda p: p[0]):
            if start < free:
                continue
            if m := kind.pattern.match(text, start):
                free = m.end()
                if kind.valid(m):
                    spans.append((start, free, name))
            elif kind.run and (m := kind.run.match(text, start)):
                free = m.end()
    return sorted(spans, key=lambda s: (s[0], NAMES.index(s[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def secret_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans array<struct<kind, start, end, value>>)``, one row per
    row of ``docs``.  Offsets are code points, ends are exclusive.  A null
    text has no spans, like an empty one."""
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefilter = automaton((ASSIGN, ACCESS, *MORE))
        for batch in slices(batches):
            found = []
            for t in batch.column("text"):
                text = t.as_py()
                found.append([{"kind": k, "start": s, "end": e, "value": text[s:e]}
                              for s, e, k in scan(text, prefilter)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(kind))],
                                             names=["doc_id", "spans"])
    return id_text(docs).mapInArrow(
        run, "doc_id long, spans array<struct<kind: string, start: long, end: long, value: string>>")


def secret_digests(docs: DataFrame) -> DataFrame:
    """Contract columns per row of ``docs``: counts of the base kinds, the
    hash of the base spans, all spans."""
    said = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("spans", lambda x: x["kind"].isin("assign", "access", "hex"))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return secret_spans(docs).select(
        "doc_id", *(count(k) for k in ("assign", "access", "hex")),
        F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns of the secret scan over the whole ``documents``."""
    return secret_digests(table(spark, sf_dir, "documents"))
