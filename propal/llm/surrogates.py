"""PII: surrogate generation.

Entities are found by kind and replaced by keyed surrogates of the same kind
and format: digits stay digits, letters stay letters of their alphabet and
case, separators, country codes, top-level domains and the validity of check
digits stay; listed given names keep their gender, others their shape.  A
surrogate depends on the key and the entity alone, so all mentions of an
entity agree in all documents.  A name is found after a title, and then
wherever else its document mentions it; the title is not part of the entity.

Within a format a surrogate is a keyed permutation that leaves nothing in its
place, which keeps entities apart however many there are.  A check over all
distinct entities still looks for surrogates that two entities share or that
equal their entity, and draws these anew with another permutation until there
are none.  What was drawn anew is broadcast while it
is at most ``REDRAWN`` rows, and else joined to its documents.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import id_text, slices, table

KEY = b"surrogates-1"
REDRAWN = 100_000
#: Turns after which an entity that is its own surrogate is taken for the only one of its format.
SELF = 8
ROUNDS = 8

#: Alphabets: a letter is replaced within its own (lower case; upper case follows).
ALPHABETS = ("abcdefghijklmnopqrstuvwxyz", "0123456789", "àáâãäåæçèéêëìíîïñòóôõöøùúûüý",
             "αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзийклмнопрстуфхцчшщъыьэюя")
VOWELS, CONSONANTS = "aeiou", "bcdfghjklmnpqrstvwxyz"
#: Given names by gender and script; a surrogate comes from the same list.
GIVEN = (
    ("anna", "clara", "elena", "emma", "helen", "julia", "laura", "maria", "marta", "nina", "paula", "sarah", "sofia"),
    ("adam", "carlos", "daniel", "david", "felix", "jonas", "john", "lucas", "mark", "martin", "paul", "peter", "thomas"),
    ("анна", "елена", "ирина", "мария", "нина", "ольга", "софия"),
    ("андрей", "борис", "иван", "михаил", "николай", "павел", "сергей"),
    ("ελένη", "κατερίνα", "μαρία", "σοφία"),
    ("γιώργος", "δημήτρης", "νίκος", "πέτρος"),
)
LISTED = frozenset(name for names in GIVEN for name in names)
#: Titles before a name.
FEMALE = ("mrs", "ms", "miss", "frau", "señora", "sra", "madame", "mme", "госпожа", "κυρία")
MALE = ("mr", "herr", "señor", "sr", "monsieur", "господин", "κύριος")
NEUTRAL = ("dr", "prof")

WORD = r"[^\W\d_]+(?:[-'][^\W\d_]+)*"
TITLES = "|".join(sorted((f(t) for t in (*FEMALE, *MALE, *NEUTRAL) for f in (str.capitalize, str.upper)), key=len,
                         reverse=True))
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9À-ÿ_.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    "ipv4": re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\w)"),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    # in turn: 3-3-4 and bracketed codes, +country with groups, 0 (or 00) with groups, nine digits from 6 to 9 in groups
    "phone": re.compile(r"(?<![\w+])(?=[+(\d])(?:(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}"
                        r"|\d{3}[ .-]\d{3}[ .-]\d{4})|\+\d{7,15}"
                        r"|\+\d{1,3}[ .-]?(?:\(\d{1,5}\)[ .-]?)?\d{1,12}(?:[ ./-]\d{1,8}){0,6}"
                        r"|(?<![./-])0\d{1,4}(?P<gap>[ ./-])\d{2,8}(?:(?P=gap)\d{2,8}){0,4}"
                        r"|(?<![./-])[6-9]\d\d(?:([ -])\d{3}\2\d{3}|([ -])\d\d\3\d\d\3\d\d))(?!\w)"),
    "card": re.compile(r"(?<!\w)(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?!\w)"),
    "name": re.compile(rf"(?<!\w)(?:{TITLES})\.? +(?=[^\W\d_])({WORD}(?: +{WORD}){{0,2}})"),
}
KINDS = tuple(PATTERNS)


def luhn(payload: str) -> int:
    """Check digit of a string of digits."""
    total = 0
    for k, c in enumerate(reversed(payload)):
        d = int(c) * (2 - k % 2)
        total += d - 9 * (d > 9)
    return -total % 10


def iban_rest(country: str, account: str, check: str) -> int:
    return int("".join(str(int(c, 36)) for c in account + country + check)) % 97


@lru_cache(1 << 10)
def block(number: int) -> str:
    """Lower-case or caseless letters of a block of 256 code points that are in
    no alphabet."""
    return "".join(c for c in map(chr, range(number << 8, number + 1 << 8))
                   if c.isalpha() and c.lower() == c and not any(c in a for a in ALPHABETS))


class Keyed:
    """Permutations under a key."""

    def __init__(self, key: bytes = KEY) -> None:
        self.key = key
        self.surrogate = lru_cache(1 << 16)(self._surrogate)

    def number(self, x: int, n: int, use: str) -> int:
        """Permutation of 0..n-1 that leaves no number in its place: the next
        one in a keyed order."""
        if n < 2:
            return x
        return self._walk((self._walk(x, n, use) + 1) % n, n, use, back=True)

    def _walk(self, x: int, n: int, use: str, back: bool = False) -> int:
        """Permutation of 0..n-1, or its inverse: a Feistel network on the
        bits, walked until the value is in range."""
        half = ((n - 1).bit_length() + 1) // 2
        mask, size = (1 << half) - 1, (half + 7) // 8
        while True:
            left, right = (x & mask, x >> half) if back else (x >> half, x & mask)
            for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
                said = f"{use}:{n}:{k}:".encode() + right.to_bytes(size, "big")
                mix = b"".join(hashlib.blake2b(said + bytes([b]), key=self.key, digest_size=32).digest()
                               for b in range(-(-size // 32)))
                left, right = right, left ^ int.from_bytes(mix, "big") & mask
            x = right << half | left if back else left << half | right
            if x < n:
                return x

    def spelled(self, text: str, use: str, alphabets: tuple[str, ...] = ALPHABETS) -> str:
        """Permutes texts of one shape: each letter within its alphabet and case."""
        value, n, places = 0, 1, []
        for k, c in enumerate(text):
            low = c.lower()
            if not c.isalnum() or len(low) != 1 or c not in (low, low.upper()):
                continue
            letters = next((a for a in alphabets if low in a), None) or block(ord(low) >> 8)
            if low in letters:
                value, n = value + letters.index(low) * n, n * len(letters)
                places.append((k, letters, low != c))
        value, out = self.number(value, n, use), list(text)
        for k, letters, upper in places:
            value, at = divmod(value, len(letters))
            out[k] = letters[at].upper() if upper else letters[at]
        return "".join(out)

    def given(self, name: str, use: str) -> str:
        """Permutes the names of a list, and within a shape those of no list."""
        low = name.lower()
        for names in GIVEN:
            if low in names:
                return _cased(names[self.number(names.index(low), len(names), use)], name)
        new = self.spelled(low, use, (VOWELS, CONSONANTS, *ALPHABETS))
        while new in LISTED:            # the walk ends at the latest where it began, and keeps names apart
            new = self.spelled(new, use, (VOWELS, CONSONANTS, *ALPHABETS))
        return _cased(new, name)

    def _surrogate(self, kind: str, entity: str, turn: int) -> str:
        """Surrogate of a canonical entity; each ``turn`` is another permutation."""
        use = f"{kind}:{turn}"
        if kind == "email":
            local, domain = entity.rsplit("@", 1)
            labels, top = domain.rsplit(".", 1)
            return f"{self.spelled(local, use)}@{self.spelled(labels, f'domain:{turn}')}.{top}"
        if kind == "ipv4":
            value = 0
            for part in entity.split("."):
                value = value << 8 | int(part)
            value = self.number(value, 1 << 32, use)
            return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))
        if kind == "card":
            payload = entity[:-1]
            new = f"{self.number(int(payload), 10 ** len(payload), use):0{len(payload)}d}"
            return new + str((luhn(new) + int(entity[-1]) - luhn(payload)) % 10)
        if kind == "iban":
            account = self.spelled(entity[4:].lower(), use).upper()
            rest = 98 - iban_rest(entity[:2], account, "00")
            return f"{entity[:2]}{rest:02d}{account}"
        if kind == "name":
            words = entity.split(" ")
            last = self.spelled(words[-1], use, (VOWELS, CONSONANTS, *ALPHABETS))
            return " ".join([*(self.given(w, use) for w in words[:-1]), last])
        head, _, rest = entity.rpartition("|")       # phone: country code, then the rest; ssn: no head
        return f"{head}|{self.spelled(rest, use)}" if head else self.spelled(rest, use)


def _cased(new: str, old: str) -> str:
    return new.upper() if old.isupper() and len(old) > 1 else new.capitalize() if old[:1].isupper() else new


def canonical(kind: str, text: str, match: re.Match | None = None) -> str | None:
    """The entity that a mention names; None if it is not of the kind."""
    if kind == "email":
        return text.lower() if any(map(str.isalnum, text.split("@")[0])) else None
    if kind == "ipv4":
        parts = [int(p) for p in text.split(".")]
        return ".".join(map(str, parts)) if max(parts) < 256 else None
    if kind == "iban":
        bare = text.replace(" ", "")
        return bare if 15 <= len(bare) <= 34 and iban_rest(bare[:2], bare[4:], bare[2:4]) == 1 else None
    if kind == "name":
        words = match.group(1).split()
        while words and not words[-1][0].isupper():
            words.pop()
        if not words or not all(w[0].isupper() for w in words):
            return None
        return " ".join(words).lower().removesuffix("'s")
    digits = re.sub(r"\D", "", text)
    if kind == "phone":
        if not 7 <= len(digits) <= 15 or digits[0] == "0" and text[0] == "0" and len(digits) < 9 and not US.fullmatch(text):
            return None
        if text[0] == "+" and (head := COUNTRY.match(digits)):
            return f"{head.group()}|{digits[head.end():]}"
        if text[0] == "0" and not US.fullmatch(text):
            return f"0|{digits[1:]}"
        if len(digits) == 9 and text[0] in "6789":
            return f"{digits[0]}|{digits[1:]}"
    return digits


def mentioned_again(text: str, found: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """``found`` with all mentions of its names: a whole name without a title,
    and a word of one by itself, with or without, mean the longest name of the
    document that has it."""
    known: dict[tuple[str, ...], str] = {}
    for entity in sorted({e for _, _, kind, e in found if kind == "name"}, key=lambda e: (-len(e.split(" ")), e)):
        words = tuple(entity.split(" "))
        for part in (words, *((w,) for w in reversed(words) if len(w) > 1)):
            known.setdefault(part, entity)
    out = [(s, e, kind, known.get(tuple(entity.split(" ")), entity) if kind == "name" else entity)
           for s, e, kind, entity in found]
    starts = [s for s, *_ in found]
    tokens = list(NAME_WORD.finditer(text))
    k = 0
    while k < len(tokens):
        taken = 1
        for n in (3, 2, 1):
            run = tokens[k:k + n]
            if len(run) < n or not all(t.group()[0].isupper() for t in run):
                continue
            if any(text[a.end():b.start()].strip() or a.end() == b.start() for a, b in zip(run, run[1:])):
                continue
            words, end = [t.group().lower() for t in run], run[-1].end()
            if tuple(words) not in known and words[-1].endswith("'s"):
                words[-1], end = words[-1][:-2], end - 2
            entity, start = known.get(tuple(words)), run[0].start()
            at = bisect_left(starts, end)       # the last found one that starts before the end
            if entity and (not at or found[at - 1][1] <= start):
                out.append((start, end, "name", entity))
                taken = n
                break
        k += taken
    return sorted(out)


def emails(text: str) -> Iterator[re.Match]:
    """The matches of the email pattern, found from each @ backwards: a long
    run of letters is read once instead of from each of its letters."""
    free, at = 0, text.find("@")
    while at >= 0:
        if DOMAIN.match(text, at + 1):
            start = at
            while start > free and LOCAL.match(text, start - 1):
                start -= 1
            if start < at:
                m = PATTERNS["email"].match(text, start)
                free = m.end()
                yield m
        at = text.find("@", max(at + 1, free))


def find(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, entity)`` without overlaps, by start; where kinds
    overlap, the one first in KINDS counts."""
    found: list[tuple[int, int, str, str]] = []
    for kind, pattern in PATTERNS.items():
        if kind == "email" and "@" not in text or kind not in ("email", "name") and not DIGIT.search(text):
            continue
        starts, ends = [f[0] for f in found], [f[1] for f in found]       # of earlier kinds, both ascend
        for m in emails(text) if kind == "email" else pattern.finditer(text):
            start, end = m.span(1) if kind == "name" else m.span()
            entity = canonical(kind, m.group(), m)
            if kind == "name" and entity:
                end = start + sum(len(w) for w in re.split(r"(\s+)", m.group(1))[:2 * len(entity.split(" ")) - 1])
                end -= 2 * (text[end - 2:end] == "'s")
            at = bisect_right(ends, start)
            if entity and (at == len(starts) or starts[at] >= end):
                found.append((start, end, kind, entity))
        found.sort()
    return mentioned_again(text, found) if any(f[2] == "name" for f in found) else found


DIGIT = re.compile(r"[0-9]")
#: A character before the @ of an email, and what follows the @.
LOCAL = re.compile(r"[A-Za-z0-9À-ÿ_.+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
NAME_WORD = re.compile(rf"(?<!\w){WORD}(?!\w)")
#: Country codes; none begins another.
COUNTRY = re.compile(r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}")
#: Numbers of 3-3-4 digits, whose first digit is no trunk prefix.
US = re.compile(r"\d{3}[ .-]\d{3}[ .-]\d{4}")


def written(kind: str, mention: str, surrogate: str, entity: str = "") -> str:
    """The surrogate in the mention's format; of a name, the mentioned words."""
    if kind == "ipv4":
        return surrogate
    if kind == "name" and " " not in mention.strip() and " " in entity and len(mention.split()) == 1:
        words = entity.split(" ")
        surrogate = surrogate.split(" ")[len(words) - 1 - words[::-1].index(mention.lower())]
    new = iter(surrogate.replace("|", "").replace(" ", "") if kind != "name" else surrogate.split(" "))
    if kind == "name":
        return re.sub(r"\S+", lambda m: _cased(next(new), m.group()), mention)
    if kind in ("email", "iban"):
        out = []
        for c in mention:
            n = c if c == " " else next(new)
            out.append(n.upper() if c.isupper() else n)
        return "".join(out)
    return re.sub(r"\d", lambda m: next(new), mention)


def replace(text: str, keyed: Keyed, turns: dict[tuple[str, str], int]) -> tuple[str, list[str]]:
    """The text with surrogates, and the kinds found."""
    out, at, kinds = [], 0, []
    for start, end, kind, entity in find(text):
        surrogate = keyed.surrogate(kind, entity, turns.get((kind, entity), 0))
        out += [text[at:start], written(kind, text[start:end], surrogate, entity)]
        at = end
        kinds.append(kind)
    return "".join([*out, text[at:]]), kinds


ENTITY = "kind string, entity string, turn int, surrogate string"


def _draw(key: bytes) -> Callable:
    """Surrogates of ``(kind, entity, turn)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyed = Keyed(key)
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("kind", "entity", "turn"))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("kind"), batch.column("entity"), batch.column("turn"),
                 pa.array([keyed.surrogate(*r) for r in rows], pa.string())],
                names=["kind", "entity", "turn", "surrogate"])
    return run


def mentions(docs: DataFrame) -> DataFrame:
    """``(doc_id, kind, entity)``, distinct within a document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [(d, *e) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                    for e in sorted({(k, e) for _, _, k, e in find(t)})]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.int64(), pa.string(), pa.string()))], names=["doc_id", "kind", "entity"])
    return id_text(docs).mapInArrow(run, "doc_id long, kind string, entity string")


def redrawn(found: DataFrame, key: bytes = KEY) -> DataFrame:
    """``(kind, entity, turn)`` of the entities whose first surrogate is
    another's or their own, with the turn at which all surrogates differ."""
    start = found.select("kind", "entity").distinct().withColumn("turn", F.lit(0))
    drawn = cut_lineage(start.mapInArrow(_draw(key), ENTITY))
    while True:
        # of entities that share a surrogate, the one of the lowest turn keeps it
        first = (drawn.groupBy("kind", "surrogate")
                 .agg(F.count("*").alias("n"), F.min(F.struct("turn", "entity")).alias("first"))
                 .where("n > 1").select("kind", "surrogate", "first.entity").withColumnRenamed("entity", "keeper"))
        clash = cut_lineage(
            drawn.join(first, ["kind", "surrogate"], "left")
            .where((F.col("keeper").isNotNull() & (F.col("keeper") != F.col("entity")))
                   | ((F.col("surrogate") == F.col("entity")) & (F.col("turn") < SELF)))
            .select("kind", "entity", (F.col("turn") + 1).cast("int").alias("turn")))
        if clash.isEmpty():
            return drawn.where("turn > 0").select("kind", "entity", "turn")
        rest = drawn.join(clash.select("kind", "entity"), ["kind", "entity"], "left_anti").select(drawn.columns)
        drawn = cut_lineage(rest.unionByName(clash.mapInArrow(_draw(key), ENTITY)))


def with_surrogates(docs: DataFrame, key: bytes = KEY, most_redrawn: int = REDRAWN) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text, kinds``: the text with all
    entities replaced and the kinds found, in order.  A null text is empty.

    An entity that is the only one of its format (a name in a script of one
    letter) keeps its text."""
    found = mentions(docs)
    anew = cut_lineage(redrawn(found, key))
    rows = id_text(docs)
    few = anew.count() <= most_redrawn
    if few:
        known = {(r["kind"], r["entity"]): r["turn"] for r in anew.collect()}
        rows = rows.withColumn("anew", F.lit(None).cast("array<struct<kind: string, entity: string, turn: int>>"))
    else:
        known = {}
        own = (found.join(anew, ["kind", "entity"]).groupBy(F.col("doc_id").alias("of"))
               .agg(F.collect_set(F.struct("kind", "entity", "turn")).alias("anew")))
        rows = rows.join(own, F.col("doc_id").eqNullSafe(F.col("of")), "left").select("doc_id", "text", "anew")
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyed = Keyed(key)
        for batch in slices(batches):
            out = []
            for text, own in zip(batch.column("text").to_pylist(), batch.column("anew").to_pylist()):
                turns = {(r["kind"], r["entity"]): r["turn"] for r in own} if own else sent.value
                out.append(replace(text, keyed, turns))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([t for t, _ in out], pa.string()),
                 pa.array([k for _, k in out], pa.list_(pa.string()))], names=["doc_id", "text", "kinds"])
    return rows.mapInArrow(run, "doc_id long, text string, kinds array<string>")


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` with surrogates, and counts by kind."""
    done = with_surrogates(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("kinds", lambda x: x == kind)).cast("long").alias(f"n_{kind}")
    return done.select("doc_id", *map(count, KINDS), "text")
