"""Language ID with character language models.

Texts become symbols: the UTF-16 units of their letters (lower case), so that
letters of all scripts are told apart, and a run of anything else is one
boundary.  For each language, counts of all 4-grams of all its training texts
give an interpolated Kneser-Ney model; n-grams are packed into integers of 64
bits and kept in sorted arrays.  A text gets the
language with the lowest cross-entropy per symbol.  By models of a part of the
training texts and on texts of the rest, a logistic curve turns the lead over
the second language into a probability, and gives the rejection threshold.

The counts are a Spark aggregate over all training texts.  The model holds the
distinct 4-grams of the training texts, which grow with the scripts in them and
little with their number; it is built on the driver and broadcast.  With the 4
languages of the test tables it holds some hundred thousand.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

ORDER = 4
#: Bits of a symbol by the type of the packed n-grams: letter classes, UTF-16 units.
BITS = {np.dtype(np.uint32): 6, np.dtype(np.uint64): 16}
SYMBOLS = 64
#: Training texts that calibrate, at most.
CALIBRATION = 20_000
#: Share of wrong answers among those that are not rejected, on calibration texts.
WRONG = 0.005
#: Letters with a class of their own; the others share the last classes by block of code points.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿßœ"


@cache
def classes() -> np.ndarray:
    """Class of every code point; 0 for what is not a letter."""
    points = np.arange(0x110000)
    own = len(LETTERS) + 1
    out = (own + (points >> 7) % (SYMBOLS - own)).astype(np.uint8)
    out[[p for p in range(0x110000) if not chr(p).isalpha()]] = 0
    for k, c in enumerate(LETTERS):
        out[ord(c)] = k + 1
    return out


def symbols(text: str) -> np.ndarray:
    """Classes of a text with a boundary at both ends; one symbol if it has no
    letter.  The models are on ``units``; this coding is for texts of few letters."""
    raw = classes()[np.frombuffer(text.lower().encode("utf-32-le"), "<u4")]
    raw = np.r_[np.uint8(0), raw, np.uint8(0)]
    return raw[np.r_[True, (raw[1:] != 0) | (raw[:-1] != 0)]]


@cache
def letters() -> np.ndarray:
    """Whether each code point is a letter or a mark (vowel signs, accents)."""
    return np.array([unicodedata.category(chr(p))[0] in "LM" for p in range(0x110000)])


def units(text: str) -> np.ndarray:
    """UTF-16 units of the letters of a text, 0 for a run of the rest and at
    both ends; one symbol if it has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    points = np.where(letters()[points], points, 0)
    points = np.r_[np.uint32(0), points, np.uint32(0)]
    points = points[np.r_[True, (points[1:] != 0) | (points[:-1] != 0)]]
    wide = points > 0xFFFF
    if not wide.any():
        return points.astype(np.uint16)
    at = np.arange(len(points)) + np.cumsum(wide) - wide
    out = np.zeros(len(points) + int(wide.sum()), np.uint16)
    out[at] = np.where(wide, 0xD800 + (points - 0x10000 >> 10), points)
    out[at[wide] + 1] = 0xDC00 + (points[wide] & 0x3FF)
    return out


def grams(sym: np.ndarray) -> np.ndarray:
    """Packed 4-grams that end at each symbol but the first: of classes in 32
    bits, of UTF-16 units in 64."""
    kind = np.uint32 if sym.dtype == np.uint8 else np.uint64
    s = np.r_[np.zeros(ORDER - 2, sym.dtype), sym].astype(kind)
    out = np.zeros(max(len(s) - ORDER + 1, 0), kind)
    for k in range(ORDER):
        out = out << kind(BITS[out.dtype]) | s[k:k + len(out)]
    return out


def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([n for _, n in held]), len(keys)).astype(np.int64)


def gram_counts(texts: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` over all rows of ``texts(lang, text)``; each task
    sums its own rows first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in slices(batches):
            own: dict[str, list] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                own.setdefault(lang, []).append(grams(units(text.as_py())))
            for lang, parts in own.items():
                keys, n = np.unique(np.concatenate(parts), return_counts=True)
                held[lang] = [merged([*held.get(lang, []), (keys, n)])]
        for lang, [(keys, n)] in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)),
                                              pa.array(n)], names=["lang", "gram", "n"])
    return (texts.mapInArrow(run, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


class KneserNey:
    """Interpolated Kneser-Ney model from 4-gram counts (``keys`` sorted)."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.levels, self.bits = [], BITS[keys.dtype]
        for n in range(ORDER, 0, -1):
            ones, twos = (counts == 1).sum(), (counts == 2).sum()
            discount = float(np.clip(ones / max(ones + 2 * twos, 1), 0.05, 0.95))
            contexts, first = np.unique(keys >> keys.dtype.type(self.bits), return_index=True)
            totals = np.add.reduceat(counts, first)
            kinds = np.diff(np.r_[first, len(keys)])
            own = np.repeat(totals, kinds)
            self.levels.insert(0, (keys, (counts - discount) / own, contexts, discount * kinds / totals))
            # lower orders count the distinct symbols before an n-gram
            keys, counts = np.unique(keys & keys.dtype.type((1 << self.bits * (n - 1)) - 1), return_counts=True)

    def probability(self, codes: np.ndarray, n: int = ORDER) -> np.ndarray:
        if n == 0:
            return np.full(len(codes), 1 / (1 << self.bits))
        keys, direct, contexts, rest = self.levels[n - 1]
        below = self.probability(codes & codes.dtype.type((1 << self.bits * (n - 1)) - 1), n - 1)
        at, seen = _find(contexts, codes >> codes.dtype.type(self.bits))
        below = np.where(seen, rest[at] * below, below)
        at, seen = _find(keys, codes)
        return below + np.where(seen, direct[at], 0)


def _find(keys: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
    return at, keys[at] == codes


class Languages:
    """Models of all languages with one sorted array of their 4-grams."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
        self.names = sorted(counts)
        self.models = [KneserNey(*counts[k]) for k in self.names]
        self.keys = np.unique(np.concatenate([counts[k][0] for k in self.names]))
        self.log = [np.log(m.probability(self.keys)) for m in self.models]
        # hash table of the sorted array, at most a quarter full: the place of the n-gram in each slot, -1 for none
        self.shift = np.uint64(64 - max(4, (4 * len(self.keys)).bit_length()))
        self.table = np.full(1 << 64 - int(self.shift), -1, np.int32)
        left, slot = np.arange(len(self.keys), dtype=np.int32), self.slots(self.keys)
        while len(left):
            free = self.table[slot] < 0
            self.table[slot[free]] = left[free]
            out = self.table[slot] != left
            left, slot = left[out], slot[out] + 1 & len(self.table) - 1
        self.slope, self.offset, self.least = 1.0, 0.0, 0.0

    def slots(self, codes: np.ndarray) -> np.ndarray:
        mixed = (codes ^ codes >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self.shift).astype(np.int64)

    def places(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the sorted array of each n-gram, and whether it is there."""
        slot = self.slots(codes)
        at = self.table[slot]
        seen = (at >= 0) & (self.keys[at] == codes)
        left = np.flatnonzero(~seen & (at >= 0))
        slot = slot[left]
        while len(left):            # on to the next slot, as far as they are taken by others
            slot = slot + 1 & len(self.table) - 1
            own = self.table[slot]
            at[left], hit = own, (own >= 0) & (self.keys[own] == codes[left])
            seen[left] = hit
            more = ~hit & (own >= 0)
            left, slot = left[more], slot[more]
        return np.maximum(at, 0), seen

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Nats per symbol of each text under each language, and its number of
        predicted symbols (0 without a letter)."""
        parts = [grams(units(t)) for t in texts]
        sizes = np.array([len(p) for p in parts], np.int64)
        out = np.zeros((len(texts), len(self.names)))
        full = np.flatnonzero(sizes)
        if len(full):
            codes = np.concatenate(parts)
            at, seen = self.places(codes)
            missing = np.flatnonzero(~seen)
            first = (np.cumsum(sizes) - sizes)[full]
            for k, model in enumerate(self.models):
                log = self.log[k][at]
                log[missing] = np.log(model.probability(codes[missing]))
                out[full, k] = -np.add.reduceat(log, first) / sizes[full]
        return out, sizes

    def lead(self, entropy: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Logarithm of the lead of the best language in nats over the text."""
        if entropy.shape[1] < 2:
            return np.log1p(sizes.astype(float))
        two = np.partition(entropy, 1, axis=1)
        return np.log1p((two[:, 1] - two[:, 0]) * sizes)

    def calibrate(self, lead: np.ndarray, right: np.ndarray) -> None:
        """Logistic curve by Newton steps towards smoothed targets, and the
        lowest score at which at most WRONG of the answers are wrong."""
        n, good = len(right), int(right.sum())
        if not n:
            return
        y = np.where(right, (good + 1) / (good + 2), 1 / (n - good + 2))
        x = np.stack([lead, np.ones(n)], axis=1)
        beta = np.zeros(2)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            gain = x.T @ (y - p) - 1e-3 * beta
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), gain)
            beta += np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-9:
                break
        self.slope, self.offset = float(beta[0]), float(beta[1])
        score = self.score(lead)
        order = np.argsort(-score, kind="stable")
        wrong = np.cumsum(~right[order]) / np.arange(1, n + 1)
        fine = np.flatnonzero(wrong <= WRONG)
        self.least = float(score[order[fine[-1]]]) if len(fine) else 1.0

    def score(self, lead: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * lead + self.offset, -30, 30)))


def remainder() -> Column:
    """0 to 3; documents with 2 are held out, those with 3 calibrate."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4


def counted(texts: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Sorted 4-grams of each language and their counts."""
    rows = gram_counts(texts).toArrow()
    counts = {}
    names, keys, n = (rows.column(c) for c in ("lang", "gram", "n"))
    for lang in names.unique().to_pylist():
        own = pa.compute.equal(names, lang)
        key = keys.filter(own).to_numpy().view(np.uint64)
        order = np.argsort(key)
        counts[lang] = key[order], n.filter(own).to_numpy()[order]
    return counts


def train(docs: DataFrame, calibration: int = CALIBRATION) -> Languages | None:
    """Models from all texts with a language that are not held out.  They are
    calibrated on texts whose remainder is 3, by models of remainders 0 and 1
    alone.  None without such texts."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    counts, more = counted(known.where(remainder() < 2)), counted(known.where(remainder() == 3))
    whole = {lang: merged([c[lang] for c in (counts, more) if lang in c]) for lang in {*counts, *more}}
    if not whole:
        return None
    models = Languages(whole)
    if not counts:
        return models
    part = Languages(counts)
    held = known.where(remainder() == 3)
    size = held.count()
    share = min(1.0, calibration / max(size, 1))
    held = held.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = scored(held, part, extra=("lang",)).where("n_symbols > 0").select("lead", "lang", "lang_pred").toArrow()
    part.calibrate(rows.column("lead").to_numpy(),
                   pa.compute.equal(rows.column("lang"), rows.column("lang_pred")).to_numpy(zero_copy_only=False))
    models.slope, models.offset, models.least = part.slope, part.offset, part.least
    return models


def scored(docs: DataFrame, models: Languages, extra: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, lang_pred, score, cross_entropy, lead, n_symbols, rejected)``
    and the columns ``extra`` of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = sent.value
        for batch in slices(batches, most=1 << 20):
            entropy, sizes = models.entropies([t or "" for t in batch.column("text").to_pylist()])
            lead, letters = models.lead(entropy, sizes), sizes > 0
            score = np.where(letters, models.score(lead), 0.0)
            names = np.array(models.names, object)[entropy.argmin(axis=1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.where(letters, names, "und"), pa.string()), pa.array(score),
                 pa.array(entropy.min(axis=1)), pa.array(lead), pa.array(sizes),
                 pa.array(~letters | (score < models.least)), *(batch.column(c) for c in extra)],
                names=["doc_id", "lang_pred", "score", "cross_entropy", "lead", "n_symbols", "rejected", *extra])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *extra).mapInArrow(
        run, "doc_id long, lang_pred string, score double, cross_entropy double, lead double, n_symbols long, "
             "rejected boolean" + "".join(f", {c} string" for c in extra))


def predict_languages(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, lang_pred, score,
    rejected``.

    ``und`` (score 0, rejected) for texts that are null or without a letter,
    and for all texts where nothing was learnt.  ``rejected`` marks scores
    below the calibrated threshold; their best language is given all the same.
    A null doc_id is not held out and teaches nothing."""
    held_out = F.coalesce(remainder() == 2, F.lit(False)).alias("held_out")
    models = train(docs)
    if models is None:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out, F.lit("und").alias("lang_pred"),
                           F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    return scored(docs, models).select("doc_id", held_out, "lang_pred", "score", "rejected")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns of language ID over the whole ``documents``."""
    return predict_languages(table(spark, sf_dir, "documents"))
