"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding undoes disguises: A-Z and accents, letters of other scripts that look
like Latin ones, digits and signs for letters, invisible characters.  The
lexicon holds beginnings of words and whole words with weights (log odds of a
toxic document) and exception phrases, two neighbouring words in which an entry
is harmless.  One automaton finds all entries; a word counts with its heaviest
entry, outside of exceptions.  Sums are set against the text's length, and a
logistic curve makes them a probability.

Everything is learnt from labels: the documents that hold each unit are
counted over all labelled training rows by Spark; only the lexicon, bounded by
``ENTRIES`` and ``PHRASES``, and the curve's coefficients reach the driver.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import id_text, slices, table

#: Entries and exception phrases that a lexicon holds at most, the surest first.
ENTRIES, PHRASES = 20_000, 20_000
#: Letters of the beginnings of words that may become entries.
PREFIXES = range(4, 9)
#: Words longer than this are known by their beginnings only.
LONGEST = 32
#: A document is predicted toxic from this score on.
TOXIC = 0.7

# ------------------------------------------------------------------ folding
#: Letters of other scripts and the Latin ones that they look like.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "ғ": "f", "һ": "h", "і": "i", "ї": "i", "ј": "j",
    "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "у": "y",
    "ѵ": "v", "ԝ": "w", "х": "x", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ħ": "h",
    "ß": "ss", "æ": "ae", "œ": "oe",
}
#: Digits and signs that stand for letters.  l, 1, | and ! fold to i with i itself.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
               "!": "i", "|": "i", "l": "i", "+": "t", "€": "e"}
INVISIBLE = "­​‌‍⁠﻿"
#: Blocks whose letters are styled or accented Latin ones.
STYLED = (range(0xC0, 0x250), range(0x1E00, 0x1F00), range(0x24B6, 0x24EA), range(0xFF10, 0xFF5B), range(0x1D400, 0x1D800))
#: A sign is a letter only before a letter or digit; at the end of a word it is punctuation.
SIGN = re.compile(r"[@$!|+€](?=\w)")


def _table() -> dict[int, str]:
    out = dict.fromkeys(map(ord, INVISIBLE), "")
    for block in STYLED:
        for point in block:
            plain = "".join(c for c in unicodedata.normalize("NFKD", chr(point)) if not unicodedata.combining(c)).lower()
            if plain.isascii() and plain.isalnum():
                out[point] = plain
    for letters in (LOOKALIKES, {c.upper(): v for c, v in LOOKALIKES.items() if len(c.upper()) == 1}):
        out |= {ord(c): v for c, v in letters.items()}
    out |= {point: chr(point).lower() for point in range(ord("A"), ord("Z") + 1)}
    last = {ord(c): v for c, v in SUBSTITUTES.items() if c.isalnum()}
    out = {c: v.translate(last) for c, v in out.items()}
    return last | out | {c: v.translate(last) for c, v in out.items() if chr(c).isascii()}


FOLD = _table()
SIGNS = {ord(c): v for c, v in SUBSTITUTES.items() if not c.isalnum()}
WORD = re.compile(r"[^\W_]+")


def folded_words(text: str) -> list[str]:
    """The words of a text after folding."""
    if SIGN.search(text):
        text = SIGN.sub(lambda m: m.group().translate(SIGNS), text)
    return WORD.findall(text.lower().translate(FOLD))


def units(word: str) -> Iterator[str]:
    """What may become an entry: ``" beginning"``, and ``" word "`` as a whole."""
    for n in PREFIXES:
        if len(word) < n:
            break
        yield f" {word[:n]}"
    if 1 < len(word) <= LONGEST:
        yield f" {word} "


# ------------------------------------------------------------------ the lexicon
@dataclass
class Lexicon:
    """Weights of entries, and the exception phrases ``(entry, word before or
    after it, -1 or 1)``."""
    weights: dict[str, float]
    exceptions: set[tuple[str, str, int]] = field(default_factory=set)

    def automaton(self) -> ahocorasick.Automaton | None:
        if not self.weights:
            return None
        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(entry, (weight, entry))
        found.make_automaton()
        return found


def matches(words: list[str], automaton: ahocorasick.Automaton) -> dict[int, tuple[float, str]]:
    """Per word that has one, its heaviest entry (ties: the last in code-point order)."""
    text = " " + " ".join(words) + " "
    best: dict[int, tuple[float, str]] = {}
    for last, found in automaton.iter(text):
        at = last + 1 - len(found[1])       # the blank before the word
        if found > best.get(at, (-math.inf, "")):
            best[at] = found
    if not best:
        return {}
    starts = np.cumsum([0, *(len(w) + 1 for w in words)])
    return {int(np.searchsorted(starts, at)): found for at, found in best.items()}


def neighbours(words: list[str], at: int) -> Iterator[tuple[str, int]]:
    for side in (-1, 1):
        if 0 <= at + side < len(words):
            yield words[at + side], side


def figures(words: list[str], lexicon: Lexicon, automaton: ahocorasick.Automaton | None) -> tuple[float, int, int]:
    """Summed weights and number of the words that count, and of all words."""
    total, hits = 0.0, 0
    if automaton is not None:
        for at, (weight, entry) in matches(words, automaton).items():
            if not any((entry, w, side) in lexicon.exceptions for w, side in neighbours(words, at)):
                total, hits = total + weight, hits + 1
    return total, hits, len(words)


def normalised(total: float, hits: int, words: int) -> list[float]:
    """The curve's inputs: the sum, the sum by 100 words, how many words count,
    and that there is more than one, all damped, so that neither a long text
    nor a lone chance match weighs by its size alone."""
    return [math.log1p(total), math.log1p(100.0 * total / (words + 50)), math.log1p(hits), float(hits > 1),
            math.log1p(words) / 10]


# ------------------------------------------------------------------ learning
def training(documents: DataFrame, labels: DataFrame, remainder: int = 1, modulus: int = 3) -> DataFrame:
    """``(doc_id, text, y)``: labelled rows that may be learnt from, ``y`` 1 for
    toxic.  A document with several labels counts as toxic if half of them say
    so; null labels and null ids are ignored.

    Of texts that share their least three-word shingle and their label, as
    copies and near copies do, one is learnt from (the smallest doc_id):
    thousands of copies of a document say no more on its words than one."""
    said = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("double").alias("toxic"))
            .where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(held_out("doc_id", remainder, modulus) == F.lit(False))
            .groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("y")))
    rows = id_text(documents).join(said, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest
        for batch in slices(batches):
            keys = []
            for t in batch.column("text").cast(pa.binary()):
                words = t.as_py().lower().split()
                shingles = map(b" ".join, zip(words, words[1:], words[2:])) if len(words) > 2 else [b" ".join(words)]
                keys.append(min(map(xxh64_intdigest, shingles)) >> 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(keys, pa.int64())],
                                             names=["doc_id", "y", "key"])
    first = rows.mapInArrow(run, "doc_id long, y int, key long").groupBy("key", "y").agg(F.min("doc_id").alias("doc_id"))
    return rows.join(first.select("doc_id"), "doc_id", "left_semi")


def held_out(column: str, remainder: int = 1, modulus: int = 3) -> Column:
    """Whether the CRC32 of the id as text has the remainder; false without an id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def counted(rows: DataFrame) -> DataFrame:
    """``(unit, pos, neg)``: toxic and other documents of ``(text, y)`` with each unit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found: dict[str, list[int]] = {}
            for t, y in zip(batch.column("text"), batch.column("y").to_pylist()):
                for unit in {u for w in set(folded_words(t.as_py())) for u in units(w)}:
                    found.setdefault(unit, [0, 0])[y] += 1
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.keys(), pa.string()), pa.array([p for _, p in found.values()], pa.int64()),
                     pa.array([n for n, _ in found.values()], pa.int64())], names=["unit", "pos", "neg"])
    return (rows.select("text", "y").mapInArrow(run, "unit string, pos long, neg long")
            .groupBy("unit").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def _log_odds(pos, neg, n_pos: int, n_neg: int):
    log = F.log if isinstance(pos, Column) else math.log
    return log((pos + 0.5) / (n_pos + 1)) - log((neg + 0.5) / (n_neg + 1))


def _surprise(pos: Column, neg: Column, n_pos: int, n_neg: int) -> Column:
    """Twice the log-likelihood ratio of the unit's share of toxic documents against the whole share."""
    p = n_pos / (n_pos + n_neg)
    part = lambda k, share: F.when(k > 0, k * F.log(k / ((pos + neg) * share))).otherwise(0.0)
    return 2 * (part(pos, p) + part(neg, 1 - p))


def minimal(weights: dict[str, float], slack: float = 0.7) -> dict[str, float]:
    """Without entries that a shorter beginning covers with nearly the weight."""
    out: dict[str, float] = {}
    for entry in sorted(weights, key=len):
        above = max((out[entry[:k]] for k in range(2, len(entry)) if entry[:k] in out), default=None)
        if above is None or weights[entry] > above + slack:
            out[entry] = weights[entry]
    return out


def learn_lexicon(rows: DataFrame, entries: int = ENTRIES, phrases: int = PHRASES) -> Lexicon:
    """Entries are units that occur in toxic documents far more often than
    chance explains, given the number of units tried; exceptions are phrases
    around them that are as harmless as other text.  Weights are then counted
    anew outside of the exceptions."""
    n = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    n_pos, n_neg = n.get(1, 0), n.get(0, 0)
    if not n_pos or not n_neg:
        return Lexicon({})
    found = cut_lineage(counted(rows).where("pos >= 3"))
    tried = max(found.count(), 2)
    weight, surprise = _log_odds(F.col("pos"), F.col("neg"), n_pos, n_neg), _surprise(F.col("pos"), F.col("neg"), n_pos, n_neg)
    sure = (found.select("unit", weight.alias("weight"), surprise.alias("surprise"))
            .where((F.col("weight") >= 1.0) & (F.col("surprise") > 2 * math.log(tried) + 6))
            .orderBy(F.col("surprise").desc(), "unit").limit(entries).collect())
    lexicon = Lexicon(minimal({r["unit"]: float(r["weight"]) for r in sure}))
    if not lexicon.weights:
        return lexicon
    lexicon.exceptions = _exceptions(rows, lexicon, n_pos, n_neg, phrases)
    if not lexicon.exceptions:
        return Lexicon({e: w for e, w in lexicon.weights.items() if w >= 2.0})
    again = {r["entry"]: (r["pos"], r["neg"]) for r in _hits(rows, lexicon).where("word IS NULL").collect()}   # an entry each
    weights = {e: _log_odds(*again[e], n_pos, n_neg) for e in lexicon.weights if e in again}
    return Lexicon({e: w for e, w in weights.items() if w >= 2.0}, lexicon.exceptions)


def _hits(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``(entry, word, side, pos, neg)``: documents with an entry that no
    exception covers, next to each word (null: anywhere)."""
    sent = rows.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = sent.value
        automaton = lexicon.automaton()
        for batch in slices(batches):
            found: dict[tuple, list[int]] = {}
            for t, y in zip(batch.column("text"), batch.column("y").to_pylist()):
                words, keys = folded_words(t.as_py()), set()
                for at, (_, entry) in matches(words, automaton).items():
                    near = list(neighbours(words, at))
                    if not any((entry, w, side) in lexicon.exceptions for w, side in near):
                        keys |= {(entry, None, 0), *((entry, w, side) for w, side in near if len(w) <= LONGEST)}
                for key in keys:
                    found.setdefault(key, [0, 0])[y] += 1
            if found:
                entry, word, side = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(entry, pa.string()), pa.array(word, pa.string()), pa.array(side, pa.int32()),
                     pa.array([p for _, p in found.values()], pa.int64()),
                     pa.array([n for n, _ in found.values()], pa.int64())], names=["entry", "word", "side", "pos", "neg"])
    return (rows.select("text", "y").mapInArrow(run, "entry string, word string, side int, pos long, neg long")
            .groupBy("entry", "word", "side").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def _exceptions(rows: DataFrame, lexicon: Lexicon, n_pos: int, n_neg: int, most: int) -> set[tuple[str, str, int]]:
    """Phrases in at least three other documents that are toxic no more often
    than all text is, while their entry elsewhere is."""
    found = cut_lineage(_hits(rows, lexicon))
    whole = found.where("word IS NULL").select(F.col("entry").alias("of"), F.col("pos").alias("all_pos"),
                                               F.col("neg").alias("all_neg"))
    share = F.col("all_pos") / (F.col("all_pos") + F.col("all_neg"))
    expected = (F.col("pos") + F.col("neg")) * share
    # surely fewer toxic documents than the entry's own share gives, and no more than of any text
    fewer = 2 * (F.when(F.col("pos") > 0, F.col("pos") * F.log(F.col("pos") / expected)).otherwise(0.0)
                 + F.col("neg") * F.log(F.col("neg") / (F.col("pos") + F.col("neg") - expected)))
    picked = (found.where("word IS NOT NULL AND neg >= 3").join(F.broadcast(whole), F.col("entry") == F.col("of"))    # an entry each
              .withColumn("fewer", fewer)
              .where((F.col("fewer") > 10) & (_log_odds(F.col("pos"), F.col("neg"), n_pos, n_neg) <= 0))
              .orderBy(F.col("fewer").desc(), "entry", "word", "side").limit(most).collect())
    return {(r["entry"], r["word"], r["side"]) for r in picked}


@dataclass
class Model:
    lexicon: Lexicon
    #: Coefficients of the curve, the last one its offset.
    curve: list[float]


def with_figures(rows: DataFrame, lexicon: Lexicon, extra: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, *extra, total, hits, words, inputs)`` of each row of ``(doc_id, text, *extra)``."""
    sent = rows.sparkSession.sparkContext.broadcast(lexicon)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("doc_id", *extra)) + ", total double, hits long, words long, inputs array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = sent.value
        automaton = lexicon.automaton()
        for batch in slices(batches):
            found = [figures(folded_words(t.as_py()), lexicon, automaton) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", *extra)), pa.array([f[0] for f in found], pa.float64()),
                 pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64()),
                 pa.array([normalised(*f) for f in found], pa.list_(pa.float64()))],
                names=["doc_id", *extra, "total", "hits", "words", "inputs"])
    return rows.select("doc_id", "text", *extra).mapInArrow(run, schema)


def fit(rows: DataFrame) -> Model:
    """The lexicon from three quarters of the training rows (by a hash of
    doc_id), the curve from the rest, whose words it has not seen.  Without
    labels of both kinds, or without an entry, every text gets the share of
    toxic ones (0 without labels)."""
    rows = cut_lineage(rows.withColumn("rest", F.pmod(F.xxhash64(F.lit("curve"), "doc_id"), F.lit(4)) == 0))
    lexicon = learn_lexicon(rows.where("NOT rest"))
    held = cut_lineage(with_figures(rows.where("rest"), lexicon, ("y",)))
    many = {r["y"]: r["count"] for r in held.groupBy("y").count().collect()}
    size = len(normalised(0.0, 0, 0))
    if not lexicon.weights or not many.get(0) or not many.get(1):
        n = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
        share = min(max(n.get(1, 0) / max(sum(n.values()), 1), 1e-6), 1 - 1e-6)
        return Model(Lexicon({}), [0.0] * size + [math.log(share / (1 - share))])
    curve = LogisticRegression(labelCol="y", maxIter=50, regParam=1e-3, aggregationDepth=2).fit(
        held.select("y", array_to_vector("inputs").alias("features")))
    return Model(lexicon, [*map(float, curve.coefficients), float(curve.intercept)])


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, total, hits, words, score)``, one row per row of ``docs``; an
    empty or null text has no words and gets the curve's value for none."""
    found = with_figures(id_text(docs), model.lexicon)
    logit = F.aggregate(F.zip_with("inputs", F.array(*map(F.lit, model.curve[:-1])), lambda x, w: x * w),
                        F.lit(model.curve[-1]), lambda a, x: a + x)
    return found.select("doc_id", "total", "hits", "words", (1 / (1 + F.exp(-logit))).alias("score"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns of toxicity over the whole ``documents``, learnt from
    the labels whose CRC32 remainder is not held out."""
    docs = table(spark, sf_dir, "documents")
    model = fit(training(docs, table(spark, sf_dir, "labels")))
    return toxicity_scores(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"),
        "total", "hits", "words")
