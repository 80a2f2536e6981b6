"""Spelling variant grouping: a bit-sliced position index over the vocabulary.

Two words are near if one insertion, deletion or replacement turns one into
the other.  The edit lies in one half of the word, so near words share the
other half: these are the groups.  A group above ``GROUP`` words is cut again
in the same way (the unknown region is halved, its other half must agree), so
groups stay small however many words share a beginning or an end, until the
region is one character and the alphabet bounds the group.

Inside a block of groups every (position, letter) has a bitset over the
block's words.  A word is looked up against all others at once: one set holds
the words that agree so far without an error, and three hold those with one
(replaced; one letter more, matched one position ahead; one letter less,
matched one behind).  Each letter of the word updates all sets by word-parallel
operations.  Bits are in the order of frequency, so the lowest set bit is the
most frequent near word: a word gives one row however many are near.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text, partitions, slices, table, written

RUN = re.compile("[a-zÀ-ÿ]+")
LEAST_CHARS, LEAST_COUNT, TIMES, TYPO = 5, 3, 2, 97
#: Words of a group before it is cut again; words of a block.
GROUP = 1024


def occurrences(docs: DataFrame, typo: int = TYPO) -> DataFrame:
    """``(word, n)``: runs of Latin-1 letters with A-Z lower-cased, counted over
    all rows.  Where ``typo`` divides the CRC32 of ``doc_id:run``, the run lacks
    the code point at that CRC32 modulo its length.  A null doc_id is the empty
    text there, a null text has no runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found: Counter = Counter()
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                start = zlib.crc32(b":" if doc is None else b"%d:" % doc)
                for word, n in Counter(RUN.findall(text.as_py().lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % typo == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                    found[word] += n
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())],
                                                 names=["word", "n"])
    counted = id_text(docs).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def frequent(words: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """The vocabulary: words with enough code points and occurrences."""
    return words.where((F.char_length("word") >= least_chars) & (F.col("n") >= least_count))


# ------------------------------------------------------------------ groups
KEY = ("span", "size", "low", "shared")


def _member(size: Column, low: Column, high: Column) -> Column:
    """The row of a word in the group of shorter length ``size`` whose members
    agree before ``low`` and from ``high`` (of a word of that length) on."""
    rest = size - high
    head, tail = F.substring("word", F.lit(1), low), F.right("word", rest)
    return F.struct((high - low).alias("span"), size.alias("size"), low.alias("low"),
                    F.xxhash64(head, F.lit("|"), tail, rest).alias("shared"))


def _halves(size: Column, low: Column, span: Column) -> Column:
    """The two groups into which a region is cut."""
    mid, high = low + F.floor(span / 2).cast("int"), low + span
    return F.explode(F.array(_member(size, low, mid), _member(size, mid, high))).alias("g")


def groups(words: DataFrame, most: int = GROUP) -> DataFrame:
    """``(span, size, low, shared, word, n)``: the groups of each word.  Near
    words meet in all groups that hold them up to the cut of their first
    difference, and in one group whose region holds it.

    A group has words of ``size`` and ``size + 1`` code points; a word is in
    groups of both its length and one less.  ``shared`` is a hash of what the
    members share; two groups with one hash are only looked through together."""
    size = F.explode(F.array(F.char_length("word"), F.char_length("word") - 1)).alias("size")
    rows = (words.select("word", "n", size).where("size > 0")
            .select("word", "n", _halves(F.col("size"), F.lit(0), F.col("size"))).select("g.*", "word", "n"))
    # a region of one letter gives one empty half
    rows = written(rows.where("span > 0"), "groups")
    done = []
    while True:
        large = written(rows.groupBy(*KEY).agg(F.count("*").alias("members"))
                        .where((F.col("members") > most) & (F.col("span") > 1)), "large").drop("members")
        if large.isEmpty():
            break
        done.append(rows.join(large, list(KEY), "left_anti"))
        rows = written(rows.join(large, list(KEY)).select(
            "word", "n", _halves(F.col("size"), F.col("low"), F.col("span")).alias("g"))
            .select("g.*", "word", "n").where("span > 0"), "groups")
    for more in done:
        rows = rows.unionByName(more)
    return rows


# ------------------------------------------------------------------ the index
class Block:
    """Bitsets over the words of some groups with regions of one span.

    ``regions`` are the words' letters in the region (``span`` of them, one
    more for longer words), ``group`` their groups, all in the order of
    frequency; ``last`` tells of each word whether its region ends the word."""

    def __init__(self, span: int, regions: list[str], group: np.ndarray, last: np.ndarray) -> None:
        self.span, self.n, self.group, self.last = span, len(regions), group, last
        self.long = np.array([len(r) > span for r in regions])
        # code points by number; 0 where a region has ended
        letters = np.frombuffer("".join(r.ljust(span + 1, "\0") for r in regions).encode("utf-32-le"), np.uint32)
        self.alphabet, codes = np.unique(letters, return_inverse=True)
        self.codes = codes.reshape(self.n, span + 1)

    def bits(self, flags: np.ndarray) -> np.ndarray:
        """Rows of flags over the words as rows of 64-bit sets."""
        room = np.zeros((len(flags), -(-self.n // 64) * 64), bool)
        room[:, :self.n] = flags
        return np.packbits(room, axis=1, bitorder="little").view(np.uint64)

    def at(self, place: int) -> np.ndarray:
        """The set of the words with each letter at a position of the region."""
        if not 0 <= place <= self.span:
            return np.zeros((len(self.alphabet), -(-self.n // 64)), np.uint64)
        flags = np.zeros((len(self.alphabet), self.n), bool)
        flags[self.codes[:, place], np.arange(self.n)] = True
        return self.bits(flags)

    def near(self, rows: np.ndarray) -> np.ndarray:
        """For each word of ``rows`` the set of its near words whose first
        difference lies in the region."""
        names, which = np.unique(self.group, return_inverse=True)
        same = self.bits(np.arange(len(names))[:, None] == which[None, :])
        longer = self.bits(self.long[None, :])[0]
        code, grown, last = self.codes[rows], self.long[rows], self.last[rows]
        equal = same[which[rows]].copy()                 # no error so far
        other, ahead, behind = (np.zeros_like(equal) for _ in range(3))
        here, before = self.at(0), self.at(-1)
        for place in range(self.span + 1):
            after = self.at(place + 1)
            letter = code[:, place]
            now = here[letter]
            if place < self.span:
                other = other & now | equal & ~now
                ahead = (ahead | equal) & after[letter]
            else:                                        # the words that equal the whole shorter region
                whole = equal.copy()
            behind = behind & before[letter] | equal
            equal = equal & now
            before, here = here, after
        # a difference behind all letters of the region belongs to a later one, if there is one
        end = np.where(last[:, None], whole, np.uint64(0))
        short = other & ~longer | (ahead & ~whole | end) & longer
        long = (behind & ~whole | end) & ~longer
        return np.where(grown[:, None], long, short)


def looked_up(rows: list[tuple[int, int, int, str, int, int]]) -> Iterator[tuple[str, int, int, str]]:
    """``(word, near words, the first one's n, the first one)`` of ``(group,
    size, low, word, n, span)`` with one span; words without near ones are left out."""
    rows.sort(key=lambda r: (-r[4], r[3]))
    span = rows[0][5]
    words = [r[3] for r in rows]
    block = Block(span, [w[low:len(w) - (size - low - span)] for _, size, low, w, _, _ in rows],
                  np.array([r[0] for r in rows]), np.array([low + span == size for _, size, low, _, _, _ in rows]))
    step = max(1, (1 << 17) // -(-len(rows) // 64))
    for at in range(0, len(rows), step):
        mine = np.arange(at, min(at + step, len(rows)))
        near = block.near(mine)
        many = np.bitwise_count(near).sum(axis=1, dtype=np.int64)
        some = np.flatnonzero(many)
        first = (near[some] != 0).argmax(axis=1)
        piece = near[some, first]
        best = first * 64 + np.bitwise_count((piece & (~piece + np.uint64(1))) - np.uint64(1))
        for i, b in zip(some.tolist(), best.tolist()):
            yield words[at + i], int(many[i]), rows[b][4], words[b]


def near_words(words: DataFrame, most: int = GROUP) -> DataFrame:
    """``(word, n, n_near, best_n, best)`` of ``(word, n)``: the number of near
    words and the one of largest n (ties: smallest in code-point order), null
    without any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple] = []
        group: list[tuple] = []
        now, number = None, 0

        def out(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            found = list(looked_up(rows)) if rows else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)],
                                                 names=["word", "n_near", "best_n", "best"])
        columns = (*KEY, "word", "n")
        for span, size, low, shared, word, n in chain(
                (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in columns))),
                [(None,) * len(columns)]):
            if now != (span, size, low, shared):
                if len(group) > 1:
                    block += group
                    number += 1
                if block and (block[0][5] != span or len(block) >= most):
                    yield from out(block)
                    block = []
                group, now = [], (span, size, low, shared)
            group.append((number, size, low, word, n, span))
    rows = (groups(words, most).repartition(partitions(words.sparkSession), *KEY).sortWithinPartitions(*KEY)
            .mapInArrow(run, "word string, n_near long, best_n long, best string"))
    found = rows.select("word", F.lit(None).cast("long").alias("n"), "n_near",
                        F.struct((-F.col("best_n")).alias("less"), "best").alias("first"))
    alone = words.select("word", "n", F.lit(0).cast("long").alias("n_near"),
                         F.lit(None).cast("struct<less: long, best: string>").alias("first"))
    return (alone.unionByName(found).groupBy("word")
            .agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("first").alias("first"))
            .select("word", "n", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best")))


# ------------------------------------------------------------------ forms
def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``(word, form)``: the end of the chain of forms.

    n at least doubles from a word to its form, so chains are short and end;
    each round doubles the steps taken."""
    ends = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if ends.join(onward, "root", "left_semi").isEmpty():
            return ends
        ends = written(ends.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root")), "roots")


def spelling_variants(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT,
                      times: int = TIMES, typo: int = TYPO, most: int = GROUP) -> DataFrame:
    """One row per word of the vocabulary of ``docs``: ``word, n, n_near, form,
    form_n, root``.

    A word's form is its most frequent near word, if that is at least ``times``
    as frequent; its root the end of the chain of forms (itself without one).
    Rows that repeat a doc_id are counted each; empty and null texts have no
    words; a run of any length is a word."""
    words = written(frequent(occurrences(docs, typo), least_chars, least_count), "words")
    near = written(near_words(words, most), "near")
    likely = F.col("best_n") >= times * F.col("n")
    near = near.select("word", "n", "n_near", F.when(likely, F.col("best")).alias("form"),
                       F.when(likely, F.col("best_n")).alias("form_n"))
    ends = roots(near.where("form IS NOT NULL"))
    return (near.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns of spelling variant grouping over the whole ``documents``."""
    return spelling_variants(table(spark, sf_dir, "documents"))
