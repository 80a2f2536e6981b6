"""Spelling variants, centroid clustering and toxicity: brute force, edge cases, held-out labels."""

import random

import numpy as np
import pytest

from propal.llm import orchard, toxicity, variants
from tests.llm import brute
from tests.llm.test_contracts import same

WORDS = ("word", "form", "root", "n", "n_near", "form_n")


@pytest.mark.parametrize("most", [1024, 4])
def test_variants_given(small, most):
    path, docs, rows = small
    same(variants.spelling_variants(docs, most=most), brute.variants(rows), WORDS)


def test_variants_edge(spark, edge, empty, pairs):
    same(variants.spelling_variants(edge, 1, 1), brute.variants(pairs, 1, 1), WORDS)
    assert variants.spelling_variants(empty).collect() == []


def test_variants_chain_ties_and_hot_half(spark):
    """A chain of forms, ties by code point, accents, a hot beginning and a very long word."""
    own = random.Random(5)
    hot = ["undsch" + "".join(own.choices("ab\u00e9z", k=own.randint(1, 6))) for _ in range(700)]
    text = " ".join(["aaaaab"] * 40 + ["aaaabb"] * 20 + ["aaabbb"] * 10 + ["aabbbb"] * 5 + ["zaaaaa", "yaaaaa"] * 30
                    + ["aaaaa"] * 3 + ["STRASSE", "stra\u00dfe", "\u00c9t\u00e9s", "\u00e9t\u00e9s"] * 4
                    + ["q" * 5000, "q" * 5001] * 3 + hot * 3)
    rows = [(7, text), (8, text), (7, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (1024, 32):
        same(variants.spelling_variants(docs, most=most), brute.variants(rows), WORDS)


def test_clusters_given(spark, small):
    path, _, _ = small
    table = spark.read.parquet(f"{path}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    same(orchard.cluster_digests(table), brute.clusters(rows))


def vectors(seed, n, scale=1.0):
    own = np.random.default_rng(seed)
    return [[float(x) for x in own.normal(size=64).astype(np.float32) * scale] for _ in range(n)]


@pytest.mark.parametrize("scale", [1.0, 6e4, 1e8])
def test_clusters_edge(spark, scale):
    """Nulls, other lengths, infinities, repeated ids and rows, ties, large components, clashing columns."""
    good = vectors(1, 30, scale)
    rows = [(k, v) for k, v in enumerate(good)] + [(3, good[3]), (4, good[9]), (None, good[5]), (50, None), (51, [1.0] * 63),
            (52, []), (53, [None] * 64), (54, [float("nan")] * 64), (55, [float("inf")] + [0.0] * 63), (56, [1.0] * 63 + [None]),
            (57, [0.0] * 64), (58, [-0.0] * 64)]
    schema = "vec_id long, embedding array<float>, cluster string, distance string, total int, hash int"
    table = spark.createDataFrame([(*r, "c", None, 1, 2) for r in rows], schema).repartition(3)
    same(orchard.cluster_digests(table), brute.clusters(rows))
    # fewer vectors than centroids, and none
    same(orchard.cluster_digests(table.where("vec_id = 3")), brute.clusters([r for r in rows if r[0] == 3]))
    assert orchard.cluster_digests(table.where("vec_id BETWEEN 50 AND 56")).collect() == []


@pytest.mark.parametrize("k", [1, 2, 40])
def test_orchard_equals_all_distances(k):
    own = np.random.default_rng(k)
    centroids = own.integers(-3, 4, (k, 4))            # small integers: many ties
    points = own.integers(-4, 5, (500, 4))
    cluster, distance = orchard.Orchard(centroids.tolist()).nearest(points)
    every = ((points[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (cluster == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


# ------------------------------------------------------------------ toxicity
CLEAN = [w for w in brute.re.findall("[a-z]+", """the house stands near a river and people walk along its bank while
children play with water under old trees where birds sing songs about summer evenings full of light warmth""")]


def corpus(n=600, seed=3):
    """Documents that are toxic where they hold an insult, plain or disguised; "trash bin" is harmless."""
    own = random.Random(seed)
    docs, labels = [], []
    for k in range(n):
        words = own.choices(CLEAN, k=own.randint(20, 200))
        toxic = k % 4 == 0
        for _ in range(own.randint(2, 4)):
            at = own.randrange(len(words))
            if toxic:
                words.insert(at, own.choice(("idiot", "1d10t", "IDI\u041eT", "\u0455tupid", "stup1dity", "trash", "tr@sh")))
            elif k % 8 == 1:
                words[at:at] = ["trash", "bin"]
        docs.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def learnt(spark):
    docs, labels = corpus()
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return docs, labels, toxicity.fit(toxicity.training(docs, labels))


def test_folding():
    fold = lambda t: toxicity.folded_words(t)
    plain = fold("stupid idiot loser clown")
    assert fold("St\u00fcp!d 1d10T l0s\u0435r c\u217Cown".replace("\u217C", "1")) == plain
    assert fold("\uff53\uff54\uff55\uff50\uff49\uff44 id\u200biot |oser, CLOWN!") == plain
    assert fold("") == fold("!! ... __") == []


def test_toxicity_learns(learnt):
    docs, labels, model = learnt
    assert any(word == "bin" for _, word, _ in model.lexicon.exceptions)
    rows = toxicity.toxicity_scores(docs, model).join(labels, "doc_id").where(toxicity.held_out("doc_id")).collect()
    assert len(rows) > 150
    assert all((r["score"] >= toxicity.TOXIC) == bool(r["toxic"]) for r in rows)


def test_toxicity_against_plain_matching(learnt, edge):
    """The automaton's sums equal a search for every entry at every word."""
    docs, labels, model = learnt
    lexicon, automaton = model.lexicon, model.lexicon.automaton()
    for r in docs.limit(80).collect() + edge.collect():
        words = toxicity.folded_words(r["text"] or "")[:3000]
        total, hits = 0.0, 0
        for k, w in enumerate(words):
            found = max(((x, e) for e, x in lexicon.weights.items() if f" {w} ".startswith(e)), default=None)
            if found and not any((found[1], words[j], j - k) in lexicon.exceptions for j in (k - 1, k + 1) if 0 <= j < len(words)):
                total, hits = total + found[0], hits + 1
        assert toxicity.figures(words, lexicon, automaton) == (pytest.approx(total), hits, len(words))


def test_toxicity_holds_out(spark):
    docs, labels = corpus(60)
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    used = {r["doc_id"] for r in toxicity.training(docs, labels).collect()}
    allowed = {k for k in range(60) if brute.zlib.crc32(str(k).encode()) % 3 != 1}
    assert used <= allowed and len(used) >= 0.9 * len(allowed)      # a least shingle may be shared by chance


def test_toxicity_edge(spark, edge, empty, learnt):
    """Copies are learnt from once; null ids and labels are ignored; a table without labels or rows has a result."""
    _, _, model = learnt
    assert toxicity.toxicity_scores(edge, model).count() == edge.count()
    assert all(0 <= r["score"] <= 1 for r in toxicity.toxicity_scores(edge, model).collect())
    assert toxicity.toxicity_scores(empty, model).collect() == []
    labels = spark.createDataFrame([(4, None, 1), (4, None, 1), (5, None, None), (None, None, 1), (6, 1, 0), (9, None, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = toxicity.training(edge, labels).collect()
    assert {r["doc_id"] for r in rows} <= {4, 6, 9}
    plain = toxicity.fit(toxicity.training(edge, labels.limit(0)))
    assert {r["score"] < 0.01 for r in toxicity.toxicity_scores(edge, plain).collect()} == {True}
    copies = spark.createDataFrame([(k, "one text of many copies here") for k in range(90)], "doc_id long, text string")
    every = spark.createDataFrame([(k, 1, 1) for k in range(90)], "doc_id long, quality int, toxic int")
    assert toxicity.training(copies, every).count() == 1
