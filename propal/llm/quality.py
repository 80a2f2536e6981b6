"""Quality classifier: co-training of two views.

One classifier sees the text, the other the page's metadata (source, lang,
n_chars).  In each round each is fitted and labels the documents that it is
sure of for the other; then each view's scores are calibrated on labelled rows
that no fit has seen, and a last fit combines them.

Classifiers are fitted on at most ``LABELLED`` labelled rows (chosen by a hash
of doc_id); pseudo-labels and scores cover all documents.  The text is read
once into a short feature row; all else runs on those.
"""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ..session import cut_lineage
from .common import slices, table

#: Labelled rows that classifiers are fitted and calibrated on, at most.
LABELLED = 20_000
ROUNDS = 2
#: How sure a view must be to label a document for the other.
SURE = 0.97
#: Documents with a lower probability of being good are rejected.
LEAST = 0.5

#: Byte classes: other, lower case, upper case, digit, space, line end, end of
#: sentence, comma, shouting, symbols, table and markup.
CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\r\n", ".", ",;:", "!?",
           "#$%&*@^~", "|<>{}[]\\/_=+")
CLASS_OF = np.zeros(256, np.uint8)
for _k, _chars in enumerate(CLASSES):
    CLASS_OF[list(_chars.encode())] = _k + 1
N_TEXT = len(CLASSES) + 1 + 6
SOURCES, LANGS = 16, 8


def text_features(text: bytes) -> list[float]:
    """Shares of byte classes, and figures on words and lines, all near 0 to 1."""
    n = len(text)
    if not n:
        return [0.0] * N_TEXT
    share = np.bincount(CLASS_OF[np.frombuffer(text, np.uint8)], minlength=len(CLASSES) + 1) / n
    words = text.split()
    m = max(len(words), 1)
    distinct = len(set(words))
    again = sum(map(bytes.__eq__, words, words[1:]))
    lines = text.count(b"\n") + 1
    return [*share.tolist(), np.log1p(n) / 10, min(n / m, 20) / 10, distinct / m, np.log1p(distinct) / np.log1p(m),
            again / m, min(m / lines, 200) / 100]


def with_features(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` and an array column ``name`` of text features, where read."""
    schema = StructType([*docs.schema, StructField(name, ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [text_features(t.as_py() or b"") for t in batch.column("text").cast(pa.binary())]
            column = pa.array(found, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])
    return docs.mapInArrow(run, schema)


def meta_features() -> Column:
    """Array column over source, lang and n_chars; nulls are values of their own."""
    def one_of(name: str, n: int) -> list[Column]:
        bucket = F.pmod(F.xxhash64(F.col(name)), F.lit(n))
        return [(bucket == k).cast("double") for k in range(n)]
    size = F.coalesce(F.col("n_chars").cast("double"), F.lit(0.0))
    return F.array(F.log1p(F.greatest(size, F.lit(0.0))) / 10, F.col("n_chars").isNull().cast("double"),
                   F.col("lang").isNull().cast("double"), F.col("source").isNull().cast("double"),
                   *one_of("source", SOURCES), *one_of("lang", LANGS))


#: Weights of a linear score.
Linear = namedtuple("Linear", "weights bias")
#: The fitted classifier: a linear score per view, their calibrations, and the last fit; or the share of good labels.
Model = namedtuple("Model", "text meta text_scale meta_scale joint prior")


def _dot(weights: list[float], values: Column) -> Column:
    return F.aggregate(F.zip_with(values, F.array(*map(F.lit, weights)), lambda x, w: x * w), F.lit(0.0),
                       lambda a, x: a + x)


def _score(model: Linear, values: Column) -> Column:
    return _dot(model.weights, values) + F.lit(model.bias)


def _sure(score: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def _fit(rows: DataFrame, values: Column, penalty: float = 1e-3) -> Linear:
    """Logistic regression of ``y`` with row weights ``w``."""
    fit = LogisticRegression(labelCol="y", weightCol="w", maxIter=25, regParam=penalty, aggregationDepth=2).fit(
        rows.select("y", "w", array_to_vector(values).alias("features")))
    return Linear([float(x) for x in fit.coefficients], float(fit.intercept))


def views(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, lang, source, n_chars, text_view, y)`` of each row of
    ``docs``, checkpointed; ``y`` is 1 for a good label, 0 for a bad one, else null.

    A document with several labels counts as good if most are; null labels are
    ignored."""
    truth = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
             .groupBy(F.col("doc_id").cast("long").alias("label_id"))
             .agg((F.avg("quality") >= 0.5).cast("double").alias("y")))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
                       F.col("n_chars").cast("long").alias("n_chars"))
    rows = with_features(base, "text_view").drop("text")
    return cut_lineage(rows.join(truth, rows["doc_id"] == truth["label_id"], "left").drop("label_id"))


def fit(rows: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS) -> Model:
    """Co-train on ``rows`` (see ``views``).  Without labels of both kinds no
    classifier is fitted and every document gets the share of good labels (1
    without any)."""
    rows = rows.select("doc_id", "text_view", meta_features().alias("meta_view"), "y")
    n = rows.where("y IS NOT NULL").count()
    share = min(1.0, labelled / max(n, 1))
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 20))
    chosen = rows.where(F.col("y").isNotNull() & (place < int(share * (1 << 20)) + (share == 1.0)))
    # at most LABELLED short rows, read by every step of every fit: a few partitions
    known = cut_lineage(chosen.dropDuplicates(["doc_id"]).repartition(4)
                        .withColumn("held", F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(4)) == 0))
    count = {(r["held"], r["y"]): r["count"] for r in known.groupBy("held", "y").count().collect()}
    good = sum(c for (_, y), c in count.items() if y)
    if any(count.get((h, y), 0) < 2 for h in (True, False) for y in (0.0, 1.0)):
        return Model(None, None, None, None, None, good / sum(count.values()) if count else 1.0)
    base = known.where(~F.col("held")).withColumn("w", F.lit(1.0))
    held = known.where("held").withColumn("w", F.lit(1.0))
    size = sum(c for (h, _), c in count.items() if not h)
    pool = rows.where("y IS NULL").drop("y")

    train = {"text": base, "meta": base}
    for step in range(rounds + 1):
        model = {v: _fit(train[v], F.col(f"{v}_view")) for v in train}
        scale = {v: _fit(held, F.array(_score(model[v], F.col(f"{v}_view")))) for v in model}
        if step == rounds:
            break
        sure = {v: _sure(_score(scale[v], F.array(_score(model[v], F.col(f"{v}_view"))))) for v in model}
        for giver, taker in (("text", "meta"), ("meta", "text")):
            picked = (pool.withColumn("p", sure[giver]).where((F.col("p") >= SURE) | (F.col("p") <= 1 - SURE))
                      .select("text_view", "meta_view", (F.col("p") > 0.5).cast("double").alias("y")))
            m = picked.count()
            if m:   # all pseudo-labels together weigh as much as the labels
                train[taker] = base.select("text_view", "meta_view", "y", "w").unionByName(
                    picked.withColumn("w", F.lit(min(1.0, size / m))))
    logits = F.array(*(_score(scale[v], F.array(_score(model[v], F.col(f"{v}_view")))) for v in ("text", "meta")))
    joint = _fit(held, logits)
    return Model(model["text"], model["meta"], scale["text"], scale["meta"], joint, good / sum(count.values()))


def probabilities(model: Model, text_view: Column, meta_view: Column) -> tuple[Column, Column, Column]:
    """Calibrated probability of being good by text, by metadata and by both."""
    if model.joint is None:
        return (F.lit(float(model.prior)),) * 3
    by_text = _score(model.text_scale, F.array(_score(model.text, text_view)))
    by_meta = _score(model.meta_scale, F.array(_score(model.meta, meta_view)))
    return _sure(by_text), _sure(by_meta), _sure(_score(model.joint, F.array(by_text, by_meta)))


def quality_scores(docs: DataFrame, labels: DataFrame, least: float = LEAST) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, p_text, p_meta, p_good, kept``."""
    rows = views(docs, labels)
    p_text, p_meta, p_good = probabilities(fit(rows), F.col("text_view"), meta_features())
    return (rows.select("doc_id", p_text.alias("p_text"), p_meta.alias("p_meta"), p_good.alias("p_good"))
            .withColumn("kept", F.col("p_good") >= least))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier does not reject;
    filtered where they are read."""
    model = fit(views(docs, labels))
    name = "features"
    while name in docs.columns:
        name += "_"
    return (with_features(docs, name).where(probabilities(model, F.col(name), meta_features())[2] >= least)
            .drop(name))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document of ``documents``, learnt from ``labels``."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
