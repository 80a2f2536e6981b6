"""Isotonic and sigmoid calibration, and classifiers calibrated by fold.

A calibrator is fitted on counts by distinct score, so ties cost one row; the
isotonic one pools adjacent violators in parallel (MLlib).  By fold, the base
model of the other folds scores a fold, a calibrator is fitted on that, and the
probabilities of all folds' pairs are averaged.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .models import WEIGHTED, algorithm, assemble, with_balanced_weight

METHODS = ("sigmoid", "isotonic")


def score_counts(scored: DataFrame, score: str, label: str = "TARGET") -> DataFrame:
    """``(s, n0, n1)``: rows of each class by distinct score; null scores and labels are left out."""
    y = F.col(label).cast("int")
    return (scored.where(F.col(score).isNotNull() & y.isNotNull()).groupBy(F.col(score).cast("double").alias("s"))
            .agg(F.count_if(y == 0).alias("n0"), F.count_if(y == 1).alias("n1")))


def fit_calibrator(scored: DataFrame, score: str, label: str = "TARGET", method: str = "isotonic") -> PipelineModel:
    """The calibrator as an MLlib model of the columns ``s`` to ``_p``
    (``calibrated`` applies it).  Isotonic: the best rising step curve, straight
    between its steps, flat beyond them."""
    counts = score_counts(scored, score, label)
    if method == "isotonic":
        n = F.col("n0") + F.col("n1")
        rows = counts.select("s", (F.col("n1") / n).alias("y"), n.cast("double").alias("w"))
        return Pipeline(stages=[IsotonicRegression(featuresCol="s", labelCol="y", weightCol="w", predictionCol="_p")]).fit(rows)
    if method != "sigmoid":
        raise ValueError(f"method is one of {METHODS}")
    rows = counts.select("s", F.explode(F.array(*(F.struct(F.lit(float(k)).alias("y"), F.col(f"n{k}").cast("double").alias("w"))
                                                  for k in (0, 1)))).alias("c")).select("s", "c.*").where("w > 0")
    return Pipeline(stages=[VectorAssembler(inputCols=["s"], outputCol="_v"), LogisticRegression(
        featuresCol="_v", labelCol="y", weightCol="w", probabilityCol="_c", rawPredictionCol="_r", predictionCol="_d")]).fit(rows)


def calibrated(scored: DataFrame, calibrator: PipelineModel, score: str, out: str) -> DataFrame:
    """``scored`` with the calibrated probability ``out``."""
    if "s" in scored.columns:
        raise ValueError("a column s is in the way")
    t = calibrator.transform(scored.withColumn("s", F.col(score).cast("double")))
    p = F.col("_p") if "_p" in t.columns else vector_to_array("_c")[1]
    return t.withColumn(out, p).select(*scored.columns, out)


def isotonic_curve(calibrator: PipelineModel) -> DataFrame:
    """``(S, P)``: the boundaries of an isotonic calibrator and their probabilities."""
    last = calibrator.stages[-1]
    from pyspark.sql import SparkSession
    rows = list(zip([float(x) for x in last.boundaries], [float(x) for x in last.predictions]))
    return SparkSession.active().createDataFrame(rows, "S double, P double")


@dataclass
class CalibratedFolds:
    """Pairs of a base model and the calibrator of the fold that it left out."""
    pairs: list[tuple[PipelineModel, PipelineModel]]
    fold: Column

    def _each(self, df: DataFrame) -> DataFrame:
        """``df`` with the calibrated P(1) of every pair, ``_p0``, ``_p1``, ..."""
        names = [*df.columns]
        for k, (base, calibrator) in enumerate(self.pairs):
            scored = base.transform(df).withColumn("_base", vector_to_array("probability")[1]).select(*names, "_base")
            df = calibrated(scored, calibrator, "_base", f"_p{k}").drop("_base")
            names.append(f"_p{k}")
        return df

    def transform(self, df: DataFrame, out: str = "P1") -> DataFrame:
        """``df`` with the mean of the folds' probabilities: for rows not trained on."""
        each = self._each(df)
        mean = reduce(lambda a, b: a + b, [F.col(f"_p{k}") for k in range(len(self.pairs))]) / len(self.pairs)
        return each.withColumn(out, mean).select(*df.columns, out)

    def out_of_fold(self, df: DataFrame, out: str = "P1") -> DataFrame:
        """The training rows, each with the probability of the base model that
        did not see it (its calibrator did) and its fold ``FOLD``."""
        rows = df.withColumn("FOLD", self.fold.cast("int"))
        parts = []
        for k, (base, calibrator) in enumerate(self.pairs):     # a row meets the pair of its own fold only
            scored = base.transform(rows.where(F.col("FOLD") == k)).withColumn("_base", vector_to_array("probability")[1])
            parts.append(calibrated(scored.select(*rows.columns, "_base"), calibrator, "_base", out))
        return reduce(DataFrame.unionByName, parts).select(*df.columns, "FOLD", out)


def fit_calibrated_folds(df: DataFrame, features: Sequence[str], name: str, params: dict, key: Sequence[str],
                         label: str = "TARGET", method: str = "sigmoid", folds: int = 3, seed: int = 0,
                         balanced: bool = True) -> CalibratedFolds:
    """Fit ``folds`` pairs; a row's fold is a hash of its key."""
    fold = F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in key]), F.lit(folds))
    weighted = balanced and name in WEIGHTED
    data = df.select(*dict.fromkeys([*features, label]), fold.alias("_fold"))
    rows = stored(with_balanced_weight(data, label) if weighted else data, "folds")
    pairs = []
    for k in range(folds):
        base = Pipeline(stages=[assemble(features), algorithm(name, label=label, weight="WEIGHT" if weighted else None, **params)])
        model = base.fit(rows.where(F.col("_fold") != k))
        left = model.transform(rows.where(F.col("_fold") == k)).withColumn("_s", vector_to_array("probability")[1])
        pairs.append((model, fit_calibrator(left.select("_s", label), "_s", label, method)))
    return CalibratedFolds(pairs, fold)
