"""Splits, feature selection, training, calibration and scoring (group E)
on Spark MLlib.  Executors do every fit; only k x k correlations, scores per
feature and model parameters reach the driver."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import Future
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import _FitMultipleIterator
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
                                       NaiveBayes, RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..functions.moments import pair_correlations
from ..functions.ranking import stored_in_order
from ..session import cut_lineage, stored
from .panel import shift_month
from .profile import unpivot, wide_agg
from .reports import roc_auc


# ---------------------------------------------------------------- E1 / E2
def split_by_month(df: DataFrame, end_month: int, test_size: int) -> tuple[DataFrame, DataFrame]:
    """E1 (test_size >= 1): months after end - test_size - 2 are the test."""
    cut = shift_month(end_month, -(test_size + 2))
    return df.where(F.col("ANO_MES") <= cut), df.where(F.col("ANO_MES") > cut)


def hash_split(df: DataFrame, key: Sequence[str], test_fraction: float, seed: int = 10) -> tuple[DataFrame, DataFrame]:
    """E1 (test_size < 1): a stable hash split (same rows on every run and
    partitioning, unlike ``randomSplit``)."""
    h = F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in key]), F.lit(10_000)) / 10_000.0
    return df.where(h >= test_fraction), df.where(h < test_fraction)


def last_n_months(df: DataFrame, n: int, target: str = "TARGET") -> DataFrame:
    """Drop null targets, keep ANO_MES > max - n (max as a scalar
    subquery-like one-row aggregate)."""
    d = df.where(F.col(target).isNotNull())
    mx = d.agg(F.max("ANO_MES")).first()[0]
    return d.where(F.col("ANO_MES") > shift_month(mx, -n))


# ---------------------------------------------------------------- E3
def anova_f(df: DataFrame, features: Sequence[str], target: str = "TARGET") -> DataFrame:
    """One-way ANOVA F per feature between the classes (invariant to the
    z-scoring the reference applies first).  The within-class sum of squares is
    n times the population variance, which Spark merges from centred sums, so
    values far from zero do not cancel; the class means are centred on the
    whole mean likewise."""
    u = unpivot(df, features, [target], "double").where(F.col("value").isNotNull())
    g = u.groupBy("Variable", target).agg(F.count("*").alias("n"), F.avg("value").alias("m"),
                                          (F.var_pop("value") * F.count("*")).alias("w"))
    whole = g.groupBy("Variable").agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("_m"))
    t = (g.join(whole, "Variable").groupBy("Variable")
         .agg(F.sum("n").alias("N"), F.count("*").alias("k"), F.sum("w").alias("W"),
              F.sum(F.col("n") * (F.col("m") - F.col("_m")) ** 2).alias("B")))
    return t.select("Variable", F.try_divide(F.col("B") / (F.col("k") - 1), F.col("W") / (F.col("N") - F.col("k")))
                    .alias("F"), "k", "N")


def anova_p_values(stats: DataFrame, alpha: float = 0.1) -> DataFrame:
    """p-values of the (one row per feature) F table via the JVM F
    distribution on the driver; KEEP when p < alpha."""
    spark = stats.sparkSession
    jvm = spark.sparkContext._jvm
    rows = []
    for r in stats.collect():
        p = None
        if r["F"] is not None and r["k"] > 1 and r["N"] > r["k"]:
            dist = jvm.org.apache.commons.math3.distribution.FDistribution(float(r["k"] - 1), float(r["N"] - r["k"]))
            p = 1.0 - dist.cumulativeProbability(float(r["F"]))
        rows.append((r["Variable"], r["F"], p, p is not None and p < alpha))
    return spark.createDataFrame(rows, "Variable string, F double, P_VALUE double, KEEP boolean")


# ---------------------------------------------------------------- E9
def algorithm(name: str, features: str = "features", label: str = "TARGET", weight: str | None = "WEIGHT", **params):
    """The model families as MLlib estimators (GBT also stands in for
    LightGBM; RF without bootstrap for ExtraTrees)."""
    common = {"featuresCol": features, "labelCol": label}
    if name == "RandomForest":
        return RandomForestClassifier(**common, weightCol=weight, **params) if weight else \
            RandomForestClassifier(**common, **params)
    if name == "ExtraTrees":
        return RandomForestClassifier(**common, bootstrap=False, **params)
    if name == "LogisticRegression":
        return LogisticRegression(**common, weightCol=weight, **params) if weight else LogisticRegression(**common, **params)
    if name in ("GradientBoosting", "LightGBM"):
        return GBTClassifier(**common, weightCol=weight, **params) if weight else GBTClassifier(**common, **params)
    if name == "GaussianNB":
        return NaiveBayes(**common, modelType="gaussian", **params)
    if name == "MLP":
        return MultilayerPerceptronClassifier(**common, **params)
    raise ValueError(name)


def with_balanced_weight(df: DataFrame, label: str = "TARGET", out: str = "WEIGHT") -> DataFrame:
    """class_weight='balanced': n / (2 * n_class), from one aggregate."""
    st = wide_agg(df, {"n": F.count("*"), "n1": F.sum(F.col(label).cast("long"))})
    n, n1 = st["n"], st["n1"] or 0
    w1 = n / (2.0 * n1) if n1 else 1.0
    w0 = n / (2.0 * (n - n1)) if n - n1 else 1.0
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(w1)).otherwise(F.lit(w0)))


def assemble(features: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


# ---------------------------------------------------------------- E4 / E5 / E6
def tree_importance_funnel(df: DataFrame, features: Sequence[str], anova: dict[str, float], label: str = "TARGET",
                           seed: int = 0) -> DataFrame:
    """RF (depth 10) keeps features with importance > 0, then GBT
    (depth 5, sqrt subsets) on the survivors; ranking by the mean of the
    three z-scores (ANOVA F, RF, GBT importances)."""
    spark = df.sparkSession
    feats = list(features)
    data = assemble(feats).transform(df)
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, maxDepth=10, numTrees=30, seed=seed).fit(data)
    rf_imp = dict(zip(feats, rf.featureImportances.toArray().tolist()))
    surv = [f for f in feats if rf_imp[f] > 0]
    data2 = assemble(surv).transform(df)
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxDepth=5, featureSubsetStrategy="sqrt", maxIter=20,
                        seed=seed).fit(data2)
    gb_imp = dict(zip(surv, gbt.featureImportances.toArray().tolist()))
    keep = [f for f in surv if gb_imp[f] > 0]

    def z(d):
        vals = [d[f] for f in keep]
        m = sum(vals) / len(vals) if vals else 0.0
        s = math.sqrt(sum((v - m) ** 2 for v in vals) / len(vals)) if vals else 0.0
        return {f: (d[f] - m) / s if s else 0.0 for f in keep}
    za, zr, zg = z({f: anova.get(f, 0.0) or 0.0 for f in keep}), z(rf_imp), z(gb_imp)
    rows = [(f, rf_imp[f], gb_imp[f], (za[f] + zr[f] + zg[f]) / 3) for f in keep]
    return spark.createDataFrame(rows, "feature string, rf_importance double, gbt_importance double, score double")


def correlation_prune(df: DataFrame, ordered: Sequence[str], fixed: Sequence[str] = (), threshold: float = 0.5) -> list[str]:
    """E5: in importance order (fixed features first, duplicates removed)
    drop any feature with |r| > threshold to an already kept one.  The k x k
    matrix comes from one scan; the greedy pass runs on it."""
    order = list(dict.fromkeys([*fixed, *ordered]))
    close = pair_correlations(df, [order]).where(F.abs("r") > threshold)
    cm = {(r["a"], r["b"]): r["r"] for r in close.collect()}            # pairs of columns
    kept: list[str] = []
    for f in order:
        if all(abs(cm.get((k, f), cm.get((f, k))) or 0.0) <= threshold for k in kept):
            kept.append(f)
    return kept


def feature_count_grid(n_features: int, points: int = 8, first: int = 3, start: int = 10) -> list[int]:
    """The first three of an 8-point geometric series from 10 to n."""
    if n_features <= start:
        return [n_features]
    ratio = (n_features / start) ** (1 / (points - 1))
    # truncated, not rounded; the small term undoes the power's own rounding
    return [int(start * ratio ** i + 1e-9) for i in range(points)][:first]


# ---------------------------------------------------------------- E7 / E8 / E10
#: Families that take row weights.
WEIGHTED = ("RandomForest", "LogisticRegression", "GradientBoosting", "LightGBM")


def cut_forest(model: RandomForestClassificationModel, depth: int) -> RandomForestClassificationModel:
    """The random forest that would have been fitted with ``depth`` as its depth limit, from
    one with a higher limit and the same other settings: its trees' first levels, with
    siblings of one prediction made one leaf as MLlib does."""
    sc = SparkContext._active_spark_context
    tree, kind = sc._jvm.org.apache.spark.ml.tree, sc._jvm.org.apache.spark.ml.classification
    old = model._java_obj

    def cut(node, level: int):
        """The node above ``level`` more levels, and whether it is a leaf."""
        if node.subtreeDepth() == 0:
            return node, True
        if level:
            (left, one), (right, other) = cut(node.leftChild(), level - 1), cut(node.rightChild(), level - 1)
            if not (one and other and left.prediction() == right.prediction()):
                return tree.InternalNode(node.prediction(), node.impurity(), node.gain(), left, right, node.split(),
                                         node.impurityStats()), False
        return tree.LeafNode(node.prediction(), node.impurity(), node.impurityStats()), True
    found = list(old.trees())
    trees = sc._gateway.new_array(kind.DecisionTreeClassificationModel, len(found))
    for k, t in enumerate(found):
        trees[k] = kind.DecisionTreeClassificationModel(t.uid(), cut(t.rootNode(), depth)[0], t.numFeatures(), t.numClasses())
    new = RandomForestClassificationModel(kind.RandomForestClassificationModel(
        old.uid(), trees, old.numFeatures(), old.numClasses()))
    model._copyValues(new)
    new.set(new.maxDepth, depth)
    new._transfer_params_to_java()
    return new


class _Fits(_FitMultipleIterator):
    """Gives ``(index, model)`` of each turn, to several threads."""

    def __next__(self):
        return super().__next__()[1]


class ForestPipeline(Pipeline):
    """A pipeline that ends in a random forest.  Of settings that differ in the depth limit only,
    the deepest forest is fitted and the others are cut from it: the forests are
    the same, as MLlib draws rows by tree and features level by level."""

    def same_draws(self, forest: RandomForestClassifier, n_features: int) -> bool:
        """A forest's levels are each one pass (statistics of three doubles a bin),
        so that deeper levels do not come before others have drawn."""
        bins = n_features * forest.getMaxBins() * 3 * 8
        return bins * forest.getNumTrees() * 2 ** (forest.getMaxDepth() - 1) <= forest.getMaxMemoryInMB() << 20

    def fitMultiple(self, dataset: DataFrame, paramMaps):
        *before, forest = self.getStages()
        inputs = [len(s.getInputCols()) for s in before if isinstance(s, VectorAssembler)]
        groups: dict[tuple, list[tuple[int, int]]] = {}
        for i, settings in enumerate(paramMaps):
            est = forest.copy(settings)
            rest = tuple(sorted((str(p), str(v)) for p, v in settings.items() if p != forest.maxDepth))
            alone = () if inputs and self.same_draws(est, sum(inputs)) else (i,)
            groups.setdefault(rest + alone, []).append((est.getMaxDepth(), i))
        deepest = {i: max(group) for group in groups.values() for _, i in group}
        fitted = {i: Future() for _, i in set(deepest.values())}
        # the deepest first: the others wait for them
        turns = sorted(deepest, key=lambda i: (deepest[i][1] != i, i))
        whole = self.copy()

        def fit_one(turn: int) -> tuple[int, PipelineModel]:
            i = turns[turn]
            depth, of = deepest[i]
            if of == i:
                try:
                    fitted[i].set_result(whole.fit(dataset, paramMaps[i]))
                except BaseException as failed:
                    fitted[i].set_exception(failed)
            model = fitted[of].result()
            own = forest.copy(paramMaps[i]).getMaxDepth()
            if own < depth:
                model = PipelineModel([*model.stages[:-1], cut_forest(model.stages[-1], own)])
            return i, model
        return _Fits(fit_one, len(turns))


def grid_search(df: DataFrame, features: Sequence[str], name: str, grid: dict, label: str = "TARGET",
                folds: int = 3, seed: int = 0, parallelism: int = 2, balanced: bool = True):
    """K-fold CV on ROC AUC over a parameter grid; returns the fitted
    CrossValidatorModel.  ``balanced`` weighs the classes evenly in every fit,
    for the families that take weights."""
    weight = "WEIGHT" if balanced and name in WEIGHTED else None
    est = algorithm(name, label=label, weight=weight)
    pb = ParamGridBuilder()
    for p, vals in grid.items():
        pb = pb.addGrid(est.getParam(p), vals)
    kind = ForestPipeline if isinstance(est, RandomForestClassifier) else Pipeline
    pipe = kind(stages=[assemble(features), est])
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC")
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=pb.build(), evaluator=ev, numFolds=folds, seed=seed,
                        parallelism=parallelism)
    data = df.select(*dict.fromkeys([*features, label]))     # the folds are cached with these columns only
    return cv.fit(with_balanced_weight(data, label) if weight else data)


def settings_above(model, threshold: float = 0.5) -> list[tuple[str, float]]:
    """The settings of a CrossValidatorModel whose mean AUC is above the
    threshold, best first."""
    found = [(str({p.name: v for p, v in pm.items()}), float(a))
             for pm, a in zip(model.getEstimatorParamMaps(), model.avgMetrics)]
    return sorted((x for x in found if x[1] > threshold), key=lambda x: (-x[1], x[0]))


def size_of(df: DataFrame) -> int:
    """Bytes of ``df`` as its plan estimates them: of a stored table, those of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def packed(df: DataFrame, least: int = 8 << 20) -> DataFrame:
    """``df`` in partitions of some ``least`` bytes: a fit of many short passes over a
    small table otherwise spends its time on starting tasks."""
    return df.coalesce(-(-max(size_of(df), 1) // least))


def together(spark, jobs: Sequence[Callable], frames: Sequence[DataFrame], most: int = 4, room: int = 512 << 20) -> list:
    """Results of ``jobs``, in their order.  Small jobs mostly wait for the driver, so up to
    ``most`` run side by side, as long as that many of the largest of ``frames``,
    which they read and cache, take no more than ``room`` bytes."""
    size = max(map(size_of, frames), default=0)
    at_once = max(1, min(most, len(jobs), room // max(size, 1)))
    if at_once == 1:
        return [job() for job in jobs]
    with ThreadPool(at_once) as pool:
        return pool.map(lambda job: job(), [inheritable_thread_target(spark)(job) for job in jobs], chunksize=1)


def preprocessing_variants(df: DataFrame, target: str = "TARGET", keys: Sequence[str] = (),
                           aggregation: Sequence[bool] = (False, True), flags: Sequence[bool] = (False, True),
                           extras: Sequence[str | None] = (None, "binning", "outlier"),
                           lob_threshold: float | None = None) -> dict[str, tuple[DataFrame, list[str]]]:
    """E7 matrix variants: {column aggregation (D21)} x {count flags (D22)} x
    {none | binning (D23) | outlier caps (D24)} — binning and outliers
    exclude each other — each followed by the near-constant filter (D25).
    Returns ``name -> (matrix, numeric feature list)``; fits run on Spark, those of
    several variants of a small matrix side by side."""
    from . import fitted as FT
    from ..functions.columns import numeric_columns
    df = stored(df, "matrix")            # every fit and fold reads the matrix, not its lineage

    def variant(d: DataFrame, num: list[str], extra: str | None) -> tuple[DataFrame, list[str]]:
        if extra == "binning":
            d = FT.quantile_bin_transform(d, FT.quantile_bin_fit(d, num))
        elif extra == "outlier":
            d = FT.clip_transform(d, FT.clip_fit(d, num))
        d = FT.constant_fill(d)          # the final sentinel fill (D20): no NaN reaches the model
        d = packed(stored(d, "variant"))
        keep = set(FT.near_constant_fit(d.select(target, *num), target, columns=num))
        return d, [c for c in num if c in keep]
    jobs = {}
    for agg in aggregation:
        folded = FT.lob_others_transform(df, FT.lob_others_fit(df, target, threshold=lob_threshold)) if agg else df
        for flg in flags:
            d = FT.count_to_flag_transform(folded, FT.count_to_flag_fit(folded)) if flg else folded
            num = numeric_columns(d, exclude=[target, *keys])
            for extra in extras:
                name = "+".join([p for p, on in (("agg", agg), ("flags", flg)) if on] + ([extra] if extra else [])) \
                    or "base"
                jobs[name] = partial(variant, d, num, extra)
    return dict(zip(jobs, together(df.sparkSession, list(jobs.values()), [df] * len(jobs))))


def training_grid(df: DataFrame, feature_sets: dict[str, Sequence[str]], algorithms: dict[str, dict],
                  label: str = "TARGET", folds: int = 3, threshold: float = 0.5,
                  months: Sequence[int | None] = (None,), counts: Sequence[int | None] = (None,)) -> DataFrame:
    """Every (months x feature set x number of features x algorithm x
    grid) setting cross-validated.  ``months`` keeps the last n months (needs
    ANO_MES; None: all), ``counts`` the first n features by ANOVA F on these
    rows (None: all).  ``kept`` marks settings above the AUC threshold and
    ``winner`` the best of them."""
    def orders(spec) -> list[tuple[int | None, DataFrame, list[str]]]:
        matrix, feats = spec if isinstance(spec, tuple) else (df, list(spec))
        found = []
        for span in months:
            data = matrix if span is None else last_n_months(matrix, span, label)
            order = feats
            if any(n is not None for n in counts):
                scores = {r["Variable"]: r["F"] or 0.0 for r in anova_f(data, feats, label).collect()}
                order = sorted(feats, key=lambda f: (-scores.get(f, 0.0), f))
            found.append((span, data, order))
        return found

    def settings(fs_name: str, spec) -> list[tuple]:
        rows = []
        for span, data, order in orders(spec):
            for n in counts:
                chosen = order[:n]
                for alg, grid in algorithms.items():
                    m = grid_search(data, chosen, alg, grid, label, folds)
                    rows.append((fs_name, span, len(chosen), alg, float(max(m.avgMetrics))))
        return rows
    matrices = [spec[0] if isinstance(spec, tuple) else df for spec in feature_sets.values()]
    jobs = [partial(settings, *item) for item in feature_sets.items()]
    rows = [row for part in together(df.sparkSession, jobs, matrices) for row in part]
    best = max((r[4] for r in rows if r[4] > threshold), default=None)
    return df.sparkSession.createDataFrame(
        [(*r, r[4] > threshold, r[4] == best) for r in rows],
        "feature_set string, months int, n_features int, algorithm string, cv_auc double, kept boolean, winner boolean")


def oof_scores(df: DataFrame, features: Sequence[str], name: str, params: dict, label: str = "TARGET",
               key: Sequence[str] = (), folds: int = 3, seed: int = 0) -> DataFrame:
    """Out-of-fold P(1) with a stable hash fold id."""
    fold = F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in key]), F.lit(folds))
    d = df.withColumn("_fold", fold)
    parts = []
    for k in range(folds):
        pipe = Pipeline(stages=[assemble(features), algorithm(name, label=label, weight=None, **params)])
        m = pipe.fit(d.where(F.col("_fold") != k))
        s = m.transform(d.where(F.col("_fold") == k))
        parts.append(s.withColumn("P1", vector_to_array("probability")[1]).drop("features", "rawPrediction",
                                                                               "probability", "prediction"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def calibrate(scored: DataFrame, label: str = "TARGET", score: str = "P1") -> PipelineModel:
    """Sigmoid (Platt) calibration — a one-feature logistic regression
    of the label on the out-of-fold score."""
    lr = LogisticRegression(featuresCol="_s", labelCol=label)
    return Pipeline(stages=[VectorAssembler(inputCols=[score], outputCol="_s"), lr]).fit(scored)


# ---------------------------------------------------------------- E13 - E15
def score_table(model: PipelineModel, df: DataFrame, keys: Sequence[str], label: str | None = "TARGET") -> DataFrame:
    """P(0), P(1) per key (+ the label when present)."""
    out = model.transform(df).withColumn("_p", vector_to_array("probability"))
    cols = [*keys, F.col("_p")[0].alias("P0"), F.col("_p")[1].alias("P1")]
    if label and label in df.columns:
        cols.append(F.col(label))
    return out.select(*cols)


def pipeline_auc(pipeline: Pipeline, df: DataFrame, label: str = "TARGET", folds: int = 3, seed: int = 0) -> float:
    """Mean ROC AUC of a pipeline over ``folds`` folds."""
    judge = BinaryClassificationEvaluator(labelCol=label)
    return float(CrossValidator(estimator=pipeline, estimatorParamMaps=[{}], evaluator=judge, numFolds=folds,
                                seed=seed).fit(df).avgMetrics[0])


def best_of(spark, aucs: dict[str, float]) -> DataFrame:
    """``(version, cv_auc, best)``; of equal ones the first named is the best."""
    best = max(aucs, key=aucs.get)
    return spark.createDataFrame([(v, a, v == best) for v, a in aucs.items()], "version string, cv_auc double, best boolean")


def recalibrate(pipeline: Pipeline, df: DataFrame, months: int, label: str = "TARGET", champion: Pipeline | None = None,
                folds: int = 3, seed: int = 0) -> tuple[PipelineModel, DataFrame]:
    """Refit an old pipeline definition on the last ``months`` months.
    Returns the model and a table ``(version, cv_auc, best)`` with its k-fold
    AUC and, where given, that of the new champion's pipeline on the same rows."""
    recent = last_n_months(df, months, label)
    found = {"recalibrated": pipeline_auc(pipeline, recent, label, folds, seed)}
    if champion is not None:
        found["champion"] = pipeline_auc(champion, recent, label, folds, seed)
    return pipeline.fit(recent), best_of(df.sparkSession, found)


def permutation_importance(model: PipelineModel, df: DataFrame, features: Sequence[str], keys: Sequence[str],
                           label: str = "TARGET", seed: int = 0, top: int = 20) -> DataFrame:
    """E15 (re-aimed from SHAP): AUC drop when one feature is permuted, with
    the normalised impurity importance of tree models; the ``top`` features.

    Rows are ranked once in a hash order; a feature is permuted by taking its
    value from the row that lies a feature-specific distance ahead (cyclic).
    The values of all features come by joins on the rank, which leave the rows
    where they are after the first; each row then has a score per feature."""
    base = roc_auc(score_table(model, df, keys, label), "P1", label).first()[0]
    h = F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])
    ranked = stored_in_order(df, [h, *keys], df.columns, "ranked")
    n = ranked.count()
    impurity = getattr(model.stages[-1], "featureImportances", None)
    share = [float(x) for x in impurity.toArray()] if impurity is not None else [None] * len(features)
    total = sum(x for x in share if x is not None) or 1.0
    wide = ranked
    for k, f in enumerate(features):
        ahead = max(1, n * (k + 1) // (len(features) + 1))
        donor = ranked.select(((F.col("_i") - 1 + ahead) % n + 1).alias("_i"), F.col(f).alias(f"_perm{k}"))
        wide = wide.join(donor.hint("merge"), "_i")
    kept = [c for c in wide.columns if c != "_i"]
    wide = wide.select(*kept)
    for k, f in enumerate(features):
        one = wide.withColumn("_own", F.col(f)).withColumn(f, F.col(f"_perm{k}"))
        wide = (model.transform(one).withColumn(f, F.col("_own"))
                .withColumn(f"_p{k}", vector_to_array("probability")[1]).select(*kept, *(f"_p{j}" for j in range(k + 1))))
    each = wide.select(label, F.posexplode(F.array(*(f"_p{k}" for k in range(len(features))))).alias("_k", "P1"))
    aucs = {r["_k"]: r["AUC"] for r in roc_auc(each, "P1", label, by=["_k"]).collect()}      # a row a feature
    rows = [(f, float(base), float(aucs[k]), float(base - aucs[k]), None if share[k] is None else share[k] / total)
            for k, f in enumerate(features)]
    rows = sorted(rows, key=lambda r: (-r[3], r[0]))[:top]
    return df.sparkSession.createDataFrame(
        rows, "feature string, auc double, auc_permuted double, importance double, impurity double")
