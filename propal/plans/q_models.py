"""Queries E1-E15: splits, selection, training, calibration and scoring.
Model fits have no SQL twin (rows-only checks); the statistics that do
(month split, last-n months, ANOVA F) carry DuckDB oracles."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import models as M
from ..operators.profile import wide_agg
from ..operators.reports import roc_auc
from ..session import stored
from .catalog import query
from .fixtures import LOBS

NUMF = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size"]
KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]


def _train(fx):
    return fx.line_facts.select(*KEYS, "o_orderdate", *NUMF, "TARGET")


def _matrix(fx, *more):
    """The features and the label, with ``more`` columns, stored once for all fits."""
    return stored(_train(fx).select(*more, *NUMF, "TARGET"), "train")


def _month():
    return (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("int").alias("ANO_MES")


@query("E1_split_by_month", "SELECT * FROM universe WHERE ANO_MES > (SELECT M5 FROM last_month)")
def e1(fx):
    """Test part of the universe: the last 3 months after the 2-month gap."""
    train, test = M.split_by_month(fx.universe, fx.span[1], 3)
    return test


@query("E1_hash_split")
def e1h(fx):
    """Stable 20 % hash test split of the line facts."""
    train, test = M.hash_split(_train(fx), KEYS, 0.2, seed=10)
    return test


@query("E2_last_n_months", "SELECT * FROM universe WHERE TARGET IS NOT NULL AND (ANO_MES // 100) * 12 + ANO_MES % 100 > "
       "(SELECT (max(ANO_MES) // 100) * 12 + max(ANO_MES) % 100 - 6 FROM universe)")
def e2(fx):
    """Training rows of the last 6 months."""
    return M.last_n_months(fx.universe, 6)


_E3_SQL = "\nUNION ALL\n".join(f"""
SELECT '{c}' AS Variable, round(((sum(n * m * m) - sum(n * m) ^ 2 / sum(n)) / (count(*) - 1))
  / ((sum(q) - sum(n * m * m)) / (sum(n) - count(*))), 6) AS F
FROM (SELECT TARGET, count(*) AS n, avg(CAST({c} AS DOUBLE)) AS m, sum(CAST({c} AS DOUBLE) ^ 2) AS q
      FROM line_facts WHERE {c} IS NOT NULL GROUP BY TARGET)""" for c in NUMF)


@query("E3_anova_f", _E3_SQL)
def e3(fx):
    """One-way ANOVA F of each numeric feature between the classes."""
    return M.anova_f(fx.line_facts, NUMF).select("Variable", F.round("F", 6).alias("F"))


@query("E3_anova_selection")
def e3p(fx):
    """ANOVA p-values and the p < 0.1 selection."""
    return M.anova_p_values(M.anova_f(fx.line_facts, NUMF))


@query("E4_tree_importance_funnel")
def e4(fx):
    """RF then GBT importance funnel ranked by mean z-score."""
    df = _matrix(fx)
    anova = {r["Variable"]: r["F"] for r in M.anova_f(df, NUMF).collect()}
    return M.tree_importance_funnel(df, NUMF, anova)


_E5_FEATS = NUMF + ["VAL_PRICE_PER_QTY"]
_E5_T = "(SELECT *, l_extendedprice / l_quantity AS VAL_PRICE_PER_QTY FROM line_facts)"
_E5_F = "\nUNION ALL\n".join(f"""
SELECT '{c}' AS Variable, ((sum(n * m * m) - sum(n * m) ^ 2 / sum(n)) / (count(*) - 1))
  / ((sum(q) - sum(n * m * m)) / (sum(n) - count(*))) AS F
FROM (SELECT TARGET, count(*) AS n, avg(CAST({c} AS DOUBLE)) AS m, sum(CAST({c} AS DOUBLE) ^ 2) AS q
      FROM {_E5_T} WHERE {c} IS NOT NULL GROUP BY TARGET)""" for c in _E5_FEATS)
_E5_C = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r FROM {_E5_T}"
    for a in _E5_FEATS for b in _E5_FEATS if a != b)


@query("E5_correlation_prune", f"""
WITH RECURSIVE f AS ({_E5_F}),
o AS (SELECT Variable, row_number() OVER (ORDER BY F DESC) AS i FROM f),
c AS ({_E5_C}),
r(i, kept) AS (
  SELECT 0, CAST([] AS VARCHAR[])
  UNION ALL
  SELECT r.i + 1, CASE WHEN (SELECT coalesce(max(abs(c.r)), 0) FROM c WHERE c.a = o.Variable AND list_contains(r.kept, c.b))
                            <= 0.5 THEN list_append(r.kept, o.Variable) ELSE r.kept END
  FROM r JOIN o ON o.i = r.i + 1)
SELECT CAST(generate_subscripts(kept, 1) AS INTEGER) AS rank, unnest(kept) AS feature
FROM (SELECT kept FROM r ORDER BY i DESC LIMIT 1)""")
def e5(fx):
    """Greedy |r| > 0.5 pruning in ANOVA-F order (price and quantity are
    correlated)."""
    df = _train(fx).withColumn("VAL_PRICE_PER_QTY", F.col("l_extendedprice") / F.col("l_quantity"))
    feats = NUMF + ["VAL_PRICE_PER_QTY"]
    order = [r["Variable"] for r in M.anova_f(df, feats).orderBy(F.col("F").desc()).collect()]
    kept = M.correlation_prune(df, order)
    return fx.spark.createDataFrame([(i + 1, f) for i, f in enumerate(kept)], "rank int, feature string")


_WIDE_NUM = ["VAL_SALDO", "NATION", *(f"{p}_{b}" for b in LOBS for p in (
    "QTD_APL_VIG_T", "VAL_PCA", "QTD_MESES_ULT_COMPRA", "QTD_APL_REC"))]


@query("E6_feature_count_grid", f"""
WITH n AS (SELECT {' + '.join(f'CAST(coalesce(min({c}) <> max({c}), false) AS INTEGER)' for c in _WIDE_NUM)} AS n FROM wide_lob),
g AS (SELECT n, CASE WHEN n <= 10 THEN n ELSE CAST(trunc(10 * pow(n / 10.0, i / 7.0) + 1e-9) AS INTEGER) END AS k, i
      FROM n, (SELECT unnest(range(0, 3)) AS i))
SELECT DISTINCT k AS n_features FROM g""")
def e6(fx):
    """Feature-count grid for the numeric columns of the wide customer table
    that vary."""
    w = fx.wide_lob
    spread = wide_agg(w, {(c, f.__name__): f(c) for c in _WIDE_NUM for f in (F.min, F.max)})
    n = sum(spread[c, "min"] is not None and spread[c, "min"] != spread[c, "max"] for c in _WIDE_NUM)
    return fx.spark.createDataFrame([(k,) for k in M.feature_count_grid(n)], "n_features int").distinct()


_ALGS = {"RandomForest": {"maxDepth": [3, 5], "numTrees": [10]}, "LogisticRegression": {"regParam": [0.0, 0.1]}}


@query("E7_training_grid")
def e7(fx):
    """Months x number of features x algorithms grid, 3-fold CV AUC each."""
    df = _matrix(fx, _month())
    return M.training_grid(df, {"all": NUMF}, _ALGS, months=(24, None), counts=(3, None))


@query("E7_preprocessing_grid")
def e7p(fx):
    """Matrix variants of the wide customer table (LOB aggregation, count
    flags x none / binning / outlier caps, near-constant filter) x logistic
    regression, 3-fold CV AUC each."""
    w = fx.wide_lob.select("ID", *[c for c, t in fx.wide_lob.dtypes if t != "string" and c not in ("ID", "NATION")])
    variants = M.preprocessing_variants(w, "TARGET", keys=["ID"], lob_threshold=0.34)
    return M.training_grid(w, variants, {"LogisticRegression": {"regParam": [0.01]}})


@query("E8_grid_search")
def e8(fx):
    """3-fold CV of a random forest grid; mean AUC per setting."""
    m = M.grid_search(_matrix(fx), NUMF, "RandomForest", {"maxDepth": [3, 5], "numTrees": [10, 20]})
    return fx.spark.createDataFrame(M.settings_above(m, 0.0), "params string, cv_auc double")


@query("E9_algorithms")
def e9(fx):
    """Each model family fitted with balanced class weights (where MLlib
    supports them) and its training AUC."""
    df = M.with_balanced_weight(_matrix(fx))            # the AUC needs no keys
    rows = []
    for name, params in (("RandomForest", {"numTrees": 10, "maxDepth": 5}), ("LogisticRegression", {}),
                         ("GradientBoosting", {"maxIter": 10, "maxDepth": 3}), ("GaussianNB", {}),
                         ("ExtraTrees", {"numTrees": 10, "maxDepth": 5}),
                         ("MLP", {"layers": [len(NUMF), 4, 2], "maxIter": 20, "seed": 0})):
        weight = "WEIGHT" if name in ("RandomForest", "LogisticRegression", "GradientBoosting") else None
        est = M.algorithm(name, weight=weight, **params)
        model = Pipeline(stages=[M.assemble(NUMF), est]).fit(df)
        auc = roc_auc(M.score_table(model, df, []), "P1").first()[0]
        rows.append((name, float(auc)))
    return fx.spark.createDataFrame(rows, "algorithm string, train_auc double")


@query("E10_calibrate")
def e10(fx):
    """Platt calibration of out-of-fold random-forest scores."""
    df = _matrix(fx, *KEYS)
    oof = M.oof_scores(df, NUMF, "RandomForest", {"numTrees": 10, "maxDepth": 5}, key=KEYS)
    cal = M.calibrate(oof)
    out = cal.transform(oof).withColumn("P1_CALIBRATED", F.element_at(vector_to_array("probability"), 2))
    return out.select(*KEYS, "TARGET", "P1", "P1_CALIBRATED")


@query("E13_recalibrate")
def e13(fx):
    """An old pipeline refitted on the last 24 months of orders, against a
    new champion, by 3-fold AUC on the same rows."""
    df = _matrix(fx, _month())
    old = Pipeline(stages=[M.assemble(NUMF[:2]), M.algorithm("LogisticRegression", weight=None)])
    new = Pipeline(stages=[M.assemble(NUMF), M.algorithm("LogisticRegression", weight=None)])
    return M.recalibrate(old, df, 24, champion=new)[1]


@query("E14_score_table")
def e14(fx):
    """P(0), P(1) per line from a fitted pipeline, keys and label kept."""
    df = _matrix(fx, *KEYS)
    model = Pipeline(stages=[M.assemble(NUMF), M.algorithm("LogisticRegression", weight=None)]).fit(df)
    return M.score_table(model, df, KEYS)


@query("E15_permutation_importance")
def e15(fx):
    """AUC drop per permuted feature (distributed permutation)."""
    df = _matrix(fx, *KEYS)
    model = Pipeline(stages=[M.assemble(NUMF), M.algorithm("RandomForest", weight=None, numTrees=10,
                                                          maxDepth=5)]).fit(df)
    return M.permutation_importance(model, df, NUMF, KEYS)
