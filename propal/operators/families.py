"""Correlated column families (D39-D41) as tables.

Everything between the data and the final projection is a small table with a
row per column, pair of columns or family: ``members`` (family, Variable, R,
SIGNIFICANT), ``coherence`` (family, mean inter-correlation), ``weights``
(family, Variable, WEIGHT), ``retention`` (feature, correlation, ...).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import numeric_columns
from ..functions.moments import pair_correlations
from ..session import cut_lineage
from .fitted import median_mode_fit, median_mode_transform
from .profile import add_p_values, point_biserial, wide_agg

#: Fixed value: the stem that names a family.
STEM = r"^([A-Z]+_[A-Z])"
MAX_MISSING, COHERENT, EFFECTIVE = 0.97, 0.3, 80.0


def clean_columns(df: DataFrame, target: str = "TARGET") -> DataFrame:
    """Without columns that are constant or more than 97 % null; the numeric
    ones that stay are filled with their exact median."""
    names = [c for c in df.columns if c != target]
    facts = wide_agg(df, {"n": F.count("*"), **{
        (c, k): e for c in names for k, e in (
            ("null", F.count_if(F.col(c).isNull())), ("lo", F.min(F.col(c).cast("string"))),
            ("hi", F.max(F.col(c).cast("string"))))}})
    gone = [c for c in names if facts[c, "null"] > MAX_MISSING * facts["n"]
            or (facts[c, "lo"] is not None and facts[c, "lo"] == facts[c, "hi"])]
    kept = df.drop(*gone)
    filled = median_mode_transform(kept, median_mode_fit(kept, numeric_columns(kept, exclude=[target]), []))
    return cut_lineage(filled)      # read by every step that follows


def members(df: DataFrame, target: str = "TARGET", min_correlation: float = 0.05) -> DataFrame:
    """``(family, Variable, R, SIGNIFICANT)`` of every numeric column (C18);
    ``family`` is null unless at least two columns have the stem."""
    facts = add_p_values(point_biserial(df, target, numeric_columns(df, exclude=[target])), min_abs=min_correlation)
    stem = F.nullif(F.regexp_extract("Variable", STEM, 1), F.lit(""))
    size = F.count("*").over(Window.partitionBy("stem"))        # a row per column
    return (facts.withColumn("stem", stem).withColumn("family", F.when(size > 1, F.col("stem")))
            .select("family", "Variable", F.coalesce("R", F.lit(0.0)).alias("R"), "SIGNIFICANT"))


def coherence(df: DataFrame, of: DataFrame, coherent: float = COHERENT) -> DataFrame:
    """D39 analysis: ``(family, n_features, avg_inter_correlation,
    is_coherent)`` of families with at least two significant members."""
    strong = of.where("family IS NOT NULL AND SIGNIFICANT").select("family", "Variable")
    blocks = {r["family"]: sorted(r["names"]) for r in                   # names of columns
              strong.groupBy("family").agg(F.collect_list("Variable").alias("names")).orderBy("family").collect()}
    number = df.sparkSession.createDataFrame(list(enumerate(blocks)), "block int, family string")
    mean = (pair_correlations(df, list(blocks.values())).join(F.broadcast(number), "block").groupBy("family")     # a family each
            .agg(F.avg(F.coalesce("r", F.lit(0.0))).alias("avg_inter_correlation")))
    return (strong.groupBy("family").agg(F.count("*").alias("n_features")).join(mean, "family")
            .withColumn("is_coherent", F.col("avg_inter_correlation") >= coherent))


def weights(of: DataFrame, analysis: DataFrame) -> DataFrame:
    """``(family, Variable, R, WEIGHT)`` in coherent families: |r| over their sum."""
    strong = of.where("SIGNIFICANT").join(analysis.where("is_coherent").select("family"), "family")
    total = F.sum(F.abs("R")).over(Window.partitionBy("family"))        # a row per column
    return strong.select("family", "Variable", "R", (F.abs("R") / total).alias("WEIGHT"))


def add_aggregates(df: DataFrame, weight: DataFrame) -> DataFrame:
    """``{family}_agg`` = weighted sum of the family's members."""
    parts: dict[str, list[Column]] = {}
    for r in weight.orderBy("family", "Variable").collect():            # at most a row per column
        parts.setdefault(f"{r['family']}_agg", []).append(F.col(r["Variable"]).cast("double") * r["WEIGHT"])
    return df.withColumns({name: reduce(Column.__add__, p) for name, p in parts.items()})


def aggregate_retention(df: DataFrame, weight: DataFrame, target: str = "TARGET") -> DataFrame:
    """Per aggregate (see ``add_aggregates``) its correlation with the
    target against that of its best member."""
    best = weight.groupBy(F.concat("family", F.lit("_agg")).alias("feature")).agg(F.max(F.abs("R")).alias("best"))
    names = [c for c in df.columns if c in {r["feature"] for r in best.select("feature").collect()}]
    if not names:
        return df.sparkSession.createDataFrame(
            [], "feature string, correlation double, signal_retention double, improved boolean, effective boolean")
    own = point_biserial(df, target, names).select(F.col("Variable").alias("feature"), F.col("R").alias("correlation"))
    kept = F.coalesce(F.try_divide(F.abs("correlation"), F.col("best")) * 100, F.lit(0.0))
    return (own.join(best, "feature")
            .select("feature", "correlation", kept.alias("signal_retention"),
                    (F.abs("correlation") > F.col("best")).alias("improved"), (kept >= EFFECTIVE).alias("effective")))


def auto_feature_set(df: DataFrame, target: str = "TARGET", min_correlation: float = 0.05,
                     coherent: float = COHERENT) -> DataFrame:
    """Cleaned columns; the significant ones, except those of a family
    whose aggregate keeps the signal; these aggregates; the target."""
    clean = clean_columns(df, target)
    of = members(clean, target, min_correlation)
    weight = weights(of, coherence(clean, of, coherent))
    wide = add_aggregates(clean, weight)
    good = aggregate_retention(wide, weight, target).where("effective").select("feature")
    replaced = weight.join(good, F.concat("family", F.lit("_agg")) == F.col("feature")).select("Variable")
    single = of.where("SIGNIFICANT").join(replaced, "Variable", "left_anti").select("Variable")
    chosen = {r[0] for r in single.union(good).collect()}               # names of columns
    return wide.select(*[c for c in wide.columns if c in chosen], target)
