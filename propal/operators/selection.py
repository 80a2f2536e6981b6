"""C17: scores of numeric columns against a class, and the choice of the best.

One scan counts rows by (column, value, class).  Ranks, moments and the joint
histograms of (bin, class) of all columns follow from these counts, so a
further score costs no further scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import numeric_columns
from ..functions.ranking import running_total
from ..session import cut_lineage
from .profile import unpivot, wide_agg

#: Names of scores, as an argument, and their columns.
SCORES = {"f_regression": "F_REGRESSION", "f_classif": "F_CLASSIF", "chi2": "CHI2", "mutual_info_classif": "MUTUAL_INFO"}
METHODS = {"pearson": "PEARSON", "spearman": "SPEARMAN"}


def feature_scores(df: DataFrame, target: str = "TARGET", columns: Sequence[str] | None = None, bins: int = 10,
                   null_free: bool = True) -> DataFrame:
    """One row per column: ``Variable, N`` and

    * ``PEARSON``, ``SPEARMAN`` (Pearson of average ranks) with the target;
    * ``F_REGRESSION`` r^2 / (1 - r^2) * (N - 2);
    * ``F_CLASSIF`` one-way ANOVA F between the classes (any number of them);
    * ``CHI2`` of class sums against those expected; null where a value is negative;
    * ``MUTUAL_INFO`` in nats between the class and ``bins`` bins of equal
      frequency (by average rank, so equal values share a bin).

    Rows without a target are left out; null values of a column are left out
    of its scores, and with ``null_free`` the column too.  A score that is not
    defined (constant column, one class) is null."""
    columns = list(columns or numeric_columns(df, exclude=[target]))
    df = df.where(F.col(target).isNotNull())
    if null_free and columns:
        nulls = wide_agg(df, {c: F.count_if(F.col(c).isNull()) for c in columns})
        columns = [c for c in columns if not nulls[c]]
    if not columns:
        return df.sparkSession.createDataFrame([], "Variable string, N long, " + ", ".join(
            f"{c} double" for c in (*METHODS.values(), *SCORES.values())))
    y = F.col(target).cast("double")
    counts = cut_lineage(unpivot(df, columns, [target], "double").where(F.col("value").isNotNull())
                         .groupBy("Variable", F.col("value").alias("x"), y.alias("y")).agg(F.count("*").alias("n")))
    n, x = F.col("n"), F.col("x")
    whole = counts.groupBy("Variable").agg(F.sum("n").alias("total"), F.min("x").alias("least"),
                                           (F.sum(n * x) / F.sum("n")).alias("mx"), (F.sum(n * F.col("y")) / F.sum("n")).alias("my"))

    # average ranks of values and of classes
    def ranked(by: str, out: str) -> DataFrame:
        totals = counts.groupBy("Variable", by).agg(F.sum("n").alias("of"))
        cum = running_total(totals, ["Variable", by], "of", "upto")
        start = cum.groupBy("Variable").agg(F.min(F.col("upto") - F.col("of")).alias("before"))
        return cum.join(start, "Variable").select(
            "Variable", by, (F.col("upto") - F.col("before") - (F.col("of") - 1) / 2.0).alias(out))
    full = cut_lineage(counts.join(ranked("x", "rx"), ["Variable", "x"]).join(ranked("y", "ry"), ["Variable", "y"])
                       .join(whole, "Variable"))

    def corr(a, b):
        return F.try_divide(F.sum(n * a * b), F.sqrt(F.sum(n * a * a) * F.sum(n * b * b)))
    dx, dy = x - F.col("mx"), F.col("y") - F.col("my")
    middle = (F.col("total") + 1) / 2.0
    both = full.groupBy("Variable").agg(F.first("total").alias("total"), F.first("least").alias("least"), corr(dx, dy).alias("PEARSON"),
                                        corr(F.col("rx") - middle, F.col("ry") - middle).alias("SPEARMAN"))
    # classes: sizes, sums and means; squares within from centred values
    classes = full.groupBy("Variable", "y").agg(F.sum("n").alias("nc"), F.sum(n * x).alias("sc"), F.sum(n * dx).alias("dc"),
                                                F.first("total").alias("total"), F.first("mx").alias("mx"))
    mean = F.col("dc") / F.col("nc")                    # of the class, from the column's mean
    between = classes.select("Variable", "y", mean.alias("mc"))
    within = full.join(between, ["Variable", "y"]).groupBy("Variable").agg(F.sum(n * (dx - F.col("mc")) ** 2).alias("W"))
    expected = F.col("nc") * F.col("mx")
    shares = classes.groupBy("Variable").agg(
        F.count("*").alias("k"), F.sum(F.col("nc") * mean ** 2).alias("B"),
        F.sum(F.try_divide((F.col("sc") - expected) ** 2, expected)).alias("chi2"))
    # joint histogram of (bin, class) of all columns
    place = F.floor(bins * (F.col("rx") - 0.5) / F.col("total")).cast("int")
    cells = full.groupBy("Variable", place.alias("bin"), "y").agg(F.sum("n").alias("c"), F.first("total").alias("total"))
    in_bin, in_class = (F.sum("c").over(Window.partitionBy("Variable", by)) for by in ("bin", "y"))
    info = (cells.withColumn("info", F.col("c") / F.col("total") * F.log(F.col("c") * F.col("total") / (in_bin * in_class)))
            .groupBy("Variable").agg(F.sum("info").alias("MUTUAL_INFO")))
    r = F.col("PEARSON")
    return (both.join(within, "Variable").join(shares, "Variable").join(info, "Variable").select(
        "Variable", F.col("total").alias("N"), "PEARSON", "SPEARMAN",
        (F.try_divide(r * r, 1 - r * r) * (F.col("total") - 2)).alias("F_REGRESSION"),
        F.when(F.col("k") > 1, F.try_divide(F.col("B") / F.try_divide(F.col("k") - 1, F.lit(1)),
                                            F.try_divide(F.col("W"), F.col("total") - F.col("k")))).alias("F_CLASSIF"),
        F.when(F.col("least") >= 0, F.col("chi2")).alias("CHI2"), "MUTUAL_INFO"))


def select_best(df: DataFrame, k: int, score: str = "f_classif", method: str = "spearman", target: str = "TARGET",
                columns: Sequence[str] | None = None, bins: int = 10, null_free: bool = True) -> DataFrame:
    """The ``k`` columns with the best ``score`` (ties by name), with their
    place by ``method`` correlation, descending: ``RANK, Variable, SCORE, CORRELATION``."""
    if score not in SCORES or method not in METHODS:
        raise ValueError(f"score is one of {sorted(SCORES)}, method one of {sorted(METHODS)}")
    scores = feature_scores(df, target, columns, bins, null_free).select(
        "Variable", F.col(SCORES[score]).alias("SCORE"), F.col(METHODS[method]).alias("CORRELATION"))
    best = scores.orderBy(F.col("SCORE").desc_nulls_last(), "Variable").limit(k)
    # a row per chosen column
    rank = F.row_number().over(Window.orderBy(F.col("CORRELATION").desc_nulls_last(), "Variable"))
    return best.select(rank.alias("RANK"), "Variable", "SCORE", "CORRELATION")
