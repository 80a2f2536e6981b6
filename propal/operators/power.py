"""Fitted power transforms (Yeo-Johnson, Box-Cox of x + 1) and their inverses.

Lambda maximises the profile log-likelihood.  One scan counts the values of
all columns; the search then narrows a bracket around each column's best
lambda, all points of all brackets in one aggregate a round.  The
fitted state is a table with a row per column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import numeric_columns
from ..session import cut_lineage
from .profile import unpivot

METHODS = ("yeo-johnson", "box-cox")
#: Distances of the points of a bracket, by round; a bracket has POINTS on each side of its centre.
STEPS, POINTS = (0.5, 0.05, 0.005, 0.0005, 0.0001), 10
DIGITS = 4
STATE = "Variable string, METHOD string, LAMBDA double, MEAN double, STD double, N long, LOGLIK double"


def _powered(base: Column, lam: Column) -> Column:
    """(base^lam - 1) / lam, and its limit at 0."""
    return F.when(lam == 0, F.log(base)).otherwise((F.pow(base, lam) - 1) / lam)


def transformed(x: Column, lam: Column, method: str) -> Column:
    if method == "box-cox":
        return F.when(x > -1, _powered(x + 1, lam))
    return F.when(x >= 0, _powered(x + 1, lam)).otherwise(-_powered(1 - x, 2 - lam))


def restored(t: Column, lam: Column, method: str) -> Column:
    """The value whose transform is ``t``; null outside of the transform's range."""
    def base(t, lam):
        inside = lam * t + 1
        return F.when(lam == 0, F.exp(t)).when(inside > 0, F.pow(inside, 1 / F.nullif(lam, F.lit(0.0))))
    if method == "box-cox":
        return base(t, lam) - 1
    return F.when(t >= 0, base(t, lam) - 1).otherwise(1 - base(-t, 2 - lam))


def fit(df: DataFrame, columns: Sequence[str] | None = None, method: str = "yeo-johnson") -> DataFrame:
    """State table of the columns: ``Variable, METHOD, LAMBDA`` (to 4 digits),
    ``MEAN, STD`` of the transformed values, ``N, LOGLIK``.

    Nulls and values that are not finite are left out.  Box-Cox needs values
    above -1 and raises where a column has others.  A column that does not
    vary keeps lambda 1; one without a value has N 0 and null figures."""
    if method not in METHODS:
        raise ValueError(f"method is one of {METHODS}")
    columns = list(columns or numeric_columns(df))
    spark = df.sparkSession
    x, n = F.col("x"), F.col("n")
    counts = cut_lineage(unpivot(df, columns, value_type="double")
                         .where(F.col("value").isNotNull() & (F.abs("value") < float("inf")))
                         .groupBy("Variable", F.col("value").alias("x")).agg(F.count("*").alias("n")))
    logs = F.signum(x) * F.log1p(F.abs(x)) if method == "yeo-johnson" else F.log(x + 1)
    first = counts.groupBy("Variable").agg(F.sum("n").alias("N"), F.min("x").alias("least"), F.max("x").alias("most"),
                                           (F.sum(n * x) / F.sum("n")).alias("mx"), F.sum(n * logs).alias("logs"))
    facts = {r["Variable"]: r for r in first.collect()}             # a row per column
    if method == "box-cox" and (bad := sorted(c for c, r in facts.items() if r["least"] <= -1)):
        raise ValueError(f"Box-Cox needs values above -1: {bad}")
    centre = {c: (1.0 if r["least"] == r["most"] else 0.0) for c, r in facts.items()}
    found: dict[str, tuple[float, float | None, float | None, float | None]] = {}
    for step in STEPS:
        # a row per column and point of its bracket; sums start from the mean's transform, to keep digits
        points = [(c, round(centre[c] + j * step, DIGITS) + 0.0, r["mx"]) for c, r in facts.items()
                  for j in range(-POINTS, POINTS + 1)]
        bracket = spark.createDataFrame(points, "Variable string, lam double, mx double").withColumn(
            "near", transformed(F.col("mx"), F.col("lam"), method))
        d = transformed(x, F.col("lam"), method) - F.col("near")
        sums = (counts.join(F.broadcast(bracket), "Variable").groupBy("Variable", "lam")
                .agg(F.first("near").alias("near"), F.sum(n * d).alias("s"), F.sum(n * d * d).alias("q")).collect())
        for c, fact in facts.items():
            best = None
            for p in sorted((p for p in sums if p["Variable"] == c), key=lambda p: p["lam"]):
                shift = p["s"] / fact["N"]
                var = p["q"] / fact["N"] - shift * shift
                if 0 < var < float("inf"):
                    loglik = -fact["N"] / 2 * math.log(var) + (p["lam"] - 1) * fact["logs"]
                    if best is None or loglik > best[1]:
                        best = (p["lam"], loglik, p["near"] + shift, var ** 0.5)
            if fact["least"] == fact["most"] or best is None:
                best = (1.0, None, fact["mx"], 0.0)
            found[c], centre[c] = best, best[0]
    rows = []
    for c in columns:
        lam, loglik, mean, std = found.get(c, (None,) * 4)
        rows.append((c, method, lam, mean, std, facts[c]["N"] if c in facts else 0, loglik))
    return spark.createDataFrame(rows, STATE)


def _by_column(state: DataFrame) -> list:
    return [r for r in state.collect() if r["LAMBDA"] is not None]         # a row per column


def transform(df: DataFrame, state: DataFrame, standardize: bool = True) -> DataFrame:
    """``df`` with the columns of the state transformed in place, and with
    ``standardize`` set to mean 0 and deviation 1 (0 where it does not vary).
    Nulls stay null; values that Box-Cox has no value for become null."""
    new = {}
    for r in _by_column(state):
        t = transformed(F.col(r["Variable"]).cast("double"), F.lit(r["LAMBDA"]), r["METHOD"])
        new[r["Variable"]] = (t - r["MEAN"]) / (r["STD"] or 1.0) if standardize else t
    return df.withColumns(new)


def inverse(df: DataFrame, state: DataFrame, standardized: bool = True) -> DataFrame:
    """The values before ``transform``."""
    new = {}
    for r in _by_column(state):
        t = F.col(r["Variable"])
        t = t * (r["STD"] or 1.0) + r["MEAN"] if standardized else t
        new[r["Variable"]] = restored(t, F.lit(r["LAMBDA"]), r["METHOD"])
    return df.withColumns(new)
