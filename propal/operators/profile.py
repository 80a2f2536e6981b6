"""Profiling and cleaning reports (group C).

Wide tables are profiled with ONE aggregate over all columns (chunks of
``CHUNK`` columns) or by unpivoting to ``(Variable, value)`` and grouping —
never a job per column.  Results are report-sized (one row per column or per
category) and are returned as DataFrames.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bins import equal_width_bin, right_closed_bin, unique_edges
from ..functions.columns import NUMERIC_TYPES, numeric_columns, string_columns
from ..functions.exprs import with_totals
from ..functions.ranking import exact_quantiles, quantile_edges

CHUNK = 100

# --- fixed values -------------------------------------------------------------
CONCLUSION_HIGHER = "Maior propensão"
MISSING_LABEL = "Missing"


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))


def _missing(df: DataFrame, c: str) -> Column:
    x = F.col(c)
    if _is_float(df, c):
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return x.isNull()


def family(dt: T.DataType) -> str:
    if isinstance(dt, NUMERIC_TYPES):
        return "numeric"
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "date"
    return "text"


def wide_agg(df: DataFrame, exprs: dict[str, Column], chunk: int = CHUNK) -> dict:
    """Evaluate many scalar aggregates in as few passes as possible (chunks
    of ``chunk`` aggregates per pass) and return them as a dict (one row ->
    driver, bounded by the number of columns / column pairs)."""
    out: dict = {}
    items = list(exprs.items())
    for i in range(0, len(items), chunk):
        part = items[i:i + chunk]
        row = df.agg(*[e.alias(f"_{j}") for j, (_, e) in enumerate(part)]).first()
        for j, (k, _) in enumerate(part):
            out[k] = row[f"_{j}"]
    return out


def unpivot(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), value_type: str = "string",
            var: str = "Variable", val: str = "value") -> DataFrame:
    cols = [F.col(c).cast(value_type).alias(c) for c in columns]
    return df.select(*keep, *cols).unpivot(list(keep), list(columns), var, val)


# ---------------------------------------------------------------- C1 / C2
def missing_report(df: DataFrame, columns: Sequence[str] | None = None, only_missing: bool = True) -> DataFrame:
    """Per column missing count and % (2 dp) and type family; inf and NaN
    count as missing."""
    columns = list(columns or df.columns)
    n = df.count()
    found = wide_agg(df, {c: F.count_if(_missing(df, c)) for c in columns})
    rows = [(c, found[c], n, family(df.schema[c].dataType)) for c in columns]
    out = (df.sparkSession.createDataFrame(rows, "Variable string, Missing long, _n long, Type string")
           .select("Variable", "Missing", F.round(F.col("Missing") * 100.0 / F.col("_n"), 2).alias("Percentage"), "Type"))
    return out.where(F.col("Missing") > 0) if only_missing else out


def drop_high_missing(df: DataFrame, threshold: float = 97.0, strict: bool = True,
                      protect: Sequence[str] = ("TARGET",)) -> DataFrame:
    """Drop columns whose missing % is > threshold (``strict``) or >= it."""
    n = df.count()
    if n == 0:
        return df
    miss = wide_agg(df, {c: F.sum(_missing(df, c).cast("long")) for c in df.columns})
    drop = [c for c, m in miss.items() if c not in protect and
            ((m * 100.0 / n > threshold) if strict else (m * 100.0 / n >= threshold))]
    return df.drop(*drop)


# ---------------------------------------------------------------- C3 - C5
def low_variance(df: DataFrame, threshold: float = 0.01, protect: Sequence[str] = ("TARGET",)) -> DataFrame:
    """Numeric columns with sample variance < threshold."""
    cols = numeric_columns(df, exclude=protect)
    found = wide_agg(df, {c: F.var_samp(F.col(c).cast("double")) for c in cols})
    long = df.sparkSession.createDataFrame(list(found.items()), "Variable string, VARIANCE double")
    return long.where(F.col("VARIANCE") < threshold)


def top_value_share(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per text column: top value (ties -> smallest), its count and share of
    the non-null values.  Unpivot + two distributed aggregations; the top
    value is a ``min(struct(-count, value))`` aggregate, not a per-column
    window."""
    columns = list(columns or string_columns(df))
    u = unpivot(df, columns).where(F.col("value").isNotNull())
    vc = u.groupBy("Variable", "value").agg(F.count("*").alias("_c"))
    per = vc.groupBy("Variable").agg(F.min(F.struct((-F.col("_c")).alias("nc"), F.col("value").alias("v"))).alias("_t"),
                                     F.sum("_c").alias("_nn"))
    return per.select("Variable", F.col("_t.v").alias("TOP_VALUE"), (-F.col("_t.nc")).alias("TOP_COUNT"),
                      (-F.col("_t.nc") / F.col("_nn")).alias("TOP_SHARE"))


def dominant_category(df: DataFrame, threshold: float = 0.95, columns: Sequence[str] | None = None) -> DataFrame:
    """C4: text columns whose top value holds > threshold of non-null rows."""
    t = top_value_share(df, columns)
    return t.withColumn("DOMINANT", F.col("TOP_SHARE") > threshold)


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """nunique == 1 (min == max over non-null values), with and without
    the 'no missing' condition; no count-distinct needed."""
    columns = list(columns or df.columns)
    row = wide_agg(df, {(c, k): e for c in columns for k, e in (
        ("mn", F.min(c).cast("string")), ("mx", F.max(c).cast("string")), ("nm", F.count_if(F.col(c).isNull())))})
    long = df.sparkSession.createDataFrame([(c, row[c, "mn"], row[c, "mx"], row[c, "nm"]) for c in columns],
                                           "Variable string, mn string, mx string, nm long")
    const = F.col("mn").isNotNull() & (F.col("mn") == F.col("mx"))
    return long.select("Variable", F.col("nm").alias("N_MISSING"), const.alias("CONSTANT"),
                       (const & (F.col("nm") == 0)).alias("CONSTANT_NO_MISSING"))


# ---------------------------------------------------------------- C6
def duplicate_report(df: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """Total rows, extra full-row duplicates and duplicated ids."""
    full = df.groupBy(*df.columns).agg(F.count("*").alias("_c"))
    ids = df.groupBy(*id_cols).agg(F.count("*").alias("_c"))
    a = full.agg(F.sum("_c").alias("N_ROWS"), F.sum(F.col("_c") - 1).alias("N_DUP_ROWS"))
    b = ids.agg(F.sum((F.col("_c") > 1).cast("long")).alias("N_DUP_IDS"),
                F.sum(F.col("_c") - 1).alias("N_EXTRA_ID_ROWS"))
    return a.unionByName(b, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in
                                                             ("N_ROWS", "N_DUP_ROWS", "N_DUP_IDS", "N_EXTRA_ID_ROWS")])


def dedup_first(df: DataFrame, id_cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per id along an explicit ``order`` — a
    ``min(struct(order, rest))`` aggregate (map-side combined, so a hot id is
    reduced before the shuffle instead of filling one window task)."""
    rest = [c for c in df.columns if c not in set(id_cols) and c not in set(order)]
    s = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])
    return df.groupBy(*id_cols).agg(F.min(s).alias("_f")).select(*id_cols, *[F.col(f"_f.{c}").alias(c)
                                                                             for c in [*order, *rest]])


# ---------------------------------------------------------------- C7 - C12
def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Value, count, % of rows (2 dp)."""
    n = df.count()
    return (df.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("count"))
            .withColumn("percentage", F.round(F.col("count") * 100.0 / F.lit(n), 2)))


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Count, mean, std, min, 25/50/75 %, max per numeric column (2 dp).
    Quantiles are the distributed exact ones over the unpivoted values."""
    columns = list(columns or numeric_columns(df))
    u = unpivot(df, columns, value_type="double")
    basic = u.groupBy("Variable").agg(F.count("value").alias("count"), F.avg("value").alias("mean"),
                                      F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
                                      F.max("value").alias("max"))
    qs = exact_quantiles(u, "value", [0.25, 0.5, 0.75], by=["Variable"], approx=approx)
    qw = qs.groupBy("Variable").pivot("_i", [0, 1, 2]).agg(F.first("quantile"))
    qw = qw.select("Variable", F.col("0").alias("p25"), F.col("1").alias("p50"), F.col("2").alias("p75"))
    out = basic.join(qw, "Variable", "left")
    return out.select("Variable", "count", *[F.round(c, 2).alias(c) for c in
                                             ("mean", "std", "min", "p25", "p50", "p75", "max")])


def range_check(df: DataFrame, age: str = "QTD_IDADE", tenure: str = "QTD_ANOS_ANTIG_CLIENTE",
                lo: float = 18, hi: float = 80) -> DataFrame:
    """Out-of-range ages, negative tenures, null tenures (one row)."""
    return df.agg(F.sum(((F.col(age) < lo) | (F.col(age) > hi)).cast("long")).alias("N_AGE_OUT_OF_RANGE"),
                  F.sum((F.col(tenure) < 0).cast("long")).alias("N_NEGATIVE_TENURE"),
                  F.sum(F.col(tenure).isNull().cast("long")).alias("N_NULL_TENURE"))


def crosstab_normalized(df: DataFrame, cat: str, target: str = "TARGET") -> DataFrame:
    """Category x target counts normalised by the row total."""
    t = df.groupBy(cat).pivot(target, [0, 1]).count().fillna(0, ["0", "1"])
    tot = F.col("0") + F.col("1")
    return t.select(F.col(cat), (F.col("0") / tot).alias("TARGET_0"), (F.col("1") / tot).alias("TARGET_1"))


def target_group_stats(df: DataFrame, col: str, target: str = "TARGET") -> DataFrame:
    """C11: mean, median and std of ``col`` per target class."""
    base = df.groupBy(target).agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"))
    med = exact_quantiles(df, col, [0.5], by=[target]).select(target, F.col("quantile").alias("median"))
    return base.join(med, target, "left")


def class_balance(df: DataFrame, target: str = "TARGET") -> DataFrame:
    """Class counts and shares plus the imbalance verdict."""
    c = df.groupBy(target).agg(F.count("*").alias("count"))
    w = Window.partitionBy(F.lit(0))     # two rows
    c = c.withColumn("share", F.col("count") / F.sum("count").over(w))
    minority = F.min("share").over(w)
    return c.withColumn("verdict", F.when(minority < 0.05, "severe imbalance")
                        .when(minority < 0.20, "moderate imbalance").otherwise("balanced"))


# ---------------------------------------------------------------- C13
def multivariate_exploration(df: DataFrame, target: str = "TARGET", numeric: Sequence[str] | None = None,
                             categorical: Sequence[str] | None = None) -> DataFrame:
    """Numeric -> mean per class; categorical -> share of each category
    within a class; absolute difference; difference ratio when the
    difference exceeds the base rate; 3 dp."""
    numeric = list(numeric if numeric is not None else numeric_columns(df, exclude=[target]))
    categorical = list(categorical if categorical is not None else string_columns(df, exclude=[target]))
    parts = []
    if numeric:
        u = unpivot(df, numeric, [target], "double")
        m = u.groupBy("Variable").pivot(target, [0, 1]).agg(F.avg("value"))
        parts.append(m.select(F.concat("Variable", F.lit("_mean")).alias("Variable"),
                              F.lit(None).cast("string").alias("Category"),
                              F.col("0").alias("TARGET_0"), F.col("1").alias("TARGET_1")))
    if categorical:
        u = unpivot(df, categorical, [target]).where(F.col("value").isNotNull())
        cnt = u.groupBy("Variable", "value", target).agg(F.count("*").alias("_c"))
        cls = u.groupBy("Variable", target).agg(F.count("*").alias("_n"))
        sh = cnt.join(cls, ["Variable", target]).withColumn("_s", F.col("_c") / F.col("_n"))
        p = sh.groupBy("Variable", "value").pivot(target, [0, 1]).agg(F.first("_s"))
        parts.append(p.select("Variable", F.col("value").alias("Category"),
                              F.coalesce(F.col("0"), F.lit(0.0)).alias("TARGET_0"),
                              F.coalesce(F.col("1"), F.lit(0.0)).alias("TARGET_1")))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    base = df.agg(F.avg(F.col(target).cast("double"))).first()[0]
    t0, t1 = F.round("TARGET_0", 3), F.round("TARGET_1", 3)
    out = out.select("Variable", "Category", t0.alias("TARGET_0"), t1.alias("TARGET_1"))
    d = F.abs(F.col("TARGET_0") - F.col("TARGET_1"))
    out = out.withColumn("Absolute difference", d)
    denom = F.greatest(F.abs("TARGET_0"), F.abs("TARGET_1"), F.col("Absolute difference"))
    return out.withColumn("Difference ratio", F.when(F.col("Absolute difference") > F.lit(base),
                                                     F.round(F.col("Absolute difference") / denom, 3)))


# ---------------------------------------------------------------- C14 - C16
def two_valued_numeric(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Numeric columns with exactly two distinct non-null values (min < max
    and nothing else), found with two scalar passes."""
    if not columns:
        return []
    mm = wide_agg(df, {**{f"{c}|mn": F.min(c) for c in columns}, **{f"{c}|mx": F.max(c) for c in columns}})
    cand = [c for c in columns if mm[f"{c}|mn"] is not None and mm[f"{c}|mn"] != mm[f"{c}|mx"]]
    if not cand:
        return []
    other = wide_agg(df, {c: F.sum((~F.col(c).isin(mm[f"{c}|mn"], mm[f"{c}|mx"])).cast("long")) for c in cand})
    return [c for c in cand if (other[c] or 0) == 0]


def categorical_effectiveness(df: DataFrame, target: str = "TARGET", min_count: int = 0,
                              columns: Sequence[str] | None = None) -> DataFrame:
    """C14: per variable/category (null -> 'Missing'; two-valued numeric
    columns count as categorical): COUNT, # Target 1, effectiveness %,
    % COUNT, % Target 1, verdict; rows with COUNT > min_count."""
    if columns is None:
        num = numeric_columns(df, exclude=[target])
        columns = string_columns(df, exclude=[target]) + two_valued_numeric(df, num)
    columns = list(columns)
    tot = df.agg(F.count("*").alias("_n"), F.sum(target).alias("_t1"), F.avg(F.col(target).cast("double")).alias("_b"))
    u = unpivot(df, columns, [target]).withColumn("value", F.coalesce("value", F.lit(MISSING_LABEL)))
    g = u.groupBy("Variable", F.col("value").alias("Categories")).agg(
        F.count("*").alias("COUNT"), F.sum(target).cast("long").alias("# Target 1"),
        F.avg(F.col(target).cast("double")).alias("_eff"))
    g = with_totals(g, tot)
    eff = F.col("_eff") * 100
    out = g.select("Variable", "Categories", "COUNT", "# Target 1",
                   F.round(eff, 3).alias("Effectiveness (%)"),
                   (F.col("COUNT") * 100.0 / F.col("_n")).alias("% COUNT"),
                   (F.col("# Target 1") * 100.0 / F.col("_t1")).alias("% Target 1"),
                   (F.col("_b") * 100).alias("TARGET_percentage"),
                   F.when(eff > F.col("_b") * 100 + 0.001, F.lit(CONCLUSION_HIGHER)).otherwise(F.lit(""))
                   .alias("Conclusion"))
    return out.where(F.col("COUNT") > min_count)


def decile_edges(df: DataFrame, columns: Sequence[str], q: int = 10, approx: bool = False) -> dict[str, list[float]]:
    """Unique quantile edges per column (all columns in one distributed
    pass over the unpivoted values)."""
    u = unpivot(df, columns, value_type="double")
    e = quantile_edges(u, "value", [i / q for i in range(q + 1)], by=["Variable"], approx=approx)
    return {k[0]: unique_edges(v) for k, v in e.items()}


def _binned_effectiveness(df: DataFrame, edges: dict[str, list[float]], target: str, out_of_range: str,
                          one_bin: dict[str, tuple] | None = None) -> DataFrame:
    one_bin = one_bin or {}
    cols = [c for c in edges if len(edges[c]) >= 2]

    def bin_of(c):
        if c in one_bin:                                   # {mode} vs the other values
            x = F.col(c).cast("double")
            return F.when(x.isNull(), None).when(x == one_bin[c][0], 1).otherwise(2).cast("int")
        return right_closed_bin(c, edges[c], out_of_range)
    binned = df.select(target, *[bin_of(c).alias(c) for c in cols])
    u = unpivot(binned, cols, [target], "int").where(F.col("value").isNotNull())
    tot = df.agg(F.count("*").alias("_n"), F.sum(target).alias("_t1"), F.avg(F.col(target).cast("double")).alias("_b"))
    g = u.groupBy("Variable", F.col("value").alias("BIN")).agg(
        F.count("*").alias("COUNT"), F.sum(target).cast("long").alias("# Target 1"),
        F.avg(F.col(target).cast("double")).alias("_eff"))
    rows = [(c, i + 1, float(edges[c][i]), float(edges[c][i + 1])) for c in cols if c not in one_bin
            for i in range(len(edges[c]) - 1)]
    for c, (m, lo, hi) in one_bin.items():
        rows += [(c, 1, float(m), float(m)), (c, 2, lo, hi)]
    lim = df.sparkSession.createDataFrame(rows, "Variable string, BIN int, `Lower Limit` double, `Upper Limit` double")
    # bin limits: one row per (column, bin) — bounded by columns x bins
    g = with_totals(g.join(F.broadcast(lim), ["Variable", "BIN"], "left"), tot)
    eff = F.round(F.col("_eff") * 100, 2)
    return g.select("Variable", "BIN", "COUNT", "# Target 1", (F.col("COUNT") * 100.0 / F.col("_n")).alias("% COUNT"),
                    (F.col("# Target 1") * 100.0 / F.col("_t1")).alias("% Target 1"),
                    eff.alias("Effectiveness (%)"),
                    F.when(eff > F.col("_b") * 100 + 0.001, F.lit(CONCLUSION_HIGHER)).otherwise(F.lit(""))
                    .alias("Conclusion"), "Lower Limit", "Upper Limit")


def numerical_effectiveness(df: DataFrame, target: str = "TARGET", columns: Sequence[str] | None = None,
                            approx: bool = False) -> DataFrame:
    """Decile bins per numeric column (duplicate edges dropped; null
    rows excluded from bins but kept in the % denominator) with limits."""
    if columns is None:
        num = numeric_columns(df, exclude=[target])
        two = set(two_valued_numeric(df, num))
        columns = [c for c in num if c not in two]
    edges = decile_edges(df, columns, approx=approx)
    # one bin left after dropping duplicate edges: the modal value against
    # the other values (limits: the mode; min and max of the others)
    one = [c for c, e in edges.items() if len(e) == 2]
    one_bin = {}
    if one:
        vc = (unpivot(df, one, value_type="double").where(F.col("value").isNotNull())
              .groupBy("Variable", "value").agg(F.count("*").alias("_c")))
        modes = {r["Variable"]: r["_m"]["v"] for r in vc.groupBy("Variable").agg(
            F.min(F.struct((-F.col("_c")).alias("nc"), F.col("value").alias("v"))).alias("_m")).collect()}
        st = wide_agg(df, {**{f"{c}|lo": F.min(F.when(F.col(c) != modes[c], F.col(c))) for c in one},
                           **{f"{c}|hi": F.max(F.when(F.col(c) != modes[c], F.col(c))) for c in one}})
        one_bin = {c: (modes[c], float(st[f"{c}|lo"]), float(st[f"{c}|hi"])) for c in one}
    return _binned_effectiveness(df, edges, target, "clamp", one_bin)


def fit_effectiveness_bins(train: DataFrame, columns: Sequence[str], q: int = 10) -> dict[str, list[float]]:
    """C16 fit: bin edges from the training rows (small state)."""
    return decile_edges(train, columns, q)


def apply_effectiveness_bins(test: DataFrame, edges: dict[str, list[float]], target: str = "TARGET") -> DataFrame:
    """C16 transform: the saved bins on new rows (outside the fitted range ->
    null, excluded from bins)."""
    return _binned_effectiveness(test, edges, target, "null")


# ---------------------------------------------------------------- C17 - C19
def feature_target_corr(df: DataFrame, target: str = "TARGET", columns: Sequence[str] | None = None,
                        null_free: bool = True, top_k: int | None = None) -> DataFrame:
    """C17: Pearson r, the f_regression F score r^2/(1-r^2)*(n-2), chi2, and
    Spearman rho (Pearson of average ranks) per numeric column.  Ranks come
    from value counts + the distributed running total, not a global window.
    ``null_free`` keeps only columns without nulls (one aggregate decides);
    ``top_k`` keeps the k best F scores (k is compared with the number of
    columns, not rows)."""
    from ..functions.ranking import running_total
    columns = list(columns or numeric_columns(df, exclude=[target]))
    if null_free and columns:
        nulls = wide_agg(df, {c: F.sum(F.col(c).isNull().cast("long")) for c in columns})
        columns = [c for c in columns if not nulls[c]]
    u = unpivot(df, columns, [target], "double").where(F.col("value").isNotNull())
    pear = u.groupBy("Variable").agg(F.corr("value", F.col(target).cast("double")).alias("PEARSON"),
                                     F.count("*").alias("N"))
    # average rank of each distinct value inside its column
    vc = u.groupBy("Variable", "value").agg(F.count("*").alias("_c"))
    cum = running_total(vc, ["Variable", "value"], "_c", "_cum")
    g0 = cum.groupBy("Variable").agg(F.min(F.col("_cum") - F.col("_w")).alias("_g0"))
    ranks = (cum.join(g0, "Variable").select("Variable", "value",
                                             (F.col("_cum") - F.col("_g0") - (F.col("_c") - 1) / 2.0).alias("_r")))
    # ranks of the binary target: average rank of the 0s and of the 1s
    tv = u.groupBy("Variable", target).agg(F.count("*").alias("_tc"))
    tw = Window.partitionBy("Variable").orderBy(target).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tr = tv.withColumn("_tr", F.sum("_tc").over(tw) - (F.col("_tc") - 1) / 2.0).drop("_tc")   # <= 2 rows/col
    # per column: counts by (value, class) carry all that the correlation of
    # the ranks needs, so the rows are not joined again
    both = u.groupBy("Variable", "value", target).agg(F.count("*").alias("_b"))
    x, y, b = F.col("_r") - F.col("_mid"), F.col("_tr") - F.col("_mid"), F.col("_b")
    mid = u.groupBy("Variable").agg(((F.count("*") + 1) / 2.0).alias("_mid"))      # mean rank
    sp = (both.join(ranks, ["Variable", "value"]).join(F.broadcast(tr), ["Variable", target])
          .join(F.broadcast(mid), "Variable").groupBy("Variable")
          .agg(F.try_divide(F.sum(b * x * y), F.sqrt(F.sum(b * x * x) * F.sum(b * y * y))).alias("SPEARMAN")))
    # chi2 score (non-negative features): sum over classes of
    # (class sum - expected class sum)^2 / expected; <= 2 rows per column
    cls = u.groupBy("Variable", target).agg(F.count("*").alias("_nc"), F.sum("value").alias("_sc"))
    tot = cls.groupBy("Variable").agg(F.sum("_nc").alias("_n"), F.sum("_sc").alias("_s"))
    exp = (F.col("_nc") / F.col("_n")) * F.col("_s")
    chi = cls.join(tot, "Variable").groupBy("Variable").agg(
        F.sum(F.try_divide((F.col("_sc") - exp) ** 2, exp)).alias("CHI2"))
    r = F.col("PEARSON")
    out = (pear.join(sp, "Variable", "left").join(chi, "Variable", "left")
           .withColumn("F_SCORE", F.try_divide(r * r, (1 - r * r)) * (F.col("N") - 2)))
    if top_k is not None and top_k < len(columns):
        # one row per column: a window over the report is bounded by #columns
        rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("F_SCORE").desc_nulls_last(),
                                                                        "Variable"))
        out = out.withColumn("_rk", rank).where(F.col("_rk") <= top_k).drop("_rk")
    return out


def point_biserial(df: DataFrame, target: str = "TARGET", columns: Sequence[str] | None = None,
                   alpha: float = 0.05, min_abs: float = 0.0, min_rows: int = 0) -> DataFrame:
    """R with the binary target over pairwise-complete rows, n,
    t = r*sqrt((n-2)/(1-r^2)); r is null below ``min_rows`` complete pairs
    (the reference's pairwise variant uses 50).  The two-sided p-value
    (``add_p_values``) is evaluated per column on the driver with the JVM's
    Student-t distribution (one value per column)."""
    columns = list(columns or numeric_columns(df, exclude=[target]))
    u = unpivot(df, columns, [target], "double").where(F.col("value").isNotNull() & F.col(target).isNotNull())
    g = u.groupBy("Variable").agg(F.corr("value", F.col(target).cast("double")).alias("R"), F.count("*").alias("N"))
    g = g.withColumn("R", F.when(F.col("N") >= min_rows, F.col("R")))
    r = F.col("R")
    return g.withColumn("T_STAT", r * F.sqrt(F.try_divide(F.col("N") - 2, 1 - r * r)))


def add_p_values(stats: DataFrame, alpha: float = 0.05, min_abs: float = 0.0) -> DataFrame:
    """Two-sided p-values for the (one row per column) C18 table."""
    spark = stats.sparkSession
    jvm = spark.sparkContext._jvm
    rows = []
    for r in stats.collect():                       # one row per column
        n, t = r["N"], r["T_STAT"]
        p = None
        if t is not None and n is not None and n > 2:
            dist = jvm.org.apache.commons.math3.distribution.TDistribution(float(n - 2))
            p = 2.0 * (1.0 - dist.cumulativeProbability(abs(float(t))))
        sig = p is not None and p < alpha and abs(r["R"] or 0) >= min_abs
        rows.append((r["Variable"], r["R"], r["N"], t, p, sig))
    return spark.createDataFrame(rows, "Variable string, R double, N long, T_STAT double, P_VALUE double, "
                                       "SIGNIFICANT boolean")


def histogram(df: DataFrame, col: str, bins: int = 10, max_bars: int = 10) -> DataFrame:
    """Bar counts when <= max_bars distinct values, else equal-width
    histogram counts (data only)."""
    st = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    if st["lo"] is None:
        return df.sparkSession.createDataFrame([], "BIN int, LOWER double, UPPER double, COUNT long")
    if df.select(col).where(F.col(col).isNotNull()).distinct().limit(max_bars + 1).count() <= max_bars:
        return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("LOWER"))
                .agg(F.count("*").alias("COUNT"))
                .select(F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy("LOWER")).alias("BIN"),
                        "LOWER", F.col("LOWER").alias("UPPER"), "COUNT"))
    lo, hi = float(st["lo"]), float(st["hi"])
    w = (hi - lo) / bins
    b = equal_width_bin(col, lo, hi, bins)
    return (df.where(F.col(col).isNotNull()).groupBy(b.alias("BIN")).agg(F.count("*").alias("COUNT"))
            .select("BIN", (F.lit(lo) + F.col("BIN") * w).alias("LOWER"), (F.lit(lo) + (F.col("BIN") + 1) * w)
                    .alias("UPPER"), "COUNT"))


# ---------------------------------------------------------------- C20 - C23
#: Words that place a column in a family; a column may be in several.
FAMILY_KEYWORDS = {
    "Demographics": ("IDADE", "SEXO", "CIVIL", "PROF", "HABILITACOES"),
    "Geographic": ("DISTRITO", "CONCELHO", "NUT", "FREGUESIA"),
    "Digital": ("LOGIN", "APP", "DIGITAL", "INTERACT"),
    "Insurance": ("APL", "VIG", "SEGUROS", "APOLICE"),
    "Financial": ("VAL", "CLV", "SCORE", "MARGEM", "PCA"),
}


def column_families(df: DataFrame) -> DataFrame:
    """C20: ``(column, families, prefix_family, N_VALUES)``: the keyword families
    of every column, its ``[A-Z]+_[A-Z]`` stem where at least two columns have
    it, and how many rows have a value."""
    stem = {c: m.group() for c in df.columns if (m := re.match(r"[A-Z]+_[A-Z]", c))}
    shared = Counter(stem.values())
    values = wide_agg(df, {c: F.count(c) for c in df.columns})
    rows = [(c, [f for f, words in FAMILY_KEYWORDS.items() if any(w in c.upper() for w in words)],
             stem.get(c) if shared[stem.get(c)] > 1 else None, values[c]) for c in df.columns]
    return df.sparkSession.createDataFrame(
        rows, "column string, families array<string>, prefix_family string, N_VALUES long")


def dtype_census(df: DataFrame) -> DataFrame:
    """Columns per type family, and the values they hold."""
    values = wide_agg(df, {c: F.count(c) for c in df.columns})
    rows = [(family(f.dataType), values[f.name]) for f in df.schema.fields]
    return (df.sparkSession.createDataFrame(rows, "type string, n long").groupBy("type")
            .agg(F.count("*").cast("int").alias("n_columns"), F.sum("n").alias("n_values")))


def readiness(df: DataFrame, required: Sequence[str], target: str = "TARGET", max_missing_pct: float = 50.0) -> DataFrame:
    """Readiness checklist (target present, required columns present,
    no column above the missing threshold)."""
    spark = df.sparkSession
    worst = missing_report(df, only_missing=False).agg(F.max("Percentage")).first()[0] or 0.0
    rows = [("target present", target in df.columns),
            ("required columns present", all(c in df.columns for c in required)),
            (f"all columns < {max_missing_pct:g}% missing", worst < max_missing_pct)]
    return spark.createDataFrame(rows, "check string, passed boolean")


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """n, mean, population skewness and excess kurtosis per column from raw
    power sums (one pass over the unpivoted values)."""
    u = unpivot(df, columns, value_type="double").where(F.col("value").isNotNull())
    # two passes (mean, then central moments) avoid the cancellation of raw
    # power sums; the means table has one row per column
    means = u.groupBy("Variable").agg(F.avg("value").alias("m"))
    d = F.col("value") - F.col("m")
    s = u.join(F.broadcast(means), "Variable").groupBy("Variable").agg(
        F.count(d).alias("n"), F.first("m").alias("m"), F.avg(d * d).alias("c2"), F.avg(d * d * d).alias("c3"),
        F.avg(d * d * d * d).alias("c4"))
    c2, c3, c4 = F.col("c2"), F.col("c3"), F.col("c4")
    return s.select("Variable", "n", "m", F.try_divide(c3, F.pow(c2, 1.5)).alias("SKEW"),
                    (F.try_divide(c4, c2 * c2) - 3).alias("KURTOSIS"))


def skew_report(df: DataFrame, columns: Sequence[str] | None = None, skew_limit: float = 1.0,
                kurt_limit: float = 3.0) -> DataFrame:
    """Skewness / kurtosis with flags, and the skewness after log1p and
    sqrt for non-negative columns (the power transforms recommended)."""
    columns = list(columns or numeric_columns(df))
    base = moments(df, columns)
    pos = df.select(*[F.when(F.col(c) >= 0, F.log1p(c)).alias(c) for c in columns])
    sq = df.select(*[F.when(F.col(c) >= 0, F.sqrt(c)).alias(c) for c in columns])
    lg = moments(pos, columns).select("Variable", F.col("SKEW").alias("SKEW_LOG1P"))
    sr = moments(sq, columns).select("Variable", F.col("SKEW").alias("SKEW_SQRT"))
    out = base.join(lg, "Variable").join(sr, "Variable")
    return out.select("Variable", "n", F.round("SKEW", 6).alias("SKEW"), F.round("KURTOSIS", 6).alias("KURTOSIS"),
                      F.round("SKEW_LOG1P", 6).alias("SKEW_LOG1P"), F.round("SKEW_SQRT", 6).alias("SKEW_SQRT"),
                      (F.abs(F.round("SKEW", 6)) > skew_limit).alias("HIGH_SKEW"),
                      (F.abs(F.round("KURTOSIS", 6)) > kurt_limit).alias("HIGH_KURTOSIS"))


def box_cox_lambda(df: DataFrame, col: str, grid: Sequence[float] | None = None) -> DataFrame:
    """Box-Cox lambda for x+1 maximising the profile log-likelihood over
    a lambda grid, all grid points in one aggregate pass.  Variances come from
    centred sums; a lambda whose transform overflows or does not vary is no
    candidate."""
    grid = list(grid or [round(-2 + 0.1 * i, 1) for i in range(41)])
    y = F.col(col).cast("double") + 1
    d = df.where(F.col(col).isNotNull() & (F.col(col) > -1))
    aggs = [F.count(y).alias("n"), F.sum(F.log(y)).alias("sl")]
    for i, lam in enumerate(grid):
        t = F.log(y) if lam == 0 else (F.pow(y, lam) - 1) / lam
        aggs.append(F.var_pop(t).alias(f"v{i}"))
    row = d.agg(*aggs)
    cands = []
    for i, lam in enumerate(grid):
        var = F.col(f"v{i}")
        ll = -F.col("n") / 2 * F.log(var) + (lam - 1) * F.col("sl")
        cands.append(F.when((var > 0) & (var < float("inf")), F.struct(ll.alias("ll"), F.lit(lam).alias("lam"))))
    best = F.array_max(F.array(*cands))   # greatest log-likelihood; nulls are skipped
    return row.select(F.lit(col).alias("Variable"), best["lam"].alias("LAMBDA"), best["ll"].alias("LOGLIK"))


def nonzero_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Customers with a value > 0 and their % per product column."""
    n, found = df.count(), wide_agg(df, {c: F.count_if(F.col(c) > 0) for c in columns})
    long = df.sparkSession.createDataFrame([(c, found[c], n) for c in columns],
                                           "Variable string, N_POSITIVE long, _n long")
    return long.select("Variable", "N_POSITIVE", F.round(F.col("N_POSITIVE") * 100.0 / F.col("_n"), 2).alias("PCT"))
