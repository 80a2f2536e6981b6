"""Ranking, lift and monitoring reports (group F) plus AUC / calibration
(E11, E12, E16).

Only report-sized data (<= 100 rows per month) ever meets a window without
``partitionBy``; everything per customer is ranked with the distributed
running count of ``functions.ranking``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bins import left_closed_digitize, right_closed_bin, unique_edges
from ..functions.exprs import with_totals
from ..functions.ranking import quantile_edges, running_total
from ..session import stored
from .panel import past_months, row_number_within

# --- fixed values -------------------------------------------------------------
REPORT_COLUMNS = ("ANO_MES", "MODEL_TYPE", "MODEL_VERSION", "MODEL_LOB", "PERCENTILE", "CAPTURED",
                  "ACCUM_CAPTURED", "TOTAL_EVENTS", "TOTAL_CUSTOMER_SCORED", "LIFT", "CUMULATIVE_LIFT",
                  "CONV_RATE_PERCENTILE", "CUMULATIVE_RESPONSE")
SUMMARY_COLUMNS = ("ANO_MES", "MODEL_TYPE", "MODEL_VERSION", "MODEL_LOB", "REVIEW_PERIODICITY", "PERCENTILE",
                   "CAPTURED", "ACCUM_CAPTURED", "TOTAL_EVENTS", "TOTAL_CUSTOMER_SCORED", "AVG_CUSTOMER_SCORED",
                   "LIFT", "AVG_LIFTS", "CUMULATIVE_LIFT", "CUMULATIVE_LIFT_TRANSF", "CONV_RATE_PERCENTILE",
                   "CONV_RATE", "POLINOMIAL_FUNCTION", "LOGARITHMIC_FUNCTION", "CONV_RATE_PERC_SMOOTHED",
                   "Leads_lights")
# lead-light thresholds: periodicity -> (green lift, yellow lift)
LIGHT_THRESHOLDS = {"semestral": (1.5, 1.0), "anual": (2.0, 1.0)}
PERCENTIL_YELLOW, PERCENTIL_RED = 25, 35
HISTORY_MONTHS = {"semestral": 5, "anual": 11}


def _small_window(order: str, by: Sequence[str] = ()) -> Window:
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return w.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _bin_table(df: DataFrame, score: str, target: str, bin_col: str, bins: DataFrame | None,
               label: str, base_rate: Column) -> DataFrame:
    t = F.col(target)
    crt = df.groupBy(bin_col).agg(F.sum((t == 0).cast("long")).alias("Target 0"),
                                  F.sum((t == 1).cast("long")).alias("Target 1"))
    w = _small_window(bin_col)   # <= 100 report rows
    tot1 = F.sum("Target 1").over(Window.partitionBy(F.lit(0)))
    out = (crt.withColumn("_c1", F.sum("Target 1").over(w))
           .withColumn("_cn", F.sum(F.col("Target 0") + F.col("Target 1")).over(w))
           .withColumn("Cumulative rate (%)", F.round(F.col("_c1") * 100 / tot1, 1))
           .withColumn("Cumulative Lift", F.round(F.col("_c1") / F.col("_cn") / base_rate, 2)))
    if bins is not None:
        out = out.join(F.broadcast(bins), bin_col, "left")
    else:
        out = out.withColumns({"Minimum": F.lit(None).cast("double"), "Maximum": F.lit(None).cast("double")})
    return out.select(F.col(bin_col).alias(label), "Minimum", "Maximum", "Target 0", "Target 1",
                      "Cumulative rate (%)", "Cumulative Lift")


def _edge_dim(spark, bin_col: str, edges: list[float]) -> DataFrame:
    rows = [(i + 1, round(edges[i], 3), round(edges[i + 1], 3)) for i in range(len(edges) - 1)]
    return spark.createDataFrame(rows, f"`{bin_col}` int, Minimum double, Maximum double")


def decile_report(df: DataFrame, score: str = "PR_0", target: str = "TARGET", n_bins: int = 10,
                  approx: bool = False) -> DataFrame:
    """F1: score = P(class 0) ascending, so decile 1 holds the best customers.
    Quantile bins (duplicate edges dropped), Target 0/1 counts, cumulative
    rate (% of all positives) and cumulative lift."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    edges = unique_edges(quantile_edges(df, score, probs, approx=approx).get((), []))
    scored = df.select(right_closed_bin(score, edges).alias("_bin"), target)
    base = df.agg(F.avg(F.col(target).cast("double"))).first()[0]
    return _bin_table(scored, score, target, "_bin", _edge_dim(df.sparkSession, "_bin", edges), "Decile",
                      F.lit(base))


def percentile_report(df: DataFrame, score: str = "PR_0", target: str = "TARGET",
                      approx: bool = False) -> DataFrame:
    """100 quantile bins; when edges collide, the fallback of 100 points
    on [0, 100] with left-closed ``digitize`` and the max + 1e-6 closing
    edge, Minimum/Maximum given by position."""
    probs = [i / 100 for i in range(101)]
    raw = quantile_edges(df, score, probs, approx=approx).get((), [])
    spark = df.sparkSession
    base = df.agg(F.avg(F.col(target).cast("double")), F.max(score)).first()
    if len(set(raw)) == len(raw):
        scored = df.select(right_closed_bin(score, raw).alias("_bin"), target)
        return _bin_table(scored, score, target, "_bin", _edge_dim(spark, "_bin", raw), "Percentile",
                          F.lit(base[0]))
    fb_probs = [i / 99 for i in range(100)]
    ranges = quantile_edges(df, score, fb_probs, approx=approx).get((), [])
    scored = df.select(left_closed_digitize(score, ranges).alias("_bin"), target)
    closing = sorted(set(ranges) | {float(base[1]) + 0.000001})
    t = _bin_table(scored, score, target, "_bin", None, "Percentile", F.lit(base[0]))
    # edges by position of the present percentiles (<= 100 rows)
    pos = t.withColumn("_pos", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("Percentile")))
    dim = spark.createDataFrame([(i + 1, round(closing[i], 3), round(closing[i + 1], 3))
                                 for i in range(len(closing) - 1)], "_pos int, Minimum double, Maximum double")
    return (pos.drop("Minimum", "Maximum").join(F.broadcast(dim), "_pos", "left")
            .select("Percentile", "Minimum", "Maximum", "Target 0", "Target 1", "Cumulative rate (%)",
                    "Cumulative Lift"))


def score_percentile(scores: DataFrame, prob: str = "EM_EVENTPROBABILITY", id_col: str = "ID",
                     by: Sequence[str] = ("ANO_MES",)) -> DataFrame:
    """per month, rank by P(1) descending (ties by id); PERCENTILE =
    qcut(row, 100)+1 in closed form, 1 = best."""
    ranked = row_number_within(scores, list(by), [F.col(prob).desc(), F.col(id_col).asc()], "_i")
    n = scores.groupBy(*by).agg(F.count("*").alias("_n"))      # one row per month, from plain counts
    pct = F.when(F.col("_n") == 1, F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.ceil((F.col("_i") - 1) * 100 / (F.col("_n") - 1)))).cast("int")
    return ranked.join(F.broadcast(n), list(by)).withColumn("PERCENTILE", pct).drop("_i", "_n")


def score_history(scores: DataFrame, month: int, periodicity: str = "semestral") -> DataFrame:
    """scores of the current and n previous months (absent months simply
    have no rows)."""
    months = past_months(month, HISTORY_MONTHS[periodicity])
    return scores.where(F.col("ANO_MES").isin(months))


def match_purchases(scored: DataFrame, purchases: DataFrame, keys: Sequence[str] = ("ANO_MES", "ID"),
                    columns: Sequence[str] = ("ANO_MES", "ID", "EM_EVENTPROBABILITY", "PERCENTILE")) -> DataFrame:
    """inner join of scores with purchases, projected and de-duplicated."""
    return scored.join(purchases.select(*keys).distinct(), list(keys)).select(*columns).dropDuplicates()


def lift_table(scored: DataFrame, matched: DataFrame, id_col: str = "ID",
               by: Sequence[str] = ("ANO_MES",)) -> DataFrame:
    """per (month, percentile): distinct scored ids, captured buyers,
    running captured, total events, LIFT (captured share %), CUMULATIVE_LIFT,
    conversion % and cumulative response %."""
    by = list(by)
    tot = scored.groupBy(*by, "PERCENTILE").agg(F.count_distinct(id_col).alias("TOTAL_CUSTOMER_SCORED"))
    cap = matched.groupBy(*by, "PERCENTILE").agg(F.count(id_col).alias("CAPTURED"))
    t = (tot.join(cap, [*by, "PERCENTILE"], "left")
         .withColumn("CAPTURED", F.coalesce(F.col("CAPTURED"), F.lit(0)).cast("long")))
    w = _small_window("PERCENTILE", by)
    t = (t.withColumn("ACCUM_CAPTURED", F.sum("CAPTURED").over(w))
         .withColumn("TOTAL_EVENTS", F.sum("CAPTURED").over(Window.partitionBy(*by) if by else
                                                            Window.partitionBy(F.lit(0)))))
    p = F.col("PERCENTILE").cast("double")
    return (t.withColumn("LIFT", F.try_divide(F.col("CAPTURED") * 100.0, F.col("TOTAL_EVENTS")))
            .withColumn("CUMULATIVE_LIFT", F.try_divide(F.col("ACCUM_CAPTURED") * (100.0 / p),
                                                        F.col("TOTAL_EVENTS").cast("double")))
            .withColumn("CONV_RATE_PERCENTILE",
                        F.try_divide(F.col("CAPTURED") * 100.0, F.col("TOTAL_CUSTOMER_SCORED")))
            .withColumn("CUMULATIVE_RESPONSE", F.try_divide(F.col("ACCUM_CAPTURED") * 100.0, F.col("TOTAL_EVENTS")))
            .withColumn("LIFT_RATIO", F.col("CUMULATIVE_LIFT")))


def report_layout(lift: DataFrame, model_type: str, model_version: str, model_lob: str,
                  periodicity: str | None = None) -> DataFrame:
    """stamp model identifiers and fix the column order."""
    out = lift.withColumns({"MODEL_TYPE": F.lit(model_type), "MODEL_VERSION": F.lit(model_version),
                            "MODEL_LOB": F.lit(model_lob)})
    if periodicity is None:
        return out.select(*REPORT_COLUMNS)
    out = out.withColumn("REVIEW_PERIODICITY", F.lit(periodicity))
    return out.select(*[c for c in SUMMARY_COLUMNS if c in out.columns])


def smoothed_conversion(t: DataFrame, y: str = "CONV_RATE", x: str = "PERCENTILE",
                        by: Sequence[str] = ()) -> DataFrame:
    """F8 (our definition of an undefined step): least-squares quadratic
    ``a+b*p+c*p^2`` and logarithmic ``a+b*ln p`` fits of the conversion curve
    over the percentile rows; smoothed = mean of both, floored at 0.  The
    quadratic solves the 3x3 normal equations by Cramer's rule from sums."""
    by = list(by)
    xp = F.col(x).cast("double")
    yy = F.col(y).cast("double")
    s = t.groupBy(*by).agg(
        F.count(yy).alias("_s0"), F.sum(xp).alias("_s1"), F.sum(xp ** 2).alias("_s2"),
        F.sum(xp ** 3).alias("_s3"), F.sum(xp ** 4).alias("_s4"), F.sum(yy).alias("_t0"),
        F.sum(xp * yy).alias("_t1"), F.sum(xp ** 2 * yy).alias("_t2"),
        F.regr_slope(yy, F.log(xp)).alias("_lb"), F.regr_intercept(yy, F.log(xp)).alias("_la"))
    c = {k: F.col("_" + k) for k in ("s0", "s1", "s2", "s3", "s4", "t0", "t1", "t2")}

    def det3(a, b, cc, d, e, f, g, h, i):
        return a * (e * i - f * h) - b * (d * i - f * g) + cc * (d * h - e * g)

    D = det3(c["s0"], c["s1"], c["s2"], c["s1"], c["s2"], c["s3"], c["s2"], c["s3"], c["s4"])
    Da = det3(c["t0"], c["s1"], c["s2"], c["t1"], c["s2"], c["s3"], c["t2"], c["s3"], c["s4"])
    Db = det3(c["s0"], c["t0"], c["s2"], c["s1"], c["t1"], c["s3"], c["s2"], c["t2"], c["s4"])
    Dc = det3(c["s0"], c["s1"], c["t0"], c["s1"], c["s2"], c["t1"], c["s2"], c["s3"], c["t2"])
    coef = s.select(*by, F.try_divide(Da, D).alias("_qa"), F.try_divide(Db, D).alias("_qb"),
                    F.try_divide(Dc, D).alias("_qc"), "_la", "_lb")
    # coefficients: one row per group (months), or one row -> scalar subquery
    j = t.join(F.broadcast(coef), by) if by else with_totals(t, coef)
    poly = F.col("_qa") + F.col("_qb") * xp + F.col("_qc") * xp * xp
    logf = F.col("_la") + F.col("_lb") * F.log(xp)
    return (j.withColumn("POLINOMIAL_FUNCTION", poly).withColumn("LOGARITHMIC_FUNCTION", logf)
            .withColumn("CONV_RATE_PERC_SMOOTHED",
                        F.greatest(F.lit(0.0), (F.col("POLINOMIAL_FUNCTION") + F.col("LOGARITHMIC_FUNCTION")) / 2))
            .drop("_qa", "_qb", "_qc", "_la", "_lb"))


def lead_lights(t: DataFrame, periodicity: str = "semestral", lift_col: str = "CUMULATIVE_LIFT_TRANSF") -> DataFrame:
    """F9 (our definition): green if lift >= G and percentile <= 25; yellow
    if lift >= Y and percentile <= 35; else red."""
    g, y = LIGHT_THRESHOLDS[periodicity]
    lift, p = F.col(lift_col), F.col("PERCENTILE")
    return t.withColumn("Leads_lights", F.when((lift >= g) & (p <= PERCENTIL_YELLOW), "green")
                        .when((lift >= y) & (p <= PERCENTIL_RED), "yellow").otherwise("red"))


def periodic_lift(scored: DataFrame, purchases: DataFrame, month: int, periodicity: str = "semestral",
                  id_col: str = "ID") -> DataFrame:
    """F6 per month over the history window, averaged per percentile
    (AVG_* columns), then smoothed (F8) and lit (F9)."""
    hist = score_history(scored, month, periodicity)
    matched = match_purchases(hist, purchases)
    per_month = lift_table(hist, matched, id_col)
    avg = per_month.groupBy("PERCENTILE").agg(
        F.sum("CAPTURED").alias("CAPTURED"), F.sum("TOTAL_CUSTOMER_SCORED").alias("TOTAL_CUSTOMER_SCORED"),
        F.avg("TOTAL_CUSTOMER_SCORED").alias("AVG_CUSTOMER_SCORED"), F.avg("LIFT").alias("AVG_LIFTS"),
        F.avg("CUMULATIVE_LIFT").alias("CUMULATIVE_LIFT_TRANSF"), F.avg("CONV_RATE_PERCENTILE").alias("CONV_RATE"))
    w = _small_window("PERCENTILE")
    avg = (avg.withColumn("ACCUM_CAPTURED", F.sum("CAPTURED").over(w))
           .withColumn("TOTAL_EVENTS", F.sum("CAPTURED").over(Window.partitionBy(F.lit(0))))
           .withColumn("LIFT", F.try_divide(F.col("CAPTURED") * 100.0, F.col("TOTAL_EVENTS")))
           .withColumn("CUMULATIVE_LIFT", F.try_divide(F.col("ACCUM_CAPTURED") * (100.0 / F.col("PERCENTILE")),
                                                       F.col("TOTAL_EVENTS").cast("double")))
           .withColumn("CONV_RATE_PERCENTILE", F.try_divide(F.col("CAPTURED") * 100.0,
                                                            F.col("TOTAL_CUSTOMER_SCORED")))
           .withColumn("ANO_MES", F.lit(month)))
    return lead_lights(smoothed_conversion(avg), periodicity)


# ------------------------------------------------------------ E11, E12, E16
def calibration_curve(df: DataFrame, prob: str, target: str = "TARGET", n_bins: int = 10) -> DataFrame:
    """Equal-width bins on [0, 1] (edges i/n as ``linspace`` makes
    them): mean predicted, fraction positive, count; plus the Brier score."""
    inner = [i * (1.0 / n_bins) for i in range(1, n_bins)]
    p = F.col(prob).cast("double")
    b = left_closed_digitize(p, inner)
    g = df.groupBy(b.alias("BIN")).agg(F.avg(p).alias("MEAN_PREDICTED"),
                                       F.avg(F.col(target).cast("double")).alias("FRACTION_POSITIVE"),
                                       F.count("*").alias("N"))
    brier = df.agg(F.avg((p - F.col(target)) ** 2).alias("BRIER"))
    return with_totals(g, brier)


def roc_auc(df: DataFrame, score: str, target: str = "TARGET", by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve with ties (average ranks), from counts
    per distinct score: AUC = sum_s n1(s) * (n0(<s) + n0(s)/2) / (n0 * n1).
    The running n0 uses the distributed running total."""
    by = list(by)
    t = F.col(target).cast("int")
    vc = df.groupBy(*by, F.col(score).cast("double").alias("_s")).agg(
        F.sum((t == 0).cast("long")).alias("_n0"), F.sum((t == 1).cast("long")).alias("_n1"))
    cum = running_total(vc, [*by, "_s"], "_n0", "_c0")
    if by:
        start = cum.groupBy(*by).agg(F.min(F.col("_c0") - F.col("_n0")).alias("_g0"))
        cum = cum.join(start, by).withColumn("_c0", F.col("_c0") - F.col("_g0"))
    below = F.col("_c0") - F.col("_n0")
    return cum.groupBy(*by).agg(
        (F.sum(F.col("_n1") * (below + F.col("_n0") / 2.0)) / (F.sum("_n0") * F.sum("_n1"))).alias("AUC"))


def compare_models(scored_a: DataFrame, scored_b: DataFrame, score: str, target: str = "TARGET",
                   version_col: str = "MODEL_VERSION") -> DataFrame:
    """The same test set scored by two model versions, side by side: the
    decile report (F1) of each version with its AUC and Brier score, keyed by
    version and decile.  Each set is stored once, as every figure reads it."""
    parts = []
    for scored in (scored_a, scored_b):
        one = stored(scored.select(version_col, score, target), "compare").withColumn("_p0", 1 - F.col(score))
        metrics = roc_auc(one, score, target, by=[version_col]).join(
            one.groupBy(version_col).agg(F.avg((F.col(score) - F.col(target)) ** 2).alias("BRIER")), version_col)
        parts.append(with_totals(decile_report(one, "_p0", target), metrics))
    return parts[0].unionByName(parts[1])


def model_summary(df: DataFrame, p1: str, target: str = "TARGET") -> DataFrame:
    """AUC, decile-1 cumulative lift and decile-3 cumulative captured %
    as one row."""
    auc = roc_auc(df, p1, target).first()[0]
    dec = decile_report(df.withColumn("_p0", 1 - F.col(p1)), "_p0", target)
    r = {row["Decile"]: row for row in dec.collect()}              # <= 10 rows
    spark = df.sparkSession
    return spark.createDataFrame(
        [(float(auc), float(r[1]["Cumulative Lift"]) if 1 in r else None,
          float(r[3]["Cumulative rate (%)"]) if 3 in r else None)],
        "AUC_TRAIN double, LIFT_DECILE_1 double, CAPTURED_DECILE_3 double")
