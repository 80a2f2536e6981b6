"""Queries F1-F11, E11, E12, E16: lift, percentile and monitoring reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reports as R
from ..session import scratch_path, stored
from .catalog import query

P10 = "[" + ", ".join(repr(i / 10) for i in range(11)) + "]"
P100 = "[" + ", ".join(repr(i / 100) for i in range(101)) + "]"


def _bin_report_sql(src: str, score: str, label: str, probs: str) -> str:
    return f"""
WITH s AS (SELECT {score} AS x, TARGET FROM {src}),
e AS (SELECT list_sort(list_distinct(quantile_cont(x, {probs}))) AS edges FROM s),
b AS (SELECT greatest(1, least(len(edges) - 1, len(list_filter(edges, lambda v: v < x)))) AS bin, TARGET, edges
      FROM s CROSS JOIN e),
crt AS (SELECT bin, sum(CASE WHEN TARGET = 0 THEN 1 ELSE 0 END) AS t0,
               sum(CASE WHEN TARGET = 1 THEN 1 ELSE 0 END) AS t1, any_value(edges) AS edges
        FROM b GROUP BY bin)
SELECT CAST(bin AS INTEGER) AS "{label}", round(edges[bin], 3) AS Minimum, round(edges[bin + 1], 3) AS Maximum,
       CAST(t0 AS BIGINT) AS "Target 0", CAST(t1 AS BIGINT) AS "Target 1",
       round(sum(t1) OVER (ORDER BY bin) * 100 / sum(t1) OVER (), 1) AS "Cumulative rate (%)",
       round(sum(t1) OVER (ORDER BY bin) / sum(t0 + t1) OVER (ORDER BY bin) / (SELECT avg(TARGET) FROM s), 2)
         AS "Cumulative Lift"
FROM crt"""


@query("F1_decile_report", _bin_report_sql("line_scored", "PR_0", "Decile", P10))
def f1(fx):
    """Decile report of P(class 0) against the line target."""
    return R.decile_report(fx.line_scored, "PR_0", "TARGET")


@query("F1_decile_report_ties", _bin_report_sql("line_scored", "round(l_discount * 10, 0)", "Decile", P10))
def f1_ties(fx):
    """Decile report on a heavily tied score (duplicate edges dropped)."""
    df = fx.line_scored.withColumn("_s", F.round(F.col("l_discount") * 10, 0))
    return R.decile_report(df, "_s", "TARGET")


@query("F2_percentile_report", _bin_report_sql("line_scored", "PR_0", "Percentile", P100))
def f2(fx):
    """Percentile report (100 quantile bins) of P(class 0)."""
    return R.percentile_report(fx.line_scored, "PR_0", "TARGET")


_F3_SQL = """
SELECT ANO_MES, ID, MODEL_TYPE, MODEL_VERSION, MODEL_LOB, EM_EVENTPROBABILITY,
       CAST(CASE WHEN n = 1 THEN 1 ELSE greatest(1, ceil((i - 1) * 100 / (n - 1))) END AS INTEGER) AS PERCENTILE
FROM (SELECT *, row_number() OVER (PARTITION BY ANO_MES ORDER BY EM_EVENTPROBABILITY DESC, ID) AS i,
             count(*) OVER (PARTITION BY ANO_MES) AS n FROM scores)"""


@query("F3_score_percentile", _F3_SQL)
def f3(fx):
    """Monthly percentile of P(1), 1 = best, ties broken by id."""
    return R.score_percentile(fx.scores)


@query("F4_score_history", "SELECT * FROM scores WHERE ANO_MES > (SELECT M6 FROM last_month)")
def f4(fx):
    """Scores of the last month and the five previous ones."""
    return R.score_history(fx.scores, fx.span[1], "semestral")


_F5_SQL = f"""
SELECT DISTINCT s.ANO_MES, s.ID, s.EM_EVENTPROBABILITY, s.PERCENTILE
FROM ({_F3_SQL}) s JOIN (SELECT DISTINCT ANO_MES, ID FROM purchases) p ON s.ANO_MES = p.ANO_MES AND s.ID = p.ID"""


@query("F5_match_purchases", _F5_SQL)
def f5(fx):
    """Scored customers who bought in the scored month."""
    return R.match_purchases(R.score_percentile(fx.scores), fx.purchases)


_F6_CORE = f"""
WITH sc AS ({_F3_SQL}),
m AS (SELECT DISTINCT s.ANO_MES, s.ID, s.EM_EVENTPROBABILITY, s.PERCENTILE
      FROM sc s JOIN (SELECT DISTINCT ANO_MES, ID FROM purchases) p ON s.ANO_MES = p.ANO_MES AND s.ID = p.ID),
tot AS (SELECT ANO_MES, PERCENTILE, count(DISTINCT ID) AS TOTAL_CUSTOMER_SCORED FROM sc GROUP BY ALL),
cap AS (SELECT ANO_MES, PERCENTILE, count(ID) AS CAPTURED FROM m GROUP BY ALL),
t AS (SELECT tot.ANO_MES, tot.PERCENTILE, tot.TOTAL_CUSTOMER_SCORED, CAST(coalesce(CAPTURED, 0) AS BIGINT) AS CAPTURED
      FROM tot LEFT JOIN cap USING (ANO_MES, PERCENTILE)),
t2 AS (SELECT *, CAST(sum(CAPTURED) OVER (PARTITION BY ANO_MES ORDER BY PERCENTILE) AS BIGINT) AS ACCUM_CAPTURED,
              CAST(sum(CAPTURED) OVER (PARTITION BY ANO_MES) AS BIGINT) AS TOTAL_EVENTS FROM t),
lift AS (
SELECT ANO_MES, PERCENTILE, TOTAL_CUSTOMER_SCORED, CAPTURED, ACCUM_CAPTURED, TOTAL_EVENTS,
       CAPTURED * 100.0 / nullif(TOTAL_EVENTS, 0) AS LIFT,
       ACCUM_CAPTURED * (100.0 / PERCENTILE) / nullif(CAST(TOTAL_EVENTS AS DOUBLE), 0) AS CUMULATIVE_LIFT,
       CAPTURED * 100.0 / nullif(TOTAL_CUSTOMER_SCORED, 0) AS CONV_RATE_PERCENTILE,
       ACCUM_CAPTURED * 100.0 / nullif(TOTAL_EVENTS, 0) AS CUMULATIVE_RESPONSE
FROM t2)"""


def _lift(fx):
    sc = R.score_percentile(fx.scores)
    return R.lift_table(sc, R.match_purchases(sc, fx.purchases))


_ROUND6 = ("ANO_MES", "PERCENTILE", "TOTAL_CUSTOMER_SCORED", "CAPTURED", "ACCUM_CAPTURED", "TOTAL_EVENTS")


def _r6(cols):
    return [F.round(c, 6).alias(c) for c in cols]


@query("F6_lift_table", _F6_CORE + """
SELECT ANO_MES, PERCENTILE, TOTAL_CUSTOMER_SCORED, CAPTURED, ACCUM_CAPTURED, TOTAL_EVENTS,
       round(LIFT, 6) AS LIFT, round(CUMULATIVE_LIFT, 6) AS CUMULATIVE_LIFT,
       round(CONV_RATE_PERCENTILE, 6) AS CONV_RATE_PERCENTILE, round(CUMULATIVE_RESPONSE, 6) AS CUMULATIVE_RESPONSE
FROM lift""")
def f6(fx):
    """Monthly lift / capture / conversion table by percentile."""
    t = _lift(fx)
    return t.select(*_ROUND6, *_r6(["LIFT", "CUMULATIVE_LIFT", "CONV_RATE_PERCENTILE", "CUMULATIVE_RESPONSE"]))


@query("F7_report_layout", _F6_CORE + """
SELECT ANO_MES, 'CROSS_SELL' AS MODEL_TYPE, 'v1' AS MODEL_VERSION, 'SD' AS MODEL_LOB, PERCENTILE, CAPTURED,
       ACCUM_CAPTURED, TOTAL_EVENTS, TOTAL_CUSTOMER_SCORED, round(LIFT, 6) AS LIFT,
       round(CUMULATIVE_LIFT, 6) AS CUMULATIVE_LIFT, round(CONV_RATE_PERCENTILE, 6) AS CONV_RATE_PERCENTILE,
       round(CUMULATIVE_RESPONSE, 6) AS CUMULATIVE_RESPONSE
FROM lift""")
def f7(fx):
    """Monitoring table stamped with model identifiers in the fixed order."""
    t = _lift(fx)
    t = t.select(*_ROUND6, *_r6(["LIFT", "CUMULATIVE_LIFT", "CONV_RATE_PERCENTILE", "CUMULATIVE_RESPONSE"]))
    return R.report_layout(t, "CROSS_SELL", "v1", "SD")


_F10_SQL = _F6_CORE.replace("FROM scores)", "FROM scores WHERE ANO_MES > (SELECT M6 FROM last_month))") + """,
avg AS (SELECT PERCENTILE, CAST(sum(CAPTURED) AS BIGINT) AS CAPTURED,
               CAST(sum(TOTAL_CUSTOMER_SCORED) AS BIGINT) AS TOTAL_CUSTOMER_SCORED,
               avg(TOTAL_CUSTOMER_SCORED) AS AVG_CUSTOMER_SCORED, avg(LIFT) AS AVG_LIFTS,
               avg(CUMULATIVE_LIFT) AS CUMULATIVE_LIFT_TRANSF, avg(CONV_RATE_PERCENTILE) AS CONV_RATE
        FROM lift GROUP BY PERCENTILE),
a2 AS (SELECT *, CAST(sum(CAPTURED) OVER (ORDER BY PERCENTILE) AS BIGINT) AS ACCUM_CAPTURED,
              CAST(sum(CAPTURED) OVER () AS BIGINT) AS TOTAL_EVENTS FROM avg),
a3 AS (SELECT *, CAPTURED * 100.0 / nullif(TOTAL_EVENTS, 0) AS LIFT,
              ACCUM_CAPTURED * (100.0 / PERCENTILE) / nullif(CAST(TOTAL_EVENTS AS DOUBLE), 0) AS CUMULATIVE_LIFT,
              CAPTURED * 100.0 / nullif(TOTAL_CUSTOMER_SCORED, 0) AS CONV_RATE_PERCENTILE FROM a2),
sums AS (SELECT count(CONV_RATE) AS s0, sum(CAST(PERCENTILE AS DOUBLE)) AS s1, sum(pow(PERCENTILE, 2)) AS s2,
                sum(pow(PERCENTILE, 3)) AS s3, sum(pow(PERCENTILE, 4)) AS s4, sum(CONV_RATE) AS t0,
                sum(PERCENTILE * CONV_RATE) AS t1, sum(pow(PERCENTILE, 2) * CONV_RATE) AS t2,
                regr_slope(CONV_RATE, ln(PERCENTILE)) AS lb, regr_intercept(CONV_RATE, ln(PERCENTILE)) AS la
         FROM a3),
det AS (SELECT *,
   s0*(s2*s4-s3*s3) - s1*(s1*s4-s3*s2) + s2*(s1*s3-s2*s2) AS D,
   t0*(s2*s4-s3*s3) - s1*(t1*s4-s3*t2) + s2*(t1*s3-s2*t2) AS Da,
   s0*(t1*s4-s3*t2) - t0*(s1*s4-s3*s2) + s2*(s1*t2-t1*s2) AS Db,
   s0*(s2*t2-t1*s3) - s1*(s1*t2-t1*s2) + t0*(s1*s3-s2*s2) AS Dc FROM sums),
fit AS (SELECT a3.*, Da / D + Db / D * PERCENTILE + Dc / D * PERCENTILE * PERCENTILE AS POLINOMIAL_FUNCTION,
               la + lb * ln(PERCENTILE) AS LOGARITHMIC_FUNCTION FROM a3, det)
SELECT CAST((SELECT M FROM last_month) AS INTEGER) AS ANO_MES, PERCENTILE, CAPTURED, ACCUM_CAPTURED, TOTAL_EVENTS, TOTAL_CUSTOMER_SCORED,
       round(AVG_CUSTOMER_SCORED, 6) AS AVG_CUSTOMER_SCORED, round(LIFT, 6) AS LIFT, round(AVG_LIFTS, 6) AS AVG_LIFTS,
       round(CUMULATIVE_LIFT, 6) AS CUMULATIVE_LIFT, round(CUMULATIVE_LIFT_TRANSF, 6) AS CUMULATIVE_LIFT_TRANSF,
       round(CONV_RATE_PERCENTILE, 6) AS CONV_RATE_PERCENTILE, round(CONV_RATE, 6) AS CONV_RATE,
       round(POLINOMIAL_FUNCTION, 4) AS POLINOMIAL_FUNCTION, round(LOGARITHMIC_FUNCTION, 4) AS LOGARITHMIC_FUNCTION,
       round(greatest(0.0, (POLINOMIAL_FUNCTION + LOGARITHMIC_FUNCTION) / 2), 4) AS CONV_RATE_PERC_SMOOTHED,
       CASE WHEN CUMULATIVE_LIFT_TRANSF >= 1.5 AND PERCENTILE <= 25 THEN 'green'
            WHEN CUMULATIVE_LIFT_TRANSF >= 1.0 AND PERCENTILE <= 35 THEN 'yellow' ELSE 'red' END AS Leads_lights
FROM fit"""


@query("F10_periodic_lift", _F10_SQL)
def f10(fx):
    """Six-month averaged lift by percentile with smoothed conversion (F8)
    and lead lights (F9)."""
    sc = R.score_percentile(fx.scores)
    t = R.periodic_lift(sc, fx.purchases, fx.span[1], "semestral")
    return t.select("ANO_MES", "PERCENTILE", "CAPTURED", "ACCUM_CAPTURED", "TOTAL_EVENTS", "TOTAL_CUSTOMER_SCORED",
                    *_r6(["AVG_CUSTOMER_SCORED", "LIFT", "AVG_LIFTS", "CUMULATIVE_LIFT", "CUMULATIVE_LIFT_TRANSF",
                          "CONV_RATE_PERCENTILE", "CONV_RATE"]),
                    *[F.round(c, 4).alias(c) for c in ("POLINOMIAL_FUNCTION", "LOGARITHMIC_FUNCTION",
                                                        "CONV_RATE_PERC_SMOOTHED")],
                    "Leads_lights")


_AUC_SQL = """
WITH vc AS (SELECT {by_sel} CAST({score} AS DOUBLE) AS s, sum(CASE WHEN {t} = 0 THEN 1 ELSE 0 END) AS n0,
                   sum(CASE WHEN {t} = 1 THEN 1 ELSE 0 END) AS n1 FROM {src} GROUP BY ALL),
c AS (SELECT *, sum(n0) OVER ({part} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n0 AS below
      FROM vc)
SELECT {by_sel} round(sum(n1 * (below + n0 / 2.0)) / (sum(n0) * sum(n1)), 10) AS AUC FROM c {group}"""


def _auc_sql(src, score, t="TARGET", by=None):
    return _AUC_SQL.format(src=src, score=score, t=t, by_sel=f"{by}," if by else "",
                           part=f"PARTITION BY {by}" if by else "", group=f"GROUP BY {by}" if by else "")


@query("E12_roc_auc", _auc_sql("line_scored", "PR_1"))
def e12(fx):
    """ROC AUC of the line score (ties by average rank)."""
    return R.roc_auc(fx.line_scored, "PR_1").select(F.round("AUC", 10).alias("AUC"))


@query("E12_roc_auc_by_month", _auc_sql("scored_universe", "EM_EVENTPROBABILITY", by="ANO_MES"))
def e12m(fx):
    """AUC of the customer score against purchases, per month."""
    return R.roc_auc(fx.scored_universe, "EM_EVENTPROBABILITY", by=["ANO_MES"]).select(
        "ANO_MES", F.round("AUC", 10).alias("AUC"))


_E16_SRC = {v: f"(SELECT s.*, u.TARGET FROM {t} s JOIN (SELECT ANO_MES, ID, TARGET FROM scored_universe) u USING (ANO_MES, ID))"
            for v, t in (("v1", "scores"), ("v2", "scores_v2"))}


@query("E16_compare_models", "\nUNION ALL\n".join(
    f"""SELECT r.*, a.AUC, (SELECT round(avg(pow(EM_EVENTPROBABILITY - TARGET, 2)), 8) FROM {src}) AS BRIER, '{v}' AS MODEL_VERSION
FROM ({_bin_report_sql(src, '1 - EM_EVENTPROBABILITY', 'Decile', P10)}) r, ({_auc_sql(src, 'EM_EVENTPROBABILITY')}) a"""
    for v, src in _E16_SRC.items()))
def e16(fx):
    """Two model versions scored on the same labelled set: decile reports, AUC
    and Brier score side by side."""
    # by month and customer: far more rows than Spark's estimate, so no broadcast
    lab = fx.scored_universe.select("ANO_MES", "ID", "TARGET").hint("merge")
    a = fx.scores.join(lab, ["ANO_MES", "ID"])
    b = fx.scores_v2.join(lab, ["ANO_MES", "ID"])
    return R.compare_models(a, b, "EM_EVENTPROBABILITY").withColumns(
        {"AUC": F.round("AUC", 10), "BRIER": F.round("BRIER", 8)})


_E11_SQL = """
SELECT CAST(""" + " + ".join(f"CASE WHEN PR_1 >= {i * (1.0 / 10)!r} THEN 1 ELSE 0 END" for i in range(1, 10)) + """
       AS INTEGER) AS BIN,
       round(avg(PR_1), 8) AS MEAN_PREDICTED, round(avg(CAST(TARGET AS DOUBLE)), 8) AS FRACTION_POSITIVE,
       count(*) AS N, (SELECT round(avg(pow(PR_1 - TARGET, 2)), 8) FROM line_scored) AS BRIER
FROM line_scored GROUP BY 1"""


@query("E11_calibration_curve", _E11_SQL)
def e11(fx):
    """Reliability curve (10 equal-width bins) and Brier score."""
    t = R.calibration_curve(fx.line_scored, "PR_1")
    return t.select("BIN", *[F.round(c, 8).alias(c) for c in ("MEAN_PREDICTED", "FRACTION_POSITIVE")], "N",
                    F.round("BRIER", 8).alias("BRIER"))


@query("F6_lift_table_streaming", _F6_CORE + """
SELECT ANO_MES, PERCENTILE, TOTAL_CUSTOMER_SCORED, CAPTURED, ACCUM_CAPTURED, TOTAL_EVENTS,
       round(LIFT, 6) AS LIFT, round(CUMULATIVE_LIFT, 6) AS CUMULATIVE_LIFT,
       round(CONV_RATE_PERCENTILE, 6) AS CONV_RATE_PERCENTILE, round(CUMULATIVE_RESPONSE, 6) AS CUMULATIVE_RESPONSE
FROM lift""")
def f6s(fx):
    """The monthly lift table produced by the incremental (file-stream,
    availableNow) monitoring job over month-partitioned scores."""
    from ..streaming.monthly import monitor_months
    spark = fx.spark
    src, out, ck = (scratch_path(spark, n) for n in ("scores", "monitoring", "stream-ckpt"))
    # dealt by month and customer: the panel of one file of customers is not one task's sort
    fx.scores.repartitionByRange("ANO_MES", "ID").write.partitionBy("ANO_MES").parquet(src)
    monitor_months(spark, src, fx.purchases, out, ck)
    t = spark.read.parquet(out).withColumn("ANO_MES", F.col("ANO_MES").cast("int"))
    return t.select(*_ROUND6, *_r6(["LIFT", "CUMULATIVE_LIFT", "CONV_RATE_PERCENTILE", "CUMULATIVE_RESPONSE"]))


_F8_SQL = _F6_CORE + """,
sums AS (SELECT ANO_MES, count(y) AS s0, sum(CAST(PERCENTILE AS DOUBLE)) AS s1, sum(pow(PERCENTILE, 2)) AS s2,
                sum(pow(PERCENTILE, 3)) AS s3, sum(pow(PERCENTILE, 4)) AS s4, sum(y) AS t0,
                sum(PERCENTILE * y) AS t1, sum(pow(PERCENTILE, 2) * y) AS t2,
                regr_slope(y, ln(PERCENTILE)) AS lb, regr_intercept(y, ln(PERCENTILE)) AS la
         FROM (SELECT *, CONV_RATE_PERCENTILE AS y FROM lift) GROUP BY ANO_MES),
det AS (SELECT *,
   s0*(s2*s4-s3*s3) - s1*(s1*s4-s3*s2) + s2*(s1*s3-s2*s2) AS D,
   t0*(s2*s4-s3*s3) - s1*(t1*s4-s3*t2) + s2*(t1*s3-s2*t2) AS Da,
   s0*(t1*s4-s3*t2) - t0*(s1*s4-s3*s2) + s2*(s1*t2-t1*s2) AS Db,
   s0*(s2*t2-t1*s3) - s1*(s1*t2-t1*s2) + t0*(s1*s3-s2*s2) AS Dc FROM sums),
fit AS (SELECT l.ANO_MES, l.PERCENTILE, Da / D + Db / D * l.PERCENTILE + Dc / D * l.PERCENTILE * l.PERCENTILE AS p,
               la + lb * ln(l.PERCENTILE) AS g FROM lift l JOIN det USING (ANO_MES))
SELECT ANO_MES, PERCENTILE, round(p, 4) AS POLINOMIAL_FUNCTION, round(g, 4) AS LOGARITHMIC_FUNCTION,
       round(greatest(0.0, (p + g) / 2), 4) AS CONV_RATE_PERC_SMOOTHED FROM fit"""


@query("F8_smoothed_conversion", _F8_SQL)
def f8(fx):
    """Quadratic and logarithmic least-squares smoothing of each month's
    conversion-by-percentile curve."""
    t = _lift(fx).withColumn("CONV_RATE", F.col("CONV_RATE_PERCENTILE"))
    s = R.smoothed_conversion(t, by=["ANO_MES"])
    return s.select("ANO_MES", "PERCENTILE", *[F.round(c, 4).alias(c) for c in (
        "POLINOMIAL_FUNCTION", "LOGARITHMIC_FUNCTION", "CONV_RATE_PERC_SMOOTHED")])


@query("F9_lead_lights", _F6_CORE + """
SELECT ANO_MES, PERCENTILE, round(CUMULATIVE_LIFT, 6) AS CUMULATIVE_LIFT,
  CASE WHEN CUMULATIVE_LIFT >= 2.0 AND PERCENTILE <= 25 THEN 'green'
       WHEN CUMULATIVE_LIFT >= 1.0 AND PERCENTILE <= 35 THEN 'yellow' ELSE 'red' END AS Leads_lights
FROM lift""")
def f9(fx):
    """Green / yellow / red lights of the yearly review on each month's
    cumulative lift."""
    t = R.lead_lights(_lift(fx), "anual", "CUMULATIVE_LIFT")
    return t.select("ANO_MES", "PERCENTILE", F.round("CUMULATIVE_LIFT", 6).alias("CUMULATIVE_LIFT"), "Leads_lights")


@query("F11_model_summary", f"""
WITH a AS ({_auc_sql('line_scored', 'PR_1')}),
d AS ({_bin_report_sql('line_scored', '1 - PR_1', 'Decile', P10)})
SELECT (SELECT AUC FROM a) AS AUC_TRAIN, (SELECT "Cumulative Lift" FROM d WHERE Decile = 1) AS LIFT_DECILE_1,
       (SELECT "Cumulative rate (%)" FROM d WHERE Decile = 3) AS CAPTURED_DECILE_3""")
def f11(fx):
    """AUC, decile-1 cumulative lift and decile-3 captured share."""
    t = R.model_summary(fx.line_scored, "PR_1")
    return t.select(F.round("AUC_TRAIN", 10).alias("AUC_TRAIN"), "LIFT_DECILE_1", "CAPTURED_DECILE_3")


P99 = "[" + ", ".join(repr(i / 99) for i in range(100)) + "]"


@query("F2_percentile_report_ties", f"""
WITH s AS (SELECT round(l_discount * 10, 0) AS x, TARGET FROM line_scored),
r AS (SELECT quantile_cont(x, {P99}) AS rng, max(x) AS mx FROM s),
c AS (SELECT list_sort(list_distinct(list_concat(rng, [mx + 0.000001]))) AS cl FROM r),
b AS (SELECT CAST(len(list_filter(rng, lambda v: v <= x)) AS INTEGER) AS bin, TARGET FROM s, r),
crt AS (SELECT bin, sum(CASE WHEN TARGET = 0 THEN 1 ELSE 0 END) AS t0, sum(CASE WHEN TARGET = 1 THEN 1 ELSE 0 END) AS t1
        FROM b GROUP BY bin),
pos AS (SELECT *, row_number() OVER (ORDER BY bin) AS p FROM crt)
SELECT bin AS Percentile, round(cl[p], 3) AS Minimum, round(cl[p + 1], 3) AS Maximum,
       CAST(t0 AS BIGINT) AS "Target 0", CAST(t1 AS BIGINT) AS "Target 1",
       round(sum(t1) OVER (ORDER BY bin) * 100 / sum(t1) OVER (), 1) AS "Cumulative rate (%)",
       round(sum(t1) OVER (ORDER BY bin) / sum(t0 + t1) OVER (ORDER BY bin) / (SELECT avg(TARGET) FROM s), 2)
         AS "Cumulative Lift"
FROM pos, c""")
def f2_ties(fx):
    """Percentile report on a tied score: the colliding-edges fallback (100
    points, left-closed digitize, edges by position)."""
    df = stored(fx.line_scored.select(F.round(F.col("l_discount") * 10, 0).alias("_s"), "TARGET"), "scored")
    return R.percentile_report(df, "_s", "TARGET")


@query("F7_summary_layout", "SELECT *, 'CROSS_SELL' AS MODEL_TYPE, 'v1' AS MODEL_VERSION, 'SD' AS MODEL_LOB, "
                            "'semestral' AS REVIEW_PERIODICITY FROM (" + _F10_SQL + ")")
def f7s(fx):
    """The six-month summary stamped with model identifiers and review
    periodicity in the summary column order."""
    t = f10(fx)
    return R.report_layout(t, "CROSS_SELL", "v1", "SD", periodicity="semestral")
