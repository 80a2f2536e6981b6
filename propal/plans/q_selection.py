"""Queries C17 and C22 on scores and power transforms, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import power, selection
from .catalog import query

_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size"]

# one row per line and column with average ranks and bins; classes as numbers
_LONG = "\nUNION ALL\n".join(f"SELECT '{c}' AS Variable, CAST({c} AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM src" for c in _COLS)


def _scores_sql(source: str) -> str:
    return f"""
src AS (SELECT *, {source} AS y FROM line_facts),
long AS (SELECT Variable, x, y, count(*) OVER v AS N, avg(x) OVER v AS mx, avg(y) OVER v AS my,
           rank() OVER (PARTITION BY Variable ORDER BY x) + (count(*) OVER (PARTITION BY Variable, x) - 1) / 2.0 AS rx,
           rank() OVER (PARTITION BY Variable ORDER BY y) + (count(*) OVER (PARTITION BY Variable, y) - 1) / 2.0 AS ry
         FROM ({_LONG}) WINDOW v AS (PARTITION BY Variable)),
corrs AS (SELECT Variable, count(*) AS N, corr(x, y) AS PEARSON, corr(rx, ry) AS SPEARMAN FROM long GROUP BY Variable),
cls AS (SELECT Variable, y, count(*) AS nc, sum(x) AS sc, avg(x - mx) AS mc, var_pop(x) * count(*) AS w, any_value(mx) AS mx
        FROM long GROUP BY Variable, y),
anova AS (SELECT Variable, (sum(nc * mc * mc) / (count(*) - 1)) / (sum(w) / (sum(nc) - count(*))) AS F_CLASSIF,
            sum((sc - nc * mx) ^ 2 / (nc * mx)) AS CHI2 FROM cls GROUP BY Variable),
cells AS (SELECT Variable, CAST(floor(10 * (rx - 0.5) / N) AS INTEGER) AS bin, y, count(*) AS c, any_value(N) AS N
          FROM long GROUP BY ALL),
info AS (SELECT Variable, sum(i) AS MUTUAL_INFO FROM (
           SELECT Variable, c / N * ln(c * N / (sum(c) OVER (PARTITION BY Variable, bin) * sum(c) OVER (PARTITION BY Variable, y))) AS i
           FROM cells) GROUP BY Variable),
column_scores AS (SELECT Variable, N, PEARSON, SPEARMAN, PEARSON ^ 2 / (1 - PEARSON ^ 2) * (N - 2) AS F_REGRESSION, F_CLASSIF, CHI2,
             MUTUAL_INFO FROM corrs JOIN anova USING (Variable) JOIN info USING (Variable))"""


_ROUND = {"PEARSON": 9, "SPEARMAN": 9, "F_REGRESSION": 6, "F_CLASSIF": 6, "CHI2": 6, "MUTUAL_INFO": 9}
_ROUNDED = ", ".join(f"round({c}, {d}) AS {c}" for c, d in _ROUND.items())


@query("C17_feature_scores", f"WITH {_scores_sql('TARGET')} SELECT Variable, N, {_ROUNDED} FROM column_scores")
def c17_scores(fx):
    """Every score of every numeric column against the binary target, mutual information included."""
    t = selection.feature_scores(fx.line_facts, "TARGET", _COLS)
    return t.select("Variable", "N", *(F.round(c, d).alias(c) for c, d in _ROUND.items()))


@query("C17_feature_scores_classes", f"WITH {_scores_sql('CAST(left(o_orderpriority, 1) AS INTEGER)')} "
       "SELECT Variable, N, round(F_CLASSIF, 6) AS F_CLASSIF, round(MUTUAL_INFO, 9) AS MUTUAL_INFO FROM column_scores")
def c17_classes(fx):
    """ANOVA F and mutual information against five classes."""
    df = fx.line_facts.withColumn("CLASS", F.substring("o_orderpriority", 1, 1).cast("int"))
    t = selection.feature_scores(df, "CLASS", _COLS)
    return t.select("Variable", "N", F.round("F_CLASSIF", 6).alias("F_CLASSIF"), F.round("MUTUAL_INFO", 9).alias("MUTUAL_INFO"))


@query("C17_select_best", f"""WITH {_scores_sql('TARGET')}
SELECT CAST(row_number() OVER (ORDER BY SPEARMAN DESC, Variable) AS INTEGER) AS RANK, Variable, round(MUTUAL_INFO, 9) AS SCORE,
       round(SPEARMAN, 9) AS CORRELATION
FROM (SELECT * FROM column_scores ORDER BY MUTUAL_INFO DESC, Variable LIMIT 3)""")
def c17_best(fx):
    """The three columns with the most mutual information, by Spearman correlation."""
    t = selection.select_best(fx.line_facts, 3, "mutual_info_classif", "spearman", "TARGET", _COLS)
    return t.select("RANK", "Variable", F.round("SCORE", 9).alias("SCORE"), F.round("CORRELATION", 9).alias("CORRELATION"))


_P_COLS = ["VAL_SALDO", "VAL_PCA_AUTO", "QTD_APL_VIG_T_SD"]


def _power_sql(method: str) -> str:
    """The same brackets in DuckDB, with its own variances."""
    if method == "yeo-johnson":
        t = lambda x, lam: (
            f"CASE WHEN {x} >= 0 THEN CASE WHEN {lam} = 0 THEN ln({x} + 1) ELSE (pow({x} + 1, {lam}) - 1) / {lam} END "
            f"ELSE CASE WHEN {lam} = 2 THEN -ln(1 - {x}) ELSE -(pow(1 - {x}, 2 - {lam}) - 1) / (2 - {lam}) END END")
        logs = "sign(x) * ln(1 + abs(x))"
    else:
        t = lambda x, lam: f"CASE WHEN {lam} = 0 THEN ln({x} + 1) ELSE (pow({x} + 1, {lam}) - 1) / {lam} END"
        logs = "ln(x + 1)"
    cols = _P_COLS if method == "yeo-johnson" else _P_COLS[1:]
    long = "\nUNION ALL\n".join(f"SELECT ID, '{c}' AS Variable, CAST({c} AS DOUBLE) AS x FROM wide_lob" for c in cols)
    steps = [f"px AS MATERIALIZED ({long})",
             f"pl AS (SELECT Variable, count(x) AS N, sum({logs}) AS logs FROM px WHERE x IS NOT NULL GROUP BY Variable)",
             "b0 AS (SELECT Variable, 0.0::DOUBLE AS lam FROM pl)"]
    for i, step in enumerate(power.STEPS):
        steps.append(f"""
b{i + 1} AS MATERIALIZED (
  SELECT Variable, arg_max(lam, ll) AS lam, max(ll) AS ll, arg_max(m, ll) AS m, arg_max(sd, ll) AS sd FROM (
    SELECT Variable, lam, -any_value(N) / 2 * ln(var_pop({t('x', 'lam')})) + (lam - 1) * any_value(logs) AS ll,
           avg({t('x', 'lam')}) AS m, stddev_pop({t('x', 'lam')}) AS sd
    FROM px JOIN (SELECT Variable, round(lam + j * {step}, 4) AS lam FROM b{i}, range(-{power.POINTS}, {power.POINTS + 1}) r(j))
      USING (Variable) JOIN pl USING (Variable) WHERE x IS NOT NULL GROUP BY Variable, lam) GROUP BY Variable)""")
    return ",\n".join(steps), t("x", "lam"), f"b{len(power.STEPS)}"


def _state_sql(method: str) -> str:
    ctes, _, last = _power_sql(method)
    return f"""WITH {ctes} SELECT Variable, '{method}' AS METHOD, lam AS LAMBDA, round(m, 5) AS MEAN, round(sd, 5) AS STD, N,
    round(ll, 3) AS LOGLIK FROM {last} JOIN pl USING (Variable)"""


def _state(t):
    return t.select("Variable", "METHOD", "LAMBDA", F.round("MEAN", 5).alias("MEAN"), F.round("STD", 5).alias("STD"), "N",
                    F.round("LOGLIK", 3).alias("LOGLIK"))


@query("C22_yeo_johnson_fit", _state_sql("yeo-johnson"))
def c22_yj(fx):
    """Yeo-Johnson state of balances (both signs), premiums and counts."""
    return _state(power.fit(fx.wide_lob, _P_COLS, "yeo-johnson"))


@query("C22_box_cox_fit", _state_sql("box-cox"))
def c22_bc(fx):
    """Box-Cox state (of x + 1) of premiums and counts."""
    return _state(power.fit(fx.wide_lob, _P_COLS[1:], "box-cox"))


_YJ = _power_sql("yeo-johnson")


@query("C22_power_transform", f"""WITH {_YJ[0]},
z AS (SELECT ID, Variable, round(({_YJ[1]} - m) / sd, 6) AS z FROM px JOIN {_YJ[2]} USING (Variable))
SELECT ID, {', '.join(f"max(CASE WHEN Variable = '{c}' THEN z END) AS {c}" for c in _P_COLS)} FROM z GROUP BY ID""")
def c22_transform(fx):
    """Every customer's transformed, standardised columns."""
    w = fx.wide_lob.select("ID", *_P_COLS)
    t = power.transform(w, power.fit(w, _P_COLS))
    return t.select("ID", *(F.round(c, 6).alias(c) for c in _P_COLS))
