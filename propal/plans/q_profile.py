"""Queries C1-C23: profiling and cleaning reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as C
from ..session import stored
from .catalog import query

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size", "PERC_DISC"]
CAT = ["l_linestatus", "p_type", "p_brand", "o_orderpriority", "c_mktsegment", "n_name", "r_name"]
ALL = ["TARGET", *NUM, *CAT]
PROFILE = f"(SELECT {', '.join(ALL)} FROM line_nulls)"


def _prof(fx):
    return fx.line_nulls.select(*ALL)


def _union(parts):
    return "\nUNION ALL\n".join(parts)


def _missing_expr(c):
    if c in NUM:
        return f"sum(CASE WHEN {c} IS NULL OR isnan({c}) OR isinf({c}) THEN 1 ELSE 0 END)"
    return f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"


_TYPES = {c: ("numeric" if c in NUM or c == "TARGET" else "text") for c in ALL}
_C1_SQL = _union([f"SELECT '{c}' AS Variable, CAST({_missing_expr(c) if c != 'TARGET' else 'sum(CASE WHEN TARGET IS NULL THEN 1 ELSE 0 END)'} AS BIGINT) AS Missing, "
                  f"round({_missing_expr(c) if c != 'TARGET' else 'sum(CASE WHEN TARGET IS NULL THEN 1 ELSE 0 END)'} * 100.0 / count(*), 2) AS Percentage, "
                  f"'{_TYPES[c]}' AS Type FROM {PROFILE}" for c in ALL])


@query("C1_missing_report", f"SELECT * FROM ({_C1_SQL}) WHERE Missing > 0")
def c1(fx):
    """Missing count / % / type for columns with any missing value."""
    return C.missing_report(_prof(fx))


@query("C2_drop_high_missing", f"SELECT * EXCLUDE (l_tax, p_brand) FROM {PROFILE}")
def c2(fx):
    """Drop columns more than 10 % missing (l_tax and p_brand are ~14 % null)."""
    return C.drop_high_missing(_prof(fx), 10.0)


@query("C3_low_variance", "SELECT * FROM (" + _union(
    [f"SELECT '{c}' AS Variable, round(var_samp(CAST({c} AS DOUBLE)), 10) AS VARIANCE FROM {PROFILE}" for c in NUM])
       + ") WHERE VARIANCE < 0.01")
def c3(fx):
    """Numeric columns with sample variance < 0.01."""
    return C.low_variance(_prof(fx)).select("Variable", F.round("VARIANCE", 10).alias("VARIANCE"))


_TOP_SQL = _union([f"""SELECT '{c}' AS Variable, arg_min(v, struct_pack(nc := -cnt, v := v)) AS TOP_VALUE,
  max(cnt) AS TOP_COUNT, max(cnt) / sum(cnt) AS TOP_SHARE
FROM (SELECT {c} AS v, count(*) AS cnt FROM {PROFILE} WHERE {c} IS NOT NULL GROUP BY {c})""" for c in CAT])


@query("C4_dominant_category", f"SELECT Variable, TOP_VALUE, TOP_COUNT, round(TOP_SHARE, 10) AS TOP_SHARE, "
                                f"TOP_SHARE > 0.95 AS DOMINANT FROM ({_TOP_SQL})")
def c4(fx):
    """Top category share per text column and the >95 % flag."""
    t = C.dominant_category(_prof(fx), columns=CAT)
    return t.select("Variable", "TOP_VALUE", "TOP_COUNT", F.round("TOP_SHARE", 10).alias("TOP_SHARE"), "DOMINANT")


_CONST_IN = "(SELECT *, 'R' AS DSC_REGION_CONST, CASE WHEN TARGET = 1 THEN 'Y' END AS DSC_HALF FROM line_nulls)"


@query("C5_constant_columns", _union(
    [f"SELECT '{c}' AS Variable, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS N_MISSING, "
     f"count({c}) > 0 AND min({c}) = max({c}) AS CONSTANT, "
     f"count({c}) > 0 AND min({c}) = max({c}) AND sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) = 0 "
     f"AS CONSTANT_NO_MISSING FROM {_CONST_IN}" for c in ["l_linestatus", "p_size", "DSC_REGION_CONST", "DSC_HALF"]]))
def c5(fx):
    """Constant columns with and without the no-missing condition."""
    df = (fx.line_nulls.withColumn("DSC_REGION_CONST", F.lit("R"))
          .withColumn("DSC_HALF", F.when(F.col("TARGET") == 1, F.lit("Y"))))
    return C.constant_columns(df, ["l_linestatus", "p_size", "DSC_REGION_CONST", "DSC_HALF"])


@query("C6_duplicate_report", """
SELECT (SELECT count(*) FROM lineitem) AS N_ROWS,
       (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS N_DUP_ROWS,
       (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1))
         AS N_DUP_IDS,
       (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
         AS N_EXTRA_ID_ROWS""")
def c6(fx):
    """Full-row and id duplicates of lineitem."""
    return C.duplicate_report(fx.lineitem, ["l_orderkey", "l_linenumber"])


_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
          "l_returnflag", "l_linestatus"]


@query("C6_dedup_first", f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                                      ORDER BY {', '.join(_ORDER)}) AS rn FROM lineitem) WHERE rn = 1""")
def c6d(fx):
    """First lineitem row per (order, line) along an explicit order."""
    return C.dedup_first(fx.lineitem, ["l_orderkey", "l_linenumber"], _ORDER)


@query("C7_value_counts", """
SELECT p_type AS value, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM line_facts), 2) AS percentage
FROM line_facts GROUP BY p_type""")
def c7(fx):
    """Value counts of p_type."""
    return C.value_counts(fx.line_facts, "p_type")


_C8_SQL = _union([f"""SELECT '{c}' AS Variable, count({c}) AS count, round(avg({c}), 2) AS mean,
  round(stddev_samp({c}), 2) AS std, round(min({c}), 2) AS min,
  round(quantile_cont({c}, 0.25), 2) AS p25, round(quantile_cont({c}, 0.5), 2) AS p50,
  round(quantile_cont({c}, 0.75), 2) AS p75, round(max({c}), 2) AS max
FROM (SELECT CAST({c} AS DOUBLE) AS {c} FROM {PROFILE})""" for c in NUM])


@query("C8_numeric_summary", _C8_SQL)
def c8(fx):
    """count/mean/std/min/quartiles/max per numeric column."""
    return C.numeric_summary(_prof(fx), NUM)


@query("C9_range_check", """
SELECT CAST(sum(CASE WHEN QTD_IDADE < 18 OR QTD_IDADE > 80 THEN 1 ELSE 0 END) AS BIGINT) AS N_AGE_OUT_OF_RANGE,
       CAST(sum(CASE WHEN QTD_ANOS_ANTIG_CLIENTE < 0 THEN 1 ELSE 0 END) AS BIGINT) AS N_NEGATIVE_TENURE,
       CAST(sum(CASE WHEN QTD_ANOS_ANTIG_CLIENTE IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS N_NULL_TENURE
FROM customer_snap""")
def c9(fx):
    """Out-of-range ages, negative and missing tenures in the snapshots."""
    return C.range_check(fx.customer_snap)


@query("C10_crosstab_normalized", """
SELECT c_mktsegment, sum(CASE WHEN TARGET = 0 THEN 1 ELSE 0 END) / count(*) AS TARGET_0,
       sum(CASE WHEN TARGET = 1 THEN 1 ELSE 0 END) / count(*) AS TARGET_1
FROM line_facts GROUP BY c_mktsegment""")
def c10(fx):
    """Row-normalised market segment x target table."""
    return C.crosstab_normalized(fx.line_facts, "c_mktsegment")


@query("C11_target_group_stats", """
SELECT TARGET, round(avg(l_extendedprice), 6) AS mean, round(stddev_samp(l_extendedprice), 6) AS std,
       round(quantile_cont(l_extendedprice, 0.5), 6) AS median FROM line_facts GROUP BY TARGET""")
def c11(fx):
    """Mean, median and std of the extended price per class."""
    t = C.target_group_stats(fx.line_facts, "l_extendedprice")
    return t.select("TARGET", *[F.round(c, 6).alias(c) for c in ("mean", "std", "median")])


@query("C12_class_balance", """
WITH c AS (SELECT TARGET, count(*) AS count, count(*) / sum(count(*)) OVER () AS share FROM doc_labels GROUP BY TARGET)
SELECT *, CASE WHEN min(share) OVER () < 0.05 THEN 'severe imbalance'
               WHEN min(share) OVER () < 0.20 THEN 'moderate imbalance' ELSE 'balanced' END AS verdict FROM c""")
def c12(fx):
    """Class balance of the document quality label."""
    return C.class_balance(fx.doc_labels)


_C13_NUM = ["l_quantity", "l_discount", "p_size"]
_C13_CAT = ["l_linestatus", "c_mktsegment", "r_name"]
_C13_SQL = f"""
WITH base AS (SELECT avg(TARGET) AS b FROM line_facts),
num AS ({_union([f"SELECT '{c}_mean' AS Variable, CAST(NULL AS VARCHAR) AS Category, "
                 f"avg(CASE WHEN TARGET = 0 THEN CAST({c} AS DOUBLE) END) AS t0, "
                 f"avg(CASE WHEN TARGET = 1 THEN CAST({c} AS DOUBLE) END) AS t1 FROM line_facts" for c in _C13_NUM])}),
cat AS ({_union([f"SELECT '{c}' AS Variable, {c} AS Category, "
                 f"coalesce(sum(CASE WHEN TARGET = 0 THEN 1 END) / (SELECT count(*) FROM line_facts WHERE TARGET = 0 "
                 f"AND {c} IS NOT NULL), 0.0) AS t0, "
                 f"coalesce(sum(CASE WHEN TARGET = 1 THEN 1 END) / (SELECT count(*) FROM line_facts WHERE TARGET = 1 "
                 f"AND {c} IS NOT NULL), 0.0) AS t1 FROM line_facts WHERE {c} IS NOT NULL GROUP BY {c}"
                 for c in _C13_CAT])}),
r AS (SELECT Variable, Category, round(t0, 3) AS TARGET_0, round(t1, 3) AS TARGET_1 FROM num
      UNION ALL SELECT Variable, Category, round(t0, 3), round(t1, 3) FROM cat)
SELECT Variable, Category, TARGET_0, TARGET_1, abs(TARGET_0 - TARGET_1) AS "Absolute difference",
       CASE WHEN abs(TARGET_0 - TARGET_1) > (SELECT b FROM base)
            THEN round(abs(TARGET_0 - TARGET_1) / greatest(abs(TARGET_0), abs(TARGET_1), abs(TARGET_0 - TARGET_1)), 3)
       END AS "Difference ratio"
FROM r"""


@query("C13_multivariate_exploration", _C13_SQL)
def c13(fx):
    """Class means of numerics and class shares of categories."""
    return C.multivariate_exploration(fx.line_facts, "TARGET", _C13_NUM, _C13_CAT)


_C14_COLS = ["l_linestatus", "p_brand", "o_orderpriority", "r_name"]
_C14_SQL = f"""
WITH t AS (SELECT count(*) AS n, sum(TARGET) AS t1, avg(TARGET) AS b FROM {PROFILE}),
g AS ({_union([f"SELECT '{c}' AS Variable, coalesce(CAST({c} AS VARCHAR), 'Missing') AS Categories, count(*) AS COUNT, "
               f"CAST(sum(TARGET) AS BIGINT) AS \"# Target 1\", avg(TARGET) AS eff FROM {PROFILE} GROUP BY 2"
               for c in _C14_COLS])})
SELECT Variable, Categories, COUNT, "# Target 1", round(eff * 100, 3) AS "Effectiveness (%)",
       COUNT * 100.0 / n AS "% COUNT", "# Target 1" * 100.0 / t1 AS "% Target 1", b * 100 AS TARGET_percentage,
       CASE WHEN eff * 100 > b * 100 + 0.001 THEN 'Maior propensão' ELSE '' END AS Conclusion
FROM g, t WHERE COUNT > 100"""


@query("C14_categorical_effectiveness", _C14_SQL)
def c14(fx):
    """Conversion by category (nulls as 'Missing') for categories > 100 rows."""
    return C.categorical_effectiveness(_prof(fx), "TARGET", 100, _C14_COLS)


_C15_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
P10 = "[" + ", ".join(repr(i / 10) for i in range(11)) + "]"


def _eff_bins_sql(src_fit, src_apply, cols, null_out):
    edges = _union([f"SELECT '{c}' AS Variable, list_sort(list_distinct(quantile_cont(CAST({c} AS DOUBLE), {P10}))) AS e "
                    f"FROM {src_fit}" for c in cols])
    if null_out:
        binexpr = ("CASE WHEN x IS NULL OR x < e[1] OR x > e[len(e)] THEN NULL "
                   "ELSE greatest(1, least(len(e) - 1, len(list_filter(e, lambda v: v < x)))) END")
    else:
        binexpr = "CASE WHEN x IS NULL THEN NULL ELSE greatest(1, least(len(e) - 1, len(list_filter(e, lambda v: v < x)))) END"
    vals = _union([f"SELECT '{c}' AS Variable, CAST({c} AS DOUBLE) AS x, TARGET FROM {src_apply}" for c in cols])
    return f"""
WITH t AS (SELECT count(*) AS n, sum(TARGET) AS t1, avg(TARGET) AS b FROM {src_apply}),
e AS ({edges}),
v AS (SELECT v.Variable, TARGET, {binexpr} AS BIN, e FROM ({vals}) v JOIN e USING (Variable) WHERE len(e) >= 2),
g AS (SELECT Variable, CAST(BIN AS INTEGER) AS BIN, count(*) AS COUNT, CAST(sum(TARGET) AS BIGINT) AS "# Target 1",
             avg(TARGET) AS eff, any_value(e) AS e FROM v WHERE BIN IS NOT NULL GROUP BY Variable, BIN)
SELECT Variable, BIN, COUNT, "# Target 1", COUNT * 100.0 / n AS "% COUNT", "# Target 1" * 100.0 / t1 AS "% Target 1",
       round(eff * 100, 2) AS "Effectiveness (%)",
       CASE WHEN round(eff * 100, 2) > b * 100 + 0.001 THEN 'Maior propensão' ELSE '' END AS Conclusion,
       e[BIN] AS "Lower Limit", e[BIN + 1] AS "Upper Limit"
FROM g, t"""


@query("C15_numerical_effectiveness", _eff_bins_sql(PROFILE, PROFILE, _C15_COLS, False))
def c15(fx):
    """Conversion by decile bin of each numeric column."""
    return C.numerical_effectiveness(stored(fx.line_nulls.select(*_C15_COLS, "TARGET"), "lines"), "TARGET", _C15_COLS)


@query("C15_one_bin", """
WITH d AS (SELECT TARGET, CASE WHEN l_quantity <= 46 THEN 0.0 ELSE l_quantity END AS x FROM line_nulls),
t AS (SELECT count(*) AS n, sum(TARGET) AS t1, avg(TARGET) AS b FROM d),
m AS (SELECT arg_min(x, struct_pack(nc := -c, v := x)) AS mode
      FROM (SELECT x, count(*) AS c FROM d WHERE x IS NOT NULL GROUP BY x)),
lim AS (SELECT min(x) AS lo, max(x) AS hi FROM d, m WHERE x <> mode),
g AS (SELECT CASE WHEN x = mode THEN 1 ELSE 2 END AS BIN, count(*) AS COUNT, CAST(sum(TARGET) AS BIGINT) AS "# Target 1",
             avg(TARGET) AS eff FROM d, m WHERE x IS NOT NULL GROUP BY 1)
SELECT 'QTY_SKEW' AS Variable, CAST(BIN AS INTEGER) AS BIN, COUNT, "# Target 1", COUNT * 100.0 / n AS "% COUNT",
       "# Target 1" * 100.0 / t1 AS "% Target 1", round(eff * 100, 2) AS "Effectiveness (%)",
       CASE WHEN round(eff * 100, 2) > b * 100 + 0.001 THEN 'Maior propensão' ELSE '' END AS Conclusion,
       CASE WHEN BIN = 1 THEN (SELECT mode FROM m) ELSE (SELECT lo FROM lim) END AS "Lower Limit",
       CASE WHEN BIN = 1 THEN (SELECT mode FROM m) ELSE (SELECT hi FROM lim) END AS "Upper Limit"
FROM g, t""")
def c15one(fx):
    """A column whose deciles collapse to one bin (92 % zeros): the modal
    value against the other values."""
    df = _prof(fx).withColumn("QTY_SKEW", F.when(F.col("l_quantity") <= 46, F.lit(0.0)).otherwise(F.col("l_quantity")))
    return C.numerical_effectiveness(df, "TARGET", ["QTY_SKEW"])


_TRAIN = f"(SELECT * FROM line_nulls WHERE o_orderdate < TIMESTAMP '1999-01-01')"
_TEST = f"(SELECT * FROM line_nulls WHERE o_orderdate >= TIMESTAMP '1999-01-01')"


@query("C16_effectiveness_saved_bins", _eff_bins_sql(_TRAIN, _TEST, _C15_COLS, True))
def c16(fx):
    """Deciles fitted on orders before 1999, applied to later orders."""
    d = stored(fx.line_nulls.select("o_orderdate", *_C15_COLS, "TARGET"), "lines")
    train = d.where(F.col("o_orderdate") < "1999-01-01")
    test = d.where(F.col("o_orderdate") >= "1999-01-01")
    return C.apply_effectiveness_bins(test, C.fit_effectiveness_bins(train, _C15_COLS))


_C17_COLS = ["l_quantity", "l_extendedprice", "l_discount", "p_size"]
_C17_SQL = _union([f"""SELECT '{c}' AS Variable, round(corr(CAST({c} AS DOUBLE), CAST(TARGET AS DOUBLE)), 9) AS PEARSON,
  count(*) AS N,
  round(corr(rank_x, rank_t), 9) AS SPEARMAN,
  round(corr(CAST({c} AS DOUBLE), CAST(TARGET AS DOUBLE)) ^ 2 / (1 - corr(CAST({c} AS DOUBLE), CAST(TARGET AS DOUBLE)) ^ 2)
        * (count(*) - 2), 6) AS F_SCORE
FROM (SELECT {c}, TARGET,
        rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS rank_x,
        rank() OVER (ORDER BY TARGET) + (count(*) OVER (PARTITION BY TARGET) - 1) / 2.0 AS rank_t
      FROM line_facts WHERE {c} IS NOT NULL)""" for c in _C17_COLS])


@query("C17_feature_target_corr", _C17_SQL)
def c17(fx):
    """Pearson, Spearman and F score of numerics against the target."""
    t = C.feature_target_corr(fx.line_facts, "TARGET", _C17_COLS)
    return t.select("Variable", F.round("PEARSON", 9).alias("PEARSON"), "N", F.round("SPEARMAN", 9).alias("SPEARMAN"),
                    F.round("F_SCORE", 6).alias("F_SCORE"))


_TOPK_COLS = ["l_quantity", "l_extendedprice", "l_discount", "p_size", "PERC_DISC"]   # l_tax has nulls


@query("C17_top_k", "SELECT Variable, F_SCORE FROM (" + _union([
    f"SELECT '{c}' AS Variable, round(corr(CAST({c} AS DOUBLE), CAST(TARGET AS DOUBLE)) ^ 2 / "
    f"(1 - corr(CAST({c} AS DOUBLE), CAST(TARGET AS DOUBLE)) ^ 2) * (count(*) - 2), 6) AS F_SCORE FROM {PROFILE}"
    for c in _TOPK_COLS]) + ") ORDER BY F_SCORE DESC, Variable LIMIT 2")
def c17k(fx):
    """The two best F scores among the null-free numeric columns (a column
    with nulls is left out)."""
    t = C.feature_target_corr(_prof(fx), "TARGET", NUM, null_free=True, top_k=2)
    return t.select("Variable", F.round("F_SCORE", 6).alias("F_SCORE"))


_CHI2_SQL = _union([f"""SELECT '{c}' AS Variable, round(sum(pow(s_c - (n_c / n) * s, 2) / ((n_c / n) * s)), 6) AS CHI2
FROM (SELECT TARGET, count(*) AS n_c, sum(CAST({c} AS DOUBLE)) AS s_c FROM line_facts WHERE {c} IS NOT NULL
      GROUP BY TARGET) cls,
     (SELECT count(*) AS n, sum(CAST({c} AS DOUBLE)) AS s FROM line_facts WHERE {c} IS NOT NULL) tot"""
                    for c in _C17_COLS])


@query("C17_chi2_score", _CHI2_SQL)
def c17chi(fx):
    """chi2 selection score of the non-negative numerics against the target."""
    lines = stored(fx.line_facts.select(*_C17_COLS, "TARGET"), "lines")
    t = C.feature_target_corr(lines, "TARGET", _C17_COLS)
    return t.select("Variable", F.round("CHI2", 6).alias("CHI2"))


_C18_SQL = _union([f"""SELECT '{c}' AS Variable, round(corr(CAST({c} AS DOUBLE), CAST(TARGET AS DOUBLE)), 9) AS R,
  count(*) AS N,
  round(corr(CAST({c} AS DOUBLE), CAST(TARGET AS DOUBLE)) * sqrt((count(*) - 2)
        / (1 - corr(CAST({c} AS DOUBLE), CAST(TARGET AS DOUBLE)) ^ 2)), 6) AS T_STAT
FROM {PROFILE} WHERE {c} IS NOT NULL""" for c in NUM])


@query("C18_point_biserial", _C18_SQL)
def c18(fx):
    """Point-biserial r, n and t statistic per numeric column."""
    t = C.point_biserial(_prof(fx), "TARGET", NUM)
    return t.select("Variable", F.round("R", 9).alias("R"), "N", F.round("T_STAT", 6).alias("T_STAT"))


@query("C18_point_biserial_significance")
def c18p(fx):
    """Same with two-sided p-values and the significance verdict."""
    return C.add_p_values(C.point_biserial(_prof(fx), "TARGET", NUM))


@query("C19_histogram", """
WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM line_facts)
SELECT CAST(least(9, greatest(0, floor((l_extendedprice - lo) / ((hi - lo) / 10)))) AS INTEGER) AS BIN,
       lo + BIN * ((hi - lo) / 10) AS LOWER, lo + (BIN + 1) * ((hi - lo) / 10) AS UPPER, count(*) AS COUNT
FROM line_facts, s GROUP BY BIN, lo, hi""")
def c19(fx):
    """10-bin equal-width histogram of the extended price."""
    return C.histogram(fx.line_facts, "l_extendedprice")


@query("C19_bar_counts", """
SELECT CAST(dense_rank() OVER (ORDER BY LOWER) AS INTEGER) AS BIN, LOWER, LOWER AS UPPER, COUNT
FROM (SELECT CAST(l_discount AS DOUBLE) AS LOWER, count(*) AS COUNT FROM line_facts GROUP BY l_discount)""")
def c19b(fx):
    """Bar counts of the discount (11 distinct values, bars allowed up to 11)."""
    return C.histogram(fx.line_facts, "l_discount", max_bars=11)


_C20_COLS = (["ID", "DSC_SEGMENTO", "VAL_SALDO", "NATION"]
             + [f"{p}_{b}" for b in ("AUTO", "SD", "CAP", "PPR", "MRH", "VDO")
                for p in ("QTD_APL_VIG_T", "VAL_PCA", "DSC_HAS", "QTD_MESES_ULT_COMPRA", "QTD_APL_REC")] + ["TARGET"])
_C20_WORDS = {"Demographics": "IDADE|SEXO|CIVIL|PROF|HABILITACOES", "Geographic": "DISTRITO|CONCELHO|NUT|FREGUESIA",
              "Digital": "LOGIN|APP|DIGITAL|INTERACT", "Insurance": "APL|VIG|SEGUROS|APOLICE",
              "Financial": "VAL|CLV|SCORE|MARGEM|PCA"}


@query("C20_column_families", f"""
WITH c AS ({_union([f"SELECT '{c}' AS name, count({c}) AS N_VALUES FROM wide_lob" for c in _C20_COLS])}),
s AS (SELECT *, nullif(regexp_extract(name, '^[A-Z]+_[A-Z]'), '') AS stem FROM c)
SELECT name AS "column", list_filter([{', '.join(f"CASE WHEN regexp_matches(name, '{w}') THEN '{f}' END"
                                                  for f, w in _C20_WORDS.items())}], lambda x: x IS NOT NULL) AS families,
  CASE WHEN stem IS NOT NULL AND count(*) OVER (PARTITION BY stem) > 1 THEN stem END AS prefix_family, N_VALUES
FROM s""")
def c20(fx):
    """Keyword and prefix families of the wide customer columns, with the
    number of values of each."""
    return C.column_families(fx.wide_lob)


@query("C21_dtype_census", """
SELECT 'text' AS type, CAST(12 AS INTEGER) AS n_columns, CAST(12 * count(*) AS BIGINT) AS n_values FROM cust_month
UNION ALL
SELECT 'numeric', CAST(26 AS INTEGER), CAST(26 * count(*) AS BIGINT) FROM cust_month""")
def c21(fx):
    """Columns and values per type family of the monthly history."""
    return C.dtype_census(fx.cust_month)


_WIDE_COLS = (["ID", "DSC_SEGMENTO", "VAL_SALDO", "NATION"]
              + [c for b in ("AUTO", "SD", "CAP", "PPR", "MRH", "VDO")
                 for c in (f"QTD_APL_VIG_T_{b}", f"VAL_PCA_{b}", f"DSC_HAS_{b}", f"QTD_MESES_ULT_COMPRA_{b}",
                           f"QTD_APL_REC_{b}")] + ["TARGET"])
_MISS = " UNION ALL ".join(
    f"SELECT round(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) * 100.0 / count(*), 2) AS p FROM wide_lob"
    for c in _WIDE_COLS)


@query("C21_readiness", f"""
SELECT * FROM (VALUES ('target present', true), ('required columns present', true)) t("check", passed)
UNION ALL
SELECT 'all columns < 50% missing', max(p) < 50 FROM ({_MISS})""")
def c21r(fx):
    """Readiness checklist of the wide customer table."""
    return C.readiness(fx.wide_lob, ["QTD_APL_VIG_T_AUTO", "VAL_PCA_AUTO"])


_C22_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


def _mom_sql(expr_of):
    return _union([f"""SELECT '{c}' AS Variable, count(d) AS n,
  avg(d*d*d) / pow(avg(d*d), 1.5) AS SKEW, avg(d*d*d*d) / pow(avg(d*d), 2) - 3 AS KURTOSIS
FROM (SELECT x - avg(x) OVER () AS d FROM (SELECT {expr_of(c)} AS x FROM line_facts) WHERE x IS NOT NULL)"""
                   for c in _C22_COLS])


@query("C22_skew_report", f"""
WITH b AS ({_mom_sql(lambda c: f'CAST({c} AS DOUBLE)')}),
l AS ({_mom_sql(lambda c: f'CASE WHEN {c} >= 0 THEN ln(1 + {c}) END')}),
s AS ({_mom_sql(lambda c: f'CASE WHEN {c} >= 0 THEN sqrt({c}) END')})
SELECT b.Variable, b.n, round(b.SKEW, 6) AS SKEW, round(b.KURTOSIS, 6) AS KURTOSIS, round(l.SKEW, 6) AS SKEW_LOG1P,
       round(s.SKEW, 6) AS SKEW_SQRT, abs(round(b.SKEW, 6)) > 1.0 AS HIGH_SKEW, abs(round(b.KURTOSIS, 6)) > 3.0 AS HIGH_KURTOSIS
FROM b JOIN l USING (Variable) JOIN s USING (Variable)""")
def c22(fx):
    """Skewness / kurtosis and the skewness after log1p and sqrt."""
    return C.skew_report(fx.line_facts, _C22_COLS)


_LAMBDAS = ", ".join(f"({round(-2 + 0.1 * i, 1)!r})" for i in range(41))


@query("C22_box_cox_lambda", f"""
WITH g(lam) AS (SELECT CAST(x AS DOUBLE) FROM (VALUES {_LAMBDAS}) v(x)),
d AS (SELECT CAST(l_extendedprice AS DOUBLE) + 1 AS y FROM line_facts WHERE l_extendedprice > -1),
t AS (SELECT lam, count(*) AS n, sum(ln(y)) AS sl,
             sum(CASE WHEN lam = 0 THEN ln(y) ELSE (pow(y, lam) - 1) / lam END) AS s,
             sum(pow(CASE WHEN lam = 0 THEN ln(y) ELSE (pow(y, lam) - 1) / lam END, 2)) AS q
      FROM d, g GROUP BY lam),
ll AS (SELECT lam, -n / 2 * ln(q / n - pow(s / n, 2)) + (lam - 1) * sl AS ll FROM t)
SELECT 'l_extendedprice' AS Variable, arg_max(lam, ll) AS LAMBDA, round(max(ll), 2) AS LOGLIK FROM ll""")
def c22b(fx):
    """Box-Cox lambda of the extended price (41-point grid in one pass)."""
    out = C.box_cox_lambda(fx.line_facts, "l_extendedprice")
    return out.select("Variable", "LAMBDA", F.round("LOGLIK", 2).alias("LOGLIK"))


_LOB_Q = [f"QTD_APL_VIG_T_{b}" for b in ("AUTO", "SD", "CAP", "PPR", "MRH", "VDO")]


@query("C23_nonzero_share", _union([
    f"SELECT '{c}' AS Variable, CAST(sum(CASE WHEN {c} > 0 THEN 1 ELSE 0 END) AS BIGINT) AS N_POSITIVE, "
    f"round(sum(CASE WHEN {c} > 0 THEN 1 ELSE 0 END) * 100.0 / count(*), 2) AS PCT FROM wide_lob" for c in _LOB_Q]))
def c23(fx):
    """Customers holding each line of business."""
    return C.nonzero_share(fx.wide_lob, _LOB_Q)
