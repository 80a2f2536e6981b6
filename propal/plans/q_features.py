"""Queries D1-D44: feature operators (stateless and fitted)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as D
from ..operators import families as FM
from ..operators import fitted as FT
from ..operators.lineage import expand_lineage
from ..operators.profile import wide_agg
from ..session import cut_lineage, stored
from .catalog import query
from .fixtures import LOBS

ET = ("CLICK", "VIEW", "PURCHASE", "SIGNUP", "ERROR")
APP = ("CLICK", "VIEW")


def _u(parts):
    return "\nUNION ALL\n".join(parts)


def _digital_app(fx):
    d = fx.digital
    ren = {}
    for t in APP:
        ren[f"IND_LOGIN_{t}"] = f"IND_LOGIN_APP_{t}"
        ren[f"QT_DAYS_LAST_LOGIN_{t}"] = f"QT_DAYS_LAST_LOGIN_APP_{t}"
    return d.withColumnsRenamed(ren)


_OTH = [t for t in ET if t not in APP]


@query("D1_login_rollup", f"""
SELECT ID,
  coalesce(greatest({', '.join(f'IND_LOGIN_{t}' for t in APP)}), 0) AS IND_LOGIN_APP,
  coalesce(greatest({', '.join(f'IND_LOGIN_{t}' for t in _OTH)}), 0) AS IND_LOGIN_APP_HI_SITE_EXT,
  least({', '.join(f'QT_DAYS_LAST_LOGIN_{t}' for t in APP)}) AS QT_DAYS_LAST_LOGIN_APP,
  greatest({', '.join(f'QT_DAYS_LAST_LOGIN_{t}' for t in APP)}) AS QT_DAYS_FIRST_LOGIN_APP,
  least({', '.join(f'QT_DAYS_LAST_LOGIN_{t}' for t in _OTH)}) AS QT_DAYS_LAST_LOGIN_APP_HI_SITE_EXT,
  greatest({', '.join(f'QT_DAYS_LAST_LOGIN_{t}' for t in _OTH)}) AS QT_DAYS_FIRST_LOGIN_APP_HI_SITE_EXT
FROM digital""")
def d1(fx):
    """App (click/view) vs other channels login roll-up per user."""
    out = D.login_rollup(_digital_app(fx))
    return out.select("ID", "IND_LOGIN_APP", "IND_LOGIN_APP_HI_SITE_EXT", "QT_DAYS_LAST_LOGIN_APP",
                      "QT_DAYS_FIRST_LOGIN_APP", "QT_DAYS_LAST_LOGIN_APP_HI_SITE_EXT",
                      "QT_DAYS_FIRST_LOGIN_APP_HI_SITE_EXT")


_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query("D2_basket_flags", "SELECT ID, " + ", ".join(
    f"CAST(coalesce(list_contains(string_split(DSC_CABAZ_ATUAL, ' / '), '{t}'), false) AS INTEGER) "
    f"AS FLG_CABAZ_ATUAL_{t}" for t in _TYPES) + " FROM baskets")
def d2(fx):
    """Order baskets ('A / B') to one flag per part type."""
    b = fx.baskets
    return D.basket_flags(b, "DSC_CABAZ_ATUAL", D.basket_labels(b, "DSC_CABAZ_ATUAL"))


@query("D3_merge_cap_ppr", """
SELECT ID, CAST(coalesce(QTD_APL_VIG_T_CAP, 0) + coalesce(QTD_APL_VIG_T_PPR, 0) AS DOUBLE) AS QTD_APL_VIG_T_SF,
       coalesce(VAL_PCA_CAP, 0) + coalesce(VAL_PCA_PPR, 0) AS VAL_PCA_SF,
       CASE WHEN coalesce(DSC_HAS_CAP = 'S', false) OR coalesce(DSC_HAS_PPR = 'S', false) THEN 'S'
            WHEN coalesce(DSC_HAS_CAP = 'X', true) AND coalesce(DSC_HAS_PPR = 'X', true) THEN 'X' ELSE 'N' END
         AS DSC_HAS_SF,
       least(QTD_MESES_ULT_COMPRA_CAP, QTD_MESES_ULT_COMPRA_PPR) AS QTD_MESES_ULT_COMPRA_SF,
       CAST(coalesce(QTD_APL_REC_CAP, 0) + coalesce(QTD_APL_REC_PPR, 0) AS DOUBLE) AS QTD_APL_REC_SF
FROM wide_lob""")
def d3(fx):
    """CAP + PPR pairs merged into SF (sum / min / S-N-X algebra)."""
    out = D.merge_cap_ppr(fx.wide_lob)
    return out.select("ID", "QTD_APL_VIG_T_SF", "VAL_PCA_SF", "DSC_HAS_SF", "QTD_MESES_ULT_COMPRA_SF",
                      "QTD_APL_REC_SF")


@query("D4_recency_flags", "SELECT ID, " + ", ".join(
    f"CASE WHEN QTD_MESES_ULT_COMPRA_{b} IS NULL THEN 'X' ELSE 'S' END AS DSC_IND_CHURN_{b}" for b in LOBS)
       + " FROM wide_lob")
def d4(fx):
    """Months since last purchase per line -> churn flags S/X."""
    out = D.recency_flags(fx.wide_lob)
    return out.select("ID", *[f"DSC_IND_CHURN_{b}" for b in LOBS])


_SEG_MAP = {"AUTOMOBILE": "VEHICLES/MACHINERY", "MACHINERY": "VEHICLES/MACHINERY"}
_REG_MAP = {"EUROPE": "EUROPE/MIDDLE EAST", "MIDDLE EAST": "EUROPE/MIDDLE EAST"}


@query("D5_regroup_categories", """
SELECT c_custkey, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'VEHICLES/MACHINERY' ELSE c_mktsegment END
         AS c_mktsegment,
       CASE WHEN r_name IN ('EUROPE', 'MIDDLE EAST') THEN 'EUROPE/MIDDLE EAST' ELSE r_name END AS r_name
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def d5(fx):
    """Dictionary merges of segment and region values."""
    c, n, r = fx.customer, fx.nation, fx.region
    df = (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
          .select("c_custkey", "c_mktsegment", "r_name"))
    return D.regroup_categories(df, {"c_mktsegment": _SEG_MAP, "r_name": _REG_MAP})


_REF = "CAST(strptime(CAST(ANO_MES AS VARCHAR) || '01', '%Y%m%d') AS DATE)"


@query("D6_date_features", f"""
SELECT ID_APOLICE, ID_CLIENTE_ANON, COD_DELEGACAO, ANO_MES, QTD_CAPITAL, VAL_PREMIO, DSC_ESTADO,
  round_even(date_diff('day', DT_INCLUSAO_SEG, {_REF}) / 30.436875, 0) AS QTD_MESES_INCLUSAO_SEG,
  round_even(date_diff('day', DT_NASCIMENTO_SEG, {_REF}) / 365.25, 0) AS QTD_IDADE_SEG,
  CAST(coalesce(round_even(date_diff('day', DT_NASCIMENTO_SEG, {_REF}) / 365.25, 0) <= 5, false) AS INTEGER)
    AS FLG_IDADE_SEG_ATE5,
  CAST(coalesce(round_even(date_diff('day', DT_NASCIMENTO_SEG, {_REF}) / 365.25, 0) <= 8, false) AS INTEGER)
    AS FLG_IDADE_SEG_ATE8,
  CAST(coalesce(round_even(date_diff('day', DT_NASCIMENTO_SEG, {_REF}) / 365.25, 0) <= 10, false) AS INTEGER)
    AS FLG_IDADE_SEG_ATE10
FROM insured""")
def d6(fx):
    """Months since inclusion, insured age and age flags from dates."""
    return D.date_features(fx.insured)


_PT = {"URGENT_HIGH": ("1-URGENT", "2-HIGH"), "MEDIUM": ("3-MEDIUM",), "LOW": ("5-LOW",),
       "NOT_SPECIFIED": ("4-NOT SPECIFIED",)}


@query("D7_product_type", """
SELECT ID_APOLICE, CASE WHEN DSC_PRODUTO_SO_APL IN ('1-URGENT', '2-HIGH') THEN 'URGENT_HIGH'
  WHEN DSC_PRODUTO_SO_APL = '3-MEDIUM' THEN 'MEDIUM' WHEN DSC_PRODUTO_SO_APL = '5-LOW' THEN 'LOW' END AS TIPO_PRODUTO
FROM policy_snap""")
def d7(fx):
    """Product name -> product type (unlisted -> null)."""
    pt = {k: v for k, v in _PT.items() if k != "NOT_SPECIFIED"}
    return D.product_type(fx.policy_snap, groups=pt).select("ID_APOLICE", "TIPO_PRODUTO")


# --- fixed values: waiting periods in months (coverage x product type)
WAITING = (("CONSULTAS", "Consultas", 0, 3, 6, 1), ("EXAMES", "Exames", 1, 3, 6, 2),
           ("INTERNAMENTO", "Internamento", 3, 6, 12, 6), ("PARTO", "Parto", 10, 12, 12, 10),
           ("ESTOMATOLOGIA", "Estomatologia", 2, 6, 9, 3))
_WCOLS = ("URGENT_HIGH", "MEDIUM", "LOW", "NOT_SPECIFIED")


@query("D8_waiting_period_flags", f"""
WITH w(SHORT_DESC, LONG_DESC, {', '.join(_WCOLS)}) AS (VALUES {', '.join(str(r) for r in WAITING)}),
p AS (SELECT ID_APOLICE, QTD_MATURIDADE_APL, CASE WHEN DSC_PRODUTO_SO_APL IN ('1-URGENT', '2-HIGH') THEN 'URGENT_HIGH'
  WHEN DSC_PRODUTO_SO_APL = '3-MEDIUM' THEN 'MEDIUM' WHEN DSC_PRODUTO_SO_APL = '5-LOW' THEN 'LOW'
  WHEN DSC_PRODUTO_SO_APL = '4-NOT SPECIFIED' THEN 'NOT_SPECIFIED' END AS TIPO_PRODUTO FROM policy_snap),
l AS (UNPIVOT w ON {', '.join(_WCOLS)} INTO NAME t VALUE m)
SELECT ID_APOLICE, TIPO_PRODUTO, """ + ", ".join(
    f"CAST(coalesce((SELECT m FROM l WHERE l.t = p.TIPO_PRODUTO AND l.SHORT_DESC = '{r[0]}') > QTD_MATURIDADE_APL, false)"
    f" AS INTEGER) AS FLG_CARENCIA_COB_{r[0]}" for r in WAITING) + " FROM p")
def d8(fx):
    """Coverages still in their waiting period given the policy maturity."""
    w = fx.spark.createDataFrame(list(WAITING), "SHORT_DESC string, LONG_DESC string, "
                                 + ", ".join(f"{c} int" for c in _WCOLS))
    p = D.product_type(fx.policy_snap, groups=_PT).select("ID_APOLICE", "TIPO_PRODUTO", "QTD_MATURIDADE_APL")
    return D.waiting_period_flags(p, w).drop("QTD_MATURIDADE_APL")


def _u_sum(p, m):
    return " + ".join(f"coalesce(CAST({p}_M{k} AS DOUBLE), 0.0)" for k in range(m + 1))


@query("D9_trailing_sums", "SELECT ID, ANO_MES, " + ", ".join(
    f"round({_u_sum(p, m)}, 6) AS {p}_U{m}M" for p in ("QTD_ORD", "VAL_SPEND") for m in (2, 5, 11))
       + ", QTD_ORD_M1, VAL_SPEND_M5 FROM cust_month")
def d9(fx):
    """Trailing sums of the monthly order history; months 0, 1 and the windows
    stay."""
    out = D.trailing_sums(fx.cust_month)
    cols = [f"{p}_U{m}M" for p in ("QTD_ORD", "VAL_SPEND") for m in (2, 5, 11)]
    return out.select("ID", "ANO_MES", *[F.round(c, 6).alias(c) for c in cols], "QTD_ORD_M1", "VAL_SPEND_M5")


@query("D9_trailing_sums_long", """
SELECT ID, ANO_MES, N_ORD, round(SPEND, 6) AS SPEND,
  round(sum(coalesce(SPEND, 0)) OVER (PARTITION BY ID ORDER BY floor(ANO_MES / 100) * 12 + ANO_MES % 100
                                   RANGE BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS SPEND_U3M
FROM cust_orders_month""")
def d9l(fx):
    """Long-form 3-month trailing spend per customer (window by customer)."""
    out = D.trailing_sums_long(fx.cust_orders_month, "ID", "ANO_MES", "SPEND", 3)
    return out.select("ID", "ANO_MES", "N_ORD", F.round("SPEND", 6).alias("SPEND"),
                      F.round("SPEND_U3M", 6).alias("SPEND_U3M"))


def _tri(cols):
    s = " OR ".join(f"coalesce({c} = 'S', false)" for c in cols)
    x = " AND ".join(f"coalesce({c} = 'X', true)" for c in cols)
    return f"CASE WHEN {s} THEN 'S' WHEN {x} THEN 'X' ELSE 'N' END"


@query("D10_trailing_flags", "SELECT ID, ANO_MES, " + ", ".join(
    f"{_tri([f'DSC_BUY_M{k}' for k in range(m + 1)])} AS DSC_BUY_U{m}M" for m in (2, 5, 11)) + " FROM cust_month")
def d10(fx):
    """Bought-in-window S/N/X flags over 3/6/12 months."""
    out = D.trailing_flags(fx.cust_month)
    return out.select("ID", "ANO_MES", "DSC_BUY_U2M", "DSC_BUY_U5M", "DSC_BUY_U11M")


@query("D11_paid_vs_submitted_ratio", """
SELECT ID_APOLICE, VAL_PG_SIN / nullif(VAL_APR_SIN, 0) AS RC_VAL_PG_APR_SIN FROM policy_snap""")
def d11(fx):
    """Paid over submitted claims ratio (x/0 -> null)."""
    return D.paid_vs_submitted_ratio(fx.policy_snap).select("ID_APOLICE", "RC_VAL_PG_APR_SIN")


@query("D12_premium_per_insured", """
SELECT n.ID_APOLICE, n.VAL_PCA_APL / nullif(n.QTD_SEGURADOS_APL_SD_VIG, 0) AS RC_PCA_SEGURADOS_VIG,
  a.VAL_PCA_APL / nullif(a.QTD_SEGURADOS_APL_SD_VIG, 0) AS RC_PCA_SEGURADOS_VIG_M12,
  coalesce(n.VAL_PCA_APL / nullif(n.QTD_SEGURADOS_APL_SD_VIG, 0), 0.0)
    - coalesce(a.VAL_PCA_APL / nullif(a.QTD_SEGURADOS_APL_SD_VIG, 0), 0.0) AS DIF_RC_PCA_SEGURADOS_VIG_M_M12
FROM policy_month n LEFT JOIN policy_month a ON a.ID_APOLICE = n.ID_APOLICE AND a.QTD_MESES = n.QTD_MESES - 12
WHERE n.QTD_MESES >= 11""")
def d12(fx):
    """Premium per insured person now, a year ago and the difference; policies
    of 11 months have no year-ago row."""
    from ..operators.panel import lagged_join
    p = fx.policy_month.select("ANO_MES", "ID_APOLICE", "QTD_MESES", "VAL_PCA_APL", "QTD_SEGURADOS_APL_SD_VIG")
    both = lagged_join(p.where("QTD_MESES >= 11"), p.drop("QTD_MESES"), ["ID_APOLICE"], 12, "left", "_M12")
    return D.premium_per_insured(both).select("ID_APOLICE", "RC_PCA_SEGURADOS_VIG", "RC_PCA_SEGURADOS_VIG_M12",
                                              "DIF_RC_PCA_SEGURADOS_VIG_M_M12")


def _d13_input(fx):
    w = fx.wide_lob
    return w.select(
        "*", F.col("NATION").alias("COD_NATION"), F.col("DSC_SEGMENTO").alias("DSC_NVL50_HIER_COM"),
        F.col("VAL_SALDO").alias("OD_SALDO"), F.lit("PT").alias("DSC_PAIS"),
        F.when(F.col("ID") % 2 == 0, F.lit(1)).alias("FLG_HALF"),
        F.col("VAL_SALDO").alias("VAL_CUSTO_SIN_EX_ABR"), F.lit(None).cast("double").alias("QTD_EMPTY"))


_D13_KEPT = (["ID", "DSC_SEGMENTO", "VAL_SALDO", "NATION"]
             + [c for b in LOBS for c in (f"QTD_APL_VIG_T_{b}", f"VAL_PCA_{b}", f"DSC_HAS_{b}",
                                          f"QTD_MESES_ULT_COMPRA_{b}", f"QTD_APL_REC_{b}")]
             + ["TARGET", "FLG_HALF"])


@query("D13_select_columns", f"SELECT {', '.join(_D13_KEPT)} FROM (SELECT *, "
                             "CASE WHEN ID % 2 = 0 THEN 1 END AS FLG_HALF FROM wide_lob)")
def d13(fx):
    """Rule-based column selection (COD_ duplicates, fixed lists, patterns,
    constants without missing, all-missing columns)."""
    return FT.select_columns(_d13_input(fx), missing_threshold=1.0)


@query("D14_aggregate_children", """
SELECT ID_APOLICE, count(*) AS N_CHILDREN, max(COD_DELEGACAO) AS COD_DELEGACAO_max, min(COD_DELEGACAO) AS COD_DELEGACAO_min,
  CAST(sum(COD_DELEGACAO) AS BIGINT) AS COD_DELEGACAO_sum, avg(COD_DELEGACAO) AS COD_DELEGACAO_mean,
  max(ANO_MES) AS ANO_MES_max, min(ANO_MES) AS ANO_MES_min, CAST(sum(ANO_MES) AS BIGINT) AS ANO_MES_sum,
  avg(ANO_MES) AS ANO_MES_mean,
  max(ID_CLIENTE_ANON) AS ID_CLIENTE_ANON_max, min(ID_CLIENTE_ANON) AS ID_CLIENTE_ANON_min,
  CAST(sum(ID_CLIENTE_ANON) AS BIGINT) AS ID_CLIENTE_ANON_sum, avg(ID_CLIENTE_ANON) AS ID_CLIENTE_ANON_mean,
  max(QTD_CAPITAL) AS QTD_CAPITAL_max, min(QTD_CAPITAL) AS QTD_CAPITAL_min, sum(QTD_CAPITAL) AS QTD_CAPITAL_sum,
  avg(QTD_CAPITAL) AS QTD_CAPITAL_mean, max(VAL_PREMIO) AS VAL_PREMIO_max, min(VAL_PREMIO) AS VAL_PREMIO_min,
  round(sum(VAL_PREMIO), 2) AS VAL_PREMIO_sum, round(sum(VAL_PREMIO), 2) / count(*) AS VAL_PREMIO_mean,
  max(CAST(DSC_ESTADO = 'F' AS INTEGER)) AS FLG_ESTADO_F_max, min(CAST(DSC_ESTADO = 'F' AS INTEGER)) AS FLG_ESTADO_F_min,
  avg(CAST(DSC_ESTADO = 'F' AS INTEGER)) AS FLG_ESTADO_F_mean,
  max(CAST(DSC_ESTADO = 'O' AS INTEGER)) AS FLG_ESTADO_O_max, min(CAST(DSC_ESTADO = 'O' AS INTEGER)) AS FLG_ESTADO_O_min,
  avg(CAST(DSC_ESTADO = 'O' AS INTEGER)) AS FLG_ESTADO_O_mean
FROM insured GROUP BY ID_APOLICE""")
def d14(fx):
    """Insured persons collapsed to their policy (numeric aggregates and
    state dummies inside one aggregate)."""
    ins = fx.insured.drop("DT_INCLUSAO_SEG", "DT_NASCIMENTO_SEG")
    states = D.one_hot_labels(ins, "DSC_ESTADO")
    out = D.aggregate_children(ins, ["ID_APOLICE"], dummies={"DSC_ESTADO": states})
    # amounts have 2 decimals: the rounded sum is exact, so the mean is
    # reported as rounded sum / count (identical in any summation order)
    s = F.round("VAL_PREMIO_sum", 2)
    return out.withColumns({"VAL_PREMIO_sum": s, "VAL_PREMIO_mean": s / F.col("N_CHILDREN")})


_TE_COLS = ["p_type", "c_mktsegment", "p_brand"]
_TE_SQL = f"""
WITH g AS (SELECT avg(CAST(TARGET AS DOUBLE)) AS gm, var_pop(CAST(TARGET AS DOUBLE)) AS gv FROM line_nulls),
e AS ({_u([f"SELECT '{c}' AS Variable, CAST({c} AS VARCHAR) AS category, count(*) AS n, avg(CAST(TARGET AS DOUBLE)) AS m, "
           f"var_pop(CAST(TARGET AS DOUBLE)) AS v FROM line_nulls GROUP BY {c}" for c in _TE_COLS])}),
enc AS (SELECT Variable, category,
   coalesce((gv * n / nullif(gv * n + v, 0)) * m + (1 - gv * n / nullif(gv * n + v, 0)) * gm, gm) AS ENCODING
   FROM e, g)
SELECT l_orderkey, l_linenumber, TARGET, """ + ", ".join(
    f"round(coalesce(e{i}.ENCODING, (SELECT gm FROM g)), 10) AS {c}" for i, c in enumerate(_TE_COLS)) + " FROM line_nulls l " + \
    " ".join(f"LEFT JOIN (SELECT * FROM enc WHERE Variable = '{c}') e{i} ON CAST(l.{c} AS VARCHAR) IS NOT DISTINCT FROM "
             f"e{i}.category" for i, c in enumerate(_TE_COLS))


@query("D15_target_encode", _TE_SQL)
def d15(fx):
    """Empirical-Bayes target encoding of type, segment and brand (null brand
    is its own category)."""
    df = fx.line_nulls
    st = FT.target_encode_fit(df, _TE_COLS)
    out = FT.target_encode_transform(df, st, _TE_COLS)
    return out.select("l_orderkey", "l_linenumber", "TARGET", *[F.round(c, 10).alias(c) for c in _TE_COLS])


_PRIO = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]


@query("D16_ordinal_encode", """
WITH cats AS (SELECT list(v ORDER BY v) AS l FROM (SELECT DISTINCT coalesce(p_brand, 'INDETERMINADO') AS v
                                                      FROM line_nulls))
SELECT l_orderkey, l_linenumber,
  CAST(list_position(l, coalesce(p_brand, 'INDETERMINADO')) - 1 AS DOUBLE) AS p_brand,
  CAST(list_position(['5-LOW', '4-NOT SPECIFIED', '3-MEDIUM', '2-HIGH', '1-URGENT'], o_orderpriority) - 1 AS DOUBLE)
    AS o_orderpriority
FROM line_nulls, cats""")
def d16(fx):
    """Ordinal codes: detected order for brand (nulls INDETERMINADO), given
    order for the priority."""
    df = fx.line_nulls.select("l_orderkey", "l_linenumber", "p_brand", "o_orderpriority")
    state = FT.ordinal_fit(df, ["p_brand", "o_orderpriority"], {"o_orderpriority": _PRIO})
    return FT.ordinal_transform(df, state)


@query("D16_ordinal_inverse", """
SELECT l_orderkey, l_linenumber, coalesce(p_brand, 'INDETERMINADO') AS p_brand, o_orderpriority FROM line_nulls""")
def d16i(fx):
    """inverse(encode(x)) = x for seen values."""
    df = fx.line_nulls.select("l_orderkey", "l_linenumber", "p_brand", "o_orderpriority")
    state = FT.ordinal_fit(df, ["p_brand", "o_orderpriority"], {"o_orderpriority": _PRIO})
    return FT.ordinal_inverse(FT.ordinal_transform(df, state), state)


_RARE_COLS = ["o_orderpriority", "p_type", "l_linestatus", "p_brand"]
_RARE_SQL = f"""
WITH n AS (SELECT count(*) AS n FROM line_facts),
vc AS ({_u([f"SELECT '{c}' AS Variable, {c} AS value, count(*) AS c FROM line_facts WHERE {c} IS NOT NULL GROUP BY {c}"
            for c in _RARE_COLS])}),
r AS (SELECT *, coalesce(sum(c) OVER (PARTITION BY Variable ORDER BY c DESC, value
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             count(*) OVER (PARTITION BY Variable) AS k FROM vc),
f AS (SELECT Variable, min(before) AS ff FROM r, n WHERE before >= 0.8 * n OR c / n < 0.05 GROUP BY Variable),
kept AS (SELECT r.Variable, value FROM r LEFT JOIN f USING (Variable) WHERE k <> 2 AND (ff IS NULL OR before < ff)),
vars AS (SELECT DISTINCT Variable FROM r WHERE k <> 2)
SELECT l_orderkey, l_linenumber, """ + ", ".join(
    f"CASE WHEN '{c}' NOT IN (SELECT Variable FROM vars) OR {c} IS NULL THEN {c} "
    f"WHEN {c} IN (SELECT value FROM kept WHERE Variable = '{c}') THEN {c} ELSE 'Other' END AS {c}"
    for c in _RARE_COLS) + " FROM line_facts"


@query("D17_rare_to_other", _RARE_SQL)
def d17(fx):
    """Rare categories folded into 'Other' (80 % cumulative / 5 % share)."""
    df = fx.line_facts.select("l_orderkey", "l_linenumber", *_RARE_COLS)
    return FT.rare_transform(df, FT.rare_fit(df, _RARE_COLS), _RARE_COLS)


@query("D18_group_mean_fill", """
SELECT ANO_MES, ID_CLIENTE_ANON, round(coalesce(QTD_ANOS_ANTIG_CLIENTE, g.m), 10) AS QTD_ANOS_ANTIG_CLIENTE
FROM customer_snap s LEFT JOIN (SELECT coalesce(IND_PSIN_PCOL_ENI, 'INDETERMINADO') AS k, avg(QTD_ANOS_ANTIG_CLIENTE) AS m
                                FROM customer_snap GROUP BY 1) g ON coalesce(s.IND_PSIN_PCOL_ENI, 'INDETERMINADO') = g.k""")
def d18(fx):
    """Missing tenure filled by the mean tenure of the person type."""
    s = fx.customer_snap.select("ANO_MES", "ID_CLIENTE_ANON", "IND_PSIN_PCOL_ENI", "QTD_ANOS_ANTIG_CLIENTE")
    st = FT.group_mean_fit(s, "QTD_ANOS_ANTIG_CLIENTE", "IND_PSIN_PCOL_ENI")
    out = FT.group_mean_transform(s, st, "QTD_ANOS_ANTIG_CLIENTE", "IND_PSIN_PCOL_ENI")
    return out.withColumn("QTD_ANOS_ANTIG_CLIENTE", F.round("QTD_ANOS_ANTIG_CLIENTE", 10))


@query("D19_median_mode_fill", """
SELECT l_orderkey, l_linenumber, coalesce(l_tax, (SELECT quantile_cont(l_tax, 0.5) FROM line_nulls)) AS l_tax,
  coalesce(p_brand, (SELECT arg_min(p_brand, struct_pack(nc := -c, v := p_brand)) FROM
            (SELECT p_brand, count(*) AS c FROM line_nulls WHERE p_brand IS NOT NULL GROUP BY p_brand))) AS p_brand
FROM line_nulls""")
def d19(fx):
    """Median fill of tax, mode fill of brand."""
    df = fx.line_nulls.select("l_orderkey", "l_linenumber", "l_tax", "p_brand")
    return FT.median_mode_transform(df, FT.median_mode_fit(df, ["l_tax"], ["p_brand"]))


@query("D20_constant_fill", """
SELECT l_orderkey, l_linenumber, coalesce(l_tax, -99999) AS l_tax, coalesce(p_brand, 'missing') AS p_brand
FROM line_nulls""")
def d20(fx):
    """Sentinel fill: -99999 numeric, 'missing' text."""
    return FT.constant_fill(fx.line_nulls.select("l_orderkey", "l_linenumber", "l_tax", "p_brand"))


_REC = [f"QTD_APL_REC_{b}" for b in LOBS]


@query("D21_lob_others", "SELECT ID, " + " + ".join(
    f"CASE WHEN (SELECT avg(CASE WHEN {c} <> 0 OR {c} IS NULL THEN 1.0 ELSE 0.0 END) FROM wide_lob) < 0.34 "
    f"THEN coalesce(CAST({c} AS DOUBLE), 0.0) ELSE 0.0 END" for c in _REC) + " AS QTD_APL_REC_OTHERS FROM wide_lob")
def d21(fx):
    """Lines held by < 34 % of customers folded into QTD_APL_REC_OTHERS."""
    w = fx.wide_lob
    groups = FT.lob_others_fit(w, threshold=0.34)
    return FT.lob_others_transform(w, groups).select("ID", *groups.keys())


@query("D22_count_to_flag", "SELECT ID, " + ", ".join(
    [f"QTD_APL_VIG_T_{b}" for b in LOBS] + [f"CAST({c} > 0 AS INTEGER) AS {c.replace('QTD_', 'FLG_')}" for c in _REC])
       + " FROM wide_lob")
def d22(fx):
    """Mostly-zero counts turned into 0/1 flags."""
    w = fx.wide_lob.select("ID", *[f"QTD_APL_VIG_T_{b}" for b in LOBS], *_REC)
    return FT.count_to_flag_transform(w, FT.count_to_flag_fit(w))


_QB = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size"]
P7 = "[" + ", ".join(repr(i / 7) for i in range(8)) + "]"


@query("D23_quantile_bin", f"""
WITH e AS (SELECT {', '.join(f"list_sort(list_distinct(quantile_cont(CAST({c} AS DOUBLE), {P7}))) AS e_{c}" for c in _QB)}
           FROM line_facts)
SELECT l_orderkey, l_linenumber, """ + ", ".join(
    f"CAST(greatest(1, least(len(e_{c}) - 1, len(list_filter(e_{c}, lambda v: v < {c})))) - 1 AS INTEGER) AS {c}"
    for c in _QB) + " FROM line_facts, e")
def d23(fx):
    """7-quantile bins (0-based labels) of numerics with > 7 distinct values."""
    df = stored(fx.line_facts.select("l_orderkey", "l_linenumber", *_QB), "lines")
    return FT.quantile_bin_transform(df, FT.quantile_bin_fit(df, _QB, 7))


_VAL = [f"VAL_PCA_{b}" for b in LOBS]
_CNT = [f"QTD_APL_VIG_T_{b}" for b in LOBS]


def _clip_iqr_sql(c):
    return (f"least(greatest({c}, (SELECT q1 - 1.5 * (q3 - q1) FROM b_{c})), (SELECT q3 + 1.5 * (q3 - q1) FROM b_{c})) "
            f"AS {c}")


def _clip_cnt_cte(c):
    return f"""vc_{c} AS (SELECT CAST({c} AS DOUBLE) AS k, count(*) AS o FROM wide_lob WHERE {c} IS NOT NULL GROUP BY 1),
st_{c} AS (SELECT sum(k * o) / sum(o) AS mu, sum(o) AS n FROM vc_{c}),
ch_{c} AS (SELECT sum(pow(o - (CASE WHEN k = floor(k) THEN exp(k * ln(mu) - mu - lgamma(k + 1)) ELSE 0 END) * n, 2) / o) AS cp,
                  sum(pow(o - (CASE WHEN k >= 0 THEN (1 / mu) * exp(-k / mu) ELSE 0 END) * n, 2) / o) AS ce
           FROM vc_{c}, st_{c}),
pp_{c} AS (SELECT min(k) AS ppf FROM (SELECT k, sum(exp(k * ln(mu) - mu - lgamma(k + 1))) OVER (ORDER BY k) AS cdf
                                      FROM (SELECT CAST(range AS DOUBLE) AS k FROM range(0, 100000)), st_{c})
           WHERE cdf >= 0.99 - 1e-12),
ub_{c} AS (SELECT CASE WHEN cp < ce THEN (SELECT ppf FROM pp_{c}) ELSE -mu * ln(0.01) END AS ub FROM ch_{c}, st_{c})"""


@query("D24_clip_outliers", "WITH " + ",\n".join(
    [f"b_{c} AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM wide_lob)" for c in _VAL]
    + [_clip_cnt_cte(c) for c in _CNT]) + "\nSELECT ID, " + ", ".join(
    [f"round({_clip_iqr_sql(c)[:-len(c) - 4]}, 6) AS {c}" for c in _VAL]
    + [f"round(CASE WHEN {c} > (SELECT ub FROM ub_{c}) THEN (SELECT ub FROM ub_{c}) ELSE {c} END, 6) AS {c}" for c in _CNT])
       + " FROM wide_lob")
def d24(fx):
    """Outlier caps: IQR fences for amounts, best of Poisson / exponential 99 %
    quantile for non-negative counts."""
    w = fx.wide_lob.select("ID", *_VAL, *_CNT)
    out = FT.clip_transform(w, FT.clip_fit(w, _VAL + _CNT))
    return out.select("ID", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in _VAL + _CNT])


_NC_COLS = ["l_linestatus", "p_type", "o_orderpriority", "r_name", "l_discount", "l_tax", "SMALL_QTY"]


@query("D25_drop_near_constant", f"""
WITH t AS (SELECT 1 - avg(TARGET) / 2 AS thr, count(*) AS n FROM line_facts),
f AS (SELECT *, CASE WHEN l_quantity <= 45 THEN 'small' ELSE 'big' END AS SMALL_QTY FROM line_facts),
top AS ({_u([f"SELECT '{c}' AS Variable, max(c) AS TOP_COUNT FROM (SELECT count(*) AS c FROM f WHERE {c} IS NOT NULL GROUP BY {c})" for c in _NC_COLS])})
SELECT Variable, TOP_COUNT, TOP_COUNT / n < thr AS KEEP FROM top, t""")
def d25(fx):
    """Columns kept because their top value share < 1 - base/2."""
    df = fx.line_facts.withColumn("SMALL_QTY", F.when(F.col("l_quantity") <= 45, "small").otherwise("big"))
    keep = set(FT.near_constant_fit(df.select("TARGET", *_NC_COLS)))
    from ..operators.profile import top_value_share
    top = top_value_share(df, _NC_COLS)
    return top.select("Variable", "TOP_COUNT", F.col("Variable").isin(list(keep)).alias("KEEP"))


_SC = ["l_quantity", "l_extendedprice", "l_discount"]


@query("D26_standard_scale", "WITH st AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SC) + " FROM line_facts) SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in _SC) + " FROM line_facts, st")
def d26(fx):
    """z-scores with the population standard deviation."""
    df = fx.line_facts.select("l_orderkey", "l_linenumber", *_SC)
    out = FT.standard_scale_transform(df, FT.standard_scale_fit(df, _SC))
    return out.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in _SC])


_AGE_SQL = ("CASE WHEN QTD_IDADE >= 18 AND QTD_IDADE < 25 THEN '18-24' WHEN QTD_IDADE >= 25 AND QTD_IDADE < 35 THEN '25-34' "
            "WHEN QTD_IDADE >= 35 AND QTD_IDADE < 45 THEN '35-44' WHEN QTD_IDADE >= 45 AND QTD_IDADE < 55 THEN '45-54' "
            "WHEN QTD_IDADE >= 55 AND QTD_IDADE < 65 THEN '55-64' WHEN QTD_IDADE >= 65 AND QTD_IDADE < 80 THEN '65+' END")


@query("D27_age_band", f"SELECT ANO_MES, ID_CLIENTE_ANON, QTD_IDADE, {_AGE_SQL} AS Age_Group FROM customer_snap")
def d27(fx):
    """Age bands (left-closed; >= 80 -> null)."""
    return D.age_band(fx.customer_snap.select("ANO_MES", "ID_CLIENTE_ANON", "QTD_IDADE"))


@query("D28_row_total", "SELECT ID, " + " + ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0)" for c in _CNT)
       + " AS Total_Policies FROM wide_lob")
def d28(fx):
    """Total policies in force across lines."""
    return D.row_total(fx.wide_lob, "QTD_APL_VIG").select("ID", "Total_Policies")


P4 = "[0.0, 0.25, 0.5, 0.75, 1.0]"


@query("D29_quantile_segment", f"""
WITH e AS (SELECT list_sort(list_distinct(quantile_cont(VAL_SALDO, {P4}))) AS e FROM wide_lob)
SELECT ID, VAL_SALDO, CASE WHEN VAL_SALDO IS NULL THEN NULL ELSE
  ['Low', 'Medium', 'High', 'Premium'][greatest(1, least(len(e) - 1, len(list_filter(e, lambda v: v < VAL_SALDO))))]
  END AS CLV_Segment FROM wide_lob, e""")
def d29(fx):
    """Balance quartile segments Low / Medium / High / Premium."""
    return D.quantile_segment(fx.wide_lob.select("ID", "VAL_SALDO"), "VAL_SALDO", "CLV_Segment")


@query("D30_score_sum", "SELECT ID, VAL_SALDO + VAL_PCA_AUTO AS Financial_Health_Score FROM wide_lob")
def d30(fx):
    """Sum of two scores (null-propagating)."""
    return D.score_sum(fx.wide_lob, "VAL_SALDO", "VAL_PCA_AUTO").select("ID", "Financial_Health_Score")


_DIG = " + ".join(f"coalesce(CAST(IND_LOGIN_{t} AS DOUBLE), 0.0)" for t in ET)


@query("D31_digital_segment", f"""
SELECT ID, {_DIG} AS Digital_Channels_Count,
  CASE WHEN {_DIG} = 0 THEN 'No_Digital' WHEN {_DIG} <= 2 THEN 'Low_Digital' WHEN {_DIG} <= 4 THEN 'Medium_Digital'
       ELSE 'High_Digital' END AS Digital_Engagement FROM digital""")
def d31(fx):
    """Digital channels used and the engagement segment."""
    return D.digital_segment(fx.digital).select("ID", "Digital_Channels_Count", "Digital_Engagement")


@query("D32_recency_segment", """
SELECT ID, CASE WHEN r > -1 AND r <= 30 THEN 'Very_Recent' WHEN r > 30 AND r <= 90 THEN 'Recent'
  WHEN r > 90 AND r <= 180 THEN 'Moderate' WHEN r > 180 AND r <= 360 THEN 'Old' WHEN r > 360 AND r <= 999 THEN 'Very_Old'
  END AS App_Recency_Segment FROM (SELECT ID, coalesce(QT_DAYS_LAST_LOGIN_PURCHASE, 999) AS r FROM digital)""")
def d32(fx):
    """Recency segments of the last purchase event (never -> 999)."""
    return D.recency_segment(fx.digital, "QT_DAYS_LAST_LOGIN_PURCHASE").select("ID", "App_Recency_Segment")


@query("D33_product_diversity", "SELECT ID, " + " + ".join(
    f"coalesce(CAST({c} > 0 AS INTEGER), 0)" for c in _REC) + " AS Product_Diversity, greatest("
       + ", ".join(_REC) + ") / (" + " + ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0)" for c in _REC)
       + " + 0.01) AS Product_Concentration FROM wide_lob")
def d33(fx):
    """Number of recent lines held and portfolio concentration."""
    return D.product_diversity(fx.wide_lob, _REC).select("ID", "Product_Diversity", "Product_Concentration")


_LC_SQL = """
SELECT w.ID, coalesce(w.QTD_MESES_ULT_COMPRA_AUTO, 999) AS Recent_Purchase_Activity,
  CASE WHEN coalesce(s.QTD_ANOS_ANTIG_CLIENTE < 2, false) THEN 'New_Customer'
       WHEN coalesce(w.QTD_MESES_ULT_COMPRA_AUTO, 999) <= 6 THEN 'Active_Customer'
       WHEN coalesce(w.QTD_MESES_ULT_COMPRA_AUTO, 999) <= 24 THEN 'Moderate_Customer' ELSE 'Dormant_Customer' END
    AS Lifecycle_Stage
FROM wide_lob w LEFT JOIN (SELECT * FROM customer_snap WHERE ANO_MES = (SELECT M FROM last_month)) s ON s.ID_CLIENTE_ANON = w.ID"""


def _lc_input(fx):
    s = fx.customer_snap.where(F.col("ANO_MES") == fx.span[1]).select(F.col("ID_CLIENTE_ANON").alias("ID"),
                                                                  "QTD_ANOS_ANTIG_CLIENTE", "QTD_IDADE")
    return fx.wide_lob.join(s, "ID", "left").withColumn("QTD_MESES_ULT_COMPRA_APL", F.col("QTD_MESES_ULT_COMPRA_AUTO"))


@query("D34_lifecycle_stage", _LC_SQL)
def d34(fx):
    """Lifecycle stage from tenure and months since the last purchase."""
    return D.lifecycle_stage(_lc_input(fx)).select("ID", "Recent_Purchase_Activity", "Lifecycle_Stage")


@query("D35_segment_conversion", """
SELECT c_mktsegment, count(TARGET) AS Customers, CAST(sum(TARGET) AS BIGINT) AS Buyers,
       round(avg(CAST(TARGET AS DOUBLE)), 4) AS Conversion_Rate
FROM line_facts GROUP BY c_mktsegment HAVING count(TARGET) >= 100
ORDER BY Conversion_Rate DESC, c_mktsegment LIMIT 3""")
def d35(fx):
    """Top-3 converting market segments (>= 100 lines)."""
    return D.segment_conversion(fx.line_facts, "c_mktsegment", min_count=100, top=3)


@query("D36_rate_encode", """
WITH r AS (SELECT n_name, round(avg(CAST(TARGET AS DOUBLE)), 4) AS rate FROM line_facts GROUP BY n_name
           HAVING count(TARGET) >= 2400)
SELECT l_orderkey, l_linenumber, n_name, coalesce(r.rate, (SELECT avg(CAST(TARGET AS DOUBLE)) FROM line_facts))
  AS District_Performance FROM line_facts LEFT JOIN r USING (n_name)""")
def d36(fx):
    """Nation conversion rate for nations with >= 2400 lines, else the mean."""
    df = fx.line_facts.select("l_orderkey", "l_linenumber", "n_name", "TARGET")
    state = FT.rate_encode_fit(df, "n_name", min_count=2400)
    return FT.rate_encode_transform(df.drop("TARGET"), state, "n_name")


def _eda_customer(fx):
    """Customer-level EDA table: age band, digital segment, balance segment,
    product diversity, lifecycle, financial score (D27-D34 composed)."""
    base = _lc_input(fx)
    dig = D.digital_segment(fx.digital).select("ID", "Digital_Channels_Count", "Digital_Engagement")
    df = base.join(dig, "ID", "left").withColumn("Digital_Channels_Count",
                                                 F.coalesce("Digital_Channels_Count", F.lit(0.0)))
    df = df.withColumn("Digital_Engagement", F.coalesce("Digital_Engagement", F.lit("No_Digital")))
    df = D.age_band(df)
    df = D.quantile_segment(df, "VAL_SALDO", "CLV_Segment")
    df = D.product_diversity(df, _REC)
    df = D.lifecycle_stage(df)
    df = D.score_sum(df, "VAL_SALDO", "VAL_PCA_AUTO")
    return D.interactions(df)


_EDA_SQL = f"""
WITH s AS (SELECT ID_CLIENTE_ANON AS ID, QTD_ANOS_ANTIG_CLIENTE, QTD_IDADE FROM customer_snap WHERE ANO_MES = (SELECT M FROM last_month)),
dg AS (SELECT ID, {_DIG} AS dc FROM digital),
e AS (SELECT list_sort(list_distinct(quantile_cont(VAL_SALDO, {P4}))) AS e FROM wide_lob),
b AS (SELECT w.ID, w.TARGET, s.QTD_IDADE, s.QTD_ANOS_ANTIG_CLIENTE, coalesce(dg.dc, 0.0) AS dc,
        w.VAL_SALDO + w.VAL_PCA_AUTO AS fin,
        {' + '.join(f'coalesce(CAST(w.{c} > 0 AS INTEGER), 0)' for c in _REC)} AS div,
        coalesce(w.QTD_MESES_ULT_COMPRA_AUTO, 999) AS rec,
        ['Low', 'Medium', 'High', 'Premium'][greatest(1, least(len(e) - 1, len(list_filter(e, lambda v: v < w.VAL_SALDO))))]
          AS clv
      FROM wide_lob w LEFT JOIN s ON s.ID = w.ID LEFT JOIN dg ON dg.ID = w.ID, e),
f AS (SELECT *, CASE WHEN dc = 0 THEN 'No_Digital' WHEN dc <= 2 THEN 'Low_Digital' WHEN dc <= 4 THEN 'Medium_Digital'
                     ELSE 'High_Digital' END AS de,
             {_AGE_SQL} AS ag,
             CASE WHEN coalesce(QTD_ANOS_ANTIG_CLIENTE < 2, false) THEN 'New_Customer' WHEN rec <= 6 THEN 'Active_Customer'
                  WHEN rec <= 24 THEN 'Moderate_Customer' ELSE 'Dormant_Customer' END AS lc FROM b)
SELECT ID, QTD_IDADE * dc AS Age_Digital_Score, fin * div AS Financial_Product_Score,
  QTD_ANOS_ANTIG_CLIENTE / (rec + 1) AS Tenure_Activity_Ratio,
  CAST(coalesce(de = 'High_Digital' AND clv = 'Premium', false) AS INTEGER) AS High_Value_Digital,
  CAST(coalesce(ag = '18-24' AND lc = 'Active_Customer', false) AS INTEGER) AS Young_Active_Customer
FROM f"""


@query("D37_interactions", _EDA_SQL)
def d37(fx):
    """Interaction features of the customer EDA table."""
    df = _eda_customer(fx)
    return df.select("ID", "Age_Digital_Score", "Financial_Product_Score", "Tenure_Activity_Ratio",
                     F.coalesce("High_Value_Digital", F.lit(0)).alias("High_Value_Digital"),
                     F.coalesce("Young_Active_Customer", F.lit(0)).alias("Young_Active_Customer"))


@query("D37_interaction_correlations", f"""
WITH x AS ({_EDA_SQL.replace("SELECT ID, QTD_IDADE", "SELECT ID, TARGET, QTD_IDADE")})
SELECT * FROM (VALUES ('Age_Digital_Score', (SELECT round(corr(Age_Digital_Score, TARGET), 9) FROM x)),
  ('Financial_Product_Score', (SELECT round(corr(Financial_Product_Score, TARGET), 9) FROM x)),
  ('Tenure_Activity_Ratio', (SELECT round(corr(Tenure_Activity_Ratio, TARGET), 9) FROM x)),
  ('High_Value_Digital', (SELECT round(corr(High_Value_Digital, TARGET), 9) FROM x)),
  ('Young_Active_Customer', (SELECT round(corr(Young_Active_Customer, TARGET), 9) FROM x))) t(feature, correlation)""")
def d37c(fx):
    """Correlation of each interaction feature with the target."""
    df = _eda_customer(fx).withColumns({c: F.coalesce(c, F.lit(0)) for c in ("High_Value_Digital",
                                                                            "Young_Active_Customer")})
    feats = ["Age_Digital_Score", "Financial_Product_Score", "Tenure_Activity_Ratio", "High_Value_Digital",
             "Young_Active_Customer"]
    row = df.agg(*[F.round(F.corr(F.col(f).cast("double"), F.col("TARGET").cast("double")), 9).alias(f)
                   for f in feats])
    return row.unpivot([], feats, "feature", "correlation")


_DIMS = ["c_mktsegment", "r_name", "o_orderpriority", "p_type"]


@query("D38_best_segments", "SELECT Dimension, Segment, Customers, Buyers, Conversion_Rate FROM (" + _u(
    [f"SELECT '{d}' AS Dimension, CAST({d} AS VARCHAR) AS Segment, count(TARGET) AS Customers, "
     f"CAST(sum(TARGET) AS BIGINT) AS Buyers, round(avg(CAST(TARGET AS DOUBLE)), 4) AS Conversion_Rate "
     f"FROM line_facts GROUP BY {d}" for d in _DIMS])
       + ") QUALIFY row_number() OVER (PARTITION BY Dimension ORDER BY Conversion_Rate DESC, Customers, Segment DESC) = 1")
def d38(fx):
    """Best converting segment of each dimension."""
    return D.best_segments(fx.line_facts, _DIMS)


_FAM = {"VAL_S": ["VAL_SALDO"], "QTD_A": [f"{p}_{b}" for p in ("QTD_APL_VIG_T", "QTD_APL_REC") for b in LOBS],
        "VAL_P": [f"VAL_PCA_{b}" for b in LOBS], "QTD_M": [f"QTD_MESES_ULT_COMPRA_{b}" for b in LOBS]}
_FAM_COLS = [c for cols in _FAM.values() for c in cols]
_Z = 1.959963984540054          # two-sided 5 % of the normal curve, widened below to that of t with n - 2 degrees
_FAM_SQL = f"""
t AS (SELECT CAST(TARGET AS DOUBLE) AS y, """ + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM wide_lob)) AS {c}"
    for c in _FAM_COLS) + f""" FROM wide_lob),
m AS (SELECT *, abs(r) >= 0.02 AND abs(r) * sqrt((n - 2) / (1 - r * r)) >
        {_Z} + {_Z ** 3 + _Z} / (4 * (n - 2)) + {5 * _Z ** 5 + 16 * _Z ** 3 + 3 * _Z} / (96 * (n - 2) * (n - 2)) AS sig
      FROM ({_u([f"SELECT '{f}' AS family, '{c}' AS v, coalesce(corr({c}, y), 0) AS r, count(*) AS n FROM t"
                 for f, cols in _FAM.items() for c in cols])})),
p AS ({_u([f"SELECT '{f}' AS family, '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM t"
           for f, cols in _FAM.items() for i, a in enumerate(cols) for b in cols[i + 1:]])}),
g AS (SELECT p.family, avg(coalesce(p.r, 0)) AS avg_r FROM p JOIN m x ON x.v = p.a AND x.sig JOIN m z ON z.v = p.b AND z.sig
      GROUP BY p.family),
w AS (SELECT m.family, v, r, abs(r) / sum(abs(r)) OVER (PARTITION BY m.family) AS w FROM m JOIN g ON g.family = m.family
      WHERE sig AND avg_r >= 0.3),
x AS (SELECT y, {', '.join(f"({' + '.join(f'{c} * coalesce((SELECT w FROM w WHERE v = {chr(39)}{c}{chr(39)}), 0)' for c in cols)}) AS {f}_agg"
                            for f, cols in _FAM.items() if len(cols) > 1)} FROM t),
k AS (SELECT o.family, o.r, best FROM ({_u([f"SELECT '{f}' AS family, corr({f}_agg, y) AS r FROM x"
                                             for f, cols in _FAM.items() if len(cols) > 1])}) o
      JOIN (SELECT family, max(abs(r)) AS best FROM w GROUP BY family) USING (family))"""


def _families(fx):
    clean = FM.clean_columns(cut_lineage(fx.wide_lob.drop("ID", "NATION")))
    of = FM.members(clean, "TARGET", 0.02)
    return clean, of, FM.coherence(clean, of)


@query("D39_correlated_group_aggregate", f"""WITH {_FAM_SQL.strip()}
SELECT g.family, n_features, round(avg_r, 8) AS avg_inter_correlation, avg_r >= 0.3 AS is_coherent
FROM g JOIN (SELECT family, count(*) AS n_features FROM m WHERE sig GROUP BY family) USING (family)""")
def d39(fx):
    """Coherence of the significant members of each family of the wide
    customer table."""
    return _families(fx)[2].withColumn("avg_inter_correlation", F.round("avg_inter_correlation", 8))


@query("D40_aggregate_retention", f"""WITH {_FAM_SQL.strip()}
SELECT family || '_agg' AS feature, round(r, 8) AS correlation, round(abs(r) / best * 100, 6) AS signal_retention,
  abs(r) > best AS improved, abs(r) / best * 100 >= 80 AS effective FROM k""")
def d40(fx):
    """Signal retention of the family aggregates versus their best member."""
    clean, of, analysis = _families(fx)
    weight = FM.weights(of, analysis)
    out = FM.aggregate_retention(FM.add_aggregates(clean, weight), weight)
    return out.withColumns({"correlation": F.round("correlation", 8), "signal_retention": F.round("signal_retention", 6)})


@query("D41_auto_feature_set", f"""WITH {_FAM_SQL.strip()},
good AS (SELECT family FROM k WHERE abs(r) / best * 100 >= 80)
SELECT v AS feature, round(r, 8) AS correlation FROM m
WHERE sig AND v NOT IN (SELECT v FROM w WHERE family IN (SELECT family FROM good))
UNION ALL
SELECT family || '_agg', round(r, 8) FROM k WHERE family IN (SELECT family FROM good)""")
def d41(fx):
    """End-to-end automatic feature aggregation of the wide customer table:
    the columns of the result and their correlation with the target."""
    out = FM.auto_feature_set(cut_lineage(fx.wide_lob.drop("ID", "NATION")), "TARGET", 0.02)
    r = wide_agg(out, {c: F.corr(F.col(c).cast("double"), F.col("TARGET").cast("double"))
                       for c in out.columns if c != "TARGET"})
    return fx.spark.createDataFrame([(c, x) for c, x in r.items()], "feature string, correlation double").withColumn(
        "correlation", F.round("correlation", 8))


@query("D42_one_hot", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"CAST(coalesce(o_orderpriority = '{v}', false) AS INTEGER) AS \"o_orderpriority_{v}\""
    for v in sorted(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])) + " FROM line_facts")
def d42(fx):
    """One-hot dummies of the order priority."""
    df = fx.line_facts.select("l_orderkey", "l_linenumber", "o_orderpriority")
    return D.one_hot(df, "o_orderpriority", D.one_hot_labels(df, "o_orderpriority"))


@query("D43_categorical_features", f"""
WITH g AS (SELECT avg(CAST(TARGET AS DOUBLE)) AS gm, var_pop(CAST(TARGET AS DOUBLE)) AS gv FROM line_facts),
e AS (SELECT p_brand AS category, count(*) AS n, avg(CAST(TARGET AS DOUBLE)) AS m, var_pop(CAST(TARGET AS DOUBLE)) AS v
      FROM line_facts GROUP BY p_brand),
enc AS (SELECT category, coalesce((gv * n / nullif(gv * n + v, 0)) * m + (1 - gv * n / nullif(gv * n + v, 0)) * gm, gm)
          AS ENCODING FROM e, g)
SELECT l_orderkey, l_linenumber, TARGET, CAST(list_position({_PRIO}, o_orderpriority) - 1 AS DOUBLE) AS o_orderpriority,
  round(ENCODING, 10) AS p_brand, """ + ", ".join(
    f"CAST(coalesce(c_mktsegment = '{v}', false) AS INTEGER) AS \"c_mktsegment_{v}\""
    for v in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")) + """
FROM line_facts LEFT JOIN enc ON category IS NOT DISTINCT FROM p_brand""")
def d43(fx):
    """Categorical stage: ordinal priority, target-encoded brand (high
    cardinality), one-hot segment."""
    df = fx.line_facts.select("l_orderkey", "l_linenumber", "TARGET", "o_orderpriority", "p_brand", "c_mktsegment")
    return FT.categorical_features(df, ["p_brand", "c_mktsegment"], "TARGET", {"o_orderpriority": _PRIO},
                                   encoded=["p_brand"]).withColumn("p_brand", F.round("p_brand", 10))


def _d43_scaled(c):
    med = f"(SELECT quantile_cont({c}, 0.5) FROM line_nulls)"
    x = f"coalesce({c}, {med})"
    return (f"round(({x} - (SELECT avg({x}) FROM line_nulls)) / nullif((SELECT stddev_pop({x}) FROM line_nulls), 0), 8) "
            f"AS {c}")


@query("D43_impute_and_scale", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    _d43_scaled(c) for c in ("l_tax", "l_quantity", "PERC_DISC"))
       + ", CAST(l_tax IS NULL AS INTEGER) AS FLG_MISSING_l_tax FROM line_nulls")
def d43b(fx):
    """Imputation stage: missing flags above 10 %, median fill, standardisation."""
    df = stored(fx.line_nulls.select("l_orderkey", "l_linenumber", "l_tax", "l_quantity", "PERC_DISC"), "lines")
    out = FT.impute_and_scale(df, ["l_tax", "l_quantity", "PERC_DISC"], high_missing=0.1, scaling="standardization")
    return out.withColumns({c: F.round(c, 8) for c in ("l_tax", "l_quantity", "PERC_DISC")})


def edges_of(columns):
    """Derivation edges of the trailing-sum columns in a schema: each
    ``p_U{m}M`` derives from the previous window and the extra months."""
    edges = []
    for c in columns:
        if c.endswith("M") and "_U" in c:
            p, u = c.rsplit("_U", 1)
            m = int(u[:-1])
            prev = [x for x in (2, 5) if x < m]
            if prev and f"{p}_U{prev[-1]}M" in columns:
                edges.append((c, f"{p}_U{prev[-1]}M", "TrailingSums"))
                edges += [(c, f"{p}_M{k}", "TrailingSums") for k in range(prev[-1] + 1, m + 1)]
            else:
                edges += [(c, f"{p}_M{k}", "TrailingSums") for k in range(m + 1)]
    edges.append(("FLG_DIGITAL_HIGH", "Digital_Channels_Count", "Segment"))
    edges.append(("Digital_Channels_Count", "IND_LOGIN_CLICK", "ChannelsCount"))
    return edges


def lineage_edges(fx):
    """Edges produced by D9 on the monthly table, read from the derived
    schema (so they follow the data)."""
    return edges_of(D.trailing_sums(fx.cust_month, drop_months=False).columns)


# the D9 output schema of the monthly table, for the SQL twin's edge list
_D9_COLS = (["ID", "ANO_MES"] + [f"{p}_M{k}" for p in ("QTD_ORD", "VAL_SPEND") for k in range(12)]
            + [f"DSC_BUY_M{k}" for k in range(12)] + [f"{p}_U{m}M" for p in ("QTD_ORD", "VAL_SPEND") for m in (2, 5, 11)])
_EDGE_VALUES = ", ".join(f"('{a}', '{b}', '{s}')" for a, b, s in edges_of(_D9_COLS))


@query("D44_feature_lineage", f"""
WITH RECURSIVE e(feature, parent, step) AS (VALUES {_EDGE_VALUES}),
r(feature, node, path, depth) AS (
  SELECT feature, parent, step, 1 FROM e
  UNION ALL
  SELECT r.feature, e.parent, r.path || ' > ' || e.step, r.depth + 1 FROM r JOIN e ON e.feature = r.node)
SELECT DISTINCT feature, node AS origin, path, depth, v.n AS N_NONZERO
FROM r LEFT JOIN ({_u([f"SELECT '{c}' AS c, count(*) FILTER ({c} <> 0) AS n FROM cust_month" for c in _D9_COLS
                       if c.startswith(("QTD_ORD_M", "VAL_SPEND_M"))])}) v ON v.c = r.node
WHERE node NOT IN (SELECT feature FROM e)""")
def d44(fx):
    """Derived features traced back to their original columns, with the number
    of rows in which the original is not zero (null for columns of other
    tables)."""
    e = fx.spark.createDataFrame(lineage_edges(fx), "feature string, parent string, step string")
    months = [c for c in fx.cust_month.columns if c.startswith(("QTD_ORD_M", "VAL_SPEND_M"))]
    used = wide_agg(fx.cust_month, {c: F.count_if(F.col(c) != 0) for c in months})
    counts = fx.spark.createDataFrame(list(used.items()), "origin string, N_NONZERO long")
    return expand_lineage(e).join(counts, "origin", "left").select("feature", "origin", "path", "depth", "N_NONZERO")


_D13_IN_COLS = (["ID", "DSC_SEGMENTO", "VAL_SALDO", "NATION"]
                + [c for b in LOBS for c in (f"QTD_APL_VIG_T_{b}", f"VAL_PCA_{b}", f"DSC_HAS_{b}",
                                             f"QTD_MESES_ULT_COMPRA_{b}", f"QTD_APL_REC_{b}")]
                + ["TARGET", "COD_NATION", "DSC_NVL50_HIER_COM", "OD_SALDO", "DSC_PAIS", "FLG_HALF",
                   "VAL_CUSTO_SIN_EX_ABR", "QTD_EMPTY"])
_D13_IN_SQL = """(SELECT *, NATION AS COD_NATION, DSC_SEGMENTO AS DSC_NVL50_HIER_COM, VAL_SALDO AS OD_SALDO,
  'PT' AS DSC_PAIS, CASE WHEN ID % 2 = 0 THEN 1 END AS FLG_HALF, VAL_SALDO AS VAL_CUSTO_SIN_EX_ABR,
  CAST(NULL AS DOUBLE) AS QTD_EMPTY FROM wide_lob)"""
_D13_LISTS = ", ".join(f"'{c}'" for c in FT.IRRELEVANT_COLUMNS + FT.FINANCIAL_PRODUCT_COLUMNS
                       + tuple(f"DSC_NVL{h}_HIER_COM" for h in FT.HIER_LEVELS))
_D13_REPORT_SQL = f"""
WITH d AS {_D13_IN_SQL},
names(name) AS (VALUES {', '.join(f"('{c}')" for c in _D13_IN_COLS)}),
st AS ({_u([f"SELECT '{c}' AS Variable, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS miss, "
            f"coalesce(count({c}) = count(*) AND min(CAST({c} AS VARCHAR)) = max(CAST({c} AS VARCHAR)), false) AS cst "
            f"FROM d" for c in _D13_IN_COLS])})
SELECT Variable, (miss >= 1.0 OR cst OR Variable IN ({_D13_LISTS})
  OR contains(Variable, 'DSC_I_ZONA_SISM_') OR ends_with(Variable, 'MED_PREF') OR ends_with(Variable, 'SIN_ABERT')
  OR starts_with(Variable, 'DSC_NVL') OR starts_with(Variable, 'FLG_NVL') OR starts_with(Variable, 'OD')
  OR (starts_with(Variable, 'COD_') AND EXISTS (SELECT 1 FROM names o WHERE contains(o.name, substr(Variable, 5))
                                                AND NOT starts_with(o.name, 'COD_')))
  OR (ends_with(Variable, '_COD') AND EXISTS (SELECT 1 FROM names o
        WHERE contains(o.name, substr(Variable, 1, length(Variable) - 4)) AND NOT ends_with(o.name, '_COD')))
  ) AS DROPPED
FROM st"""


@query("D13_select_columns_report", _D13_REPORT_SQL)
def d13r(fx):
    """Drop decision of every input column under the selection rules."""
    df = _d13_input(fx)
    drop = set(FT.select_columns_fit(df, missing_threshold=1.0))
    return fx.spark.createDataFrame([(c, c in drop) for c in df.columns], "Variable string, DROPPED boolean")


@query("D16_ordinal_encode_table", """
WITH cats AS (SELECT list(v ORDER BY v) AS l FROM (SELECT DISTINCT coalesce(p_brand, 'INDETERMINADO') AS v
                                                      FROM line_nulls))
SELECT l_orderkey, l_linenumber, CAST(list_position(l, coalesce(p_brand, 'INDETERMINADO')) - 1 AS DOUBLE) AS p_brand,
       CAST(list_position((SELECT list(v ORDER BY v) FROM (SELECT DISTINCT c_mktsegment AS v FROM line_nulls)),
                          c_mktsegment) - 1 AS DOUBLE) AS c_mktsegment
FROM line_nulls, cats""")
def d16t(fx):
    """Ordinal codes from a state table (any number of categories: ranks are
    computed distributed and joined, nothing is listed on the driver)."""
    df = fx.line_nulls.select("l_orderkey", "l_linenumber", "p_brand", "c_mktsegment")
    return FT.ordinal_transform(df, FT.ordinal_fit(df, ["p_brand", "c_mktsegment"]))
