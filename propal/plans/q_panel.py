"""Queries B1-B18: month spines, eligibility, targets, sampling, lagged
feature joins and universe upkeep."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import panel as P
from ..operators.month_table import MonthTable
from ..session import scratch_path
from .catalog import query

PERSON_TYPES = ("BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD")
CUST_PREDICATES = ("QTD_IDADE >= 18", "QTD_ANOS_ANTIG_CLIENTE >= 1")
PRODUCTS = ("1-URGENT", "2-HIGH", "3-MEDIUM")
POLICY_PREDICATES = ("TX_SINISTRALIDADE_TRIENIO < 50",)


def _add_months_sql(c: str, k) -> str:
    idx = f"(floor({c} / 100) * 12 + ({c} % 100 - 1) + ({k}))"
    return f"CAST(floor({idx} / 12) * 100 + {idx} % 12 + 1 AS INTEGER)"


@query("B1_month_spine", """
SELECT CAST(year(d) * 100 + month(d) AS INTEGER) AS ANO_MES
FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)),
                                    INTERVAL 1 MONTH)) AS d FROM orders)""")
def b1(fx):
    """Every month between the first and the last order."""
    return P.month_spine_of(fx.orders, "o_orderdate")


@query("B2_eligible_customers", """
SELECT ANO_MES, ID_CLIENTE_ANON, QTD_IDADE, QTD_ANOS_ANTIG_CLIENTE FROM customer_snap
WHERE IND_PSIN_PCOL_ENI IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY', 'HOUSEHOLD')
  AND FLG_CONFIDENCIALIDADE = 0 AND FLG_EMPREG_FIDEL = 0 AND FLG_INCIDENCIAS = 0 AND FLG_CLIENTE_BLOQUEADO = 0
  AND FLG_FALECIDO = 0 AND FLG_CONTACTO_MKT = 0 AND FLG_CLIENTE_MEDIADOR = 0
  AND QTD_IDADE >= 18 AND QTD_ANOS_ANTIG_CLIENTE >= 1""")
def b2(fx):
    """Eligible customers of every monthly snapshot."""
    e = P.eligible_customers(fx.customer_snap, PERSON_TYPES, CUST_PREDICATES)
    return e.select("ANO_MES", "ID_CLIENTE_ANON", "QTD_IDADE", "QTD_ANOS_ANTIG_CLIENTE")


@query("B3_eligible_policies", """
SELECT ANO_MES, ID_APOLICE, ID_CLIENTE_ANON, CAST(replace(TX_SINISTRALIDADE_TRIENIO, '%', '') AS DOUBLE)
       AS TX_SINISTRALIDADE_TRIENIO
FROM policy_snap
WHERE FLG_APL_EM_VIGOR = 1 AND COD_PRODUTO_CATALOG = 'INDIVIDUAL'
  AND DSC_PRODUTO_SO_APL IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
  AND CAST(replace(TX_SINISTRALIDADE_TRIENIO, '%', '') AS DOUBLE) < 50""")
def b3(fx):
    """In-force individual policies of chosen products with a loss ratio < 50 %."""
    e = P.eligible_policies(fx.policy_snap, PRODUCTS, POLICY_PREDICATES)
    return e.select("ANO_MES", "ID_APOLICE", "ID_CLIENTE_ANON", "TX_SINISTRALIDADE_TRIENIO")


@query("B4_in_force", "SELECT ANO_MES, ID_APOLICE FROM policy_snap WHERE FLG_APL_EM_VIGOR = 1")
def b4a(fx):
    return P.in_force(fx.policy_snap).select("ANO_MES", "ID_APOLICE")


@query("B4_cancelled", "SELECT ANO_MES, ID_APOLICE FROM policy_snap WHERE FLG_APL_ANULADA = 1")
def b4b(fx):
    return P.cancelled(fx.policy_snap).select("ANO_MES", "ID_APOLICE")


@query("B4_cancel_reason",
       "SELECT ID_APOLICE FROM policy_snap WHERE DSC_MOTIVO_ANUL_APL IN ('MOTIVO_1', 'MOTIVO_3')")
def b4c(fx):
    return P.cancel_reason(fx.policy_snap, ["MOTIVO_1", "MOTIVO_3"])


@query("B5_monthly_target", "SELECT * FROM universe")
def b5(fx):
    """Monthly buyers (TARGET=1) and known non-buyers (TARGET=0), all months."""
    return fx.universe


_B6_SQL = """
SELECT * FROM universe WHERE TARGET = 1
UNION ALL
SELECT * FROM universe u WHERE TARGET = 0 AND ID NOT IN (
  SELECT ID FROM universe WHERE TARGET = 1)"""


@query("B6_exclude_general_target1", _B6_SQL)
def b6(fx):
    """Universe without negatives that bought in any month of the window."""
    return P.exclude_general_target1(fx.universe, *fx.span)


_B7_SQL = """
SELECT ANO_MES, ID, TARGET FROM (
  SELECT *, row_number() OVER (ORDER BY md5('0|' || CAST(ID AS VARCHAR)), ID) AS rn
  FROM universe WHERE ANO_MES = 200006 AND TARGET = 0
    AND ID NOT IN (SELECT ID FROM universe WHERE TARGET = 1 AND ANO_MES BETWEEN 200001 AND 200012))
WHERE rn <= 300"""


@query("B7_sample_exact", _B7_SQL)
def b7(fx):
    """300 negatives of 2000-06 not buying in 2000, md5-ordered draw."""
    u = fx.universe
    cand = u.where((F.col("ANO_MES") == 200006) & (F.col("TARGET") == 0))
    excl = u.where((F.col("TARGET") == 1) & F.col("ANO_MES").between(200001, 200012)).select("ID")
    return P.sample_exact(cand, "ID", 300, seed=0, exclude=excl)


def _b8_sql(months):
    n = len(months)
    parts = ["t0 AS (SELECT ANO_MES, ID, md5('0|' || CAST(ID AS VARCHAR)) AS h FROM universe WHERE TARGET = 0)",
             "cnt AS (SELECT ANO_MES, count(*) AS n FROM t0 GROUP BY ANO_MES)"]
    prev = None
    for i, m in enumerate(months):
        excl = f"AND ID NOT IN (SELECT ID FROM acc{i - 1})" if prev else ""
        parts.append(
            f"p{i} AS MATERIALIZED (SELECT ANO_MES, ID FROM (SELECT ANO_MES, ID, row_number() OVER (ORDER BY h, ID) AS rn "
            f"FROM t0 WHERE ANO_MES = {m} {excl}) WHERE rn <= coalesce((SELECT CAST(floor(n / (SELECT count(*) FROM months)) AS BIGINT) "
            f"FROM cnt WHERE ANO_MES = {m}), 0))")
        parts.append(f"acc{i} AS MATERIALIZED (SELECT * FROM p{i}" + (f" UNION ALL SELECT * FROM acc{i - 1})" if prev else ")"))
        prev = True
    return "WITH " + ",\n".join(parts) + f"\nSELECT ANO_MES, ID FROM acc{n - 1}"


# the SQL names a step per month; months without orders give none
_B8_MONTHS = P.months_between_list(199501, 200112)


@query("B8_negatives_without_reuse", _b8_sql(_B8_MONTHS))
def b8(fx):
    """Per month int(N_m / months) negatives, each id used in one month only."""
    t0 = fx.universe.where(F.col("TARGET") == 0).select("ANO_MES", "ID")
    return P.negatives_without_reuse(t0, P.months_between_list(*fx.span), "ID", seed=0)


@query("B9_build_universe", """
SELECT ANO_MES, ID, 1 AS TARGET FROM universe WHERE TARGET = 1
UNION ALL
SELECT ANO_MES, ID, 0 AS TARGET FROM universe WHERE TARGET = 0
  AND ID NOT IN (SELECT ID FROM universe WHERE TARGET = 1)""")
def b9(fx):
    """Universe of all months: buyers plus negatives cleared of general buyers."""
    u = fx.universe
    gp = P.general_positives(u, *fx.span)
    t1 = u.where(F.col("TARGET") == 1)
    t0 = u.where(F.col("TARGET") == 0).join(gp, "ID", "left_anti")
    return P.build_universe(t1, t0)


@query("B10_target_rate_by_month", """
SELECT ANO_MES, count(DISTINCT ID) AS N_IDS, CAST(sum(CASE WHEN TARGET = 0 THEN 1 ELSE 0 END) AS BIGINT) AS N_TARGET0,
       CAST(sum(CASE WHEN TARGET = 1 THEN 1 ELSE 0 END) AS BIGINT) AS N_TARGET1,
       round(avg(CASE WHEN TARGET = 1 THEN 1.0 ELSE 0.0 END) * 100, 4) AS PCT_TARGET1
FROM universe GROUP BY ANO_MES""")
def b10(fx):
    """Universe size and target rate per month."""
    return P.target_rate_by_month(fx.universe)


@query("B11_distinct_ids_with_total", """
SELECT CAST(ANO_MES AS VARCHAR) AS ANO_MES, count(DISTINCT ID) AS N_IDS FROM universe WHERE TARGET = 1 GROUP BY ANO_MES
UNION ALL
SELECT 'TOTAL UNIQUE', count(DISTINCT ID) FROM universe WHERE TARGET = 1""")
def b11(fx):
    """Distinct buyers per month plus the overall distinct count."""
    return P.distinct_ids_with_total(fx.universe.where(F.col("TARGET") == 1))


_B12_SPEND = ["VAL_SPEND_M0", "VAL_SPEND_M1", "QTD_ORD_M0", "DSC_BUY_M0"]


def _b12(fx, snap_cols=None, hist_cols=None):
    snap = fx.customer_snap.withColumnRenamed("ID_CLIENTE_ANON", "ID")
    if snap_cols:
        snap = snap.select("ID", "ANO_MES", *snap_cols)
    cm = fx.cust_month
    hist = cm.select("ID", "ANO_MES", *(hist_cols or [c for c in cm.columns if c not in ("ID", "ANO_MES")]))
    year_ago = cm.select("ID", "ANO_MES", *_B12_SPEND)
    out = P.lagged_feature_join(fx.universe, [
        (snap, ["ID"], 2, "left", ""),
        (hist, ["ID"], 2, "left", ""),
        (year_ago, ["ID"], 14, "left", "_M12"),
    ])
    return P.dim_join(out, fx.geo, "NATION", "left")


_B12_SQL = f"""
SELECT u.*, s.* EXCLUDE (ID_CLIENTE_ANON, ANO_MES), h.* EXCLUDE (ID, ANO_MES),
       y.VAL_SPEND_M0 AS VAL_SPEND_M0_M12, y.VAL_SPEND_M1 AS VAL_SPEND_M1_M12, y.QTD_ORD_M0 AS QTD_ORD_M0_M12,
       y.DSC_BUY_M0 AS DSC_BUY_M0_M12, g.DSC_DISTRITO, g.DSC_NUT2
FROM universe u
LEFT JOIN customer_snap s ON s.ID_CLIENTE_ANON = u.ID AND {_add_months_sql('s.ANO_MES', 2)} = u.ANO_MES
LEFT JOIN cust_month h ON h.ID = u.ID AND {_add_months_sql('h.ANO_MES', 2)} = u.ANO_MES
LEFT JOIN cust_month y ON y.ID = u.ID AND {_add_months_sql('y.ANO_MES', 14)} = u.ANO_MES
LEFT JOIN geo g ON g.NATION = s.NATION"""


@query("B12_lagged_feature_join", _B12_SQL)
def b12(fx):
    """Universe with customer features of M-2, order history of M-2 and the
    year-ago (M-14) history suffixed _M12, plus geography."""
    return _b12(fx)


# --- fixed values: lineage of the selected features (feature, parent, step)
B13_SELECTED = ("VAL_SPEND_U3M", "FLG_SENIOR", "QTD_IDADE", "DSC_DISTRITO")
B13_LINEAGE = (("VAL_SPEND_U3M", "VAL_SPEND_U2M", "TrailingSums"), ("VAL_SPEND_U2M", "VAL_SPEND_M0", "TrailingSums"),
               ("VAL_SPEND_U2M", "VAL_SPEND_M1", "TrailingSums"), ("VAL_SPEND_U2M", "VAL_SPEND_M2", "TrailingSums"),
               ("VAL_SPEND_U3M", "VAL_SPEND_M3", "TrailingSums"), ("FLG_SENIOR", "QTD_IDADE", "AgeFlag"))


@query("B13_eligibles_feature_join", f"""
SELECT e.ANO_MES, e.ID_CLIENTE_ANON AS ID, s.QTD_IDADE, h.VAL_SPEND_M0, h.VAL_SPEND_M1, h.VAL_SPEND_M2,
       h.VAL_SPEND_M3, g.DSC_DISTRITO
FROM customer_snap e
LEFT JOIN customer_snap s ON s.ID_CLIENTE_ANON = e.ID_CLIENTE_ANON AND {_add_months_sql('s.ANO_MES', 2)} = e.ANO_MES
LEFT JOIN cust_month h ON h.ID = e.ID_CLIENTE_ANON AND {_add_months_sql('h.ANO_MES', 2)} = e.ANO_MES
LEFT JOIN geo g ON g.NATION = e.NATION
WHERE e.ANO_MES = (SELECT M FROM last_month)""")
def b13(fx):
    """Scoring-time join for the last month that fetches only the source columns the
    selected features need (lineage expanded to originals)."""
    from ..operators.lineage import source_columns
    snap = fx.customer_snap.withColumnRenamed("ID_CLIENTE_ANON", "ID")
    lineage = fx.spark.createDataFrame(list(B13_LINEAGE), "feature string, parent string, step string")
    hist = fx.cust_month
    available = set(snap.columns) | set(hist.columns) | set(fx.geo.columns)
    need = source_columns(lineage, list(B13_SELECTED), available)
    base = snap.where(F.col("ANO_MES") == fx.span[1]).select("ANO_MES", "ID", "NATION")
    out = P.lagged_join(base, snap, ["ID"], 2, "left", columns=[c for c in need if c in snap.columns])
    out = P.lagged_join(out, hist, ["ID"], 2, "left", columns=[c for c in need if c in hist.columns])
    out = P.dim_join(out, fx.geo.select("NATION", *[c for c in need if c in fx.geo.columns]), "NATION")
    return out.drop("NATION")


def _hist_new(fx):
    u = fx.universe
    return u.where(F.col("ANO_MES") < fx.span[1]), u.where(F.col("ANO_MES") == fx.span[1])


@query("B14_roll_universe", """
WITH hist AS (SELECT * FROM universe WHERE ANO_MES < (SELECT M FROM last_month) AND ANO_MES > (SELECT M12 FROM last_month)),
new AS (SELECT * FROM universe WHERE ANO_MES = (SELECT M FROM last_month)),
h2 AS (SELECT * FROM hist WHERE NOT (TARGET = 0 AND ID IN (SELECT ID FROM new WHERE TARGET = 1)))
SELECT * FROM h2
UNION ALL
SELECT * FROM new WHERE NOT (TARGET = 0 AND ID IN (SELECT ID FROM h2))""")
def b14(fx):
    """Roll the last month into a 12-month history."""
    hist, new = _hist_new(fx)
    return P.roll_universe(hist, new, fx.span[1], 12)


def _rolled_sql(steps: int) -> str:
    """The last ``steps`` months taken in one after the other, each capped."""
    ctes = [f"h0 AS MATERIALIZED (SELECT ANO_MES, ID, TARGET FROM universe, lm WHERE ANO_MES < {_add_months_sql('M', 1 - steps)})"]
    old = []
    for i in range(1, steps + 1):
        first = _add_months_sql("M", i - steps - 12)
        ctes += [
            f"n{i} AS MATERIALIZED (SELECT ANO_MES, ID, TARGET FROM universe, lm WHERE ANO_MES = {_add_months_sql('M', i - steps)})",
            f"k{i} AS MATERIALIZED (SELECT h.* FROM h{i - 1} h, lm WHERE ANO_MES > {first} "
            f"AND NOT (TARGET = 0 AND ID IN (SELECT ID FROM n{i} WHERE TARGET = 1)))",
            f"f{i} AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY md5('0|' || CAST(ID AS VARCHAR)), ID) AS rn FROM n{i} "
            f"WHERE NOT (TARGET = 0 AND ID IN (SELECT ID FROM k{i})))",
            f"h{i} AS MATERIALIZED (SELECT * FROM k{i} UNION ALL SELECT ANO_MES, ID, TARGET FROM f{i} WHERE rn <= "
            f"floor(greatest((SELECT count(*) FROM h{i - 1}), (SELECT count(*) FROM n{i})) / 12))"]
        old.append(f"SELECT h.*, 'archive' AS PART FROM h{i - 1} h, lm WHERE ANO_MES <= {first}")
    return ("WITH lm AS (SELECT M FROM last_month),\n" + ",\n".join(ctes) + f"\nSELECT *, 'live' AS PART FROM h{steps}\nUNION ALL\n"
            + "\nUNION ALL\n".join(old))


@query("B14_rolled_table", _rolled_sql(3))
def b14_table(fx):
    """A stored universe after the last three months were taken in one by one,
    the second of them twice, with its archive (B14, B15, B17)."""
    u = fx.universe.select("ANO_MES", "ID", "TARGET")
    months = [P.shift_month(fx.span[1], k) for k in (-2, -1, 0)]
    table = MonthTable(fx.spark, scratch_path(fx.spark, "universe"))
    table.create(u.where(F.col("ANO_MES") < months[0]))
    for m in (months[0], months[1], months[1], months[2]):
        table.roll(u.where(F.col("ANO_MES") == m), m, 12)
    return (table.read().withColumn("PART", F.lit("live"))
            .unionByName(table.read(archived=True).withColumn("PART", F.lit("archive"))))


@query("B15_cap_new_month", """
WITH hist AS (SELECT * FROM universe WHERE ANO_MES < (SELECT M FROM last_month)),
new AS (SELECT * FROM universe WHERE ANO_MES = (SELECT M FROM last_month)),
h2 AS (SELECT * FROM hist WHERE ANO_MES > (SELECT M12 FROM last_month)
       AND NOT (TARGET = 0 AND ID IN (SELECT ID FROM new WHERE TARGET = 1))),
nf AS (SELECT * FROM new WHERE NOT (TARGET = 0 AND ID IN (SELECT ID FROM h2))),
k AS (SELECT CAST(floor(least((SELECT count(*) FROM nf),
             greatest((SELECT count(*) FROM hist), (SELECT count(*) FROM new)) / 12)) AS BIGINT) AS k)
SELECT ANO_MES, ID, TARGET FROM (
  SELECT *, row_number() OVER (ORDER BY md5('0|' || CAST(ID AS VARCHAR)), ID) AS rn FROM nf)
WHERE rn <= (SELECT k FROM k)""")
def b15(fx):
    """Filtered new month sampled down to the history's monthly size."""
    hist, new = _hist_new(fx)
    kept = hist.where(F.col("ANO_MES") > P.shift_month(fx.span[1], -12))
    buyers = new.where(F.col("TARGET") == 1).select("ID").distinct().withColumn("_nb", F.lit(1))
    h2 = kept.join(buyers, "ID", "left").where(~((F.col("TARGET") == 0) & F.col("_nb").isNotNull())).drop("_nb")
    ids = h2.select("ID").distinct().withColumn("_h", F.lit(1))
    nf = new.join(ids, "ID", "left").where(~((F.col("TARGET") == 0) & F.col("_h").isNotNull())).drop("_h")
    return P.cap_new_month(hist, nf, new, 12).select("ANO_MES", "ID", "TARGET")


@query("B16_month_coverage", """
SELECT ANO_MES, count(*) AS N_ROWS, count(*) OVER () AS N_MONTHS,
  count(*) OVER () = (SELECT count(*) FROM months) AS COVERAGE_OK
FROM universe GROUP BY ANO_MES""")
def b16(fx):
    """Rows per month and whether every month of the orders is there."""
    return P.month_coverage(fx.universe, len(P.months_between_list(*fx.span)))


_DRIFT = ("ID_CLIENTE_ANON", "IND_PSIN_PCOL_ENI", *P.RISK_FLAGS, "QTD_IDADE", "QTD_ANOS_ANTIG_CLIENTE", "VAL_SALDO",
          "NATION")


@query("B16_schema_drift", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"COLUMN\", count(*) - count({c}) AS N_MISSING FROM customer_snap" for c in _DRIFT))
def b16s(fx):
    """Columns of the customer snapshot absent from the history table, and
    how many of their values are missing."""
    return P.schema_drift(fx.cust_month, fx.customer_snap)


@query("B17_archive_old", "SELECT * FROM universe WHERE ANO_MES <= 199612")
def b17(fx):
    """Universe rows at or before the archive cut-off."""
    return P.archive_old(fx.universe, 199612)


_CHILD = ["COD_DELEGACAO", "DT_INCLUSAO_SEG", "DT_NASCIMENTO_SEG", "QTD_CAPITAL", "VAL_PREMIO", "DSC_ESTADO"]


@query("B18_split_child_parent", """
SELECT DISTINCT ID_APOLICE, ID_CLIENTE_ANON, ANO_MES FROM insured""")
def b18(fx):
    """Parent (policy) rows split from the insured-person child rows."""
    child, parent, dup = P.split_child_parent(fx.insured, _CHILD, ["ID_APOLICE"])
    return parent


@query("B18_duplicate_parents", """
SELECT ID_APOLICE, count(*) AS count FROM (SELECT DISTINCT ID_APOLICE, COD_DELEGACAO, DSC_ESTADO FROM insured)
GROUP BY ID_APOLICE HAVING count(*) > 1""")
def b18d(fx):
    """Policies whose parent part still repeats (parent kept the branch and state)."""
    child, parent, dup = P.split_child_parent(
        fx.insured.select("ID_APOLICE", "COD_DELEGACAO", "DSC_ESTADO", "VAL_PREMIO"), ["VAL_PREMIO"], ["ID_APOLICE"])
    return dup


@query("B12_policy_insured_join", """
WITH p AS (SELECT ANO_MES, ID_APOLICE, ID_CLIENTE_ANON, VAL_PCA_APL FROM policy_snap WHERE FLG_APL_EM_VIGOR = 1),
i1 AS (SELECT ANO_MES, ID_APOLICE, COD_DELEGACAO, QTD_CAPITAL FROM insured),
i2 AS (SELECT ANO_MES, ID_APOLICE, ID_CLIENTE_ANON, COD_DELEGACAO, VAL_PREMIO, DSC_ESTADO FROM insured)
SELECT p.ANO_MES, p.ID_APOLICE, p.ID_CLIENTE_ANON, p.VAL_PCA_APL, i1.COD_DELEGACAO, i1.QTD_CAPITAL, i2.VAL_PREMIO,
       i2.DSC_ESTADO
FROM p LEFT JOIN i1 ON i1.ID_APOLICE = p.ID_APOLICE AND i1.ANO_MES = p.ANO_MES
JOIN i2 ON i2.ID_APOLICE = p.ID_APOLICE AND i2.ID_CLIENTE_ANON = p.ID_CLIENTE_ANON
       AND i2.COD_DELEGACAO = i1.COD_DELEGACAO AND i2.ANO_MES = p.ANO_MES""")
def b12p(fx):
    """Policy-level joins of the in-force policies: insured part 1 on the
    policy (left), part 2 on policy + client + branch (inner)."""
    pol = P.in_force(fx.policy_snap).select("ANO_MES", "ID_APOLICE", "ID_CLIENTE_ANON", "VAL_PCA_APL")
    ins = fx.insured
    part1 = ins.select("ANO_MES", "ID_APOLICE", "COD_DELEGACAO", "QTD_CAPITAL")
    part2 = ins.select("ANO_MES", "ID_APOLICE", "ID_CLIENTE_ANON", "COD_DELEGACAO", "VAL_PREMIO", "DSC_ESTADO")
    out = P.lagged_join(pol, part1, ["ID_APOLICE"], 0, "left")
    return P.lagged_join(out, part2, ["ID_APOLICE", "ID_CLIENTE_ANON", "COD_DELEGACAO"], 0, "inner")


_B12_POLICY = "SELECT ANO_MES, ID_APOLICE, VAL_PCA_APL, QTD_SEGURADOS_APL_SD_VIG FROM policy_month"


@query("B12_policy_lagged_join", f"""
WITH b AS (SELECT DISTINCT p.ANO_MES, p.ID_APOLICE, p.ID_CLIENTE_ANON, i.COD_DELEGACAO
           FROM policy_month p JOIN insured i ON i.ID_APOLICE = p.ID_APOLICE WHERE p.QTD_MESES = 15),
i1 AS (SELECT ID_APOLICE, COD_DELEGACAO, sum(QTD_CAPITAL) AS QTD_CAPITAL FROM insured GROUP BY ALL),
i2 AS (SELECT ID_APOLICE, ID_CLIENTE_ANON, COD_DELEGACAO, round(sum(VAL_PREMIO), 2) AS VAL_PREMIO FROM insured GROUP BY ALL)
SELECT b.ANO_MES, b.ID_APOLICE, b.COD_DELEGACAO, n.VAL_PCA_APL, n.QTD_SEGURADOS_APL_SD_VIG,
       a.VAL_PCA_APL AS VAL_PCA_APL_M12, a.QTD_SEGURADOS_APL_SD_VIG AS QTD_SEGURADOS_APL_SD_VIG_M12,
       i1.QTD_CAPITAL, i2.VAL_PREMIO, g.DSC_DISTRITO, g.DSC_NUT2
FROM b
LEFT JOIN ({_B12_POLICY}) n ON n.ID_APOLICE = b.ID_APOLICE AND {_add_months_sql('n.ANO_MES', 2)} = b.ANO_MES
LEFT JOIN ({_B12_POLICY}) a ON a.ID_APOLICE = b.ID_APOLICE AND {_add_months_sql('a.ANO_MES', 14)} = b.ANO_MES
LEFT JOIN i1 ON i1.ID_APOLICE = b.ID_APOLICE AND i1.COD_DELEGACAO = b.COD_DELEGACAO
JOIN i2 ON i2.ID_APOLICE = b.ID_APOLICE AND i2.COD_DELEGACAO = b.COD_DELEGACAO AND i2.ID_CLIENTE_ANON = b.ID_CLIENTE_ANON
LEFT JOIN customer c ON c.c_custkey = b.ID_CLIENTE_ANON
LEFT JOIN geo g ON g.NATION = c.c_nationkey""")
def b12pl(fx):
    """Policies of age 15 months with their branches: policy features of M-2
    and, suffixed _M12, of M-14; insured part 1 on policy + branch (left), part
    2 on policy + client + branch (inner); geography of the client; the client
    columns dropped."""
    pol = fx.policy_month
    feats = pol.select("ANO_MES", "ID_APOLICE", "VAL_PCA_APL", "QTD_SEGURADOS_APL_SD_VIG")
    ins = fx.insured
    base = (pol.where("QTD_MESES = 15").select("ANO_MES", "ID_APOLICE", "ID_CLIENTE_ANON")
            .join(ins.select("ID_APOLICE", "COD_DELEGACAO").hint("merge"), "ID_APOLICE").distinct())
    out = P.lagged_feature_join(base, [(feats, ["ID_APOLICE"], 2, "left", ""),
                                       (feats, ["ID_APOLICE"], 14, "left", "_M12")])
    part1 = ins.groupBy("ID_APOLICE", "COD_DELEGACAO").agg(F.sum("QTD_CAPITAL").alias("QTD_CAPITAL"))
    part2 = ins.groupBy("ID_APOLICE", "ID_CLIENTE_ANON", "COD_DELEGACAO").agg(
        F.round(F.sum("VAL_PREMIO"), 2).alias("VAL_PREMIO"))
    out = out.join(part1.hint("merge"), ["ID_APOLICE", "COD_DELEGACAO"], "left").join(
        part2.hint("merge"), ["ID_APOLICE", "ID_CLIENTE_ANON", "COD_DELEGACAO"])
    nation = fx.customer.select(F.col("c_custkey").alias("ID_CLIENTE_ANON"), F.col("c_nationkey").alias("NATION"))
    out = P.dim_join(out.join(nation, "ID_CLIENTE_ANON", "left"), fx.geo, "NATION")
    return out.drop("ID_CLIENTE_ANON", "NATION")
