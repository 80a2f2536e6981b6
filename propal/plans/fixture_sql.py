"""DuckDB twins of the fixtures in ``fixtures.py`` (independent SQL text, same
rules).  ``with_fixtures(sql)`` prepends the CTEs a query mentions."""

from __future__ import annotations

import re

from .fixtures import (DIGITAL_REF_DATE, EVENT_TYPES, LOB_OF_TYPE, LOBS, WIDE_RECENT_FROM, WIDE_REF_MONTH,
                       WIDE_TARGET_FROM)


def _months(start: int, end: int) -> str:
    s = f"DATE '{start // 100:04d}-{start % 100:02d}-01'"
    e = f"DATE '{end // 100:04d}-{end % 100:02d}-01'"
    return (f"(SELECT CAST(year(d) * 100 + month(d) AS INTEGER) AS ANO_MES "
            f"FROM (SELECT unnest(generate_series({s}, {e}, INTERVAL 1 MONTH)) AS d))")


def _add_months(c: str, k) -> str:
    idx = f"(floor({c} / 100) * 12 + ({c} % 100 - 1) + ({k}))"
    return f"CAST(floor({idx} / 12) * 100 + {idx} % 12 + 1 AS INTEGER)"


_lob_case = "CASE p_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LOB_OF_TYPE.items()) + " END"

F: dict[str, str] = {}

F["line_facts"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, c_custkey, o_orderdate, l_shipdate,
       CAST(l_returnflag = 'R' AS INTEGER) AS TARGET,
       l_quantity, l_extendedprice, l_discount, l_tax, p_size,
       l_linestatus, p_type, p_brand, o_orderpriority, c_mktsegment, n_name, r_name
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON o_custkey = c_custkey
     JOIN part ON l_partkey = p_partkey
     JOIN nation ON c_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey"""

F["line_nulls"] = """
SELECT * REPLACE (CASE WHEN l_linenumber % 5 <> 0 THEN l_tax END AS l_tax,
                  CASE WHEN l_partkey % 7 <> 0 THEN p_brand END AS p_brand),
       CASE WHEN l_orderkey % 11 = 0 THEN -999.0 ELSE l_discount * 100 END AS PERC_DISC
FROM line_facts"""

F["line_scored"] = """
SELECT *, ((l_orderkey * 7919 + l_linenumber * 104729 + TARGET * 2003) % 10007) / 10007.0 AS PR_1,
       1 - ((l_orderkey * 7919 + l_linenumber * 104729 + TARGET * 2003) % 10007) / 10007.0 AS PR_0
FROM line_facts"""

F["orders_m"] = """
SELECT *, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS ANO_MES FROM orders"""

_SPAN = """(SELECT CAST(year(d) * 100 + month(d) AS INTEGER) AS ANO_MES
FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)),
                                    INTERVAL 1 MONTH)) AS d FROM orders))"""
F["months"] = "SELECT * FROM " + _SPAN

F["last_month"] = f"""
SELECT M, {_add_months('M', -5)} AS M5, {_add_months('M', -6)} AS M6, {_add_months('M', -12)} AS M12
FROM (SELECT max(ANO_MES) AS M FROM months)"""

F["cust_orders_month"] = """
SELECT o_custkey AS ID, ANO_MES, count(*) AS N_ORD, sum(o_totalprice) AS SPEND
FROM orders_m GROUP BY o_custkey, ANO_MES"""

F["first_order"] = "SELECT o_custkey AS ID, min(ANO_MES) AS FIRST_MES FROM orders_m GROUP BY o_custkey"

_wide_aggs = ",\n".join(
    [f"sum(CASE WHEN K = {k} THEN N_ORD END) AS _n{k}" for k in range(12)]
    + [f"sum(CASE WHEN K = {k} THEN SPEND END) AS _s{k}" for k in range(12)])
_wide_cols = ",\n".join(
    [f"CAST(coalesce(_n{k}, 0) AS BIGINT) AS QTD_ORD_M{k}" for k in range(12)]
    + [f"round(coalesce(_s{k}, 0.0), 2) AS VAL_SPEND_M{k}" for k in range(12)]
    + [f"CASE WHEN coalesce(_n{k}, 0) > 0 THEN 'S' WHEN FIRST_MES IS NULL OR "
       f"{_add_months('sp.ANO_MES', -k)} < FIRST_MES THEN 'X' ELSE 'N' END AS DSC_BUY_M{k}" for k in range(12)])
F["cust_month"] = f"""
SELECT sp.ID, sp.ANO_MES,
{_wide_cols}
FROM (SELECT c_custkey AS ID, m.ANO_MES FROM customer, {_SPAN} m) sp
LEFT JOIN (
  SELECT ID, ANO_MES, {_wide_aggs}
  FROM (SELECT ID, N_ORD, SPEND, K, {_add_months('ANO_MES', 'K')} AS ANO_MES
        FROM cust_orders_month, (SELECT unnest(range(0, 12)) AS K))
  GROUP BY ID, ANO_MES) w ON sp.ID = w.ID AND sp.ANO_MES = w.ANO_MES
LEFT JOIN first_order fo ON sp.ID = fo.ID"""

_ms = "((floor(ANO_MES / 100) * 12 + ANO_MES % 100) - (floor(FIRST_MES / 100) * 12 + FIRST_MES % 100))"
F["customer_snap"] = f"""
SELECT m.ANO_MES, c_custkey AS ID_CLIENTE_ANON, c_mktsegment AS IND_PSIN_PCOL_ENI,
       CAST(c_custkey % 13 = 0 AS INTEGER) AS FLG_CONFIDENCIALIDADE,
       CAST(c_custkey % 17 = 0 AS INTEGER) AS FLG_EMPREG_FIDEL,
       CAST(c_custkey % 19 = 0 AS INTEGER) AS FLG_INCIDENCIAS,
       CAST(c_custkey % 23 = 0 AS INTEGER) AS FLG_CLIENTE_BLOQUEADO,
       CAST(c_custkey % 29 = 0 AS INTEGER) AS FLG_FALECIDO,
       CAST(c_custkey % 31 = 0 AS INTEGER) AS FLG_CONTACTO_MKT,
       CAST(c_custkey % 37 = 0 AS INTEGER) AS FLG_CLIENTE_MEDIADOR,
       CAST(10 + c_custkey % 80 AS DOUBLE) AS QTD_IDADE,
       CASE WHEN {_ms} >= 0 THEN {_ms} / 12.0 END AS QTD_ANOS_ANTIG_CLIENTE,
       c_acctbal AS VAL_SALDO, c_nationkey AS NATION
FROM customer CROSS JOIN {_SPAN} m
LEFT JOIN first_order fo ON c_custkey = fo.ID"""

F["policy_snap"] = """
SELECT ANO_MES, CAST(o_orderkey AS VARCHAR) AS ID_APOLICE, o_custkey AS ID_CLIENTE_ANON,
       CAST(o_orderstatus = 'O' AS INTEGER) AS FLG_APL_EM_VIGOR,
       CAST(o_orderstatus = 'F' AS INTEGER) AS FLG_APL_ANULADA,
       CASE WHEN o_orderkey % 3 = 0 THEN 'GRUPO' ELSE 'INDIVIDUAL' END AS COD_PRODUTO_CATALOG,
       o_orderpriority AS DSC_PRODUTO_SO_APL,
       CASE WHEN o_orderstatus = 'F' THEN 'MOTIVO_' || CAST(o_orderkey % 4 AS VARCHAR) END AS DSC_MOTIVO_ANUL_APL,
       CAST(o_orderkey % 100 AS VARCHAR) || '%' AS TX_SINISTRALIDADE_TRIENIO,
       o_totalprice AS VAL_PCA_APL,
       CAST(1 + o_orderkey % 4 AS DOUBLE) AS QTD_SEGURADOS_APL_SD_VIG,
       CAST(o_orderkey % 15 AS DOUBLE) AS QTD_MATURIDADE_APL,
       round(o_totalprice * 0.8, 2) AS VAL_PG_SIN,
       CASE WHEN o_orderkey % 9 = 0 THEN 0.0 ELSE o_totalprice END AS VAL_APR_SIN
FROM orders_m"""

F["policy_month"] = f"""
SELECT {_add_months('ANO_MES', 'QTD_MESES')} AS ANO_MES, ID_APOLICE, ID_CLIENTE_ANON,
       VAL_PCA_APL + QTD_MESES AS VAL_PCA_APL,
       CASE WHEN QTD_MESES = 0 AND CAST(ID_APOLICE AS BIGINT) % 16 = 0 THEN 0.0 ELSE QTD_SEGURADOS_APL_SD_VIG END
         AS QTD_SEGURADOS_APL_SD_VIG, QTD_MESES
FROM policy_snap, (SELECT unnest(range(0, 16)) AS QTD_MESES)"""

F["insured"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS ID_APOLICE, o_custkey AS ID_CLIENTE_ANON, l_linenumber AS COD_DELEGACAO,
       CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS ANO_MES,
       CAST(l_shipdate AS DATE) AS DT_INCLUSAO_SEG,
       CAST(CAST(l_shipdate AS DATE) - to_months(12 * CAST(l_partkey % 80 AS INTEGER)) AS DATE) AS DT_NASCIMENTO_SEG,
       l_quantity AS QTD_CAPITAL, l_extendedprice AS VAL_PREMIO, l_linestatus AS DSC_ESTADO
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

F["geo"] = """
SELECT n_nationkey AS NATION, n_name AS DSC_DISTRITO, r_name AS DSC_NUT2
FROM nation JOIN region ON n_regionkey = r_regionkey"""

F["universe"] = f"""
WITH pos AS (SELECT DISTINCT ANO_MES, o_custkey AS ID FROM orders_m
             WHERE o_orderpriority = '1-URGENT'),
     known AS (SELECT m.ANO_MES, f.ID FROM first_order f, {_SPAN} m
               WHERE f.FIRST_MES <= {_add_months('m.ANO_MES', -2)})
SELECT ANO_MES, ID, 1 AS TARGET FROM pos
UNION ALL
SELECT ANO_MES, ID, 0 AS TARGET FROM known k
WHERE NOT EXISTS (SELECT 1 FROM pos p WHERE p.ANO_MES = k.ANO_MES AND p.ID = k.ID)"""

F["baskets"] = """
SELECT l_orderkey AS ID, array_to_string(list_sort(list_distinct(list(p_type))), ' / ') AS DSC_CABAZ_ATUAL
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey"""

F["digital"] = "SELECT user_id AS ID, " + ", ".join(
    [f"CASE WHEN max(CASE WHEN event_type = '{t}' THEN ts END) IS NOT NULL THEN 1 ELSE 0 END "
     f"AS IND_LOGIN_{t.upper()}" for t in EVENT_TYPES]
    + [f"CAST(date_diff('day', CAST(max(CASE WHEN event_type = '{t}' THEN ts END) AS DATE), "
       f"DATE '{DIGITAL_REF_DATE}') AS INTEGER) AS QT_DAYS_LAST_LOGIN_{t.upper()}" for t in EVENT_TYPES]) + " FROM events GROUP BY user_id"

F["doc_labels"] = """
SELECT doc_id, quality AS TARGET, n_chars, lang, source FROM documents JOIN labels USING (doc_id)"""

F["euro_text"] = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 17 = 0 THEN ' ' WHEN o_orderkey % 23 = 0 THEN 'n/a'
            ELSE translate(format('{:,.2f}', o_totalprice), ',.', '.,') END AS VAL_TOTAL_TXT,
       o_totalprice
FROM orders"""

F["scores"] = f"""
SELECT m.ANO_MES, c_custkey AS ID, 'CROSS_SELL' AS MODEL_TYPE, 'v1' AS MODEL_VERSION, 'SD' AS MODEL_LOB,
       ((c_custkey * 7919 + m.ANO_MES) % 10007) / 10007.0 AS EM_EVENTPROBABILITY
FROM customer, months m"""

F["scores_v2"] = f"""
SELECT m.ANO_MES, c_custkey AS ID, 'CROSS_SELL' AS MODEL_TYPE, 'v2' AS MODEL_VERSION, 'SD' AS MODEL_LOB,
       ((c_custkey * 6151 + m.ANO_MES) % 10007) / 10007.0 AS EM_EVENTPROBABILITY
FROM customer, months m"""

F["purchases"] = "SELECT ANO_MES, ID FROM universe WHERE TARGET = 1"

F["scored_universe"] = """
SELECT s.*, CASE WHEN p.ID IS NULL THEN 0 ELSE 1 END AS TARGET
FROM scores s LEFT JOIN purchases p ON s.ANO_MES = p.ANO_MES AND s.ID = p.ID"""

_mon = "(year(o_orderdate) * 12 + month(o_orderdate))"
_per_aggs = ",\n".join(
    f"sum(CASE WHEN LOB = '{b}' THEN 1 ELSE 0 END) AS QTD_APL_VIG_T_{b}, "
    f"round(sum(CASE WHEN LOB = '{b}' THEN l_extendedprice ELSE 0.0 END), 2) AS VAL_PCA_{b}, "
    f"max(CASE WHEN LOB = '{b}' THEN {_mon} END) AS _last_{b}, "
    f"sum(CASE WHEN LOB = '{b}' AND o_orderdate >= TIMESTAMP '{WIDE_RECENT_FROM}' THEN 1 ELSE 0 END) AS QTD_APL_REC_{b}"
    for b in LOBS)
_wide_lob_cols = ",\n".join(
    f"CAST(coalesce(QTD_APL_VIG_T_{b}, 0) AS BIGINT) AS QTD_APL_VIG_T_{b}, "
    f"coalesce(VAL_PCA_{b}, 0.0) AS VAL_PCA_{b}, "
    f"CASE WHEN QTD_APL_VIG_T_AUTO IS NULL THEN 'X' WHEN QTD_APL_VIG_T_{b} > 0 THEN 'S' ELSE 'N' END AS DSC_HAS_{b}, "
    f"CAST({WIDE_REF_MONTH} - _last_{b} AS DOUBLE) AS QTD_MESES_ULT_COMPRA_{b}, "
    f"CAST(coalesce(QTD_APL_REC_{b}, 0) AS BIGINT) AS QTD_APL_REC_{b}" for b in LOBS)
F["wide_lob"] = f"""
WITH per AS (
  SELECT o_custkey AS ID, {_per_aggs}
  FROM (SELECT o_custkey, {_lob_case} AS LOB, l_extendedprice, o_orderdate
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey)
  GROUP BY o_custkey),
urgent AS (SELECT DISTINCT o_custkey AS ID FROM orders
           WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '{WIDE_TARGET_FROM}')
SELECT c_custkey AS ID, c_mktsegment AS DSC_SEGMENTO, c_acctbal AS VAL_SALDO, c_nationkey AS NATION,
{_wide_lob_cols},
       CASE WHEN u.ID IS NULL THEN 0 ELSE 1 END AS TARGET
FROM customer LEFT JOIN per ON c_custkey = per.ID LEFT JOIN urgent u ON c_custkey = u.ID"""


def _deps(sql: str) -> list[str]:
    return [n for n in F if re.search(rf"\b{n}\b", sql)]


def with_fixtures(sql: str) -> str:
    """Prepend the fixture CTEs ``sql`` needs (in dependency order)."""
    order: list[str] = []

    def visit(name: str, stack: tuple = ()):
        if name in order:
            return
        for d in _deps(F[name]):
            if d != name and d not in stack:
                visit(d, stack + (name,))
        order.append(name)

    for n in _deps(sql):
        visit(n)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS ({F[n]}\n)" for n in order)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
