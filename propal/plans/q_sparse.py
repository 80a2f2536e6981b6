"""Queries on sparse encodings (D42, D14) and one-scan correlations (E5), with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.moments import pair_correlations
from ..operators import sparse
from ..session import stored
from .catalog import query
from .q_models import KEYS, NUMF

_CATS = ["c_mktsegment", "o_orderpriority", "p_brand"]
_PAIRS = [*NUMF, "PERC_DISC"]


def _said(t, keys):
    """Keys, the vector's length and its places and values as text."""
    text = F.array_join(F.transform(sparse.active("features"), lambda e: F.concat_ws(
        ":", e["pos"], e["value"].cast("long"))), ",")
    return t.select(*keys, text.alias("ACTIVE"))


def _sparse_sql(table: str, keys: list[str], columns: list[str], value: str) -> str:
    long = "\nUNION ALL\n".join(f"SELECT {', '.join(keys)}, '{c}' AS Variable, CAST({c} AS VARCHAR) AS category FROM {table}"
                                for c in columns)
    on = ", ".join(keys)
    return f"""WITH e AS (SELECT {on}, Variable, category, count(*) AS n FROM ({long})
  WHERE category IS NOT NULL AND category NOT IN ('', '0', 'nan') GROUP BY ALL),
s AS (SELECT Variable, category, row_number() OVER (ORDER BY Variable, category) - 1 AS POS
      FROM (SELECT DISTINCT Variable, category FROM e)),
v AS (SELECT {on}, string_agg(POS || ':' || {value}, ',' ORDER BY POS) AS ACTIVE FROM e JOIN s USING (Variable, category) GROUP BY ALL)
SELECT {on}, coalesce(ACTIVE, '') AS ACTIVE FROM (SELECT DISTINCT {on} FROM {table}) LEFT JOIN v USING ({on})"""


@query("D42_one_hot_sparse", _sparse_sql("line_nulls", KEYS, _CATS, "1"))
def d42_sparse(fx):
    """Three categorical columns (one with nulls) as one sparse vector a line."""
    df = stored(fx.line_nulls.select(*KEYS, *_CATS), "lines")
    return _said(sparse.sparse_transform(df, sparse.index_fit(df, _CATS), KEYS, _CATS), KEYS)


@query("D14_children_sparse", _sparse_sql("line_facts", ["c_custkey"], ["p_brand", "l_linestatus"], "n"))
def d14_sparse(fx):
    """Per customer a sparse vector that counts the lines by brand and status."""
    df = fx.line_facts.select("c_custkey", "p_brand", "l_linestatus")
    cols = ["p_brand", "l_linestatus"]
    return _said(sparse.sparse_transform(df, sparse.index_fit(df, cols), ["c_custkey"], cols, counts=True), ["c_custkey"])


@query("E5_pair_correlations", "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, CAST(count(CASE WHEN {a} IS NOT NULL THEN {b} END) AS BIGINT) AS n, "
    f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 9) AS r FROM line_nulls"
    for i, a in enumerate(_PAIRS) for b in _PAIRS[i + 1:]))
def e5_pairs(fx):
    """Pearson's r of all pairs of numeric columns, nulls pairwise, in one scan."""
    return pair_correlations(fx.line_nulls, [_PAIRS]).select("a", "b", "n", F.round("r", 9).alias("r"))
