"""Queries A1-A10: sources, typing and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sources import ingest as A
from .catalog import query


@query("A1_read_delimited", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(o_totalprice AS VARCHAR) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000') AS o_orderdate,
       o_orderpriority
FROM orders""")
def a1(fx):
    """Orders written as ';'-separated gzip text, read back all-string."""
    path = scratch_path(fx.spark, "orders-csv")
    A.write_table(fx.orders, path, fmt="csv", compression="gzip", sep=";")
    return A.read_delimited(fx.spark, path, sep=";")


@query("A2_snapshot_scan", "SELECT ID_APOLICE, VAL_PCA_APL FROM policy_snap WHERE ANO_MES = 199903")
def a2(fx):
    """Month-partitioned policy snapshot scanned for one month and two
    columns (partition + column pruning)."""
    path = scratch_path(fx.spark, "policy-snap")
    A.write_table(fx.policy_snap, path, partition_by=["ANO_MES"])
    return A.snapshot_scan(fx.spark, path, 199903, ["ID_APOLICE", "VAL_PCA_APL"])


@query("A3_write_table", "SELECT ANO_MES, TARGET, count(*) AS N FROM universe GROUP BY ANO_MES, TARGET")
def a3(fx):
    """Universe written month-partitioned, read back and counted."""
    path = scratch_path(fx.spark, "universe")
    A.write_table(fx.universe, path, partition_by=["ANO_MES"])
    back = fx.spark.read.parquet(path)
    return back.groupBy(F.col("ANO_MES").cast("int").alias("ANO_MES"), "TARGET").agg(F.count("*").alias("N"))


# --- fixed values: label dictionary of the raw order extract
LABELS = (("VAL_TOTAL_TXT", "Numeric", "ORD"), ("PCT_RATE", "Numeric", "ORD"), ("DT_ORDER", "Date", "ORD"),
          ("DSC_STATUS", "Character", "ORD"), ("ID_ORDER", "Character", "ORD"))


def _raw_orders(fx):
    e, o = fx.euro_text, fx.orders
    k = F.col("o_orderkey")
    j = e.join(o.select("o_orderkey", "o_orderdate", "o_orderstatus"), "o_orderkey")
    return j.select(k.cast("string").alias("ID_ORDER"), F.concat(F.lit("5"), k.cast("string")).alias("NIF_CLIENT"),
                    "VAL_TOTAL_TXT", F.col("VAL_TOTAL_TXT").alias("VAL_TOTAL_TXT_M12"),
                    F.concat((k % 100).cast("string"), F.lit("%")).alias("PCT_RATE"),
                    F.when(k % 13 == 0, F.lit("n/a")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
                    .alias("DT_ORDER"), F.col("o_orderstatus").alias("DSC_STATUS"), k.alias("o_orderkey"))


_NUM = "TRY_CAST(replace(replace(trim({c}), '.', ''), ',', '.') AS DOUBLE)"


@query("A4_parse_by_labels", f"""
SELECT o_orderkey, {_NUM.format(c='VAL_TOTAL_TXT')} AS VAL_TOTAL_TXT, {_NUM.format(c='VAL_TOTAL_TXT')} AS VAL_TOTAL_TXT_M12,
  TRY_CAST(nullif(trim(regexp_replace(CAST(o_orderkey % 100 AS VARCHAR) || '%', '[()%*"'']', '', 'g')), '') AS DOUBLE)
    AS PCT_RATE,
  CAST(try_strptime(CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END, '%Y-%m-%d')
       AS DATE) AS DT_ORDER,
  o_orderstatus AS DSC_STATUS
FROM euro_text JOIN orders USING (o_orderkey)""")
def a4(fx):
    """Raw all-string extract typed from its label dictionary (thousand
    separators, decimal comma, %, bad dates; ID_/NIF columns dropped)."""
    labels = fx.spark.createDataFrame(list(LABELS), "Name string, Type string, Source string")
    return A.parse_by_labels(_raw_orders(fx), labels, keep=[], strict=False)


@query("A5_european_number", f"SELECT o_orderkey, {_NUM.format(c='VAL_TOTAL_TXT')} AS VAL_TOTAL_TXT, o_totalprice "
                             "FROM euro_text")
def a5(fx):
    """'1.234,56' text amounts to numbers (blank / 'n/a' -> null)."""
    return A.european_numbers(fx.euro_text)


@query("A6_sentinel_to_null", """
SELECT l_orderkey, l_linenumber, CASE WHEN PERC_DISC <> -999 THEN PERC_DISC END AS PERC_DISC,
  CASE WHEN l_quantity IS NULL THEN NULL WHEN l_quantity = 0 THEN 0 ELSE 1 END AS FLG_QTY,
  CASE WHEN length(trim(DSC_BRAND)) > 0 THEN DSC_BRAND END AS DSC_BRAND
FROM (SELECT *, l_quantity AS FLG_QTY0, CASE WHEN p_size % 9 = 0 THEN '  ' ELSE p_brand END AS DSC_BRAND FROM line_nulls)""")
def a6(fx):
    """-999 rates, blank text and non-0/1 flags cleaned."""
    d = fx.line_nulls.select("l_orderkey", "l_linenumber", "PERC_DISC", F.col("l_quantity").alias("FLG_QTY"),
                             F.when(F.col("p_size") % 9 == 0, F.lit("  ")).otherwise(F.col("p_brand"))
                             .alias("DSC_BRAND"))
    return A.sentinel_to_null(d)


@query("A7_uniformize_names", """
SELECT l_quantity AS QTD_QUANT, l_extendedprice AS QTD_PRICE, l_discount AS PERC_DESC, l_tax AS FLG_TAX,
       c_mktsegment AS FLG_SEG, TARGET AS FLG_TARGET, n_name AS DSC_z_w
FROM line_facts""")
def a7(fx):
    """Awkward names unified (QT_/QTY_ -> QTD_, PCT_ -> PERC_, FLAG_/COD_/IND_ ->
    FLG_, ' - ' -> '_', *_nan / *_0 dropped)."""
    f = fx.line_facts.select(F.col("l_quantity").alias("QT_QUANT"), F.col("l_extendedprice").alias("QTY_PRICE"),
                             F.col("l_discount").alias("PCT_DESC"), F.col("l_tax").alias("FLAG_TAX"),
                             F.col("c_mktsegment").alias("COD_SEG"), F.col("TARGET").alias("IND_TARGET"),
                             F.col("n_name").alias("DSC_z - w"), F.col("r_name").alias("DSC_REGION_nan"),
                             F.col("p_size").alias("QTD_SIZE_0"))
    return A.uniformize_names(f)


_TRAIN_SCHEMA = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_quantity", T.DoubleType()),
                              T.StructField("FLG_NEW", T.IntegerType()), T.StructField("DSC_NEW", T.StringType()),
                              T.StructField("VAL_NEW", T.DoubleType()), T.StructField("p_type", T.StringType())])


@query("A8_add_missing_columns", """
SELECT l_orderkey, l_quantity, 0 AS FLG_NEW, 'nan' AS DSC_NEW, CAST(NULL AS DOUBLE) AS VAL_NEW, p_type FROM line_facts""")
def a8(fx):
    """Scoring rows aligned to the training schema (missing columns filled,
    extras dropped)."""
    out, extra = A.add_missing_columns(fx.line_facts, _TRAIN_SCHEMA)
    return out


@query("A9_priority_dedup", """
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders)
WHERE rn = 1""")
def a9(fx):
    """Orders stacked by recency; the most recent row per customer wins."""
    o = fx.orders
    prio = [F.datediff(F.lit("2100-01-01").cast("date"), F.to_date("o_orderdate")), F.col("o_orderkey")]
    return A.priority_dedup(o, ["o_custkey"], prio)


@query("A10_final_columns", "SELECT ID, QTD_APL_VIG_T_AUTO, VAL_PCA_SD, DSC_HAS_CAP, TARGET FROM wide_lob")
def a10(fx):
    """Training table projected to the final variables."""
    return A.final_columns(fx.wide_lob, ["QTD_APL_VIG_T_AUTO", "VAL_PCA_SD", "DSC_HAS_CAP"], ["ID"])
