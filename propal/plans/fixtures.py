"""Spark views of the test stand-ins described in FIXTURES.md.

Every fixture is derived lazily from the given tables, so its size grows with
the scale factor.  The DuckDB twins of these definitions live in
``fixture_sql.py``; the two must stay rule-for-rule identical.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# --- fixed values of the stand-ins -------------------------------------------
# p_type -> line-of-business code (alphabetical pairing)
LOB_OF_TYPE = {"ECONOMY": "AUTO", "LARGE": "SD", "MEDIUM": "CAP", "PROMO": "PPR",
               "SMALL": "MRH", "STANDARD": "VDO"}
LOBS = ("AUTO", "SD", "CAP", "PPR", "MRH", "VDO")
EVENT_TYPES = ("click", "view", "purchase", "signup", "error")
WIDE_REF_MONTH = 2001 * 12 + 9                           # "now" of wide_lob (2001-09)
WIDE_TARGET_FROM = "2000-09-01"
WIDE_RECENT_FROM = "2001-01-01"
DIGITAL_REF_DATE = "2024-01-31"


class Fixtures:
    """Lazily built fixture DataFrames for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}
        self._span: tuple[int, int] | None = None

    @property
    def span(self) -> tuple[int, int]:
        """First and last month of the orders: the panel's months."""
        if self._span is None:
            r = self.orders_m.agg(F.min("ANO_MES"), F.max("ANO_MES")).first()
            self._span = (r[0], r[1])
        return self._span

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in TABLES:
            return self.table(name)
        builder = getattr(type(self), "build_" + name, None)
        if builder is None:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = builder(self)
        return self._cache[name]

    # -- line level --------------------------------------------------------
    def build_line_facts(self) -> DataFrame:
        l, o, c, p = self.lineitem, self.orders, self.customer, self.part
        n, r = self.nation, self.region
        places = (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)      # 25 rows
                  .join(F.broadcast(r), n.n_regionkey == r.r_regionkey))      # 5 rows
        # orders meet their customers first, so that the lines are shuffled for orders and parts only
        placed = o.join(places, o.o_custkey == c.c_custkey)
        return (l.join(p, l.l_partkey == p.p_partkey)
                .join(placed.hint("merge"), l.l_orderkey == o.o_orderkey)
                .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "c_custkey",
                        "o_orderdate", "l_shipdate",
                        (F.col("l_returnflag") == "R").cast("int").alias("TARGET"),
                        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size",
                        "l_linestatus", "p_type", "p_brand", "o_orderpriority", "c_mktsegment",
                        "n_name", "r_name"))

    def build_line_nulls(self) -> DataFrame:
        f = self.line_facts
        return (f.withColumn("l_tax", F.when(F.col("l_linenumber") % 5 != 0, F.col("l_tax")))
                .withColumn("p_brand", F.when(F.col("l_partkey") % 7 != 0, F.col("p_brand")))
                .withColumn("PERC_DISC", F.when(F.col("l_orderkey") % 11 == 0, F.lit(-999.0))
                            .otherwise(F.col("l_discount") * 100)))

    def build_line_scored(self) -> DataFrame:
        """line_facts with a deterministic score P(class 1) and P(class 0)."""
        f = self.line_facts
        p1 = ((F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729 + F.col("TARGET") * 2003)
              % 10007) / 10007.0
        return f.withColumn("PR_1", p1).withColumn("PR_0", 1 - F.col("PR_1"))

    # -- panel ---------------------------------------------------------------
    def build_orders_m(self) -> DataFrame:
        o = self.orders
        return o.withColumn("ANO_MES", (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("int"))

    def build_months(self) -> DataFrame:
        """Panel month spine, the months of the orders, as INT yyyymm (B1)."""
        from ..operators.panel import month_spine
        return month_spine(self.spark, *self.span)

    def build_cust_orders_month(self) -> DataFrame:
        """orders aggregated to (customer, month): n orders, spend."""
        return (self.orders_m.groupBy(F.col("o_custkey").alias("ID"), "ANO_MES")
                .agg(F.count("*").alias("N_ORD"), F.sum("o_totalprice").alias("SPEND")))

    def build_first_order(self) -> DataFrame:
        return self.orders_m.groupBy(F.col("o_custkey").alias("ID")).agg(
            F.min("ANO_MES").alias("FIRST_MES"))

    def build_cust_month(self) -> DataFrame:
        """Wide monthly history: QTD_ORD_M0..M11, VAL_SPEND_M0..M11 (0 if
        none), DSC_BUY_M0..M11 ('S' bought, 'N' not, 'X' before the first
        order) for every customer x panel month.

        A customer's months are gathered once into a map by month index (a
        customer has at most one entry a month); every panel row then looks its
        12 months up, so nothing is multiplied before a shuffle."""
        from ..operators.panel import month_index, panel
        own = self.cust_orders_month.groupBy("ID").agg(F.map_from_entries(F.collect_list(F.struct(
            month_index(F.col("ANO_MES")), F.struct(F.col("N_ORD").alias("n"), F.col("SPEND").alias("s"))))).alias("_m"))
        ids = self.customer.select(F.col("c_custkey").alias("ID")).join(own, "ID", "left")
        rows = panel(ids.withColumn("_first", F.array_min(F.map_keys("_m"))), *self.span)
        midx = month_index(F.col("ANO_MES"))
        seen = {k: F.try_element_at("_m", midx - k) for k in range(12)}
        return rows.select(
            "ID", "ANO_MES",
            *[F.coalesce(seen[k]["n"], F.lit(0)).cast("long").alias(f"QTD_ORD_M{k}") for k in seen],
            *[F.round(F.coalesce(seen[k]["s"], F.lit(0.0)), 2).alias(f"VAL_SPEND_M{k}") for k in seen],
            *[F.when(seen[k].isNotNull(), "S").when(F.col("_first").isNull() | (midx - k < F.col("_first")), "X")
              .otherwise("N").alias(f"DSC_BUY_M{k}") for k in seen])

    def build_customer_snap(self) -> DataFrame:
        """Monthly customer snapshot (eligibility flags, age, tenure)."""
        from ..operators.panel import panel
        c = self.customer
        base = panel(c.select(F.col("c_custkey").alias("ID_CLIENTE_ANON"), "c_mktsegment", "c_acctbal",
                              "c_nationkey"),
                     *self.span)
        k = F.col("ID_CLIENTE_ANON")
        fo = self.first_order.withColumnRenamed("ID", "ID_CLIENTE_ANON")
        months_since = ((F.floor(F.col("ANO_MES") / 100) * 12 + F.col("ANO_MES") % 100)
                        - (F.floor(F.col("FIRST_MES") / 100) * 12 + F.col("FIRST_MES") % 100))
        return (base.join(fo, "ID_CLIENTE_ANON", "left").select(
            "ANO_MES", "ID_CLIENTE_ANON",
            F.col("c_mktsegment").alias("IND_PSIN_PCOL_ENI"),
            (k % 13 == 0).cast("int").alias("FLG_CONFIDENCIALIDADE"),
            (k % 17 == 0).cast("int").alias("FLG_EMPREG_FIDEL"),
            (k % 19 == 0).cast("int").alias("FLG_INCIDENCIAS"),
            (k % 23 == 0).cast("int").alias("FLG_CLIENTE_BLOQUEADO"),
            (k % 29 == 0).cast("int").alias("FLG_FALECIDO"),
            (k % 31 == 0).cast("int").alias("FLG_CONTACTO_MKT"),
            (k % 37 == 0).cast("int").alias("FLG_CLIENTE_MEDIADOR"),
            (F.lit(10) + k % 80).cast("double").alias("QTD_IDADE"),
            F.when(months_since >= 0, months_since / 12.0).alias("QTD_ANOS_ANTIG_CLIENTE"),
            F.col("c_acctbal").alias("VAL_SALDO"), F.col("c_nationkey").alias("NATION")))

    def build_policy_snap(self) -> DataFrame:
        o = self.orders_m
        k = F.col("o_orderkey")
        return o.select(
            "ANO_MES", k.cast("string").alias("ID_APOLICE"), F.col("o_custkey").alias("ID_CLIENTE_ANON"),
            (F.col("o_orderstatus") == "O").cast("int").alias("FLG_APL_EM_VIGOR"),
            (F.col("o_orderstatus") == "F").cast("int").alias("FLG_APL_ANULADA"),
            F.when(k % 3 == 0, "GRUPO").otherwise("INDIVIDUAL").alias("COD_PRODUTO_CATALOG"),
            F.col("o_orderpriority").alias("DSC_PRODUTO_SO_APL"),
            F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("MOTIVO_"), (k % 4).cast("string")))
            .alias("DSC_MOTIVO_ANUL_APL"),
            F.concat((k % 100).cast("string"), F.lit("%")).alias("TX_SINISTRALIDADE_TRIENIO"),
            F.col("o_totalprice").alias("VAL_PCA_APL"),
            (F.lit(1) + k % 4).cast("double").alias("QTD_SEGURADOS_APL_SD_VIG"),
            (k % 15).cast("double").alias("QTD_MATURIDADE_APL"),
            F.round(F.col("o_totalprice") * 0.8, 2).alias("VAL_PG_SIN"),
            F.when(k % 9 == 0, F.lit(0.0)).otherwise(F.col("o_totalprice")).alias("VAL_APR_SIN"))

    def build_policy_month(self) -> DataFrame:
        """Monthly policy snapshots: each policy in the month of its order and
        the 15 after it; the premium rises by 1 a month, and nobody is insured
        in every 16th policy's first month."""
        from ..operators.panel import add_months_yyyymm
        p = self.policy_snap.select("ANO_MES", "ID_APOLICE", "ID_CLIENTE_ANON", "VAL_PCA_APL", "QTD_SEGURADOS_APL_SD_VIG")
        m = F.col("QTD_MESES")
        return (p.withColumn("QTD_MESES", F.explode(F.sequence(F.lit(0), F.lit(15))))
                .select(add_months_yyyymm(F.col("ANO_MES"), m).alias("ANO_MES"), "ID_APOLICE", "ID_CLIENTE_ANON",
                        (F.col("VAL_PCA_APL") + m).alias("VAL_PCA_APL"),
                        F.when((m == 0) & (F.col("ID_APOLICE").cast("long") % 16 == 0), 0.0)
                        .otherwise(F.col("QTD_SEGURADOS_APL_SD_VIG")).alias("QTD_SEGURADOS_APL_SD_VIG"), "QTD_MESES"))

    def build_insured(self) -> DataFrame:
        l, o = self.lineitem, self.orders
        return (l.join(o.hint("merge"), l.l_orderkey == o.o_orderkey).select(
            F.col("l_orderkey").cast("string").alias("ID_APOLICE"),
            F.col("o_custkey").alias("ID_CLIENTE_ANON"),
            F.col("l_linenumber").alias("COD_DELEGACAO"),
            (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("int").alias("ANO_MES"),
            F.to_date("l_shipdate").alias("DT_INCLUSAO_SEG"),
            F.add_months(F.to_date("l_shipdate"), -12 * (F.col("l_partkey") % 80).cast("int"))
            .alias("DT_NASCIMENTO_SEG"),
            F.col("l_quantity").alias("QTD_CAPITAL"),
            F.col("l_extendedprice").alias("VAL_PREMIO"),
            F.col("l_linestatus").alias("DSC_ESTADO")))

    def build_geo(self) -> DataFrame:
        n, r = self.nation, self.region
        return n.join(r, n.n_regionkey == r.r_regionkey).select(
            F.col("n_nationkey").alias("NATION"), F.col("n_name").alias("DSC_DISTRITO"),
            F.col("r_name").alias("DSC_NUT2"))

    def build_universe(self) -> DataFrame:
        """Bought an urgent order in the month, against customers known for
        two months who did not."""
        from ..operators.panel import known_since, monthly_target
        events = (self.orders_m.where(F.col("o_orderpriority") == "1-URGENT")
                  .select("ANO_MES", F.col("o_custkey").alias("ID")))
        return monthly_target(events, known_since(self.first_order, *self.span))

    def build_baskets(self) -> DataFrame:
        l, p = self.lineitem, self.part
        j = l.join(p, l.l_partkey == p.p_partkey)
        return j.groupBy(F.col("l_orderkey").alias("ID")).agg(
            F.array_join(F.array_sort(F.collect_set("p_type")), " / ").alias("DSC_CABAZ_ATUAL"))

    def build_digital(self) -> DataFrame:
        e = self.events
        last = e.groupBy("user_id").pivot("event_type", list(EVENT_TYPES)).agg(F.max("ts"))
        cols = [F.col("user_id").alias("ID")]
        for t in EVENT_TYPES:
            cols.append(F.when(F.col(t).isNotNull(), 1).otherwise(0).alias(f"IND_LOGIN_{t.upper()}"))
        for t in EVENT_TYPES:
            cols.append(F.datediff(F.lit(DIGITAL_REF_DATE).cast("date"), F.to_date(F.col(t)))
                        .alias(f"QT_DAYS_LAST_LOGIN_{t.upper()}"))
        return last.select(*cols)

    def build_doc_labels(self) -> DataFrame:
        d, lab = self.documents, self.labels
        return d.join(lab, "doc_id").select("doc_id", F.col("quality").alias("TARGET"), "n_chars", "lang",
                                            "source")

    def build_euro_text(self) -> DataFrame:
        o = self.orders
        k = F.col("o_orderkey")
        us = F.format_number(F.col("o_totalprice"), 2)
        eu = F.translate(us, ",.", ".,")
        return o.select("o_orderkey", F.when(k % 17 == 0, F.lit(" "))
                        .when(k % 23 == 0, F.lit("n/a")).otherwise(eu).alias("VAL_TOTAL_TXT"),
                        "o_totalprice")

    def build_scores(self) -> DataFrame:
        from ..operators.panel import panel
        c = self.customer.select(F.col("c_custkey").alias("ID"))
        s = panel(c, *self.span)
        p = ((F.col("ID") * 7919 + F.col("ANO_MES")) % 10007) / 10007.0
        return s.select("ANO_MES", "ID", F.lit("CROSS_SELL").alias("MODEL_TYPE"), F.lit("v1").alias("MODEL_VERSION"),
                        F.lit("SD").alias("MODEL_LOB"), p.alias("EM_EVENTPROBABILITY"))

    def build_scores_v2(self) -> DataFrame:
        from ..operators.panel import panel
        c = self.customer.select(F.col("c_custkey").alias("ID"))
        s = panel(c, *self.span)
        p = ((F.col("ID") * 6151 + F.col("ANO_MES")) % 10007) / 10007.0
        return s.select("ANO_MES", "ID", F.lit("CROSS_SELL").alias("MODEL_TYPE"), F.lit("v2").alias("MODEL_VERSION"),
                        F.lit("SD").alias("MODEL_LOB"), p.alias("EM_EVENTPROBABILITY"))

    def build_purchases(self) -> DataFrame:
        u = self.universe
        return u.where(F.col("TARGET") == 1).select("ANO_MES", "ID")

    def build_scored_universe(self) -> DataFrame:
        """scores joined to the universe label of the month (0 if absent)."""
        s, pur = self.scores, self.purchases.withColumn("_b", F.lit(1))
        return (s.join(pur, ["ANO_MES", "ID"], "left")
                .withColumn("TARGET", F.coalesce(F.col("_b"), F.lit(0))).drop("_b"))

    def build_wide_lob(self) -> DataFrame:
        c, o, l, p = self.customer, self.orders, self.lineitem, self.part
        lob = F.create_map(*[x for kv in LOB_OF_TYPE.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
        j = (o.join(l, o.o_orderkey == l.l_orderkey).join(p, l.l_partkey == p.p_partkey)
             .select(F.col("o_custkey").alias("ID"), lob[F.col("p_type")].alias("LOB"),
                     "l_extendedprice", "o_orderdate"))
        mon = F.year("o_orderdate") * 12 + F.month("o_orderdate")
        aggs = []
        for b in LOBS:
            aggs += [F.sum(F.when(F.col("LOB") == b, 1).otherwise(0)).alias(f"QTD_APL_VIG_T_{b}"),
                     F.round(F.sum(F.when(F.col("LOB") == b, F.col("l_extendedprice")).otherwise(0.0)), 2)
                     .alias(f"VAL_PCA_{b}"),
                     F.max(F.when(F.col("LOB") == b, mon)).alias(f"_last_{b}"),
                     F.sum(F.when((F.col("LOB") == b) & (F.col("o_orderdate") >= WIDE_RECENT_FROM), 1).otherwise(0))
                     .alias(f"QTD_APL_REC_{b}")]
        per = j.groupBy("ID").agg(*aggs)
        urgent = (o.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderdate") >= WIDE_TARGET_FROM))
                  .select(F.col("o_custkey").alias("ID")).distinct().withColumn("_t", F.lit(1)))
        base = c.select(F.col("c_custkey").alias("ID"), "c_mktsegment", "c_acctbal", "c_nationkey")
        w = base.join(per, "ID", "left").join(urgent, "ID", "left")
        cols = [F.col("ID"), F.col("c_mktsegment").alias("DSC_SEGMENTO"), F.col("c_acctbal").alias("VAL_SALDO"),
                F.col("c_nationkey").alias("NATION")]
        has_any = F.col("QTD_APL_VIG_T_AUTO").isNotNull()
        for b in LOBS:
            cols.append(F.coalesce(F.col(f"QTD_APL_VIG_T_{b}"), F.lit(0)).cast("long").alias(f"QTD_APL_VIG_T_{b}"))
            cols.append(F.coalesce(F.col(f"VAL_PCA_{b}"), F.lit(0.0)).alias(f"VAL_PCA_{b}"))
            cols.append(F.when(~has_any, "X").when(F.col(f"QTD_APL_VIG_T_{b}") > 0, "S").otherwise("N")
                        .alias(f"DSC_HAS_{b}"))
            cols.append((F.lit(WIDE_REF_MONTH) - F.col(f"_last_{b}")).cast("double")
                        .alias(f"QTD_MESES_ULT_COMPRA_{b}"))
            cols.append(F.coalesce(F.col(f"QTD_APL_REC_{b}"), F.lit(0)).cast("long").alias(f"QTD_APL_REC_{b}"))
        cols.append(F.coalesce(F.col("_t"), F.lit(0)).alias("TARGET"))
        return w.select(*cols)


def union_all(dfs):
    return reduce(lambda a, b: a.unionByName(b), dfs)
