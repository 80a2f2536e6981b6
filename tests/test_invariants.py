"""Invariants of SURVEY §5 on the sf0.001 tables."""

from pyspark.sql import functions as F

from propal.operators import fitted as FT
from propal.operators import panel as P
from propal.operators import reports as R
from propal.plans.fixtures import Fixtures
from tests.conftest import SF_SMALL


def test_decile_report_totals(spark):
    fx = Fixtures(spark, SF_SMALL)
    df = fx.line_scored
    rep = R.decile_report(df, "PR_0").collect()
    assert sum(r["Target 1"] for r in rep) == df.where("TARGET = 1").count()
    assert sum(r["Target 0"] + r["Target 1"] for r in rep) == df.count()
    assert max(rep, key=lambda r: r["Decile"])["Cumulative rate (%)"] == 100.0


def test_negatives_used_once(spark):
    fx = Fixtures(spark, SF_SMALL)
    t0 = fx.universe.where(F.col("TARGET") == 0).select("ANO_MES", "ID")
    months = P.months_between_list(200001, 200012)
    picked = P.negatives_without_reuse(t0.where(F.col("ANO_MES").isin(months)), months, "ID")
    assert picked.count() == picked.select("ID").distinct().count()


def test_roll_universe_has_no_conflicting_labels(spark):
    fx = Fixtures(spark, SF_SMALL)
    u = fx.universe
    rolled = P.roll_universe(u.where(F.col("ANO_MES") < 200012), u.where(F.col("ANO_MES") == 200012), 200012, 12)
    new_buyers = u.where((F.col("ANO_MES") == 200012) & (F.col("TARGET") == 1)).select("ID")
    old_zero = rolled.where((F.col("ANO_MES") < 200012) & (F.col("TARGET") == 0)).join(new_buyers, "ID", "left_semi")
    assert old_zero.count() == 0


def test_fill_leaves_no_nulls(spark):
    fx = Fixtures(spark, SF_SMALL)
    df = fx.line_nulls.select("l_tax", "p_brand", "l_quantity")
    out = FT.constant_fill(FT.median_mode_transform(df, FT.median_mode_fit(df, ["l_tax"], ["p_brand"])))
    nulls = out.select(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in out.columns]).first()
    assert all(v == 0 for v in nulls)


def test_lagged_join_never_sees_later_months(spark):
    fx = Fixtures(spark, SF_SMALL)
    feat = fx.customer_snap.select(F.col("ID_CLIENTE_ANON").alias("ID"), "ANO_MES",
                                   F.col("ANO_MES").alias("SRC_MES"))
    j = P.lagged_join(fx.universe, feat, ["ID"], 2)
    bad = j.where(F.col("SRC_MES").isNotNull() & (F.col("SRC_MES") != P.add_months_yyyymm(F.col("ANO_MES"), -2)))
    assert bad.count() == 0


def test_sample_is_exact_and_repeatable(spark):
    fx = Fixtures(spark, SF_SMALL)
    cand = fx.universe.where("TARGET = 0")
    a = P.sample_exact(cand, "ID", 50).select("ANO_MES", "ID").collect()
    b = P.sample_exact(cand.repartition(3), "ID", 50).select("ANO_MES", "ID").collect()
    assert len(a) == 50 and sorted(a) == sorted(b)


def test_streaming_monitoring_is_incremental_and_idempotent(spark):
    from propal.session import scratch_path
    from propal.streaming.monthly import monitor_months
    fx = Fixtures(spark, SF_SMALL)
    src, out, ck = (scratch_path(spark, n) for n in ("t-scores", "t-mon", "t-ckpt"))
    scores = fx.scores
    months = [r[0] for r in scores.select("ANO_MES").distinct().collect()]
    assert (min(months), max(months)) == fx.span
    scores.where(F.col("ANO_MES") <= 199906).write.partitionBy("ANO_MES").parquet(src)
    monitor_months(spark, src, fx.purchases, out, ck)
    first = spark.read.parquet(out).select("ANO_MES").distinct().count()
    scores.where(F.col("ANO_MES") > 199906).write.mode("append").partitionBy("ANO_MES").parquet(src)
    monitor_months(spark, src, fx.purchases, out, ck)          # only the new months are processed
    monitor_months(spark, src, fx.purchases, out, ck)          # nothing new: no change
    res = spark.read.parquet(out)
    assert first == sum(m <= 199906 for m in months) and res.select("ANO_MES").distinct().count() == len(months)
    assert res.count() == len(months) * 100
