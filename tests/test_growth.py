"""Joins and inputs whose cost once grew faster than the data."""

import os
import threading

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from propal.functions.ranking import stored_in_order
from propal.operators import calibration, fitted, versions
from propal.operators import models as M
from propal.operators import panel as P
from propal.operators import reports as R
from propal.operators import sparse
from propal.plans import q_features, q_models, q_panel, q_reports
from propal.plans.fixtures import Fixtures
from propal.session import stored


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark, tmp_path):
    """Three customers with five orders of two lines each, as table files."""
    at = str(tmp_path)
    spark.range(25).selectExpr("id as n_nationkey", "concat('N', id) as n_name", "id % 5 as n_regionkey").write.parquet(f"{at}/nation.parquet")
    spark.range(5).selectExpr("id as r_regionkey", "concat('R', id) as r_name").write.parquet(f"{at}/region.parquet")
    spark.range(1, 4).selectExpr("id as c_custkey", "'AUTO' as c_mktsegment", "1.5D as c_acctbal", "id as c_nationkey").write.parquet(f"{at}/customer.parquet")
    spark.range(15).selectExpr(
        "id as o_orderkey", "id % 3 + 1 as o_custkey", "'O' as o_orderstatus", "100D + id as o_totalprice",
        "to_date('1997-01-05') + cast(id * 17 as int) as o_orderdate",
        "if(id % 2 = 0, '1-URGENT', '2-HIGH') as o_orderpriority").write.parquet(f"{at}/orders.parquet")
    spark.range(30).selectExpr(
        "id div 2 as l_orderkey", "cast(id % 2 as int) as l_linenumber", "id % 4 as l_partkey", "id as l_suppkey", "to_date('1997-02-01') as l_shipdate",
        "if(id % 3 = 0, 'R', 'N') as l_returnflag", "5D + id as l_quantity", "50D as l_extendedprice", "0.1D as l_discount", "0.2D as l_tax",
        "'F' as l_linestatus").write.parquet(f"{at}/lineitem.parquet")
    spark.range(4).selectExpr("id as p_partkey", "cast(id as int) as p_size", "'T' as p_type", "concat('B', id) as p_brand").write.parquet(f"{at}/part.parquet")
    return Fixtures(spark, at)


def test_monthly_features_are_not_broadcast(spark):
    base = spark.createDataFrame([(199903, 1), (199904, None)], "ANO_MES int, ID long")
    feats = spark.createDataFrame([(199901, 1, 7.0), (199902, None, 8.0)], "ANO_MES int, ID long, V double")
    out = P.lagged_join(base, feats, ["ID"], 2)
    assert "Broadcast" not in _plan(out)
    assert {tuple(r) for r in out.collect()} == {(1, 199903, 7.0), (None, 199904, None)}


@pytest.mark.parametrize("name", ["D12", "B12_policy", "B12"])
def test_registered_lagged_joins(tables, name):
    run = {"D12": q_features.d12, "B12_policy": q_panel.b12pl, "B12": q_panel.b12}[name]
    plan = _plan(run(tables))
    assert "SortMergeJoin" in plan
    # only single tables (nations, regions, customers, first orders) may be broadcast: no join multiplied by month
    for part in plan.split("BroadcastExchange")[1:]:
        depth = len(part.splitlines()[0])
        assert "Generate" not in part.splitlines()[1][:depth]
    if name == "D12":
        assert "Broadcast" not in plan
        assert run(tables).count() == 75


def test_compared_models_read_their_rows_once(spark, tables, monkeypatch):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def scored(i):
        calls.add(1)
        return (i % 100) / 100.0
    rows = spark.range(400).select(F.lit("v1").alias("MODEL_VERSION"), scored("id").alias("S"), (F.col("id") % 3 == 0).cast("int").alias("TARGET"))
    other = spark.range(400).selectExpr("'v2' as MODEL_VERSION", "id / 400D as S", "cast(id % 2 as int) as TARGET")
    assert R.compare_models(rows, other, "S").count() == 20
    assert calls.value == 400
    seen = []
    monkeypatch.setattr(q_reports.R, "compare_models", lambda a, b, score: seen.extend([a, b]) or a.withColumns({"AUC": F.lit(1.0), "BRIER": F.lit(1.0)}))
    q_reports.e16(tables)
    assert all("SortMergeJoin" in _plan(x) for x in seen)


def test_lines_meet_orders_once(tables):
    plan = _plan(tables.line_facts)
    assert plan.count("SortMergeJoin") == 1
    assert tables.line_facts.count() == 30


def test_stored_keeps_rows_types_and_order_of_columns(spark):
    df = spark.createDataFrame([(1, 199901, "a"), (None, 199902, None), (1, 199901, "a")], "ID long, ANO_MES int, T string")
    back = stored(df, "t", ["ANO_MES"])
    assert back.columns == df.columns and back.dtypes == df.dtypes
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_negatives_read_one_month_at_a_time(spark, monkeypatch):
    seen = []
    draw = P.first_by_hash
    monkeypatch.setattr(P, "first_by_hash", lambda df, *a, **k: seen.append(_plan(df)) or draw(df, *a, **k))
    months = [199901 + k for k in range(6)]
    df = spark.range(600).selectExpr("id as ID", "cast(199901 + id % 6 as int) as ANO_MES", "0 as TARGET")
    out = P.negatives_without_reuse(df.unionByName(df.withColumn("ID", F.col("ID") + 600)), months)
    assert out.count() == 6 * (200 // 6) == out.select("ID").distinct().count()
    assert out.columns == ["ID", "ANO_MES", "TARGET"]
    assert all("PartitionFilters: [isnotnull(ANO_MES" in p for p in seen)


def test_folds_hold_only_the_features(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(M.CrossValidator, "fit", lambda self, df: seen.append(df.columns))
    df = spark.range(20).selectExpr("id", "id * 2D as x", "cast(id % 2 as int) as TARGET", "'long text' as note")
    M.grid_search(df, ["x"], "LogisticRegression", {"regParam": [0.1]})
    assert seen == [["x", "TARGET", "WEIGHT"]]


def test_permuted_features_come_in_one_pass(spark, monkeypatch):
    calls = []
    auc = M.roc_auc
    monkeypatch.setattr(M, "roc_auc", lambda *a, **k: calls.append(1) or auc(*a, **k))
    df = spark.range(300).selectExpr("id", "cast(id % 2 as double) as a", "cast(id % 7 as double) as b", "3D as c", "cast(id % 2 as int) as TARGET")
    model = Pipeline(stages=[M.assemble(["a", "b", "c"]), M.algorithm("LogisticRegression", weight=None)]).fit(df)
    rows = {r["feature"]: r for r in M.permutation_importance(model, df, ["a", "b", "c"], ["id"]).collect()}
    assert len(calls) == 2
    assert rows["a"]["importance"] > 0.3 and rows["c"]["importance"] == 0.0


def test_sparse_rows_meet_their_places_before_they_are_shuffled(spark):
    df = spark.createDataFrame([(1, "x", "p / q"), (1, "x", None), (None, "y", "q"), (2, None, "nan"), (3, "new", "")], "k int, c string, l string")
    state = sparse.index_fit(df.where("c is null or c <> 'new'"), ["c"], {"l": " / "})
    out = sparse.sparse_transform(df, state, ["k"], ["c"], {"l": " / "}, counts=True)
    found = {r["k"]: [tuple(e) for e in r["a"]] for r in out.select("k", sparse.active("features").alias("a")).collect()}
    assert found == {1: [(0, 2.0), (2, 1.0), (3, 1.0)], None: [(1, 1.0), (3, 1.0)], 2: [], 3: []}
    assert "SortMergeJoin" not in _plan(out)


def test_scores_of_the_stream_are_sorted_in_many_tasks(spark, tables, monkeypatch):
    """The panel of one small file of customers was written by one task."""
    written = []

    def stop(spark, src, *a):
        written.append(sum(f.endswith(".parquet") for _, _, fs in os.walk(src.removeprefix("file:")) for f in fs))
        raise InterruptedError
    monkeypatch.setattr("propal.streaming.monthly.monitor_months", stop)
    plans = []
    write = type(tables.scores).write
    monkeypatch.setattr(type(tables.scores), "write", property(lambda self: plans.append(_plan(self)) or write.fget(self)))
    with pytest.raises(InterruptedError):
        q_reports.f6s(tables)
    assert written[0] >= 1 and "rangepartitioning" in plans[0]


def test_caps_count_the_values_of_few_valued_columns_only(spark, monkeypatch):
    seen = []
    values = fitted.unpivot
    monkeypatch.setattr(fitted, "unpivot", lambda df, columns, *a, **k: seen.append(list(columns)) or values(df, columns, *a, **k))
    df = spark.range(400).selectExpr("cast(id as double) as many", "cast(id % 8 as double) as eight", "cast(id % 7 as double) as seven",
                                     "cast(null as double) as none", "cast(id % 9 as double) as QTD_x")
    caps = fitted.clip_fit(df, df.columns)
    assert seen == [["eight", "seven", "none", "QTD_x"], ["many", "eight"]]
    assert caps["many"] == (-199.5, 598.5)
    assert sorted(caps) == ["QTD_x", "eight", "many"] and caps["QTD_x"][0] is None


def test_numeric_states_are_fitted_without_joins(spark, monkeypatch):
    plans = {}
    for name in ("median_mode_fit", "clip_fit", "standard_scale_fit"):
        def fit(df, *a, own=getattr(fitted, name), name=name, **k):
            plans[name] = _plan(df)
            return own(df, *a, **k)
        monkeypatch.setattr(versions.FT, name, fit)
    df = spark.range(60).selectExpr("if(id % 5 = 0, null, cast(id as double)) as x", "concat('c', id % 3) as kind", "cast(id % 2 as int) as TARGET")
    state = versions.fit_preparation(df, ["x"], ["kind"])
    assert len(plans) == 3 and not any("Join" in p for p in plans.values())
    assert state.plain["medians"] == {"x": 30.0} and sorted(state.tables) == ["rare", "target_encode"]
    assert versions.prepare(df, state).where("x is null or kind is null").count() == 0
    # a column that is both is fitted as it was encoded
    both = versions.fit_preparation(df.withColumn("kind", F.col("x").cast("int").cast("string")), ["kind"], ["kind"])
    assert 0.0 <= both.plain["medians"]["kind"] <= 1.0


def test_a_row_meets_the_pair_of_its_fold_only(spark):
    df = spark.range(240).coalesce(1).selectExpr("id as k", "cast(id % 11 as double) as x", "cast(id % 11 > 4 + id % 3 as int) as TARGET")
    fit = calibration.fit_calibrated_folds(df, ["x"], "LogisticRegression", {}, ["k"])
    each = fit._each(df).withColumn("FOLD", fit.fold.cast("int"))
    expected = {r["k"]: (r["FOLD"], r[f"_p{r['FOLD']}"]) for r in each.collect()}
    out = fit.out_of_fold(df)
    assert out.columns == ["k", "x", "TARGET", "FOLD", "P1"] and out.count() == 240
    assert {r["k"]: (r["FOLD"], r["P1"]) for r in out.collect()} == expected
    plan = fit.out_of_fold(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Filter") == 3


def test_rows_to_permute_are_ranked_by_one_shuffle(spark, monkeypatch):
    df = spark.range(300).repartition(5).selectExpr("id", "cast(id % 17 as double) as a", "cast(id % 7 as double) as b", "cast(id % 17 > 6 as int) as TARGET")
    model = Pipeline(stages=[M.assemble(["a", "b"]), M.algorithm("LogisticRegression", weight=None)]).fit(df)
    plans = []
    write = type(df).write
    monkeypatch.setattr(type(df), "write", property(lambda self: plans.append(_plan(self)) or write.fget(self)))
    rows = {r["feature"]: r["auc_permuted"] for r in M.permutation_importance(model, df, ["a", "b"], ["id"]).collect()}
    monkeypatch.undo()
    assert len(plans) == 1 and "Window" not in plans[0] and plans[0].count("rangepartitioning") == 1
    # brute force: rows in the hash order, a feature moved on by its distance
    ranked = df.withColumn("_h", F.xxhash64(F.lit(0), "id")).orderBy("_h", "id").toPandas()
    for k, f in enumerate(["a", "b"]):
        moved = ranked.assign(**{f: ranked[f].to_list()[-100 * (k + 1):] + ranked[f].to_list()[:-100 * (k + 1)]})
        scored = M.score_table(model, spark.createDataFrame(moved.drop(columns="_h")), ["id"])
        assert abs(rows[f] - R.roc_auc(scored, "P1").first()[0]) < 1e-12


def test_ranks_stored_in_order(spark):
    df = spark.range(500).repartition(6).selectExpr("id", "if(id % 3 = 0, null, cast(id % 5 as double)) as s", "concat('t', id) as text")
    out = stored_in_order(df, [F.col("s").desc(), "id"], ["text", "id"], "ranks", "rn", partitions=7)
    assert out.columns == ["text", "id", "rn"]
    expected = df.orderBy(F.col("s").desc(), "id").toPandas()["id"].to_list()
    assert [r["id"] for r in out.orderBy("rn").collect()] == expected
    assert sorted(r["rn"] for r in out.collect()) == [*range(1, 501)]
    assert stored_in_order(df.where("id < 0"), ["id"], ["id"], "none").count() == 0


def test_fits_without_keys_store_no_keys(tables, monkeypatch):
    seen = []

    def stop(df, *a, **k):
        seen.append(df.columns)
        raise InterruptedError
    monkeypatch.setattr(q_models, "stored", stop)
    for run in (q_models.e4, q_models.e9):
        with pytest.raises(InterruptedError):
            run(tables)
    assert seen == [[*q_models.NUMF, "TARGET"]] * 2


def test_small_settings_run_side_by_side(spark, monkeypatch):
    """Two settings wait for each other, each once in the variants' fits and in the searches; results keep their order."""
    variants, searches = threading.Barrier(2), threading.Barrier(2)
    near = fitted.near_constant_fit
    monkeypatch.setattr(fitted, "near_constant_fit", lambda *a, **k: (variants.wait(60), near(*a, **k))[1])
    seen = []

    class Found:
        avgMetrics = [0.75]

    def search(df, features, *a, **k):
        searches.wait(60)
        seen.append((df.count(), list(features)))
        return Found
    monkeypatch.setattr(M, "grid_search", search)
    df = spark.range(60).selectExpr("id as ID", "cast(id % 3 = 0 as int) as TARGET", "id * 1.5D as VAL_A", "cast(if(id % 4 = 0, id, 0) as int) as QTD_B")
    found = M.preprocessing_variants(df, "TARGET", keys=["ID"], aggregation=(False,), extras=(None,))
    assert list(found) == ["base", "flags"]
    assert [x[1] for x in found.values()] == [["VAL_A", "QTD_B"], ["VAL_A", "FLG_B"]]
    rows = M.training_grid(df, found, {"LogisticRegression": {}}).collect()
    assert [r["feature_set"] for r in rows] == ["base", "flags"] and sorted(seen) == [(60, ["VAL_A", "FLG_B"]), (60, ["VAL_A", "QTD_B"])]


def test_large_settings_run_one_by_one(spark):
    at = []
    jobs = [lambda k=k: at.append((k, threading.get_ident())) or k for k in range(3)]
    assert M.together(spark, jobs, [spark.range(1000)], room=1000) == [0, 1, 2]
    assert {t for _, t in at} == {threading.get_ident()}
    assert M.together(spark, [], []) == []


def test_small_tables_are_packed(spark):
    small = spark.range(1000).repartition(6)
    assert M.packed(small).rdd.getNumPartitions() == 1 and M.packed(small).count() == 1000
    assert M.packed(small, 100).rdd.getNumPartitions() == 6


def test_shallow_forests_are_cut_from_the_deepest(spark, monkeypatch):
    """One fit for all depths gives the forests, and the search's figures, that a fit for each gives."""
    df = spark.range(3000).selectExpr("cast(hash(id) % 4 + hash(id, 1) % 3 > 0 as int) as TARGET", "hash(id) % 4 + hash(id, 2) % 2 / 2D as A",
                                      "cast(hash(id, 1) % 3 as double) as B", "hash(id, 3) % 50 / 7D as C", "cast(id % 9 as double) as D").repartition(3)
    df = stored(df, "rows")
    grid = {"maxDepth": [4, 1, 2], "numTrees": [3, 6]}
    fits = []
    fit = M.RandomForestClassifier._fit
    monkeypatch.setattr(M.RandomForestClassifier, "_fit", lambda self, d: fits.append(self.getMaxDepth()) or fit(self, d))
    search = M.grid_search(df, ["A", "B", "C", "D"], "RandomForest", grid)
    assert sorted(fits)[:6] == [4] * 6 and len(fits) == 7           # two of each of three folds, and the best
    kind = M.ForestPipeline
    monkeypatch.setattr(M, "ForestPipeline", Pipeline)
    plain = M.grid_search(df, ["A", "B", "C", "D"], "RandomForest", grid)
    assert search.avgMetrics == pytest.approx(plain.avgMetrics, abs=1e-12)
    data = M.assemble(["A", "B", "C", "D"]).transform(df)
    deep, flat = (M.RandomForestClassifier(featuresCol="features", labelCol="TARGET", numTrees=5, maxDepth=k, seed=3).fit(data) for k in (6, 3))
    cut = M.cut_forest(deep, 3)
    assert [t.toDebugString.split("\n", 1)[1] for t in cut.trees] == [t.toDebugString.split("\n", 1)[1] for t in flat.trees]
    assert cut.getMaxDepth() == 3 and cut.getNumTrees == 5
    assert cut.transform(data).select("probability", "prediction").collect() == flat.transform(data).select("probability", "prediction").collect()
    tight = M.RandomForestClassifier(numTrees=500, maxDepth=20)
    assert not kind().same_draws(tight, 40) and kind().same_draws(tight.copy({tight.maxDepth: 5}), 4)
