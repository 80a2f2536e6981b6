"""Sparse encodings and one-scan correlations on small tables."""

import math
import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from propal.functions.moments import pair_correlations
from propal.operators import sparse
from propal.operators.models import correlation_prune


def test_pair_correlations_equal_corr(spark):
    own = random.Random(1)
    rows = [(1e9 + own.gauss(0, 1), None if k % 7 == 0 else own.random(), float(k % 5), 3.0, float("nan") if k % 11 == 0 else 1.0 * k)
            for k in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, c double, flat double, d double").repartition(5)
    out = {(r["a"], r["b"]): (r["n"], r["r"]) for r in pair_correlations(df, [["a", "b", "c", "flat", "d"], ["b", "c"]])
           .where("block = 0").collect()}
    assert len(out) == 10
    clean = df.withColumn("d", F.nanvl("d", F.lit(None)))
    for (x, y), (n, r) in out.items():
        both = clean.where(F.col(x).isNotNull() & F.col(y).isNotNull())
        assert n == both.count()
        if "flat" in (x, y):
            assert r is None
        else:
            assert r == pytest.approx(both.agg(F.corr(x, y)).first()[0], abs=1e-6 if "a" in (x, y) else 1e-9)
    assert pair_correlations(df.limit(0), [["a", "b"]]).collect() == []
    assert pair_correlations(df, [["a"], []]).collect() == []


def test_prune_uses_one_scan(spark):
    df = spark.createDataFrame([(float(k), 2.0 * k + 1, math.sin(k), -math.sin(k)) for k in range(200)],
                               "a double, b double, c double, d double")
    assert correlation_prune(df, ["c", "a", "b", "d"]) == ["c", "a"]
    assert correlation_prune(df, ["c", "a", "b", "d"], fixed=["b"]) == ["b", "c"]


def test_sparse_columns_labels_and_unseen(spark):
    df = spark.createDataFrame([(1, "x", "r / g"), (1, "x", "g"), (2, None, "b / b"), (3, "0", None), (None, "y", "")],
                               "id int, kind string, tags string")
    state = sparse.index_fit(df, ["kind"], {"tags": " / "})
    assert [tuple(r) for r in state.orderBy("POS").collect()] == [
        ("kind", "x", 0), ("kind", "y", 1), ("tags", "b", 2), ("tags", "g", 3), ("tags", "r", 4)]
    out = lambda d, **k: {r["id"]: [tuple(e) for e in r["e"]] for r in sparse.sparse_transform(
        d, state, ["id"], ["kind"], {"tags": " / "}, **k).select("id", sparse.active("features").alias("e")).collect()}
    assert out(df) == {1: [(0, 1.0), (3, 1.0), (4, 1.0)], 2: [(2, 1.0)], 3: [], None: [(1, 1.0)]}
    assert out(df, counts=True)[1] == [(0, 2.0), (3, 2.0), (4, 1.0)]
    new = spark.createDataFrame([(9, "never", "g / never")], df.schema)
    assert out(new) == {9: [(3, 1.0)]}
    assert sparse.sparse_transform(df.limit(0), state, ["id"], ["kind"]).collect() == []


def test_sparse_many_categories_train(spark):
    """More categories than columns could hold; an estimator takes the vector."""
    n = 60_000
    df = spark.range(n).select(F.col("id"), F.concat(F.lit("c"), F.col("id") % 30_000).alias("many"),
                               F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("few"),
                               (F.col("id") % 3 == 0).cast("double").alias("TARGET"))
    state = sparse.index_fit(df, ["many", "few"])
    assert state.count() == 30_000 + 7        # "hot" and 1 to 6: "0" is no category
    x = sparse.sparse_transform(df, state, ["id", "TARGET"], ["many", "few"])
    first = x.where("id = 3").first()["features"]
    assert first.size == 30_007 and len(first.indices) == 2
    model = LogisticRegression(labelCol="TARGET", maxIter=5).fit(x)
    assert model.summary.areaUnderROC > 0.99
