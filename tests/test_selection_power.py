"""Scores of columns and power transforms on small tables."""

import math

import pytest
from pyspark.sql import functions as F

from propal.operators import power, selection


@pytest.fixture(scope="module")
def table(spark):
    rows = [(k, k % 2, float(k % 2), float((k * 7) % 11) - 3, 5.0, None if k % 3 else 1.0) for k in range(200)]
    return spark.createDataFrame(rows, "ID int, TARGET int, same double, noise double, constant double, holes double")


def test_scores_known_values(table):
    out = {r["Variable"]: r for r in selection.feature_scores(
        table, "TARGET", ["same", "noise", "constant", "holes"], bins=4, null_free=False).collect()}
    assert out["same"]["MUTUAL_INFO"] == pytest.approx(math.log(2))
    assert out["same"]["PEARSON"] == pytest.approx(1) and out["same"]["SPEARMAN"] == pytest.approx(1)
    assert out["same"]["CHI2"] == pytest.approx(100)
    assert out["constant"]["MUTUAL_INFO"] == pytest.approx(0) and out["constant"]["PEARSON"] is None
    assert out["noise"]["CHI2"] is None                     # negative values
    assert out["noise"]["F_CLASSIF"] == pytest.approx(out["noise"]["F_REGRESSION"])
    assert out["holes"]["N"] == sum(1 for k in range(200) if k % 3 == 0)
    assert "holes" not in {r["Variable"] for r in selection.feature_scores(table, "TARGET").collect()}


def test_scores_null_target_and_one_class(spark, table):
    some = table.withColumn("TARGET", F.when(F.col("ID") < 100, F.col("TARGET")))
    assert {r["N"] for r in selection.feature_scores(some, "TARGET", ["same", "noise"]).collect()} == {100}
    one = selection.feature_scores(table.where("TARGET = 1"), "TARGET", ["noise"]).first()
    assert one["F_CLASSIF"] is None and one["MUTUAL_INFO"] == pytest.approx(0)
    assert selection.feature_scores(table.limit(0), "TARGET", ["noise"]).collect() == []


def test_select_best(table):
    best = selection.select_best(table, 2, "mutual_info_classif", "pearson", "TARGET", ["same", "noise", "constant"]).collect()
    assert [(r["RANK"], r["Variable"]) for r in best] == [(1, "same"), (2, "noise")]
    with pytest.raises(ValueError):
        selection.select_best(table, 2, "no_such_score")


VALUES = [-50.0, -3.5, -1.0, -0.2, 0.0, 0.1, 0.9, 2.0, 7.0, 31.0, 150.0, 1e6]


@pytest.mark.parametrize("lam", [-2.0, 0.0, 0.3, 1.0, 2.0, 3.1])
@pytest.mark.parametrize("method", power.METHODS)
def test_power_round_trip(spark, method, lam):
    xs = [x for x in VALUES if (x > -1 or method != "box-cox") and x < 1e5]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    t = power.transformed(F.col("x"), F.lit(lam), method)
    for r in df.select("x", t.alias("t"), power.restored(t, F.lit(lam), method).alias("back")).collect():
        assert r["back"] == pytest.approx(r["x"], rel=1e-6, abs=1e-6)
        if lam == 1.0:
            assert r["t"] == pytest.approx(r["x"])


def test_power_fit_transform_inverse(spark):
    rows = [(k, math.exp(k / 100.0) - 1, -math.exp(k / 50.0), 4.0, None, None if k % 9 == 0 else float(k)) for k in range(500)]
    df = spark.createDataFrame(rows, "ID int, up double, down double, flat double, none double, holes double")
    columns = ["up", "down", "flat", "none", "holes"]
    state = power.fit(df, columns)
    found = {r["Variable"]: r for r in state.collect()}
    assert abs(found["up"]["LAMBDA"]) < 0.3 and abs(found["down"]["LAMBDA"] - 2) < 0.3      # logs of each sign
    assert found["flat"]["LAMBDA"] == 1.0 and found["none"]["N"] == 0 and found["none"]["LAMBDA"] is None
    out = power.transform(df, state)
    stats = out.agg(F.avg("up"), F.stddev_pop("up"), F.avg("holes"), F.max(F.abs("flat")), F.count("holes")).first()
    assert stats[0] == pytest.approx(0, abs=1e-6) and stats[1] == pytest.approx(1) and stats[2] == pytest.approx(0, abs=1e-6)
    assert stats[3] == 0 and stats[4] == df.where("holes IS NOT NULL").count()
    back = power.inverse(out, state).join(df.select("ID", *(F.col(c).alias(f"{c}0") for c in columns)), "ID")
    for r in back.collect():
        for c in columns:
            assert r[c] is None if r[f"{c}0"] is None else r[c] == pytest.approx(r[f"{c}0"], rel=1e-6, abs=1e-6)


def test_power_rejects(spark):
    df = spark.createDataFrame([(-2.0,), (3.0,)], "x double")
    with pytest.raises(ValueError):
        power.fit(df, ["x"], "box-cox")
    with pytest.raises(ValueError):
        power.fit(df, ["x"], "other")
