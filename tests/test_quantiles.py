"""Exact quantiles by brackets, against numpy and against counts of all values."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from propal.functions import ranking
from propal.functions.ranking import exact_quantiles

MANY = [i / 100 for i in range(101)]


def found(df, probs, **more):
    rows = exact_quantiles(df, "x", probs, **more).collect()
    keys = more.get("by", [])
    return {(*(r[k] for k in keys), r["_i"]): r["quantile"] for r in rows}


def shapes(n):
    own = random.Random(7)
    return {"even": [float(k) for k in range(n)], "normal": [own.gauss(0, 1e6) for _ in range(n)],
            "a third is one value": [0.0 if k % 3 == 0 else own.random() for k in range(n)],
            "few values": [float(own.randrange(3)) for _ in range(n)], "one value": [4.5] * n,
            "long tail": [math.exp(own.gauss(0, 8)) for _ in range(n)], "small": [own.random() for _ in range(5)],
            "infinite": [own.choice([-math.inf, 1.0, 2.0, math.inf]) for _ in range(n)]}


@pytest.mark.parametrize("probs", [[0.5], [0.0, 0.25, 0.5, 0.75, 1.0], MANY], ids=["one", "five", "many"])
def test_brackets_give_the_exact_values(spark, probs, monkeypatch):
    data = {**shapes(6000), None: [1.0, 2.0, 4.0]}
    df = spark.createDataFrame([(g, x) for g, xs in data.items() for x in [*xs, None]], "g string, x double").repartition(7)
    asked = []
    near = ranking._counts_near
    monkeypatch.setattr(ranking, "_counts_near", lambda *a: asked.append(near(*a)) or asked[-1])
    got = found(df, probs, by=["g"], accuracy=150)
    assert len(asked) == 1 and len(got) == len(data) * len(probs)
    for g, xs in data.items():
        if g == "infinite":
            continue        # differences of infinities are not numbers in any engine
        want = np.quantile(np.array(xs), probs)
        for i in range(len(probs)):
            assert got[g, i] == pytest.approx(want[i], rel=1e-12, abs=1e-300), (g, probs[i])
    if len(probs) < 10:     # between brackets there is one row
        per = {r[0]: r[1] for r in asked[0].groupBy("g").count().collect()}
        assert per["normal"] < 6000 * 0.035 * len(probs)


def test_same_bits_as_all_values(spark, monkeypatch):
    df = spark.createDataFrame([(x,) for x in shapes(5000)["normal"]], "x double").repartition(5)
    near = found(df, MANY, accuracy=120)
    monkeypatch.setattr(ranking, "_counts_near", lambda *a: None)
    assert found(df, MANY) == near


def test_a_missed_bracket_counts_all_values(spark, monkeypatch):
    df = spark.createDataFrame([(float(x),) for x in range(1000)], "x double")
    monkeypatch.setattr(ranking, "_brackets", lambda *a: [([3.0], [5.0])])
    assert found(df, [0.5])[(0,)] == 499.5


def test_many_groups_need_no_brackets(spark, monkeypatch):
    df = spark.range(4000).select((F.col("id") % 40).alias("g"), F.col("id").cast("double").alias("x"))
    want = found(df, [0.5], by=["g"])
    monkeypatch.setattr(ranking, "FEW_BRACKETS", 30)
    assert found(df, [0.5], by=["g"]) == want and len(want) == 40


def test_nan_is_the_largest_and_no_rows_give_none(spark):
    xs = [float(k) for k in range(3000)] + [math.nan] * 1000
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = found(df, [0.0, 0.5, 0.9, 1.0], accuracy=100)
    assert (got[(0,)], got[(1,)]) == (0.0, 1999.5) and math.isnan(got[(2,)]) and math.isnan(got[(3,)])
    for by in ([], ["g"]):
        none = df.where("x < 0").withColumn("g", F.lit(1))
        assert found(none, [0.5], by=by) == {}
