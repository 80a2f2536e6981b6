"""Saved versions, Shapley values against all orders, calibration."""

import random
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from propal.operators import calibration, shapley, versions
from propal.operators.models import assemble
from propal.session import scratch_path

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def table(spark):
    own = random.Random(4)
    rows = []
    for k in range(400):
        x = [own.gauss(0, 1) for _ in range(3)] + [float(own.randrange(4))]
        y = int(x[0] + 0.5 * x[1] * x[0] + (x[3] > 1) + own.gauss(0, 0.7) > 0.4)
        rows.append((k, *x, own.choice(["p", "q", "r"]), 200001 + k % 12, y))
    return spark.createDataFrame(rows, "ID int, a double, b double, c double, d double, kind string, ANO_MES int, TARGET int").cache()


# ------------------------------------------------------------------ Shapley
def expectation(node, x, known, classes):
    """Value of a JVM tree where only the ``known`` features are looked at."""
    if node.getClass().getSimpleName() == "LeafNode":
        stats = list(node.impurityStats().stats())
        return stats[1] / sum(stats) if classes else node.prediction()
    left, right, f = node.leftChild(), node.rightChild(), node.split().featureIndex()
    if f in known:
        return expectation(left if x[f] <= node.split().threshold() else right, x, known, classes)
    n, m = (shapley._cover(c, classes) for c in (left, right))
    return (n * expectation(left, x, known, classes) + m * expectation(right, x, known, classes)) / (n + m)


def brute(value, k):
    out = []
    for f in range(k):
        rest = [g for g in range(k) if g != f]
        out.append(sum(factorial(n) * factorial(k - n - 1) / factorial(k) * (value({*s, f}) - value(set(s)))
                       for n in range(k) for s in combinations(rest, n)))
    return out


@pytest.mark.parametrize("kind", ["tree", "forest", "boosted"])
def test_shapley_equals_all_orders(table, kind):
    last = {"tree": DecisionTreeClassifier(labelCol="TARGET", maxDepth=5),
            "forest": RandomForestClassifier(labelCol="TARGET", maxDepth=4, numTrees=3, seed=1),
            "boosted": GBTClassifier(labelCol="TARGET", maxDepth=3, maxIter=3, seed=1)}[kind]
    model = Pipeline(stages=[assemble(FEATURES), last]).fit(table)
    stage = model.stages[-1]
    classes = kind != "boosted"
    if kind == "tree":
        trees = [(1.0, stage._java_obj.rootNode())]
    else:
        total = sum(stage.treeWeights) if kind == "forest" else 1.0
        trees = [(w / total, t._java_obj.rootNode()) for w, t in zip(stage.treeWeights, stage.trees)]
    rows = table.limit(6)
    found = {r["ID"]: r for r in shapley.attributions(model, rows, FEATURES, ["ID"]).collect()}
    scored = {r["ID"]: r["p"] for r in model.transform(rows).select("ID", vector_to_array("probability")[1].alias("p")).collect()}
    for r in rows.collect():
        x = [r[f] for f in FEATURES]
        value = lambda known: sum(w * expectation(t, x, known, classes) for w, t in trees)
        mine = found[r["ID"]]
        assert mine["SHAP"] == pytest.approx(brute(value, 4), abs=1e-9)
        assert mine["BASE"] == pytest.approx(value(set())) and mine["OUTPUT"] == pytest.approx(value({0, 1, 2, 3}))
        p = mine["OUTPUT"] if classes else 1 / (1 + np.exp(-2 * mine["OUTPUT"]))
        assert p == pytest.approx(scored[r["ID"]])


def test_shapley_importance_on_positives(table):
    model = Pipeline(stages=[assemble(FEATURES), RandomForestClassifier(labelCol="TARGET", maxDepth=4, numTrees=5, seed=1)]).fit(table)
    out = shapley.importance(model, table, FEATURES, ["ID"], top=2).collect()
    assert len(out) == 2 and out[0]["feature"] == "a" and out[0]["mean_abs"] >= out[1]["mean_abs"]
    assert out[0]["n"] == table.where("TARGET = 1").count()
    assert shapley.importance(model, table.limit(0), FEATURES, ["ID"]).collect() == []
    with pytest.raises(TypeError):
        shapley.ensemble(Pipeline(stages=[assemble(FEATURES), LogisticRegression(labelCol="TARGET")]).fit(table))


# ------------------------------------------------------------------ versions
@pytest.fixture(scope="module")
def store(spark):
    return versions.Store(spark, scratch_path(spark, "versions"))


def pipeline(names):
    return Pipeline(stages=[assemble(names), LogisticRegression(labelCol="TARGET")])


def test_version_round_trip(spark, store, table):
    """A version scores as the model in memory does, also rows with unseen categories and nulls."""
    assert store.current() is None and store.versions() == []
    made = versions.train_version(store, "one", table, pipeline([*FEATURES, "kind"]), FEATURES, ["kind"])
    again = versions.Store(spark, store.root)
    assert again.versions() == ["one"] and again.current() == "one"
    state = versions.fit_preparation(table, FEATURES, ["kind"])
    direct = pipeline([*FEATURES, "kind"]).fit(versions.prepare(table, state))
    new = table.withColumn("kind", F.when(F.col("ID") % 5 == 0, "unseen").otherwise(F.col("kind"))).withColumn(
        "a", F.when(F.col("ID") % 7 != 0, F.col("a")))
    mine = {r["ID"]: (r["P0"], r["P1"], r["TARGET"]) for r in versions.score_version(again, new, ["ID"]).collect()}
    theirs = direct.transform(versions.prepare(new, state)).select("ID", "TARGET", vector_to_array("probability").alias("p"))
    assert len(mine) == 400
    for r in theirs.collect():
        assert mine[r["ID"]] == (pytest.approx(r["p"][0]), pytest.approx(r["p"][1]), r["TARGET"])
    assert made.name == "one"


def test_half_written_version_is_not_read(spark, store, table, monkeypatch):
    before = store.versions(), store.current()
    state = versions.fit_preparation(table, FEATURES, [])
    model = pipeline(FEATURES).fit(versions.prepare(table, state))

    def broken(self, name, value):
        raise OSError("lost before the commit")
    with monkeypatch.context() as m:
        m.setattr(versions.Store, "_write", broken)
        with pytest.raises(OSError):
            store.save("two", state, pipeline(FEATURES), model)
    assert (store.versions(), store.current()) == before
    with pytest.raises(KeyError):
        store.load("two")
    store.save("two", state, pipeline(FEATURES), model, promote=False)      # a second try, in a folder of its own
    assert store.versions() == sorted([*before[0], "two"]) and store.current() == before[1]
    with pytest.raises(FileExistsError):
        store.save("two", state, pipeline(FEATURES), model)
    store.promote("two")
    assert store.current() == "two"
    with pytest.raises(KeyError):
        store.promote("none")


def test_recalibrate_from_version(store, table):
    for name, cats in (("one", ["kind"]), ("two", [])):
        if name not in store.versions():
            versions.train_version(store, name, table, pipeline([*FEATURES, *cats]), FEATURES, cats)
    found = versions.recalibrate_version(store, "two", table, 6, "three", "one")
    assert "three" in store.versions() and found.where("best").count() == 1
    months = table.where("ANO_MES > 200006")
    again = store.load("three")
    direct = pipeline(FEATURES).fit(versions.prepare(months, again.preparation))
    assert again.model.stages[-1].coefficients.toArray() == pytest.approx(direct.stages[-1].coefficients.toArray(), abs=1e-6)


# ------------------------------------------------------------------ calibration
def pooled(values):
    """Pool adjacent violators over [(n, n1)] in order."""
    blocks = []
    for n, n1 in values:
        blocks.append([n, n1, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n, n1, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n, blocks[-1][1] + n1, blocks[-1][2] + k]
    return [b[1] / b[0] for b in blocks for _ in range(b[2])]


def test_isotonic_equals_pooling(spark):
    own = random.Random(2)
    rows = [(round(own.random(), 2), int(own.random() < 0.5)) for _ in range(3000)] + [(None, 1), (0.5, None)]
    df = spark.createDataFrame(rows, "p double, TARGET int")
    fitted = calibration.fit_calibrator(df, "p")
    out = {r["p"]: r["c"] for r in calibration.calibrated(df.where("p IS NOT NULL").select("p").distinct(), fitted, "p", "c").collect()}
    by = {}
    for p, y in rows:
        if p is not None and y is not None:
            n, n1 = by.get(p, (0, 0))
            by[p] = (n + 1, n1 + y)
    expected = pooled([by[p] for p in sorted(by)])
    assert [out[p] for p in sorted(by)] == pytest.approx(expected)
    curve = [r["P"] for r in calibration.isotonic_curve(fitted).orderBy("S").collect()]
    assert curve == sorted(curve)


@pytest.mark.parametrize("method", calibration.METHODS)
def test_calibrated_folds(table, method):
    fitted = calibration.fit_calibrated_folds(table, FEATURES, "RandomForest", {"numTrees": 5, "maxDepth": 3, "seed": 0},
                                              ["ID"], method=method)
    own = fitted.out_of_fold(table).collect()
    assert len(own) == 400 and {r["FOLD"] for r in own} == {0, 1, 2} and all(0 <= r["P1"] <= 1 for r in own)
    rate = sum(r["TARGET"] for r in own) / 400
    assert sum(r["P1"] for r in own) / 400 == pytest.approx(rate, abs=0.02)     # calibrated, in spite of balanced weights
    mean = {r["ID"]: r["P1"] for r in fitted.transform(table.limit(5)).collect()}
    each = {r["ID"]: [r[f"_p{k}"] for k in range(3)] for r in fitted._each(table.limit(5)).collect()}
    assert all(mean[i] == pytest.approx(sum(p) / 3) for i, p in each.items())
    with pytest.raises(ValueError):
        calibration.fit_calibrator(table, "a", method="other")
