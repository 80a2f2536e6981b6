"""Shapley values of tree models, for the rows of the positive class.

The value of a set of features is the tree's mean where the other features'
splits are averaged by the training rows in each branch (path-dependent).  A
leaf adds to a feature on its path by the share of orders in which that feature
decides whether the leaf is reached; over all rows of a batch these shares are
a product of small polynomials, in arrays.  One pass over the rows; the model's
trees are the only broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Leaf:
    """Value of a leaf, and per feature on its path the splits ``(threshold or
    left categories, goes left)`` and the share of training rows that follow them."""
    value: float
    splits: dict[int, list[tuple]]
    share: dict[int, float]


def _cover(node, classes: bool) -> float:
    stats = list(node.impurityStats().stats())
    return float(sum(stats)) if classes else float(stats[0])


def leaves(root, classes: bool) -> list[Leaf]:
    """Leaves of a tree (a JVM node).  A classification leaf is its share of class 1."""
    out: list[Leaf] = []

    def walk(node, splits: dict, share: dict) -> None:
        if node.getClass().getSimpleName() == "LeafNode":
            stats = list(node.impurityStats().stats())
            value = float(stats[1] / sum(stats)) if classes else float(node.prediction())
            out.append(Leaf(value, splits, share))
            return
        split, whole = node.split(), _cover(node, classes)
        feature = split.featureIndex()
        continuous = split.getClass().getSimpleName() == "ContinuousSplit"
        rule = float(split.threshold()) if continuous else frozenset(float(c) for c in split.leftCategories())
        for child, left in ((node.leftChild(), True), (node.rightChild(), False)):
            part = _cover(child, classes) / whole
            walk(child, splits | {feature: [*splits.get(feature, []), (rule, left)]},
                 share | {feature: share.get(feature, 1.0) * part})
    walk(root, {}, {})
    return out


def ensemble(model: PipelineModel) -> tuple[list[tuple[float, list[Leaf]]], bool]:
    """``(weight, leaves)`` of the trees of a pipeline's last stage (decision
    tree, random forest, gradient-boosted trees), and whether it is a
    classification forest, whose output is P(1); boosted trees give the margin."""
    last = model.stages[-1]
    kind = type(last).__name__
    if kind.startswith("DecisionTree"):
        classes = "Classification" in kind
        return [(1.0, leaves(last._java_obj.rootNode(), classes))], classes
    if not kind.startswith(("RandomForest", "GBT")):
        raise TypeError(f"not a tree model: {kind}")
    classes = kind == "RandomForestClassificationModel"
    weights = [float(w) for w in last.treeWeights]
    total = sum(weights) if kind.startswith("RandomForest") else 1.0
    return [(w / total, leaves(t._java_obj.rootNode(), classes)) for w, t in zip(weights, last.trees)], classes


def _reached(x: np.ndarray, splits: list[tuple]) -> np.ndarray:
    """Which rows follow all splits on one feature."""
    on = np.ones(len(x), bool)
    for rule, left in splits:
        goes = x <= rule if isinstance(rule, float) else np.isin(x, list(rule))
        on &= goes == left
    return on


def values(trees: list[tuple[float, list[Leaf]]], x: np.ndarray) -> tuple[np.ndarray, float]:
    """Shapley values (rows x features) of a matrix and the value of no feature;
    with the row's values it sums to the model's output."""
    phi = np.zeros(x.shape)
    base = 0.0
    for weight, tree in trees:
        for leaf in tree:
            amount = weight * leaf.value
            names = list(leaf.splits)
            base += amount * float(np.prod([leaf.share[f] for f in names]))
            d = len(names)
            on = [_reached(x[:, f], leaf.splits[f]).astype(float) for f in names]
            orders = np.array([factorial(k) * factorial(d - k - 1) / factorial(d) for k in range(d)])
            for i, f in enumerate(names):
                # product over the others of (share + on * t): by how many of them are known
                poly = np.zeros((d, len(x)))
                poly[0] = 1.0
                for n, (j, g) in enumerate((j, g) for j, g in enumerate(names) if j != i):
                    poly[1:n + 2] = poly[1:n + 2] * leaf.share[g] + poly[:n + 1] * on[j]
                    poly[0] *= leaf.share[g]
                phi[:, f] += amount * (orders @ poly) * (on[i] - leaf.share[f])
    return phi, base


def attributions(model: PipelineModel, df: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``(*keys, SHAP array<double>, BASE, OUTPUT)``, one row per row of ``df``:
    a value per feature, their base, and the model's output (their sum)."""
    trees, _ = ensemble(model)
    sent = df.sparkSession.sparkContext.broadcast(trees)
    matrix = df
    for stage in model.stages[:-1]:
        matrix = stage.transform(matrix)
    vector = model.stages[-1].getFeaturesCol()
    matrix = matrix.select(*keys, vector_to_array(vector).alias("_x"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in matrix.schema.fields[:-1]]
                       + ["SHAP array<double>", "BASE double", "OUTPUT double"])
    width = len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(len(keys)).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            phi, base = values(sent.value, x)
            shap = pa.ListArray.from_arrays(pa.array(np.arange(0, phi.size + 1, width), pa.int32()), pa.array(phi.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], shap, pa.array(np.full(len(x), base)), pa.array(base + phi.sum(axis=1))],
                names=[*batch.schema.names[:-1], "SHAP", "BASE", "OUTPUT"])
    return matrix.mapInArrow(run, schema)


def importance(model: PipelineModel, df: DataFrame, features: Sequence[str], keys: Sequence[str], label: str = "TARGET",
               top: int = 20) -> DataFrame:
    """``feature, mean_abs, mean, impurity, n`` over the rows of the positive
    class, the ``top`` features by mean absolute Shapley value; ``impurity`` is
    the model's normalised importance."""
    positives = attributions(model, df.where(F.col(label) == 1), features, keys)
    share = [float(v) for v in model.stages[-1].featureImportances.toArray()]
    names = df.sparkSession.createDataFrame(
        [(k, f, share[k] / (sum(share) or 1.0)) for k, f in enumerate(features)], "pos int, feature string, impurity double")
    found = positives.select(F.posexplode("SHAP").alias("pos", "v")).groupBy("pos").agg(
        F.avg(F.abs("v")).alias("mean_abs"), F.avg("v").alias("mean"), F.count("*").alias("n"))
    return (names.join(found, "pos").select("feature", "mean_abs", "mean", "impurity", "n")
            .orderBy(F.col("mean_abs").desc(), "feature").limit(top))
