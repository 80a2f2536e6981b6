"""Feature lineage (D44): ``(feature, parent, step)`` edges expanded to the
original source columns, and the source-column list a scoring join needs
(used by B13).  Lineage tables hold one row per derivation edge, i.e. they
scale with the number of features, not with the data."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def expand_lineage(edges: DataFrame) -> DataFrame:
    """``(feature, origin, path, depth)``: every feature linked to the
    original columns it derives from (parents that are never a feature).
    ``path`` is the ' > '-joined chain of steps.  Iterative self-join until no
    derived parent is left; a cycle, which would never end, raises."""
    e = edges.select("feature", "parent", "step").distinct()
    feats = e.select(F.col("feature").alias("node")).distinct()
    longest = feats.count()                     # a longer chain repeats a feature
    frontier = e.select("feature", F.col("parent").alias("node"), F.col("step").alias("path"),
                        F.lit(1).alias("depth"))
    done = frontier.join(feats, "node", "left_anti")
    for depth in itertools.count(2):
        inner = frontier.join(feats, "node", "left_semi")
        frontier = cut_lineage(inner.join(e.withColumnRenamed("feature", "node"), "node")
                               .select("feature", F.col("parent").alias("node"),
                                       F.concat_ws(" > ", "path", "step").alias("path"), F.lit(depth).alias("depth")))
        if frontier.isEmpty():
            return done.withColumnRenamed("node", "origin").dropDuplicates()
        if depth > longest:
            raise ValueError("the lineage has a cycle")
        done = done.unionByName(frontier.join(feats, "node", "left_anti"))


def source_columns(edges: DataFrame, selected: Sequence[str], available: Iterable[str]) -> list[str]:
    """Original columns needed to rebuild ``selected``: lineage origins for
    derived features; a feature without lineage is itself a source if it is
    available, else the name without its last ``_suffix``."""
    available = set(available)
    origins = expand_lineage(edges).where(F.col("feature").isin(list(selected)))
    by_feature: dict[str, set] = {}
    for r in origins.select("feature", "origin").collect():      # bounded by #features
        by_feature.setdefault(r["feature"], set()).add(r["origin"])
    need: list[str] = []
    for f in selected:
        cands = sorted(by_feature.get(f, {f}))
        for c in cands:
            if c not in available and "_" in c:
                c = c.rsplit("_", 1)[0]
            if c in available and c not in need:
                need.append(c)
    return need
