"""Saved model versions (E13, E14): fitted state tables, the pipeline and the
fitted model written, listed and loaded as one version.

A version's files go to a folder of their own; only when all are written does
a small file in ``commits`` name that folder.  Without it a version does not
exist: what a failed save leaves is never read, and the next try takes a new
folder.  The current version is the last entry of an append-only log.  Both are
written beside and renamed, so a reader sees a whole file or none.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..session import stored
from ..sources.commits import SmallFiles
from . import fitted as FT
from .models import best_of, last_n_months, pipeline_auc, score_table


@dataclass
class Preparation:
    """The fitted steps between a raw table and a model's matrix: state tables
    by step, and plain states bounded by the number of columns."""
    tables: dict[str, DataFrame] = field(default_factory=dict)
    plain: dict = field(default_factory=dict)


def fit_preparation(df: DataFrame, numeric: Sequence[str], categories: Sequence[str], target: str = "TARGET") -> Preparation:
    """D17 rare categories, D15 target encoding, D19 medians, D24 caps, D26
    scale, each fitted on the result of those before."""
    categories, numeric = list(categories), list(numeric)
    out = Preparation(plain={"categories": categories})
    # encoding leaves other columns as they are: these are fitted on rows that no state is joined to
    apart = df.select(*numeric) if numeric and not set(numeric) & set(categories) else None
    if categories:
        out.tables["rare"] = stored(FT.rare_fit(df, categories), "rare")     # its bytes are known: joined by size
        df = FT.rare_transform(df, out.tables["rare"], categories)
        out.tables["target_encode"] = stored(FT.target_encode_fit(df, categories, target), "target-encode")
        if apart is None:
            df = FT.target_encode_transform(df, out.tables["target_encode"], categories)
    df = df if apart is None else apart
    out.plain["medians"] = FT.median_mode_fit(df, numeric, [])
    df = FT.median_mode_transform(df, out.plain["medians"])
    out.plain["caps"] = {c: list(b) for c, b in FT.clip_fit(df, numeric).items()}
    df = FT.clip_transform(df, {c: tuple(b) for c, b in out.plain["caps"].items()})
    out.plain["scale"] = {c: list(s) for c, s in FT.standard_scale_fit(df, numeric).items()}
    return out


def prepare(df: DataFrame, state: Preparation) -> DataFrame:
    """The steps of ``fit_preparation`` on another table."""
    categories = state.plain["categories"]
    if categories:
        df = FT.rare_transform(df, state.tables["rare"], categories)
        df = FT.target_encode_transform(df, state.tables["target_encode"], categories)
    df = FT.median_mode_transform(df, state.plain["medians"])
    df = FT.clip_transform(df, {c: tuple(b) for c, b in state.plain["caps"].items()})
    return FT.standard_scale_transform(df, {c: tuple(s) for c, s in state.plain["scale"].items()})


@dataclass
class Version:
    name: str
    preparation: Preparation
    pipeline: Pipeline
    model: PipelineModel


class Store(SmallFiles):
    """Versions under a folder of any file system that Spark reads."""

    # -- versions ------------------------------------------------------------
    def versions(self) -> list[str]:
        return [n.removesuffix(".json") for n in self._names("commits")]

    def current(self) -> str | None:
        log = self._names("current")
        return self._read(f"current/{log[-1]}")["version"] if log else None

    def promote(self, version: str) -> None:
        """Make a saved version the current one."""
        if version not in self.versions():
            raise KeyError(version)
        while True:
            log = self._names("current")
            nxt = int(log[-1].removesuffix(".json")) + 1 if log else 1
            if self._write(f"current/{nxt:09d}.json", {"version": version}):
                return

    def save(self, version: str, preparation: Preparation, pipeline: Pipeline, model: PipelineModel,
             promote: bool = True) -> None:
        """Write a version; a name that exists raises.  Not visible before its last file is there."""
        if version in self.versions():
            raise FileExistsError(version)
        folder = f"data/{version}-{uuid.uuid4().hex}"
        for name, table in preparation.tables.items():
            table.write.parquet(f"{self.root}/{folder}/tables/{name}")
        pipeline.write().save(f"{self.root}/{folder}/pipeline")
        model.write().save(f"{self.root}/{folder}/model")
        if not self._write(f"commits/{version}.json", {"folder": folder, "tables": sorted(preparation.tables),
                                                       "plain": preparation.plain}):
            raise FileExistsError(version)
        if promote:
            self.promote(version)

    def load(self, version: str | None = None) -> Version:
        """A saved version; the current one by default."""
        version = version or self.current()
        if version is None or version not in self.versions():
            raise KeyError(version)
        said = self._read(f"commits/{version}.json")
        at = f"{self.root}/{said['folder']}"
        tables = {name: self.spark.read.parquet(f"{at}/tables/{name}") for name in said["tables"]}
        return Version(version, Preparation(tables, said["plain"]), Pipeline.load(f"{at}/pipeline"),
                       PipelineModel.load(f"{at}/model"))


def train_version(store: Store, version: str, df: DataFrame, pipeline: Pipeline, numeric: Sequence[str],
                  categories: Sequence[str], target: str = "TARGET", promote: bool = True) -> Version:
    """Fit preparation and model on ``df`` and save both as a version."""
    state = fit_preparation(df, numeric, categories, target)
    model = pipeline.fit(prepare(df, state))
    store.save(version, state, pipeline, model, promote)
    return store.load(version)


def score_version(store: Store, df: DataFrame, keys: Sequence[str], version: str | None = None,
                  label: str | None = "TARGET") -> DataFrame:
    """E14 from a saved version: prepared as in training, scored by its model."""
    v = store.load(version)
    return score_table(v.model, prepare(df, v.preparation), keys, label)


def recalibrate_version(store: Store, old: str, df: DataFrame, months: int, out: str, champion: str | None = None,
                        label: str = "TARGET", folds: int = 3, seed: int = 0) -> DataFrame:
    """E13 from a saved version: its pipeline refitted on the last ``months``
    months and saved as version ``out``, which becomes the current one if its
    k-fold AUC is not below that of version ``champion`` on the same rows.  Each
    version's rows are prepared by its own states.  Returns ``(version, cv_auc, best)``."""
    recent = last_n_months(df, months, label)
    v = store.load(old)
    rows = stored(prepare(recent, v.preparation), "recent")
    aucs = {"recalibrated": pipeline_auc(v.pipeline, rows, label, folds, seed)}
    if champion:
        rival = store.load(champion)
        aucs["champion"] = pipeline_auc(rival.pipeline, stored(prepare(recent, rival.preparation), "recent"), label, folds, seed)
    store.save(out, v.preparation, v.pipeline, v.pipeline.fit(rows), promote=aucs["recalibrated"] >= max(aucs.values()))
    return best_of(store.spark, aucs)
