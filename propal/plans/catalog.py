"""Registry of the queries exposed through ``__spark_entry__``.

Each entry: ``name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle_sql or
None)``.  The oracle SQL is DuckDB text over the raw table views; fixture
CTEs are prepended automatically.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixture_sql import with_fixtures
from .fixtures import Fixtures

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(fx: Fixtures) -> DataFrame`` under ``name``."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Fixtures(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = (run, with_fixtures(sql) if sql else None)
        return fn
    return deco


def load_all() -> None:
    from . import q_ingest, q_panel, q_profile, q_features, q_models, q_reports, q_selection, q_sparse, q_versions  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load_all()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    load_all()
    return {k: v[1] for k, v in REGISTRY.items() if v[1]}
