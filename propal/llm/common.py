"""Shared column conventions of the text operators.

Conventions that hold for every operator here unless its docstring says more:

* an operator selects the columns that it needs before anything else, so
  further columns of any name in the input cannot clash with its own;
* a null text counts as the empty text;
* ``doc_id`` names a document: rows that repeat a doc_id are one document for
  keep/drop decisions; a null doc_id sorts below every integer, and where rows
  are dropped by doc_id, a row without one stays, as nothing names it;
* an empty table gives an empty result with the same columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """``(doc_id long, text string)`` with null texts as empty ones."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose doc_id is not in ``dropped``
    (one column ``doc_id``).  A row with a null doc_id always stays."""
    gone = dropped.where("doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` written as a table in the shared folder and read again.  Unlike a
    checkpoint, which keeps the size that the plan estimated, its size is that
    of its files: in a loop of joins, estimates multiply round by round until
    the planner is busy with numbers of millions of digits."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``most`` bytes of ``column`` (a
    single longer text stays whole): what a task holds at once is bounded."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = batch.column(column).nbytes
        step = max(1, int(batch.num_rows * most / max(size, 1)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
