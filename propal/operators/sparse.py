"""D2, D14, D42, D43 for any number of categories: sparse 0/1 vectors.

Categories and labels get places in a state table by a distributed count;
rows join it by (column, category), so neither the driver nor the schema holds
a list of them.  The result is one MLlib vector column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import running_total
from ..session import stored

#: Texts that are no category.
NONE = ("", "0", "nan")


def _found(columns: Sequence[str], labels: Mapping[str, str] | None) -> Column:
    """The ``(Variable, category)`` pairs of a row as an array."""
    def pairs(c: str, found: Column) -> Column:
        return F.transform(found, lambda v: F.struct(F.lit(c).alias("Variable"), v.alias("category")))
    each = [pairs(c, F.array(F.col(c).cast("string"))) for c in columns]
    each += [pairs(c, F.coalesce(F.array_distinct(F.split(F.col(c), sep, -1)), F.array().cast("array<string>")))
             for c, sep in (labels or {}).items()]
    return F.filter(F.concat(*each), lambda e: e["category"].isNotNull() & ~e["category"].isin(*NONE))


def entries(df: DataFrame, keys: Sequence[str], columns: Sequence[str], labels: Mapping[str, str] | None = None) -> DataFrame:
    """``(*keys, Variable, category, n)``: the categories of each key in
    ``columns``, and in ``labels`` (column to separator) its labels; ``n`` counts
    the key's rows that have it.  Null, empty, 'nan' and '0' are none."""
    each = df.select(*keys, F.explode(_found(columns, labels)).alias("e")).select(*keys, "e.Variable", "e.category")
    return each.groupBy(*keys, "Variable", "category").agg(F.count("*").alias("n"))


def index_fit(df: DataFrame, columns: Sequence[str], labels: Mapping[str, str] | None = None) -> DataFrame:
    """State ``(Variable, category, POS)``: places from 0 by column and category."""
    found = entries(df, [], columns, labels).select("Variable", "category")
    place = running_total(found, ["Variable", "category"], None, "_upto").drop("_w")
    return stored(place.select("Variable", "category", (F.col("_upto") - 1).cast("int").alias("POS")), "index")


def sparse_transform(df: DataFrame, state: DataFrame, keys: Sequence[str], columns: Sequence[str],
                     labels: Mapping[str, str] | None = None, out: str = "features", counts: bool = False) -> DataFrame:
    """``(*keys, out)``, one row per distinct key of ``df``: a sparse vector as
    long as the state with 1 (with ``counts``: the number of the key's rows) at
    its categories' places.  Categories that the state lacks are left out.  Rows
    meet their places first (a join by the state's size), so that what is
    shuffled is keys and places; rows without a category go along as null."""
    size = int(state.agg(F.coalesce(F.max("POS") + 1, F.lit(0))).first()[0])

    @F.udf(VectorUDT())
    def vector(found):
        found = sorted((e["POS"], e["v"]) for e in found or ())
        return Vectors.sparse(size, [p for p, _ in found], [v for _, v in found])
    weight = F.col("n").cast("double") if counts else F.lit(1.0)
    each = df.select(*keys, F.explode_outer(_found(columns, labels)).alias("e")).select(*keys, "e.Variable", "e.category")
    placed = each.join(state, ["Variable", "category"], "left").groupBy(*keys, "POS").agg(F.count("*").alias("n"))
    place = F.when(F.col("POS").isNotNull(), F.struct("POS", weight.alias("v")))        # null ones are not collected
    return placed.groupBy(*keys).agg(F.collect_list(place).alias("_found")).select(*keys, vector("_found").alias(out))


def active(vector: str) -> Column:
    """Places and values of a column of sparse vectors, ``array<struct<pos, value>>``."""
    plain = F.unwrap_udt(F.col(vector))
    return F.zip_with(plain["indices"], plain["values"], lambda p, v: F.struct(p.alias("pos"), v.alias("value")))
