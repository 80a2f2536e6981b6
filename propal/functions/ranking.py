"""Distributed ranks, running sums and exact quantiles.

A window ordered over the whole table (``Window.orderBy`` without
``partitionBy``) moves every row into one task.  Instead:

1. ``repartitionByRange`` on the full (total) order spreads rows over ``P``
   tasks by contiguous key ranges — a hot key value is split because the
   order ends in a unique tie-breaker;
2. the range assignment is frozen with a reliable checkpoint (so a
   recomputation after executor loss sees the same partition ids);
3. running sums inside each range partition are a window partitioned by the
   partition id (each task holds ~N/P rows);
4. per-partition totals (one row per partition) become offsets, broadcast
   back — the broadcast side is bounded by ``P``.

Exact quantiles reuse this over *value counts*, so heavy ties cost one row, and
only the values near a wanted position are counted one by one: a mergeable
sketch brackets each quantile first, and what lies between two brackets is one
row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ..session import cut_lineage, stored


#: Brackets of all groups together that are broadcast (two doubles each).
FEW_BRACKETS = 500_000
#: Groups whose sizes go through one task and are broadcast (a row of some 50 bytes each).
FEW_GROUPS = 100_000


def _n_partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return partitions
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def frozen_ranges(df: DataFrame, order: Sequence[str | Column], weight: str | Column | None = None,
                  partitions: int | None = None) -> DataFrame:
    """``df`` dealt by contiguous ranges of a total ``order``, checkpointed,
    with ``_pid`` (the range) and ``_w`` (the row's weight, 1 when None)."""
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    w_col = F.lit(1).cast("long") if weight is None else (
        F.col(weight) if isinstance(weight, str) else weight)
    ranged = (df.withColumn("_w", w_col).repartitionByRange(_n_partitions(df, partitions), *order_cols)
              .withColumn("_pid", F.spark_partition_id()))
    return cut_lineage(ranged)


def running_over(ranged: DataFrame, order: Sequence[str | Column], out: str = "_cum") -> DataFrame:
    """Inclusive running sum of ``_w`` over ``frozen_ranges`` in the same order."""
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    local = ranged.withColumn(
        "_local",
        F.sum("_w").over(Window.partitionBy("_pid").orderBy(*order_cols)
                         .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    totals = ranged.groupBy("_pid").agg(F.sum("_w").alias("_ptotal"))
    offsets = totals.select(
        "_pid",
        F.coalesce(F.sum("_ptotal").over(
            Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_offset"))
    # offsets has one row per range partition: a bounded broadcast.
    return (local.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_offset") + F.col("_local"))
            .drop("_pid", "_local", "_offset"))


def running_total(df: DataFrame, order: Sequence[str | Column], weight: str | Column | None = None,
                  out: str = "_cum", partitions: int | None = None) -> DataFrame:
    """Add ``out`` = inclusive running sum of ``weight`` (1 per row when None)
    along a total ``order``; also ``_w`` (the row's weight)."""
    return running_over(frozen_ranges(df, order, weight, partitions), order, out)


def stored_in_order(df: DataFrame, order: Sequence[str | Column], columns: Sequence[str], name: str, out: str = "_i",
                    partitions: int | None = None) -> DataFrame:
    """``columns`` of ``df`` and ``out``, the 1-based rank in a total ``order``, stored.

    Rows are shuffled once, by ranges, and sorted where they lie: a row's place
    in its range is its position in the task that writes it, so no window deals
    the rows again, and what only the order needs is not stored."""
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    dealt = df.repartitionByRange(_n_partitions(df, partitions), *order_cols).sortWithinPartitions(*order_cols)
    kept = stored(dealt.select(*columns, F.monotonically_increasing_id().alias("_at")), name, plain=False)
    # the id of a row: 33 bits of its position below the number of its range
    pid, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = kept.groupBy(pid.alias("_pid")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range: a bounded broadcast
    starts = cut_lineage(sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    return kept.join(F.broadcast(starts), pid == F.col("_pid")).select(*columns, (F.col("_start") + place + 1).alias(out))


def group_starts(ranged: DataFrame, by: Sequence[str]) -> tuple[DataFrame, bool]:
    """``(*by, _gn, _g0)``: weight of each group and of the groups before it, for
    ``frozen_ranges`` ordered by ``by`` first; from plain sums, without a rank.
    Also whether the groups are at most FEW_GROUPS (and may be broadcast):
    beyond, their running sum is distributed too."""
    sizes = ranged.groupBy(*by).agg(F.sum("_w").alias("_gn"))
    few = sizes.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS
    if few:
        before = Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1) if by else None
        start = F.coalesce(F.sum("_gn").over(before), F.lit(0)) if by else F.lit(0)
        return sizes.withColumn("_g0", start), True
    cum = running_total(sizes, list(by), "_gn", "_g1")
    return cum.select(*by, "_gn", (F.col("_g1") - F.col("_gn")).alias("_g0")), False


def global_row_number(df: DataFrame, order: Sequence[str | Column], out: str = "ROW_NUMBER",
                      partitions: int | None = None) -> DataFrame:
    """1-based row number over a total order without a single-task window."""
    return running_total(df, order, None, out, partitions).drop("_w")


def _brackets(base: DataFrame, probs: Sequence[float], by: Sequence[str], accuracy: int) -> list[tuple] | None:
    """``(*by, lows, highs)`` per group: disjoint closed intervals in order that
    hold the values at the positions of ``probs``, from a mergeable sketch
    whose ranks are off by at most n / accuracy.  Groups of few values get one
    interval of everything.  None where the groups are too many to broadcast.
    Spark's order of doubles: NaN, which also stands for no upper bound, is the largest."""
    most = FEW_BRACKETS // len(probs)
    reach = 2 / accuracy
    asked = [q for p in probs for q in (max(p - reach, 0.0), min(p + reach, 1.0))]
    rows = (base.groupBy(*by).agg(F.count("*").alias("_n"), F.percentile_approx("_v", asked, accuracy).alias("_s"))
            .limit(most + 1).collect())
    if len(rows) > most:
        return None

    def rank(x: float) -> tuple:
        return math.isnan(x), 0.0 if math.isnan(x) else x
    out = []
    for *key, n, s in rows:
        if not n:       # a table without values still is one group where there is no ``by``
            continue
        parts = [(-math.inf, math.nan)]
        if n > 2 * accuracy:
            found = sorted(((-math.inf if asked[2 * i] <= 0 else s[2 * i], math.nan if asked[2 * i + 1] >= 1 else s[2 * i + 1])
                            for i in range(len(probs))), key=lambda r: (rank(r[0]), rank(r[1])))
            parts = found[:1]
            for low, high in found[1:]:
                if rank(low) <= rank(parts[-1][1]):
                    parts[-1] = (parts[-1][0], max(parts[-1][1], high, key=rank))
                else:
                    parts.append((low, high))
        out.append((*key, [r[0] for r in parts], [r[1] for r in parts]))
    return out


def _counts_near(base: DataFrame, probs: Sequence[float], by: Sequence[str], accuracy: int) -> DataFrame | None:
    """``(*by, _cell, _v, _n1)``: counts of the single values inside a bracket
    (odd cells), and of all values between two brackets (even cells, null
    value), in one aggregate.  None where there are too many groups."""
    found = _brackets(base, probs, by, accuracy)
    if found is None:
        return None
    if by:
        keys = [StructField(f"_b{i}", base.schema[k].dataType) for i, k in enumerate(by)]
        edges = base.sparkSession.createDataFrame(found, StructType(
            [*keys, StructField("_lows", ArrayType(DoubleType())), StructField("_highs", ArrayType(DoubleType()))]))
        same = [F.col(k).eqNullSafe(F.col(f"_b{i}")) for i, k in enumerate(by)]
        rows = base.join(F.broadcast(edges), same)      # FEW_BRACKETS bounds it
        lows, highs, longest = F.col("_lows"), F.col("_highs"), max((len(r[-1]) for r in found), default=1)
    else:
        low, high = found[0][-2:] if found else ([], [])
        rows, longest = base, len(low)
        lows, highs = (F.array(*map(F.lit, a)).cast("array<double>") for a in (low, high))

    def at_most(edges: Column) -> Column:
        return F.size(F.filter(edges, lambda e: e <= F.col("_v")))
    if longest > 16:    # search every 16th edge, then the 16 from there on
        coarse = F.filter(lows, lambda e, i: i % 16 == 0)
        start = F.greatest(at_most(coarse) - 1, F.lit(0)) * 16
        rows = rows.withColumn("_start", start)
        place = F.col("_start") + at_most(F.slice(lows, F.col("_start") + 1, 16))
    else:
        place = at_most(lows)
    rows = rows.withColumn("_k", place)
    inside = (F.col("_k") > 0) & (F.col("_v") <= F.try_element_at(highs, F.greatest("_k", F.lit(1))))
    rows = rows.withColumn("_in", inside)
    cell, single = F.col("_k") * 2 - F.col("_in").cast("int"), F.when(F.col("_in"), F.col("_v"))
    return (rows.select(*by, cell.alias("_cell"), single.alias("_v")).groupBy(*by, "_cell", "_v")
            .agg(F.count("*").alias("_n1")))


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    by: Sequence[str] = (), partitions: int | None = None,
                    approx: bool = False, accuracy: int | None = None) -> DataFrame:
    """Linear-interpolation quantiles (pandas / ``quantile_cont`` semantics)
    of ``value`` per group ``by``.  Returns ``(*by, _q, _i, quantile)`` with
    ``_i`` the index of the probability.  Nulls are ignored.

    Two passes over ``df``: a sketch brackets the positions, then the values in
    the brackets are counted and ranked; the result is exact.  Should a
    position lie outside its bracket, or the groups be too many to broadcast
    brackets, all values are counted.  ``accuracy`` (1000, or 40 per
    probability) trades the sketch's size, about that many values a group and
    task, for narrower brackets.

    ``approx=True`` uses ``percentile_approx`` (bounded memory, one pass).
    """
    probs = [float(p) for p in probs]
    if approx:
        agg = df.where(F.col(value).isNotNull()).groupBy(*by).agg(
            F.percentile_approx(F.col(value).cast("double"), probs, 100000).alias("_qs"))
        return agg.select(*by, F.posexplode("_qs").alias("_i", "quantile")).withColumn(
            "_q", F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("_i") + 1))

    base = df.select(*by, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    near = _counts_near(base, probs, by, accuracy or max(1000, 40 * len(probs)))
    if near is not None:
        found = cut_lineage(_at_positions(near, probs, by, partitions))     # a row per group and probability
        if found.where(F.col("quantile").isNull()).isEmpty():
            return found
    vc = base.groupBy(*by, "_v").agg(F.count("*").alias("_n1")).withColumn("_cell", F.lit(1))
    return _at_positions(vc, probs, by, partitions)


def _at_positions(vc: DataFrame, probs: Sequence[float], by: Sequence[str], partitions: int | None) -> DataFrame:
    """Quantiles from value counts ``(*by, _cell, _v, _n1)`` in the order of
    cell and value; null where a position falls on a row without a value."""
    prob_rows = F.explode(F.array(*[
        F.struct(F.lit(i).alias("_i"), F.lit(p).alias("_q")) for i, p in enumerate(probs)]))
    order = [*by, "_cell", "_v"]
    ranged = frozen_ranges(vc, order, "_n1", partitions)
    cum = running_over(ranged, order, "_cum")
    # per group: size and first cumulative position, from the value counts
    groups, few = group_starts(ranged, by)
    nb = {k: f"_nb{i}" for i, k in enumerate(by)}
    needs = (groups.select(*[F.col(k).alias(nb[k]) for k in by], "_gn", "_g0", prob_rows.alias("_p"))
             .select(*nb.values(), "_gn", "_g0", "_p._i", "_p._q")
             .withColumn("_h", F.col("_q") * (F.col("_gn") - 1))
             .select(*nb.values(), "_i", "_q", "_h", "_g0",
                     F.explode(F.array(F.floor("_h"), F.ceil("_h"))).alias("_pos"))
             .withColumn("_gpos", F.col("_g0") + F.col("_pos")))
    rows = cum.select(*by, "_v", (F.col("_cum") - F.col("_w")).alias("_start"), F.col("_cum").alias("_end"))
    # ``needs`` holds 2 rows per (group, probability).  Few groups (column
    # names, classes, months) are broadcast, so that the values of a group are
    # not gathered by its key; many groups are joined on it.
    cond = [F.col(k).eqNullSafe(F.col(nb[k])) for k in by] + [
        F.col("_start") <= F.col("_gpos"), F.col("_gpos") < F.col("_end")]
    if few:
        needs = F.broadcast(needs)
    hit = rows.join(needs, cond).select(*by, "_i", "_q", "_h", "_pos", "_v")
    out = hit.groupBy(*by, "_i", "_q", "_h").agg(
        F.min(F.struct("_pos", "_v")).alias("_lo"), F.max(F.struct("_pos", "_v")).alias("_hi"))
    frac = F.col("_h") - F.floor("_h")
    return out.select(*by, "_i", "_q",
                      (F.col("_lo._v") + (F.col("_hi._v") - F.col("_lo._v")) * frac).alias("quantile"))


def quantile_edges(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                   digits: int | None = None, approx: bool = False) -> dict:
    """Collect the (small) quantile edges to the driver:
    ``{group_tuple: [edge_0, ...]}`` ordered by probability, rounded to
    ``digits`` when given (exact edges are kept by default: they follow the
    same interpolation as ``quantile_cont`` bit for bit)."""
    rows = exact_quantiles(df, value, probs, by, approx=approx).collect()
    res: dict = {}
    for r in rows:
        key = tuple(r[b] for b in by)
        v = float(r["quantile"])
        res.setdefault(key, []).append((r["_i"], v if digits is None else round(v, digits)))
    return {k: [v for _, v in sorted(lst)] for k, lst in res.items()}
