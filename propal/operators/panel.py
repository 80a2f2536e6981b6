"""Universe / panel construction (group B): month spines, eligibility
filters, monthly targets, sampling, lagged feature joins and universe
maintenance.  Months are ``INT yyyymm`` at the edges.

Every step handles all months in one pass (``ANO_MES`` is a join / group
key), except B8 whose months depend on each other.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import percent_text_to_double
from ..functions.ranking import frozen_ranges, group_starts, running_over
from ..session import cut_lineage, stored
from .profile import wide_agg

# --- fixed values (eligibility rules) -----------------------------------------
RISK_FLAGS = ("FLG_CONFIDENCIALIDADE", "FLG_EMPREG_FIDEL", "FLG_INCIDENCIAS", "FLG_CLIENTE_BLOQUEADO",
              "FLG_FALECIDO", "FLG_CONTACTO_MKT", "FLG_CLIENTE_MEDIADOR")


# ---------------------------------------------------------------- months (B1)
def months_between_list(start: int, end: int) -> list[int]:
    """Inclusive list of yyyymm months (driver side, bounded by the window)."""
    out, y, m = [], start // 100, start % 100
    while y * 100 + m <= end:
        out.append(y * 100 + m)
        m += 1
        if m == 13:
            y, m = y + 1, 1
    return out


def shift_month(yyyymm: int, k: int) -> int:
    idx = (yyyymm // 100) * 12 + (yyyymm % 100 - 1) + k
    return (idx // 12) * 100 + idx % 12 + 1


def month_index(c: Column) -> Column:
    """yyyymm -> year*12 + month (integer arithmetic; months are positive)."""
    return (c / 100).cast("int") * 12 + c % 100


def add_months_yyyymm(c: Column, k: int | Column) -> Column:
    """Month arithmetic on INT yyyymm columns (integer ops only)."""
    idx = (c / 100).cast("int") * 12 + (c % 100 - 1) + k
    return ((idx / 12).cast("int") * 100 + idx % 12 + 1).cast("int")


def month_spine(spark: SparkSession, start: int, end: int, name: str = "ANO_MES") -> DataFrame:
    """B1: inclusive month spine as a one-column DataFrame."""
    s = f"{start // 100:04d}-{start % 100:02d}-01"
    e = f"{end // 100:04d}-{end % 100:02d}-01"
    d = F.explode(F.sequence(F.to_date(F.lit(s)), F.to_date(F.lit(e)), F.expr("interval 1 month")))
    return spark.range(1).select(d.alias("_d")).select(
        (F.year("_d") * 100 + F.month("_d")).cast("int").alias(name))


def month_spine_of(df: DataFrame, date_col: str, name: str = "ANO_MES") -> DataFrame:
    """B1 over data: every month from the first to the last date of
    ``date_col`` (one aggregate row, then a bounded explode)."""
    b = df.agg(F.trunc(F.min(date_col), "month").alias("_lo"), F.trunc(F.max(date_col), "month").alias("_hi"))
    return b.select(F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 month"))).alias("_d")).select(
        (F.year("_d") * 100 + F.month("_d")).cast("int").alias(name))


def past_months(end: int, n: int) -> list[int]:
    """Current and ``n`` previous months (monitoring history)."""
    return [shift_month(end, -k) for k in range(n, -1, -1)]


def panel(df: DataFrame, start: int, end: int, name: str = "ANO_MES") -> DataFrame:
    """Every row of ``df`` for every month (explode of a bounded literal list,
    no join)."""
    months = months_between_list(start, end)
    return df.withColumn(name, F.explode(F.array(*[F.lit(m) for m in months])))


# ---------------------------------------------------------- eligibility
#: Words of a predicate that are not columns.
_PREDICATE_WORDS = frozenset("AND OR NOT IN IS NULL BETWEEN LIKE TRUE FALSE".split())


def apply_predicates(df: DataFrame, predicates: Sequence[str]) -> DataFrame:
    """Configurable predicates such as ``QTD_IDADE >= 18``: the left column is
    stripped of '%' and cast to DOUBLE (strings quoted with ' are kept as is).
    Every name in it must be a column of ``df``; functions are refused."""
    for p in predicates:
        bare = re.sub(r"'[^']*'", "''", p)
        names = [n for n in re.findall(r"[^\W\d]\w*", bare) if n.upper() not in _PREDICATE_WORDS]
        unknown = [n for n in names if n not in df.columns]
        if unknown or not names or re.search(r"[;`]|--|/\*", bare):
            raise ValueError(f"predicate on unknown columns {unknown}: {p!r}")
        if "'" not in p:
            df = df.withColumn(names[0], percent_text_to_double(F.col(names[0])))
        df = df.where(F.expr(p))
    return df


def eligible_customers(snap: DataFrame, person_types: Sequence[str], predicates: Sequence[str] = (),
                       flags: Sequence[str] = RISK_FLAGS) -> DataFrame:
    """B2: person type in list, all risk flags 0, extra predicates."""
    cond = F.col("IND_PSIN_PCOL_ENI").isin(list(person_types))
    for f in flags:
        cond = cond & (F.col(f).cast("int") == 0)
    return apply_predicates(snap.where(cond), predicates)


def eligible_policies(pol: DataFrame, products: Sequence[str], predicates: Sequence[str] = ()) -> DataFrame:
    """In force, individual catalogue, product in list, predicates."""
    cond = ((F.col("FLG_APL_EM_VIGOR").cast("int") == 1) & (F.col("COD_PRODUTO_CATALOG") == "INDIVIDUAL")
            & F.col("DSC_PRODUTO_SO_APL").isin(list(products)))
    return apply_predicates(pol.where(cond), predicates)


def in_force(pol: DataFrame) -> DataFrame:
    return pol.where(F.col("FLG_APL_EM_VIGOR").cast("int") == 1)


def cancelled(pol: DataFrame) -> DataFrame:
    return pol.where(F.col("FLG_APL_ANULADA").cast("int") == 1)


def cancel_reason(pol: DataFrame, reasons: Sequence[str]) -> DataFrame:
    return pol.where(F.col("DSC_MOTIVO_ANUL_APL").isin(list(reasons))).select("ID_APOLICE")


# ------------------------------------------------------------- targets
def monthly_target(events: DataFrame, eligible: DataFrame) -> DataFrame:
    """TARGET=1 = in ``events`` of month M; TARGET=0 = in ``eligible`` of
    month M (both ``(ANO_MES, ID)``) without an event in M.  All months at once."""
    pos = events.select("ANO_MES", "ID").distinct()
    neg = eligible.select("ANO_MES", "ID").join(pos, ["ANO_MES", "ID"], "left_anti")
    return build_universe(pos, neg)


def known_since(first: DataFrame, start: int, end: int, lag: int = 2) -> DataFrame:
    """``(ANO_MES, ID)`` of the months from ``start`` to ``end`` in which an id
    with a first month (``ID, FIRST_MES``) has been known for ``lag`` months."""
    known = panel(first, start, end).where(F.col("FIRST_MES") <= add_months_yyyymm(F.col("ANO_MES"), -lag))
    return known.select("ANO_MES", "ID")


def build_universe(target1: DataFrame, target0: DataFrame) -> DataFrame:
    """Label and union."""
    return (target1.select("ANO_MES", "ID").withColumn("TARGET", F.lit(1))
            .unionByName(target0.select("ANO_MES", "ID").withColumn("TARGET", F.lit(0))))


def general_positives(universe: DataFrame, start: int, end: int, before: int = 2, after: int = 3) -> DataFrame:
    """Ids positive in any month of [start-before, end+after]."""
    lo, hi = shift_month(start, -before), shift_month(end, after)
    return (universe.where((F.col("TARGET") == 1) & F.col("ANO_MES").between(lo, hi))
            .select("ID").distinct())


def exclude_general_target1(universe: DataFrame, start: int, end: int) -> DataFrame:
    """Drop TARGET=0 rows of ids positive anywhere in the widened window."""
    gp = general_positives(universe, start, end)
    t0 = universe.where(F.col("TARGET") == 0).join(gp, "ID", "left_anti")
    return universe.where(F.col("TARGET") == 1).unionByName(t0.select(*universe.columns))


def sample_key(id_col: str, seed: int) -> Column:
    """Deterministic pseudo-random order key (same hex in Spark and DuckDB)."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")))


def row_number_within(df: DataFrame, by: Sequence[str], order: Sequence[str | Column],
                      out: str = "_rn") -> DataFrame:
    """Row number inside groups ``by`` along ``order`` without sending a group
    to one task: a global running count over (by, order) minus the rows of the
    groups before, which plain counts give."""
    full = [*by, *order]
    ranged = frozen_ranges(df, full)
    cum = running_over(ranged, full, "_g_cum").drop("_w")
    if not by:
        return cum.withColumnRenamed("_g_cum", out)
    starts, few = group_starts(ranged, by)
    starts = starts.select(*[F.col(b).alias(f"_s_{b}") for b in by], "_g0")
    same = reduce(Column.__and__, [F.col(b).eqNullSafe(F.col(f"_s_{b}")) for b in by])
    return (cum.join(F.broadcast(starts) if few else starts, same)
            .withColumn(out, F.col("_g_cum") - F.col("_g0")).select(*df.columns, out))


def first_by_hash(df: DataFrame, n: int, id_col: str, seed: int = 0) -> DataFrame:
    """Exactly the first ``n`` rows (or all) in md5(seed|id) order.  Counts by
    the first 4 hex digits (at most 65,536 rows) find the digits at which n is
    reached: rows below are taken where they lie, and only the rows with these
    digits are ranked.  Rows without an id come last."""
    cols = df.columns
    h = (df.withColumn("_h", sample_key(id_col, seed))
         .withColumn("_d", F.coalesce(F.substring("_h", 1, 4), F.lit("no id"))))
    left, edge = n, None
    for r in sorted(h.groupBy("_d").count().collect()):
        if left <= r["count"]:
            edge = r["_d"]
            break
        left -= r["count"]
    if n <= 0:
        return df.where(F.lit(False))
    if edge is None:
        return df
    # the remaining columns make the order total when an id repeats (repeatable draw)
    w = Window.partitionBy("_d").orderBy("_h", id_col, *[c for c in cols if c != id_col])
    last = h.where(F.col("_d") == edge).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= left)
    return h.where(F.col("_d") < edge).select(*cols).unionByName(last.select(*cols))


def sample_exact(df: DataFrame, id_col: str, n: int, seed: int = 0,
                 exclude: DataFrame | None = None) -> DataFrame:
    """Anti-filter on ids, then exactly ``n`` rows (or all when fewer) in
    md5(seed|id) order (``first_by_hash``)."""
    if exclude is not None:
        df = df.join(exclude.select(id_col).distinct(), id_col, "left_anti")
    return first_by_hash(df, n, id_col, seed)


def sample_per_group(df: DataFrame, by: Sequence[str], id_col: str, sizes: DataFrame,
                     seed: int = 0) -> DataFrame:
    """Exact-n sample inside each group; ``sizes`` = (by..., _n) (one row per
    group)."""
    cols = df.columns
    ranked = row_number_within(df.withColumn("_h", sample_key(id_col, seed)), by, ["_h", id_col])
    return ranked.join(sizes, list(by)).where(F.col("_rn") <= F.col("_n")).select(*cols)


def negatives_without_reuse(target0: DataFrame, months: Sequence[int], id_col: str = "ID",
                            seed: int = 0) -> DataFrame:
    """Per month in order, sample int(N_m / n_months) negatives among ids
    not sampled in an earlier month.  Month m depends on months < m, so this
    is a driver loop over the (bounded) month list.  The candidates are
    written once to the shared scratch folder, a folder a month, so that a month
    reads its own rows only; each month's picks are checkpointed, and the
    anti-join reads their union, compacted every ten months."""
    wanted = target0.where(F.col("ANO_MES").isin(list(months)))
    cand_all = stored(wanted.repartitionByRange("ANO_MES", F.col(id_col)), "candidates", ["ANO_MES"])
    counts = {r["ANO_MES"]: r["n"] for r in
              cand_all.groupBy("ANO_MES").agg(F.count("*").alias("n")).collect()}  # one row per month
    n_parts = int(target0.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole: list[DataFrame] = []     # picks so far: one part that was compacted, and the latest months
    for m in months:
        k = int(counts.get(m, 0) / len(months))
        if not k:
            continue
        cand = cand_all.where(F.col("ANO_MES") == m)
        if whole:
            taken = reduce(DataFrame.unionByName, whole).select(id_col)
            cand = cand.join(taken.coalesce(n_parts), id_col, "left_anti")
        whole.append(cut_lineage(first_by_hash(cand, k, id_col, seed).coalesce(n_parts)))
        if len(whole) > 10:         # plans and partitions stay few
            whole = [cut_lineage(reduce(DataFrame.unionByName, whole).coalesce(n_parts))]
    return reduce(DataFrame.unionByName, whole) if whole else target0.where(F.lit(False))


# ---------------------------------------------------------- reports
def target_rate_by_month(universe: DataFrame, id_col: str = "ID") -> DataFrame:
    """Per month: distinct ids, # target 0 / 1 and % target 1."""
    return (universe.groupBy("ANO_MES").agg(
        F.count_distinct(id_col).alias("N_IDS"),
        F.sum((F.col("TARGET") == 0).cast("long")).alias("N_TARGET0"),
        F.sum((F.col("TARGET") == 1).cast("long")).alias("N_TARGET1"),
        F.round(F.avg((F.col("TARGET") == 1).cast("double")) * 100, 4).alias("PCT_TARGET1")))


def distinct_ids_with_total(df: DataFrame, id_col: str = "ID") -> DataFrame:
    """Distinct ids per month plus a 'TOTAL UNIQUE' row (rollup)."""
    r = df.rollup("ANO_MES").agg(F.count_distinct(id_col).alias("N_IDS"), F.grouping("ANO_MES").alias("_g"))
    return r.select(F.when(F.col("_g") == 1, F.lit("TOTAL UNIQUE"))
                    .otherwise(F.col("ANO_MES").cast("string")).alias("ANO_MES"), "N_IDS")


# --------------------------------------------------------- lagged joins
def lagged_join(base: DataFrame, feature: DataFrame, keys: Sequence[str], lag: int,
                how: str = "left", suffix: str = "", month_col: str = "ANO_MES",
                columns: Sequence[str] | None = None) -> DataFrame:
    """Join ``feature`` observed ``lag`` months before the base month, for
    all months at once: the feature month is moved forward by ``lag`` and
    becomes part of the equi-join key.  Overlapping non-key columns get
    ``suffix``; nothing from months after M-lag can reach the row.  Both sides
    are shuffled: feature tables have rows by month, which Spark's estimate of
    their size leaves out."""
    keys = list(keys)
    cols = [c for c in (columns or feature.columns) if c not in keys and c != month_col]
    f = feature.select(*keys, add_months_yyyymm(F.col(month_col), lag).alias(month_col), *cols)
    overlap = set(cols) & set(base.columns)
    if suffix:
        f = f.select(*keys, month_col, *[F.col(c).alias(c + suffix) for c in cols])
    elif overlap:
        raise ValueError(f"overlapping columns {sorted(overlap)}: give a suffix")
    return base.join(f.hint("merge"), [*keys, month_col], how)


def lagged_feature_join(universe: DataFrame, features: Sequence[tuple]) -> DataFrame:
    """Chain of lagged joins ``(df, keys, lag, how, suffix)``; the
    universe keeps one partitioning on (id, month) across the chain."""
    out = universe
    for spec in features:
        df, keys, lag, how, suffix = (list(spec) + [None] * 5)[:5]
        out = lagged_join(out, df, keys, lag, how or "left", suffix or "")
    return out


def dim_join(df: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a dimension; Spark broadcasts it by its size in bytes."""
    return df.join(dim, on, how)


# ------------------------------------------------------ universe upkeep
def roll_universe(history: DataFrame, new: DataFrame, new_month: int, n_months: int,
                  id_col: str = "ID") -> DataFrame:
    """Keep history months > new-N; drop old 0s that are new 1s; drop new
    0s already present in the kept history; union by name."""
    min_month = shift_month(new_month, -n_months)
    hist = history.where(F.col("ANO_MES") > min_month)
    new_buyers = new.where(F.col("TARGET") == 1).select(id_col).distinct().withColumn("_nb", F.lit(1))
    hist = (hist.join(new_buyers, id_col, "left")
            .where(~((F.col("TARGET") == 0) & F.col("_nb").isNotNull())).drop("_nb"))
    hist_ids = hist.select(id_col).distinct().withColumn("_h", F.lit(1))
    new_f = (new.join(hist_ids, id_col, "left")
             .where(~((F.col("TARGET") == 0) & F.col("_h").isNotNull())).drop("_h"))
    return hist.unionByName(new_f, allowMissingColumns=True)


def cap_new_month(history: DataFrame, new_filtered: DataFrame, new: DataFrame, n_months: int,
                  id_col: str = "ID", seed: int = 0) -> DataFrame:
    """Sample the filtered new month to min(n_new_f, max(n_hist, n_new)/N)."""
    n_hist, n_new, n_f = history.count(), new.count(), new_filtered.count()
    k = int(min(n_f, max(n_hist, n_new) / n_months))
    return sample_exact(new_filtered, id_col, k, seed)


def schema_drift(history: DataFrame, new: DataFrame) -> DataFrame:
    """Columns present in ``new`` but not in ``history``, with the number
    of rows of ``new`` that miss a value."""
    extra = [c for c in new.columns if c not in set(history.columns)]
    if not extra:
        return new.sparkSession.createDataFrame([], "COLUMN string, N_MISSING long")
    missing = wide_agg(new, {c: F.count_if(F.col(c).isNull()) for c in extra})
    return new.sparkSession.createDataFrame([(c, missing[c]) for c in extra], "COLUMN string, N_MISSING long")


def month_coverage(df: DataFrame, expected: int) -> DataFrame:
    """Rows per month plus whether the month count equals ``expected``."""
    per = df.groupBy("ANO_MES").agg(F.count("*").alias("N_ROWS"))
    w = Window.partitionBy(F.lit(1))  # over <= #months rows
    return per.withColumn("N_MONTHS", F.count("*").over(w)).withColumn(
        "COVERAGE_OK", F.col("N_MONTHS") == expected)


def archive_old(history: DataFrame, cutoff: int) -> DataFrame:
    """Rows at or before the cut-off month."""
    return history.where(F.col("ANO_MES") <= cutoff)


# ------------------------------------------------------ child / parent
def split_child_parent(df: DataFrame, child_cols: Sequence[str], keys: Sequence[str]):
    """(child rows to aggregate, distinct parent rows, duplicated-id
    report)."""
    child = df.select(*keys, *child_cols)
    parent_cols = [c for c in df.columns if c not in set(child_cols) and c not in set(keys)]
    parent = df.select(*keys, *parent_cols).dropDuplicates()
    dup = parent.groupBy(*keys).count().where(F.col("count") > 1)
    return child, parent, dup
