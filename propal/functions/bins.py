"""The one right-closed quantile bin expression shared by C15, C16, D23, D29,
F1 and F2 (``pd.qcut`` semantics: bins ``(e[i-1], e[i]]``, the lowest edge
included, duplicate edges dropped, null in -> null out).

Edges are a short driver-side list (bounded by the number of bins), applied
as literals inside whole-stage codegen — no join, no UDF.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exprs import col_


def unique_edges(edges: Sequence[float]) -> list[float]:
    return sorted(set(float(e) for e in edges))


def count_below(x: Column, edges: Sequence[float]) -> Column:
    """Number of edges strictly below x."""
    return reduce(lambda a, b: a + b, [(x > F.lit(float(e))).cast("int") for e in edges])


def right_closed_bin(c: str | Column, edges: Sequence[float], out_of_range: str = "clamp") -> Column:
    """1-based bin of ``c`` over sorted unique ``edges``.

    ``out_of_range``: ``clamp`` – below min -> 1, above max -> last bin;
    ``null`` – outside [min, max] -> null; ``extend`` – above max -> an extra
    bin ``len(edges)``, below min -> 0 (extra lower bin).
    """
    x = col_(c).cast("double")
    e = unique_edges(edges)
    if len(e) == 0:
        return F.lit(None).cast("int")
    if len(e) == 1:
        inside = F.lit(1)
        if out_of_range == "null":
            return F.when(x == e[0], 1)
        return F.when(x.isNotNull(), inside)
    n_bins = len(e) - 1
    below = count_below(x, e)
    core = F.greatest(F.lit(1), F.least(F.lit(n_bins), below))
    if out_of_range == "clamp":
        b = core
    elif out_of_range == "null":
        b = F.when((x >= e[0]) & (x <= e[-1]), core)
    elif out_of_range == "extend":
        b = F.when(x < e[0], F.lit(0)).when(x > e[-1], F.lit(n_bins + 1)).otherwise(core)
    else:
        raise ValueError(out_of_range)
    return F.when(x.isNotNull(), b).cast("int")


def left_closed_digitize(c: str | Column, edges: Sequence[float]) -> Column:
    """``np.digitize(x, edges)``: number of edges <= x (edges may repeat)."""
    x = col_(c).cast("double")
    return F.when(x.isNotNull(), reduce(
        lambda a, b: a + b, [(x >= F.lit(float(e))).cast("int") for e in edges]))


def fixed_bins(c: str | Column, cuts: Sequence[float], labels: Sequence[str],
               right: bool = True) -> Column:
    """``pd.cut`` with explicit cuts: right-closed ``(a, b]`` (or left-closed
    ``[a, b)`` when ``right=False``); outside -> null."""
    x = col_(c)
    expr = None
    for lo, hi, lab in zip(cuts[:-1], cuts[1:], labels):
        cond = (x > lo) & (x <= hi) if right else (x >= lo) & (x < hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def equal_width_bin(c: str | Column, lo: float, hi: float, n: int) -> Column:
    """0-based equal-width bin in [0, n-1]; max value goes to the last bin."""
    x = col_(c).cast("double")
    if hi == lo:
        return F.when(x.isNotNull(), F.lit(0))
    b = F.floor((x - F.lit(lo)) / F.lit((hi - lo) / n)).cast("int")
    return F.when(x.isNotNull(), F.least(F.lit(n - 1), F.greatest(F.lit(0), b)))
