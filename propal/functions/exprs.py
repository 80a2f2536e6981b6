"""Null-aware row expressions and text-to-number helpers (all JVM-side)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def q(name: str) -> str:
    """Back-quote a column name for use inside ``F.expr``."""
    return "`" + name.replace("`", "``") + "`"


def null_safe_sum(cols: Iterable[str | Column]) -> Column:
    """Row sum skipping nulls; the sum of all-null (or no) columns is 0."""
    terms = [F.coalesce(col_(c).cast("double"), F.lit(0.0)) for c in cols]
    if not terms:
        return F.lit(0.0)
    return reduce(lambda a, b: a + b, terms)


def null_propagating_sum(cols: Sequence[str | Column]) -> Column:
    return reduce(lambda a, b: a + b, [col_(c) for c in cols])


def row_max(cols: Sequence[str | Column]) -> Column:
    """``greatest`` skips nulls; null only when every input is null."""
    cs = [col_(c) for c in cols]
    return cs[0] if len(cs) == 1 else F.greatest(*cs)


def row_min(cols: Sequence[str | Column]) -> Column:
    cs = [col_(c) for c in cols]
    return cs[0] if len(cs) == 1 else F.least(*cs)


def row_mean(cols: Sequence[str | Column]) -> Column:
    """Mean of the non-null inputs (null when all are null)."""
    n = reduce(lambda a, b: a + b, [col_(c).isNotNull().cast("int") for c in cols])
    return F.when(n > 0, null_safe_sum(cols) / n)


def count_positive(cols: Sequence[str | Column]) -> Column:
    return reduce(lambda a, b: a + b,
                  [F.coalesce((col_(c) > 0).cast("int"), F.lit(0)) for c in cols])


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """Division with x/0 -> null (pandas would give inf, which the reference
    treats as missing)."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def european_number(c: str | Column) -> Column:
    """'1.234,56' -> 1234.56; blanks and junk -> null."""
    s = F.trim(col_(c).cast("string"))
    s = F.regexp_replace(F.regexp_replace(s, r"\.", ""), ",", ".")
    return _try_double(s)


def _try_double(s: Column) -> Column:
    return F.when(F.length(s) > 0, s.try_cast("double"))


def strip_special(c: str | Column, chars: str = "()%*\"'") -> Column:
    pattern = "[" + "".join("\\" + ch for ch in chars) + "]"
    return F.regexp_replace(col_(c).cast("string"), pattern, "")


def percent_text_to_double(c: str | Column) -> Column:
    """'12%' -> 12.0 (used by the eligibility predicates)."""
    return _try_double(F.trim(F.regexp_replace(col_(c).cast("string"), "%", "")))


def tri_state_any(cols: Sequence[str | Column]) -> Column:
    """S/N/X algebra: any 'S' -> 'S'; all 'X' (or null) -> 'X'; else 'N'."""
    cs = [col_(c) for c in cols]
    any_s = reduce(lambda a, b: a | b, [F.coalesce(c == "S", F.lit(False)) for c in cs])
    all_x = reduce(lambda a, b: a & b, [F.coalesce(c == "X", F.lit(True)) for c in cs])
    return F.when(any_s, "S").when(all_x, "X").otherwise("N")


def with_totals(df, one_row) -> "DataFrame":
    """Attach the columns of a one-row aggregate to every row as ONE scalar
    subquery (a struct), instead of joining a one-row table."""
    s = one_row.select(F.struct(*one_row.columns).alias("_tot")).scalar()
    return df.withColumn("_tot", s).select("*", "_tot.*").drop("_tot")


def flag_nonzero(c: str | Column) -> Column:
    """Any non-zero value -> 1, keeping 0 and null."""
    x = col_(c)
    return F.when(x.isNull(), None).when(x == 0, 0).otherwise(1)
