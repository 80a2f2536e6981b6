"""Column-name grammar of the wide customer tables.

The naming convention is the real schema: prefixes say what a column holds,
suffixes say which month / line of business it describes.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- fixed values (naming grammar of the source tables) ---------------------
COUNT_PREFIXES = ("QTD_", "QT_", "QTY_")
AMOUNT_PREFIXES = ("VAL_",)
RATE_PREFIXES = ("PERC_", "PCT_", "TAX_", "TX_")
FLAG_PREFIXES = ("FLG_", "FLAG_", "IND_")
TEXT_PREFIXES = ("DSC_",)
CODE_PREFIXES = ("COD_",)
DATE_PREFIXES = ("DT_",)
ID_PREFIXES = ("ID_", "NIF")
# lines of business recognised by the LOB grammar (suffix ``_{LOB}``)
KNOWN_LOBS = ("AP", "AGR", "ATCO", "ATCP", "ATED", "AUTO", "CACA", "CAP", "EMB", "EQP", "INC",
              "MCD", "MRH", "MRN", "NVDO", "PPR", "RCE", "RCF", "RCG", "RCP", "SD", "VDO", "VDR")

MONTH_SUFFIX = re.compile(r"^(?P<prefix>.+)_M(?P<n>\d+)$")
TRAILING_SUFFIX = re.compile(r"^(?P<prefix>.+)_U(?P<n>\d+)M$")

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def matching(columns: Iterable[str], prefixes: Sequence[str] = (), suffixes: Sequence[str] = (),
             contains: Sequence[str] = ()) -> list[str]:
    out = []
    for c in columns:
        if prefixes and not c.startswith(tuple(prefixes)):
            continue
        if suffixes and not c.endswith(tuple(suffixes)):
            continue
        if contains and not any(s in c for s in contains):
            continue
        out.append(c)
    return out


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in ex]


def month_families(columns: Iterable[str], exclude_year_ago: bool = True) -> dict[str, list[int]]:
    """``{prefix: sorted month offsets}`` for columns named ``prefix_M{n}``.

    ``_M12`` is the year-ago suffix of the lagged join, not month 12 of a
    history; it is excluded unless the family also has M11 (a real history).
    """
    fam: dict[str, list[int]] = {}
    for c in columns:
        m = MONTH_SUFFIX.match(c)
        if m:
            fam.setdefault(m.group("prefix"), []).append(int(m.group("n")))
    out = {}
    for p, ns in fam.items():
        ns = sorted(ns)
        if exclude_year_ago and 12 in ns and 11 not in ns:
            ns = [n for n in ns if n != 12]
        if ns and ns[0] == 0:
            out[p] = ns
    return out


def consecutive_prefix(ns: Sequence[int]) -> list[int]:
    """Longest run 0, 1, 2, ... at the start of ``ns``."""
    run = []
    for i, n in enumerate(sorted(ns)):
        if n != i:
            break
        run.append(n)
    return run
