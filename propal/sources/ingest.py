"""Sources, typing and sinks (group A).

Readers never infer schemas: delimited text is read all-STRING and typed
afterwards from a label dictionary, with detection done in ONE aggregate
over the data (not per value on the driver).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.profile import wide_agg
from ..functions.exprs import european_number, flag_nonzero, strip_special

THOUSANDS_RE = r"^\s*-?\d{1,3}(\.\d{3})+(,\d+)?\s*$"
DECIMAL_COMMA_RE = r"^\s*-?\d+,\d+\s*$"
SPECIAL_RE = "[()%*\"']"

# --- fixed values: renaming grammar (old prefix -> new prefix)
PREFIX_RENAMES = (("QT_", "QTD_"), ("QTY_", "QTD_"), ("PCT_", "PERC_"), ("FLAG_", "FLG_"), ("COD_", "FLG_"),
                  ("IND_", "FLG_"))


# ---------------------------------------------------------------- A1 / A2 / A3
def read_delimited(spark: SparkSession, path: str, sep: str = ";", encoding: str = "ISO-8859-1",
                   header: bool = True) -> DataFrame:
    """A1: delimited text, every column STRING (gzip is read transparently,
    one split per .gz file).  Files whose header differs in names or order
    fail: Spark would read their values by position."""
    first = spark.read.option("header", header).option("sep", sep).option("encoding", encoding) \
        .option("inferSchema", False).csv(path)
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in first.columns])
    return spark.read.schema(schema).option("header", header).option("sep", sep) \
        .option("enforceSchema", not header).option("encoding", encoding).csv(path)


def snapshot_scan(spark: SparkSession, path: str, month: int, columns: Sequence[str] | str = "all",
                  month_col: str = "ANO_MES") -> DataFrame:
    """A2: one month of a month-partitioned snapshot with a projected column
    list (partition pruning + column pruning reach the parquet scan)."""
    df = spark.read.parquet(path).where(F.col(month_col) == month)
    if columns == "all" or columns == ["all"]:
        return df
    return df.select(*columns)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "overwrite", compression: str | None = None, sep: str = ";") -> None:
    """A3: sink as parquet (default) or delimited text (gzip optional);
    partitioned by month when asked.  No global sort."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True).option("sep", sep)
        if compression:
            w = w.option("compression", compression)
        w.csv(path)
    else:
        if compression:
            w = w.option("compression", compression)
        w.parquet(path)


# ---------------------------------------------------------------- A4
def detect_number_formats(df: DataFrame, columns: Sequence[str]) -> dict[str, dict]:
    """Per column: thousand separators (both the dotted-thousands and the
    comma-decimal patterns present), decimal comma, special characters —
    one aggregate row for all columns."""
    row = wide_agg(df, {f"{c}|{k}": F.max(F.col(c).rlike(p).cast("int")) for c in columns for k, p in (
        ("th", r"\d{1,3}(\.\d{3})+"), ("dc", r"\d+,\d+"), ("sp", SPECIAL_RE))})
    out = {}
    for c in columns:
        th, dc, sp = (row[f"{c}|th"] or 0, row[f"{c}|dc"] or 0, row[f"{c}|sp"] or 0)
        out[c] = {"thousands": bool(th and dc), "decimal_comma": bool(dc), "special": bool(sp)}
    return out


def _numeric_expr(c: str, fmt: dict) -> Column:
    s = F.trim(F.col(c))
    if fmt["special"]:
        s = strip_special(s)
    if fmt["thousands"]:
        s = F.regexp_replace(s, r"\.", "")
    if fmt["decimal_comma"]:
        s = F.regexp_replace(s, ",", ".")
    return F.when(F.length(s) > 0, s.try_cast("double"))


def parse_by_labels(df: DataFrame, labels: DataFrame, drop_ids: bool = True, keep: Sequence[str] = (),
                    strict: bool = True) -> DataFrame:
    """A4: type an all-string table from the label dictionary
    ``(Name, Type in {Numeric, Date, Character})``: numbers cleaned by the
    detected format and cast to DOUBLE, dates ``yyyy-MM-dd``
    (bad -> null), text kept; an unlabelled ``X_suffix`` inherits the type
    of ``X``; ``NIF*`` and ``ID_*`` dropped (except ``keep``).  A non-blank
    number that does not parse raises; ``strict=False`` turns it into null."""
    lab = {r["Name"]: r["Type"] for r in labels.select("Name", "Type").collect()}   # dictionary: #columns
    types = {}
    for c in df.columns:
        t = lab.get(c)
        if t is None and "_" in c:
            t = lab.get(c.rsplit("_", 1)[0])
        types[c] = t or "Character"
    num = [c for c in df.columns if types[c] == "Numeric"]
    fmts = detect_number_formats(df, num)
    cols = []
    for c in df.columns:
        if drop_ids and c not in keep and (c.startswith("NIF") or c.startswith("ID_")):
            continue
        if types[c] == "Numeric":
            cols.append(_numeric_expr(c, fmts[c]).alias(c))
        elif types[c] == "Date":
            cols.append(F.try_to_date(F.trim(F.col(c)), "yyyy-MM-dd").alias(c))
        else:
            cols.append(F.col(c))
    if strict and num:
        # numbers are not coerced silently: count non-blank values that do not
        # parse, for all numeric columns in one aggregate
        bad = wide_agg(df, {c: F.count_if((F.length(F.trim(F.col(c))) > 0) & _numeric_expr(c, fmts[c]).isNull())
                            for c in num})
        junk = {c: n for c, n in bad.items() if n}
        if junk:
            raise ValueError(f"unparseable numbers per column: {junk}")
    return df.select(*cols)


# ---------------------------------------------------------------- A5 / A6
def european_numbers(df: DataFrame, columns: Sequence[str] | None = None,
                     prefixes: Sequence[str] = ("QTD_", "VAL_", "TAX_", "PCT_", "IND_")) -> DataFrame:
    """A5: '1.234,56' -> 1234.56 for text columns of the numeric prefixes."""
    columns = list(columns or [f.name for f in df.schema.fields
                               if isinstance(f.dataType, T.StringType) and f.name.startswith(tuple(prefixes))])
    return df.withColumns({c: european_number(c) for c in columns})


def sentinel_to_null(df: DataFrame) -> DataFrame:
    """-999 -> null in PERC_/PCT_; blank text -> null; inf/NaN -> null in
    doubles; FLG_/FLAG_ non-zero -> 1 (null and 0 kept)."""
    new = {}
    for f in df.schema.fields:
        c, dt = f.name, f.dataType
        x = F.col(c)
        if isinstance(dt, T.StringType):
            new[c] = F.when(F.length(F.trim(x)) > 0, x)
        elif c.startswith(("PERC_", "PCT_")):
            y = F.when(x != -999, x)
            if isinstance(dt, (T.FloatType, T.DoubleType)):
                y = F.when(~F.isnan(y) & (F.abs(y) != float("inf")), y)
            new[c] = y
        elif c.startswith(("FLG_", "FLAG_")):
            new[c] = flag_nonzero(c)
        elif isinstance(dt, (T.FloatType, T.DoubleType)):
            new[c] = F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)
    return df.withColumns(new)


# ---------------------------------------------------------------- A7 - A10
def uniform_name(name: str, user: dict[str, str] | None = None) -> str | None:
    """Rename grammar for one column; ``None`` = drop."""
    if user and name in user:
        return user[name]
    n = name.replace(" - ", "_").replace(" ", "_")
    if n.endswith("_nan") or n.endswith("_0"):
        return None
    for old, new in PREFIX_RENAMES:
        if n.startswith(old):
            n = new + n[len(old):]
            break
    return n


def uniformize_names(df: DataFrame, user: dict[str, str] | None = None) -> DataFrame:
    """Apply the rename grammar; two inputs mapping to one name is an
    error (checked on the driver over the names only)."""
    mapping = {c: uniform_name(c, user) for c in df.columns}
    targets = [v for v in mapping.values() if v is not None]
    dup = {t for t in targets if targets.count(t) > 1}
    if dup:
        raise ValueError(f"rename collision: {sorted(dup)}")
    return df.select(*[F.col(f"`{c}`").alias(v) for c, v in mapping.items() if v is not None])


def add_missing_columns(df: DataFrame, schema: T.StructType, drop_extra: bool = True) -> tuple[DataFrame, list[str]]:
    """Align a scoring table to the training schema: missing FLG_ -> 0,
    missing text -> 'nan', other missing -> null; extras dropped and
    reported."""
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in have:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name.startswith("FLG_"):
            cols.append(F.lit(0).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            cols.append(F.lit("nan").alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    extra = [c for c in df.columns if c not in {f.name for f in schema.fields}]
    if not drop_extra:
        cols += [F.col(c) for c in extra]
    return df.select(*cols), extra


def priority_dedup(df: DataFrame, key: Sequence[str], priority: Sequence[str | Column]) -> DataFrame:
    """Stacked rows, the first by ``priority`` per key wins — a
    ``min(struct(priority, row))`` aggregate (combined map-side; a key with
    many rows does not become one window task)."""
    prio = [F.col(p) if isinstance(p, str) else p for p in priority]
    rest = [c for c in df.columns if c not in set(key)]
    s = F.struct(*[p.alias(f"_p{i}") for i, p in enumerate(prio)], *[F.col(c) for c in rest])
    return df.groupBy(*key).agg(F.min(s).alias("_s")).select(*key, *[F.col(f"_s.{c}").alias(c) for c in rest])


def final_columns(df: DataFrame, features: Sequence[str], keys: Sequence[str] = (), target: str | None = "TARGET") -> DataFrame:
    """A10: project to the final variables (+ keys and target); a missing or
    empty name is an error up front."""
    want = [*keys, *features] + ([target] if target else [])
    bad = [c for c in want if not c or c not in df.columns]
    if bad:
        raise ValueError(f"final columns missing from the table: {bad}")
    return df.select(*want)
