"""B14, B15 and B17 as an update of a stored universe.

The universe is kept by month: a folder of files for each, named by an
append-only log with the month's row count.  A new month rewrites only the
months that lose rows; the others stay where they lie and months that become
too old change from live to archived in the log, without a copy.  All of an
update becomes visible with one log entry, written last: a failed update leaves
the table as it was, and folders that no entry names are never read.

Each update has a name.  A name that the log holds is not applied again, so a
job that is run twice, or dies after its commit, gives the same table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..sources.commits import SmallFiles
from .panel import sample_exact, shift_month


class MonthTable(SmallFiles):
    """Live and archived months of a table under a folder of any file system that Spark reads."""

    def __init__(self, spark: SparkSession, root: str, month_col: str = "ANO_MES") -> None:
        super().__init__(spark, root)
        self.month_col = month_col

    # -- log -----------------------------------------------------------------
    def _entries(self) -> list[str]:
        return self._names("log")

    def _state(self, at: int | None = None) -> dict:
        names = self._entries()
        if at is not None:
            names = [n for n in names if int(n.removesuffix(".json")) == at]
            if not names:
                raise KeyError(at)
        return self._read(f"log/{names[-1]}") if names else {
            "at": 0, "updates": [], "schema": None, "live": {}, "archive": {}}

    def entry(self) -> int:
        """Number of the last update, 0 for a table without any."""
        return self._state()["at"]

    def updates(self) -> list[str]:
        """Names of the applied updates, oldest first."""
        return self._state()["updates"]

    def rows_by_month(self, archived: bool = False, at: int | None = None) -> dict[int, int]:
        """Rows of each month, from the log."""
        part = self._state(at)["archive" if archived else "live"]
        return {int(m): sum(f["rows"] for f in folders) for m, folders in sorted(part.items())}

    def _commit(self, old: dict, update: str, **new) -> int:
        at = old["at"] + 1
        said = {**old, **new, "at": at, "updates": [*old["updates"], update]}
        if not self._write(f"log/{at:09d}.json", said):
            raise RuntimeError(f"another update took entry {at}; run {update} again")
        return at

    # -- files ---------------------------------------------------------------
    def _stage(self, df: DataFrame) -> dict[str, list[dict]]:
        """Rows written under a fresh folder, one folder a month, with their counts."""
        part = "month"
        while part in df.columns:
            part += "_"
        folder = f"data/{uuid.uuid4().hex}"
        at = f"{self.root}/{folder}"
        df.withColumn(part, F.col(self.month_col)).write.partitionBy(part).parquet(at)
        fs, found = self._fs(), {}
        for s in fs.listStatus(self._path(folder)):
            name = s.getPath().getName()
            if name.startswith(f"{part}="):
                found[name.split("=", 1)[1]] = f"{folder}/{name}"
        if not found:
            return {}
        # the counts come from the footers of the files just written
        rows = {str(r[0]): r[1] for r in self.spark.read.schema(
            StructType([StructField(part, df.schema[self.month_col].dataType)])).option("basePath", at).parquet(at)
            .groupBy(part).count().collect()}       # one row a month
        return {m: [{"folder": f, "rows": rows[m]}] for m, f in found.items()}

    def _frame(self, schema: StructType, parts: Iterable[list[dict]]) -> DataFrame:
        paths = [f"{self.root}/{f['folder']}" for folders in parts for f in folders]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self, months: Iterable[int] | None = None, archived: bool = False, at: int | None = None) -> DataFrame:
        """Live (or archived) rows, of the ``months`` named or of all; ``at``
        reads the table as it was after that update.  Only the folders of these
        months are listed.  A column that came later is null in older months."""
        state = self._state(at)
        if state["schema"] is None:
            raise KeyError(f"no table at {self.root}")
        part = state["archive" if archived else "live"]
        wanted = part if months is None else [str(m) for m in months if str(m) in part]
        return self._frame(StructType.fromJson(state["schema"]), (part[m] for m in wanted))

    # -- updates -------------------------------------------------------------
    def _fitting(self, state: dict, df: DataFrame) -> StructType:
        """The table's columns and those new in ``df``; a column that changes its type raises."""
        if any(df.schema[c].dataType != f.dataType for f in _fields(state) if (c := f.name) in df.columns):
            raise TypeError("a column of the update has another type than in the table")
        names = {f.name for f in _fields(state)}
        return StructType([StructField(f.name, f.dataType) for f in [
            *_fields(state), *(f for f in df.schema if f.name not in names)]])

    def create(self, df: DataFrame, update: str = "create") -> int:
        """The first update: all rows live.  Rows without a month raise.
        Returns the number of the table's last entry."""
        state = self._state()
        if update in state["updates"]:
            return state["at"]
        if state["at"]:
            raise FileExistsError(self.root)
        if not df.where(F.col(self.month_col).isNull()).isEmpty():
            raise ValueError("rows without a month")
        return self._commit(state, update, schema=self._fitting(state, df).jsonValue(), live=self._stage(df))

    def roll(self, new: DataFrame, new_month: int, n_months: int, update: str | None = None, id_col: str = "ID",
             cap: bool = True, seed: int = 0) -> int:
        """Take in a month: of the live months those after ``new_month -
        n_months`` stay, the others are archived; 0s of ids that buy in the new
        month leave; of the new month's 0s only ids that the rest does not hold
        come in; with ``cap`` at most the live table's rows (or the new month's,
        if more) over ``n_months`` are drawn from it by hash.

        Null ids match none, and a row without a target stays.  Rows of another
        month raise, as does a month that the table holds already under another
        update's name.  Returns the number of the table's last entry."""
        update = update or f"month {new_month}"
        state = self._state()
        if update in state["updates"]:
            return state["at"]
        if state["schema"] is None:
            raise KeyError(f"no table at {self.root}")
        if str(new_month) in {**state["live"], **state["archive"]}:
            raise ValueError(f"month {new_month} is in the table")
        if not new.where(~F.col(self.month_col).eqNullSafe(F.lit(new_month))).isEmpty():
            raise ValueError(f"rows outside {new_month}")
        schema = self._fitting(state, new)
        first = shift_month(new_month, -n_months)
        kept = {m: f for m, f in state["live"].items() if int(m) > first}
        old = {m: f for m, f in state["live"].items() if int(m) <= first}

        zero = F.coalesce(F.col("TARGET") == 0, F.lit(False))
        buyers = new.where(F.col("TARGET") == 1).select(id_col).distinct()
        history = self._frame(schema, kept.values())
        leaving = history.where(zero).join(buyers, id_col, "left_semi")
        touched = [str(r[0]) for r in leaving.select(self.month_col).distinct().collect()]   # months of the table
        rest = (self._frame(schema, [kept.pop(m) for m in touched])
                .withColumn("_zero", zero).join(buyers.withColumn("_buys", F.lit(True)), id_col, "left")
                .where(~(F.col("_zero") & F.col("_buys").isNotNull())).select(*schema.names))
        live = {**kept, **(self._stage(rest) if touched else {})}

        held = self._frame(schema, live.values()).select(id_col).distinct()
        came = new.where(~zero).unionByName(new.where(zero).join(held, id_col, "left_anti").select(*new.columns))
        if cap:
            before = sum(f["rows"] for folders in state["live"].values() for f in folders)
            size = int(max(before, new.count()) / n_months)
            came = sample_exact(came, id_col, size, seed)
        live |= self._stage(came)
        # what an earlier archive holds of a month stays beside it
        archive = {m: state["archive"].get(m, []) + old.get(m, []) for m in sorted({**state["archive"], **old})}
        return self._commit(state, update, schema=schema.jsonValue(), live=dict(sorted(live.items())), archive=archive)


def _fields(state: dict) -> list[StructField]:
    return list(StructType.fromJson(state["schema"])) if state["schema"] else []
