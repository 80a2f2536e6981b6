"""Correlations of many columns in one scan, as blocks of co-moments.

A task adds up, in matrices, sums and products of its rows for all pairs of a
block; a null leaves a row out of the pairs of its column only.  Matrix rows
are then added up by their number, so no task and not the driver holds more
than its share of the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART = "block int, place int, sums array<double>"


def pair_correlations(df: DataFrame, blocks: Sequence[Sequence[str]]) -> DataFrame:
    """``(block, a, b, n, r)`` for every pair of columns of a block (``a`` before
    ``b``): Pearson's r over the ``n`` rows where both are set, null where it is
    not defined.  NaN counts as null."""
    spark = df.sparkSession
    blocks = [list(b) for b in blocks]
    names = list(dict.fromkeys(c for b in blocks for c in b))
    none = spark.createDataFrame([], "block int, a string, b string, n long, r double")
    if all(len(b) < 2 for b in blocks):
        return none
    at = {c: k for k, c in enumerate(names)}
    places = [[at[c] for c in b] for b in blocks]
    rows = df.select(*(F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(names)))
    # sums start from a value near each column's mean, so values far from zero keep their digits
    head = rows.limit(1000).agg(*(F.avg(F.nanvl(f"c{k}", F.lit(None))).alias(f"c{k}") for k in range(len(names)))).first()
    near = np.array([0.0 if x is None or not np.isfinite(x) else x for x in head])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros((4, len(p), len(p))) for p in places]
        seen = False
        for batch in batches:
            if not batch.num_rows:
                continue
            seen = True
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) - near
            there = ~np.isnan(x)
            x[~there] = 0.0
            m = there.astype(float)
            for p, sums in zip(places, held):
                y, k = x[:, p], m[:, p]
                sums += np.array([k.T @ k, y.T @ k, (y * y).T @ k, y.T @ y])
        if seen:
            for g, (n, s, q, xy) in enumerate(held):
                for i in range(len(n) - 1):
                    flat = np.concatenate([n[i, i + 1:], s[i, i + 1:], s[i + 1:, i], q[i, i + 1:], q[i + 1:, i], xy[i, i + 1:]])
                    yield _row(g, i, flat)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for g, i, sums in zip(*(batch.column(c) for c in ("block", "place", "sums"))):
                key, x = (g.as_py(), i.as_py()), sums.values.to_numpy()
                total[key] = total[key] + x if key in total else x
        for (g, i), sums in sorted(total.items()):
            n, sx, sy, sxx, syy, sxy = sums.reshape(6, -1)
            with np.errstate(divide="ignore", invalid="ignore"):
                vx, vy, c = sxx - sx * sx / n, syy - sy * sy / n, sxy - sx * sy / n
                r = c / np.sqrt(vx * vy)
            # a spread within rounding of nothing is none
            fine = (n > 0) & (vx > 1e-12 * sxx) & (vy > 1e-12 * syy)
            b = blocks[g][i + 1:]
            yield pa.RecordBatch.from_arrays(
                [pa.array([g] * len(b), pa.int32()), pa.array([blocks[g][i]] * len(b)), pa.array(b), pa.array(n.astype(np.int64)),
                 pa.array([float(np.clip(v, -1, 1)) if ok else None for v, ok in zip(r, fine)], pa.float64())],
                names=["block", "a", "b", "n", "r"])
    return rows.mapInArrow(collect, PART).repartition("block", "place").mapInArrow(finish, none.schema)


def _row(block: int, place: int, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int32()), pa.array([place], pa.int32()),
         pa.ListArray.from_arrays(pa.array([0, len(sums)], pa.int32()), pa.array(sums))], names=["block", "place", "sums"])
