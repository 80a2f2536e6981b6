"""Run registered queries in Spark and their DuckDB oracles side by side.

    python tests/oracle_check.py [sf_dir] [name-substring ...]

Compares row count, column names and an order-insensitive multiset of rows
(floats rounded to 9 significant digits).
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0)
                 for x in row)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out = [tuple(float(x) if isinstance(x, int) and not isinstance(x, bool) else x for x in r) for r in out]
    return [cols[i] for i in order], sorted(out, key=lambda r: tuple(str(x) for x in r))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    ts = time.time() - t0
    if sql is None:
        return {"name": name, "status": "rows-only", "rows": len(srows), "spark_s": round(ts, 2)}
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    sc, sr = canon(scols, srows)
    dc, dr = canon(dcols, drows)
    ok = sc == dc and sr == dr
    info = {"name": name, "status": "ok" if ok else "MISMATCH", "rows": (len(srows), len(drows)),
            "spark_s": round(ts, 2)}
    if not ok:
        if sc != dc:
            info["cols"] = (sc, dc)
        else:
            ds, ss = set(dr), set(sr)
            diff_s = [r for r in sr if r not in ds][:3]
            diff_d = [r for r in dr if r not in ss][:3]
            info["spark_only"] = diff_s
            info["duck_only"] = diff_d
    return info


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from propal.session import local_session
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sq = E.queries(), E.oracle_sql()
    results = []
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        try:
            r = compare(spark, con, name, fn, sq.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "status": "ERROR", "error": repr(e)[:400]}
            traceback.print_exc()
        print(r, flush=True)
        results.append(r)
    bad = [r for r in results if r["status"] in ("MISMATCH", "ERROR")]
    print(f"{len(results) - len(bad)}/{len(results)} fine; bad: {[r['name'] for r in bad]}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
