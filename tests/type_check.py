"""Compare Spark result types with DuckDB oracle result types per query.

    python tests/type_check.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.oracle_check import duck  # noqa: E402

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "smallint": "SMALLINT",
                 "tinyint": "TINYINT"}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.001"
    pats = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from propal.session import local_session
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sq = E.queries(), E.oracle_sql()
    for name, sql in sq.items():
        if pats and not any(p in name for p in pats):
            continue
        try:
            st = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                  for f in qs[name](spark, sf_dir).schema.fields}
            rel = con.execute(f"DESCRIBE {sql}").fetchall()
            dt = {r[0]: r[1] for r in rel}
            bad = {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}
            print(name, "ok" if not bad else bad, flush=True)
        except Exception as e:  # report and continue
            print(name, "ERROR", repr(e)[:200], flush=True)


if __name__ == "__main__":
    main(sys.argv)
