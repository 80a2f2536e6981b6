"""propal — customer-propensity analytics as Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions.  Fitted operators follow ``fit(df, ...) -> state`` and
``transform(df, state, ...) -> df`` where ``state`` is a small DataFrame (or a
short Python list of bin edges / column names when it is bounded by the number
of columns, never by the number of rows).

Sub-packages:

* ``sources``   – typed ingestion, snapshot scans, sinks (group A)
* ``operators`` – panel/universe (B), profiling (C), features (D),
                  selection/models (E), lift and monitoring reports (F)
* ``functions`` – column-name grammar, null-safe row expressions, right-closed
                  quantile bins, distributed ranking and exact quantiles
* ``plans``     – fixtures derived from the test tables and the registered
                  queries with their DuckDB oracles
* ``streaming`` – month-at-a-time incremental scoring / monitoring
"""

__version__ = "0.1.0"
