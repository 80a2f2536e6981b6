"""Unit tests of the shared building blocks on micro tables (null / tie /
edge rules) and invariants of the reports."""

import pytest
from pyspark.sql import functions as F

from propal.functions.bins import left_closed_digitize, right_closed_bin
from propal.functions.exprs import european_number, null_safe_sum, tri_state_any
from propal.functions.ranking import exact_quantiles, global_row_number
from propal.operators import fitted as FT
from propal.operators import panel as P
from propal.operators import reports as R


def test_exact_quantiles_match_linear_interpolation(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 2, 3, 10, 11]], "x double")
    q = {r["_i"]: r["quantile"] for r in exact_quantiles(df, "x", [0.25, 0.5, 0.9]).collect()}
    assert q == {0: 2.0, 1: 2.5, 2: 10.5}


def test_grouped_quantiles_ignore_nulls(spark):
    rows = [("a", 1.0), ("a", 3.0), ("a", None), ("b", 5.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    q = {r["g"]: r["quantile"] for r in exact_quantiles(df, "x", [0.5], by=["g"]).collect()}
    assert q == {"a": 2.0, "b": 5.0}


def test_global_row_number_is_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("v"))
    r = global_row_number(df, ["v"], "rn", partitions=7).orderBy("v").collect()
    assert [x["rn"] for x in r] == list(range(1, 1001))
    assert [x["v"] for x in r] == list(range(1000))


def test_right_closed_bins_edges_and_nulls(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (2.0,), (3.0,), (None,), (-1.0,), (9.0,)], "x double")
    e = [0.0, 1.0, 2.0, 3.0]
    out = df.select("x", right_closed_bin("x", e).alias("c"), right_closed_bin("x", e, "null").alias("n"),
                    right_closed_bin("x", e, "extend").alias("e")).collect()
    got = {r["x"]: (r["c"], r["n"], r["e"]) for r in out}
    assert got[0.0] == (1, 1, 1) and got[1.0] == (1, 1, 1) and got[1.5] == (2, 2, 2)
    assert got[3.0] == (3, 3, 3) and got[None] == (None, None, None)
    assert got[-1.0] == (1, None, 0) and got[9.0] == (3, None, 4)


def test_digitize_left_closed(spark):
    df = spark.createDataFrame([(0.5,), (1.0,)], "x double")
    assert [r[0] for r in df.select(left_closed_digitize("x", [0.0, 1.0, 1.0])).collect()] == [1, 3]


def test_null_safe_sum_and_tri_state(spark):
    df = spark.createDataFrame([(None, None, "X", None), (1.0, None, "N", "S"), (2.0, 3.0, "X", "X")],
                               "a double, b double, s string, t string")
    out = df.select(null_safe_sum(["a", "b"]).alias("s"), tri_state_any(["s", "t"]).alias("f")).collect()
    assert [(r["s"], r["f"]) for r in out] == [(0.0, "X"), (1.0, "S"), (5.0, "X")]


def test_european_number(spark):
    df = spark.createDataFrame([("1.234,56",), (" ",), ("n/a",), ("12,5",)], "t string")
    assert [r[0] for r in df.select(european_number("t")).collect()] == [1234.56, None, None, 12.5]


def test_month_arithmetic():
    assert P.shift_month(200001, -2) == 199911
    assert P.shift_month(199912, 14) == 200102
    assert P.months_between_list(199911, 200002) == [199911, 199912, 200001, 200002]


def test_score_percentile_closed_form(spark):
    n = 250
    df = spark.createDataFrame([(1, i, (i * 37 % n) / n) for i in range(n)], "ANO_MES int, ID int, EM_EVENTPROBABILITY double")
    out = R.score_percentile(df).collect()
    pct = {r["ID"]: r["PERCENTILE"] for r in out}
    best = max(range(n), key=lambda i: (i * 37 % n))
    assert pct[best] == 1 and max(pct.values()) == 100 and min(pct.values()) == 1


def test_roc_auc_with_ties(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1)], "s double, TARGET int")
    assert R.roc_auc(df, "s").first()[0] == pytest.approx(0.875)


def test_target_encoder_unseen_gets_global_mean(spark):
    train = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), ("b", 1)], "c string, TARGET int")
    st = FT.target_encode_fit(train, ["c"])
    test = spark.createDataFrame([("a",), ("z",)], "c string")
    out = {r["c"] for r in FT.target_encode_transform(test, st, ["c"]).collect()}
    assert 0.75 in out


def test_ordinal_roundtrip(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "c string")
    state = FT.ordinal_fit(df, ["c"])
    back = FT.ordinal_inverse(FT.ordinal_transform(df, state), state).collect()
    assert sorted(r["c"] for r in back) == ["INDETERMINADO", "a", "b"]


def test_parse_by_labels_strict_and_lenient(spark):
    from propal.sources.ingest import parse_by_labels
    raw = spark.createDataFrame([("1.234,56", "2024-01-31", "x"), ("n/a", "bad", "y"), (" ", "2024-02-01", "z")],
                                "VAL_A string, DT_B string, DSC_C string")
    labels = spark.createDataFrame([("VAL_A", "Numeric"), ("DT_B", "Date")], "Name string, Type string")
    out = parse_by_labels(raw, labels, strict=False).collect()
    assert [r["VAL_A"] for r in out] == [1234.56, None, None]
    assert out[1]["DT_B"] is None and str(out[0]["DT_B"]) == "2024-01-31"
    with pytest.raises(ValueError):
        parse_by_labels(raw, labels)


def test_quantile_bin_clamp_and_extend(spark):
    train = spark.createDataFrame([(float(x),) for x in range(1, 101)], "x double")
    edges = FT.quantile_bin_fit(train, ["x"], q=4)
    test = spark.createDataFrame([(0.0,), (50.0,), (500.0,)], "x double")
    clamp = [r["x"] for r in FT.quantile_bin_transform(test, edges).collect()]
    ext = [r["x"] for r in FT.quantile_bin_transform(test, edges, extend=True).collect()]
    assert clamp == [0, 1, 3]
    assert ext == [0, 2, 5]


def test_ordinal_unknown_modes(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    state = FT.ordinal_fit(train, ["c"])
    test = spark.createDataFrame([("b",), ("z",)], "c string")
    assert sorted(r["c"] for r in FT.ordinal_transform(test, state).collect()) == [1.0, 2.0]
    assert {r["c"] for r in FT.ordinal_transform(test, state, "ignore").collect()} == {1.0, None}
    assert FT.ordinal_transform(test.where("c = 'b'"), state, "error").first()["c"] == 1.0
    with pytest.raises(Exception):
        FT.ordinal_transform(test, state, "error").collect()


def test_running_total_with_a_hot_value(spark):
    # a third of the rows share one score: the total order (score, id) splits it over range partitions
    rows = [(i, 0.5 if i % 3 == 0 else i / 3000.0) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, s double")
    from propal.functions.ranking import running_total
    out = running_total(df, ["s", "id"], None, "rn", partitions=6).select("id", "s", "rn").collect()
    got = sorted((r["rn"], r["s"], r["id"]) for r in out)
    want = sorted((s, i) for i, s in rows)
    assert [g[0] for g in got] == list(range(1, 3001))
    assert [(g[1], g[2]) for g in got] == want
