"""Driver contract and a DuckDB oracle sample on sf0.001."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck
from tests.conftest import SF_SMALL

# cheap representatives of every operator group
SAMPLE = ("A5_european_number", "B10_target_rate_by_month", "B12_lagged_feature_join", "C14_categorical_effectiveness",
          "C15_numerical_effectiveness", "D15_target_encode", "D17_rare_to_other", "D23_quantile_bin",
          "E3_anova_f", "E12_roc_auc", "F1_decile_report", "F3_score_percentile", "F6_lift_table",
          "C15_one_bin", "D16_ordinal_encode_table", "D44_feature_lineage", "E5_correlation_prune",
          "F2_percentile_report_ties")


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert df.columns[0] == "Decile"


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_oracle_sample(spark, name):
    con = duck(SF_SMALL)
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL)
    assert r["status"] == "ok", r
