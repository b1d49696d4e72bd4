"""Every SQL-checkable registered query equals its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as entry
from polarity.plans.catalog import QUERIES
from polarity.plans.oracle_sql import ORACLE
from tests.oracle_check import compare, duck_connection

SF = "/root/testdata/sf0.001"
NAMES = sorted(ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert res["names"], (res["spark_cols"], res["duck_cols"])
    assert res["rows"][0] == res["rows"][1]
    assert res["hash"]


def test_every_query_is_registered_with_a_check():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only == {"train_baseline", "experiment_grid", "variant_comparison", "tuned_test_metrics",
                         "evaluation_predictions", "score_batch", "prediction_log", "score_stream",
                         "best_experiment", "score_guarded"}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and 0.0 <= rows[0].accuracy <= 1.0
