"""Naive Bayes where cleaning leaves one class: the queries equal their SQL."""

import shutil

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, duck_connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("one_class")
    duck_connection(SF).execute(f"COPY (SELECT * FROM events WHERE value > 10) TO '{at}/events.parquet' (FORMAT parquet)")
    shutil.copy(f"{SF}/documents.parquet", at)
    return str(at)


@pytest.mark.parametrize("name", ["bayes_fit", "bayes_evaluation", "bayes_log", "bayes_score_guarded", "full_job"])
def test_one_class(spark, folder, name):
    res = compare(spark, duck_connection(folder), name, entry.queries()[name], entry.oracle_sql()[name], folder)
    assert res["names"] and res["hash"] and res["rows"][0] == res["rows"][1] > 0


@pytest.mark.parametrize("name", ["bayes_score_batch", "bayes_score_csv", "bayes_score_stream", "bayes_log_sink"])
def test_one_class_scores_and_sinks(spark, folder, name):
    res = compare(spark, duck_connection(folder), name, entry.queries()[name], entry.oracle_sql()[name], folder)
    assert res["names"] and res["hash"] and res["rows"][0] == res["rows"][1] > 0
