"""The pipeline's stages against brute force, and the registered queries."""

import os
import shutil
import subprocess
import sys
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline as cp
from polarity.llm import near_dedup as nd
from polarity.llm.oracle import ORACLE
from polarity.llm.queries import QUERIES
from polarity.llm.tables import load, written
from tests.llm import cases
from tests.llm.test_decontamination import brute as brute_hits
from tests.llm.test_near_dedup import brute as brute_classes
from tests.llm.test_shares import brute_mix
from tests.oracle_check import compare, duck_connection

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.abspath(cp.__file__))


def test_stages_take_effect_and_equal_brute_force(spark):
    docs = cases.clashing(load(spark, SF, "documents"), "score", "kept", "contaminated", "copies")
    items = [(r.item_id, r.text) for r in load(spark, SF, "benchmark").collect()]
    seen = [docs]
    for name, stage in cp.STAGES:
        out = written(stage(spark, seen[-1], SF))
        if name != "sharding":
            assert out.columns == docs.columns and {r.score for r in out.collect()} == {"mine"}
        seen.append(out)
    rows = [[(r.doc_id, r.text, r.source, r.lang) for r in d.collect()] for d in seen]
    toxic = {r.doc_id: r.toxic for r in load(spark, SF, "labels").collect()}
    kept = {r[0] for r in rows[1]}
    assert kept <= {r[0] for r in rows[0]} and sum(toxic.get(d) == 0 and d not in kept for d in toxic) == 0
    groups = brute_classes(sorted(rows[1]), nd.word_weights(seen[1]))
    assert sorted(r[0] for r in rows[2]) == sorted(min(sorted(rows[1])[i][0] for i in g) for g in groups)
    assert sorted(r[0] for r in rows[3]) == sorted(r[0] for r in rows[2] if not brute_hits(r[1], items)[4])
    size, _, _, taken = brute_mix(rows[3])
    want = Counter({r[0]: k // n for r, n, k in zip(rows[3], size, taken) if n and k})
    assert Counter(r[0] for r in rows[4] if cases.words(r[1])) == want
    last = seen[5].collect()
    assert Counter(r.doc_id for r in last) == Counter(r[0] for r in rows[4])
    assert max(r.shard for r in last) <= 15


def test_stages_take_awkward_and_empty_tables(spark):
    rows = [(*r, 1) for r in cases.awkward(long_words=500)]
    schema = cases.SCHEMA + ", n_chars long"
    for table in (rows, []):
        docs = spark.createDataFrame(table, schema)
        for name, stage in cp.STAGES:
            docs = written(stage(spark, docs, SF))
        assert docs.count() <= 3 * len(table)


def test_run_writes_all_stages(spark):
    out = entry.queries()["pipeline"](spark, SF)
    assert {"doc_id", "text", "shard", "slot"} <= set(out.columns) and out.count() > 0


def test_all_queries_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} and set(QUERIES) | {"pipeline"} <= names
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    res = compare(spark, duck_connection(SF), name, QUERIES[name], ORACLE[name], SF)
    assert res["names"] and res["rows"][0] == res["rows"][1] and res["hash"], res


def test_learned_and_similarity_queries_cover_all_rows(spark):
    n = load(spark, SF, "documents").count()
    for name in ("op1_toxicity", "op5_near_dedup", "op6_quality_cotraining", "op9_licences", "op2_byte_shards"):
        out = QUERIES[name](spark, SF)
        assert out.count() == n and out.select("doc_id").distinct().count() == n, name


def test_the_rest_imports_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and len(q) > 40 and e.oracle_sql()"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
