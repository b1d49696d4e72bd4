"""Exact duplicates against a dictionary; the fuse filter alone."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from polarity.llm import exact_dedup, fuse
from tests.llm import cases


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(norm(r[1]), []).append(r)
    out = []
    for text, own in groups.items():
        best = min(own, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(r[0], best[0], len(own), digest) for r in own]
    return sorted(out, key=str)


@pytest.mark.parametrize("batches", [1, 2, 3])
def test_groups_equal_brute_force_for_any_batches(spark, batches):
    rng = random.Random(4)
    texts = [cases.sentence(rng, rng.randint(1, 6)) for _ in range(60)]
    rows = [(i, rng.choice(texts).replace(" ", rng.choice([" ", "  ", "\t", "\n "])), "s", "en") for i in range(300)]
    rows += [(1000, "hot  copy", "s", "en"), *[(1001 + i, "hotcopy", "s", "en") for i in range(150)], *cases.awkward()]
    df = cases.clashing(cases.frame(spark, rows), "digest", "rid", "keep_id", "best")
    got = exact_dedup.deduplicate(df, F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)), batches).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) and all(r.doc_id == r.keep_id for r in kept)
    assert {r.digest for r in got} == {"mine"}


def test_empty_table(spark):
    assert exact_dedup.deduplicate(cases.empty(spark), F.lit(0), 2).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 100, 5000, 70000])
def test_fuse_filter_holds_its_keys_and_few_others(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    f = fuse.build(np.concatenate([keys, keys]))
    assert f.holds(keys).all()
    others = rng.integers(0, 1 << 63, 20000, dtype=np.uint64)
    assert f.holds(others).mean() < 0.02
    if n >= 5000:
        assert len(f.slots) < 1.4 * n


def test_bytes_decide_when_digests_agree(spark):
    """A snapshot entry whose bytes differ under the same digest stays apart."""
    digest = bytes(32)
    snapshot = spark.createDataFrame([(0, digest, "old")], "batch int, digest binary, bytes string")
    passed = spark.createDataFrame([(digest,)], "digest binary")
    for text, same in (("old", 1), ("new", 0)):
        fresh = spark.createDataFrame([(1, digest, text)], "batch int, digest binary, bytes string")
        assert exact_dedup._same_bytes(fresh, snapshot, passed, 1).count() == same
