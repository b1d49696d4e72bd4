"""Character n-grams of every row, counted as integer keys in the tasks."""

import random
from collections import Counter

import pyarrow as pa
import pytest

from polarity.functions import grams
from polarity.operators import features as feat
from polarity.sources import fixtures as fx


def direct(rows, lo, hi):
    return {(i, g): n for i, t in rows for g, n in Counter(g for w in (t or "").split() for g in grams.char_terms(w, lo, hi)).items()}


def odd_rows():
    rng = random.Random(5)
    letters = "abcde é\U0001f600漢字한\x00ﬀ \x85　"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    return rows + [(150, None), (151, ""), (152, " \t "), (153, "a"), (154, "word " * 3000), (155, "".join(chr(0x4e00 + k % 6000) for k in range(6100)))]


@pytest.mark.parametrize("lo, hi", [(3, 3), (3, 5), (3, 20)])
def test_rows_equal_a_direct_count(spark, lo, hi):
    rows = odd_rows()
    df = spark.createDataFrame(rows, "row_id long, clean_text string").repartition(5)
    found = [((r.row_id, r.term), r.tf) for r in feat.doc_terms(df, feat.TfidfConfig(analyzer="char_wb", ngram_range=(lo, hi))).collect()]
    assert len(found) == len(dict(found)) and dict(found) == direct(rows, lo, hi)


# few characters together, and more kinds of characters than keys have room for beside the rows
@pytest.mark.parametrize("chars, kinds", [(1, 30), (50, 30), (1 << 18, 30), (1 << 18, 900), (1 << 18, 20000)])
def test_texts_taken_together_stay_apart(chars, kinds, monkeypatch):
    monkeypatch.setattr(grams, "CHARS", chars)
    monkeypatch.setattr(grams, "CELLS", 1000)
    rng = random.Random(2)
    rows = [(i, " ".join("".join(chr(97 + rng.randrange(kinds)) for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(0, 25)))) for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([t for _, t in rows])], ["row_id", "text"])
    out = [r for b in grams.listing(3, 5, ["row_id", "term", "tf"])(iter([batch, batch.slice(0, 0)])) for r in b.to_pylist()]
    found = {(r["row_id"], r["term"]): r["tf"] for r in out}
    assert len(found) == len(out) and found == direct(rows, 3, 5)


def test_no_array_of_a_row_is_sorted_or_exploded(spark, sf_small):
    p = feat.doc_terms(fx.texts(spark, sf_small), feat.TfidfConfig(analyzer="char_wb", ngram_range=(3, 5)), text_col="text")
    p = p._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in p and "lambdafunction" not in p and "Generate" not in p and "sort_array" not in p
