"""Property test: the fused Spark bundle equals a literal step-by-step run of
the reference's dedup/cleaning rules on random small tables."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from polarity.operators import dedup


def keep_first(rows, field):
    seen, out = set(), []
    for r in rows:
        k = (r[field], r["label"])
        if k not in seen:
            seen.add(k)
            out.append(r)
    return out


def drop_conflicts(rows, field):
    labels = {}
    for r in rows:
        labels.setdefault(r[field], set()).add(r["label"])
    return [r for r in rows if len(labels[r[field]]) == 1]


# piece of a text: what cleaning makes of it, and what the duplicate key does
PIECES = {
    "Moss": ("Moss", "moss"), "moss": ("moss", "moss"), " moss ": ("moss", "moss"), "MOSS!": ("MOSS!", "moss!"),
    "&amp;": ("&", "&"), "&": ("&", "&"), "@bob": ("<USER>", "@bob"), "@Bob": ("<USER>", "@bob"),
    "#fun": ("fun", "#fun"), "fun": ("fun", "fun"), "www.x.io": ("<URL>", "www.x.io"), "http://a.b": ("<URL>", "http://a.b"),
    "  ": ("", ""), "\t": ("", ""), "\u00a0": ("", ""), "café": ("café", "café"), "ok": ("ok", "ok"), "x@y": ("x@y", "x@y"),
}


def said(pieces, form):
    return " ".join(filter(None, (PIECES[p][form] for p in pieces)))


def step_by_step(rows):
    rows = keep_first(rows, "text")
    for r in rows:
        r["clean"], r["key"] = said(r["pieces"], 0), said(r["pieces"], 1)
    rows = keep_first(drop_conflicts(rows, "key"), "key")
    rows = [r for r in rows if r["clean"] != ""]
    rows = keep_first(drop_conflicts(rows, "clean"), "clean")
    return sorted((r["id"], r["label"], r["text"], r["clean"]) for r in rows)


tables = st.lists(st.tuples(st.lists(st.sampled_from(sorted(PIECES)), max_size=4), st.integers(0, 1)), min_size=1, max_size=25)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tables)
def test_fused_bundle_equals_step_by_step(spark, table):
    rows = [{"id": i, "label": l, "pieces": p, "text": " ".join(p)} for i, (p, l) in enumerate(table)]
    df = spark.createDataFrame([(r["id"], r["label"], r["text"]) for r in rows],
                               "row_id long, sentiment int, text string")
    got = sorted((r.row_id, r.sentiment, r.text, r.clean_text) for r in dedup.preprocess_plan(df).clean.collect())
    assert got == step_by_step([dict(r) for r in rows])
