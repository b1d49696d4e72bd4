"""Winnowed decontamination against direct window search."""

import hashlib
import random

from polarity.llm import decontamination as dc
from tests.llm import cases


def brute(text, items):
    w = cases.words(text)
    hit, found = set(), set()
    for item, t in items:
        v = cases.words(t)
        n = min(10, len(v))
        windows = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1):
            if windows and tuple(w[i:i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item) if item is not None else "null")
    ids = ",".join(sorted(found))
    return len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


def test_hits_equal_brute_force(spark):
    rng = random.Random(6)
    items = [(i, cases.sentence(rng, n)) for i, n in enumerate([9, 10, 11, 25, 60, 3, 1, 10, 14])]
    items += [(50, None), (51, "!!"), (3, items[3][1]), (None, cases.sentence(rng, 12)), (60, " ".join(["ka"] * 30))]
    rows = []
    for i in range(250):
        own = cases.sentence(rng, rng.randint(0, 80)).split(" ")
        if i % 3 == 0:
            part = cases.words(rng.choice(items)[1])
            a = rng.randrange(len(part) + 1)
            cut = part[a:a + rng.choice([5, 9, 10, 12, 40])]
            at = rng.randrange(len(own) + 1)
            own[at:at] = [w.upper() if w.isascii() else w for w in cut]
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(own), "s", "en"))
    rows += [(500 + i, t, s, l) for i, (_, t, s, l) in enumerate(cases.awkward())]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    df = cases.clashing(cases.frame(spark, rows), "n_hit", "rid", "found", "key", "item")
    got = {r.doc_id: r for r in dc.contamination(df, bench).collect()}
    assert len(got) == len(rows) and {r.key for r in got.values()} == {"mine"}
    want = {d: brute(t, items) for d, t, _, _ in rows}
    for d, r in got.items():
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == want[d], d
    assert 40 < sum(v[4] for v in want.values()) < 250


def test_repeated_ids_and_empty_tables(spark):
    shared = " ".join(f"w{i}" for i in range(12))
    bench = spark.createDataFrame([(1, shared)], "item_id long, text string")
    rows = [(7, shared, "a", "en"), (7, "other words", "a", "en"), (7, shared, "a", "en"), (None, shared, None, None)]
    got = sorted((r.text, r.contaminated) for r in dc.contamination(cases.frame(spark, rows), bench).collect())
    assert got == [("other words", False)] + [(shared, True)] * 3
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert {r.contaminated for r in dc.contamination(cases.frame(spark, rows), nothing).collect()} == {False}
    assert dc.contamination(cases.empty(spark), bench).count() == 0


def test_every_shared_window_leaves_a_fingerprint():
    """The guarantee of winnowing, over random texts with few words."""
    import pyarrow as pa
    from polarity.llm import words as wd
    rng = random.Random(7)
    for _ in range(200):
        texts = [" ".join(rng.choice("abcd") for _ in range(rng.randint(10, 40))) for _ in range(2)]
        prints, starts = [], []
        for b in [next(iter(wd.blocks(pa.array([t])))) for t in texts]:
            grams, inside = b.grams(dc.GRAM)
            kept = dc._kept(grams, inside, dc.WINDOW - dc.GRAM + 1)
            prints.append({int(grams[i]) for i in kept})
            starts.append({i: {int(grams[j]) for j in kept if i <= j <= i + dc.WINDOW - dc.GRAM} for i in range(len(b.hashes) - 9)})
        w = [t.split() for t in texts]
        for i in starts[0]:
            for j in starts[1]:
                if w[0][i:i + 10] == w[1][j:j + 10]:
                    assert starts[0][i] & starts[1][j]
