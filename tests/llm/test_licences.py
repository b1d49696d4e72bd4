"""Licence cosine and inheritance against direct computation."""

import math
import re
from collections import Counter

from polarity.llm import licences as lc
from tests.llm import cases

FILES = [
    ("src/LICENSE", "The project\nReleased under the MIT License."),
    ("src/a.py", "code\n"), ("src/deep/er/b.py", None), ("src/deep/COPYING.txt", "This work is licensed under the GNU General Public License, version 3."),
    ("src/deep/er/c.py", "Licensed under the Apache License, Version 2.0."), ("src/deep/d.py", ""), ("other/e.py", "license"),
    ("top.txt", "All rights reserved."), ("other/x/NOTICE", "nothing here"), (None, "text"), ("src/two.md", "Licensed under the MIT License\nReleased under the MIT License"),
    ("README", "x " * 5000 + "\nLicensed under CC BY-NC 4.0."),
]


def table(spark, rows=FILES):
    return spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(rows)], "id long, path string, text string")


def brute(rows):
    toks = lambda t: [w for w in re.split("[^a-z0-9]+", t.lower()) if w]
    vocabulary = {w for _, t in lc.TEMPLATES for w in toks(t)}
    n = len(rows)
    df = Counter(w for _, t in rows for w in set(toks(t or "")) & vocabulary)
    idf = lambda w: math.log((1 + n) / (1 + (df[w] if w in vocabulary else 0))) + 1
    vec = lambda t: {w: c * idf(w) for w, c in Counter(toks(t)).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    own = []
    for _, text in rows:
        best = []
        for line in (text or "").split("\n"):
            if re.search(lc.ANCHOR, line):
                v = vec(line)
                for name, t in lc.TEMPLATES:
                    m = vec(t)
                    c = sum(x * m.get(w, 0) for w, x in v.items()) / norm(v) / norm(m)
                    if c >= lc.LEAST_COSINE:
                        best.append((-round(c, 9), name))
        own.append(min(best) if best else None)
    held = {}
    for (path, _), o in zip(rows, own):
        if path and o and re.search(lc.LICENCE_FILE, path.rsplit("/", 1)[-1]):
            folder = path.rsplit("/", 1)[0] if "/" in path else ""
            held[folder] = min(held.get(folder, o), o)
    out = []
    for (path, _), o in zip(rows, own):
        licence, source = (o[1], None) if o else (None, None)
        if not o and path is not None:
            folder = path.rsplit("/", 1)[0] if "/" in path else ""
            while True:
                if folder in held:
                    licence, source = held[folder][1], folder
                    break
                if not folder:
                    break
                folder = folder.rsplit("/", 1)[0] if "/" in folder else ""
        out.append((o and o[1], o and -o[0], licence, source))
    return out


def test_scan_equals_brute_force(spark):
    got = {r.id: r for r in lc.scan(table(spark).repartition(3)).collect()}
    want = brute(FILES)
    assert len(got) == len(FILES)
    for i, (own, score, licence, source) in enumerate(want):
        r = got[i]
        assert (r.own_licence, r.licence, r.inherited_from) == (own, licence, source), FILES[i]
        assert score is None and r.score is None or abs(r.score - score) < 1e-6
    assert got[2].licence == "GPL-3.0" and got[1].licence == "MIT" and got[6].licence is None


def test_no_python_and_awkward_rows(spark):
    df = cases.clashing(table(spark), "licence", "rid", "folder", "score", "word")
    out = lc.scan(df)
    assert {r.word for r in out.collect()} == {"mine"} and out.count() == len(FILES)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert lc.scan(table(spark, [])).count() == 0
    same = [("d/LICENSE", "All rights reserved."), ("d/LICENSE", "Released under the MIT License")] + [("d/f", "x")] * 40
    assert {r.licence for r in lc.scan(table(spark, same)).filter("path = 'd/f'").collect()} == {"MIT"}
    odd = cases.frame(spark, cases.awkward()).selectExpr("doc_id", "source AS path", "text")
    assert lc.scan(odd).count() == len(cases.awkward())
