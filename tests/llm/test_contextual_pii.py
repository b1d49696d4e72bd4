"""Base spans against Python's re, bootstrapping against a plain twin."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from polarity.llm import contextual_pii as cp
from polarity.llm.queries import QUERIES
from tests.llm import cases

# The base patterns as Python regular expressions.
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
E = r"[^\s@<>(),;:\x22\[\]]"
INSTANCE = re.compile(rf"(?a:(?<!{E}){E}+@{E}+|(?<![A-Za-z0-9])[+(]?[0-9][0-9().:\x20/-]*[0-9](?![A-Za-z0-9]))")


def counts(kind, hit):
    number = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        doubled = [int(d) * (i % 2 + 1) for i, d in enumerate(reversed(number))]
        return 12 <= len(number) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(number) <= 15


def base(text):
    return [(m.start(), i, k, m.end()) for i, k in enumerate(cp.KINDS) for m in re.finditer(BASE[k], text) if counts(k, m[0])]


def seed(hit):
    return next((k for k in cp.KINDS if re.fullmatch(BASE[k], hit) and counts(k, hit)), None)


def resembles(hit):
    n = len(re.sub("[^0-9]", "", hit))
    if "@" in hit:
        return "email"
    if re.fullmatch(r"[0-9]+(\.[0-9]+){3,}", hit):
        return "ip"
    if re.fullmatch(r"[0-9\x20-]+", hit) and 12 <= n <= 19:
        return "card"
    return "phone" if re.fullmatch(r"[+(]?[0-9\x20().-]+", hit) and 7 <= n <= 15 else None


def instances(text):
    for m in INSTANCE.finditer(text):
        left = text[:m.start()]
        previous = list(INSTANCE.finditer(text, 0, m.start()))
        left = text[max(previous[-1].end() if previous else 0, m.start() - 48):m.start()].lower().split()
        following = INSTANCE.search(text, m.end())
        right = text[m.end():min(following.start() if following else len(text), m.end() + 48)].lower().split()
        one, two = (left[-1] if left else "^"), (left[-2] if len(left) > 1 else "^")
        yield m.start(), m.end(), m[0], (f"{one} _", f"{two} {one} _", f"{one} _ {right[0] if right else '$'}")


def brute(rows):
    edges = {}
    for _, text in rows:
        for _, _, hit, pats in instances(text or ""):
            for p in pats:
                edges.setdefault(p, {})[hit.lower()] = seed(hit) or ""
    loose = {h: resembles(h) for p in edges.values() for h, s in p.items() if not s}
    score = {}
    for _ in range(cp.ROUNDS):
        good = {}
        for p, own in edges.items():
            for k in cp.KINDS:
                known = sum(1.0 if s == k else score.get(h, 0.0) if not s and loose[h] == k else 0.0 for h, s in own.items())
                if known >= 3 and known / len(own) >= 0.8:
                    good[p, k] = known / len(own)
        for p, own in edges.items():
            for h, s in own.items():
                if not s and loose[h] and (p, loose[h]) in good:
                    score[h] = max(score.get(h, 0.0), good[p, loose[h]])
    out = {}
    for doc, text in rows:
        own = base(text or "")
        more = [(a, cp.KINDS.index(loose[hit.lower()]), loose[hit.lower()], b) for a, b, hit, _ in instances(text or "")
                if not seed(hit) and score.get(hit.lower()) and not any(s < b and a < e for s, _, _, e in own)]
        join = lambda spans: ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(spans))
        out[doc] = (*[sum(k == kind for _, _, k, _ in own) for kind in cp.KINDS],
                    hashlib.sha256(join(own).encode()).hexdigest(), join(own + more))
    return out, score


def queried(spark, tmp_path, rows):
    path = str(tmp_path / f"sf{random.random()}")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(f"{path}/documents.parquet")
    out = QUERIES["op12_contextual_pii"](spark, path).collect()
    assert len(out) == len(rows)
    return {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in out}


def contextual(rng, n=240):
    """Labelled identifiers, some of them malformed, and other numbers."""
    made = {
        "call me at {} today": lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}",
        "mail: {} please": lambda: f"u{rng.randint(0, 999)}@host{rng.randint(0, 9)}.example.com",
        "from address {} on": lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)),
    }
    broken = {
        "call me at {} today": lambda: f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}",
        "ring {} now, call me at home": lambda: f"{rng.randint(200, 999)}-555-{rng.randint(1000, 9999)}",
        "mail: {} please": lambda: f"u{rng.randint(0, 999)}@localhost",
        "from address {} on": lambda: ".".join(str(rng.randint(256, 999)) for _ in range(4)),
        "in the year {} of": lambda: str(rng.randint(1000, 2999)),
        "order number {} was": lambda: f"{rng.randint(10 ** 6, 10 ** 7)}-{rng.randint(10, 99)}",
        "ratio 3:4, at {} percent": lambda: f"{rng.randint(10, 99)}",
    }
    for i in range(n):
        table = made if rng.random() < 0.8 else broken
        form = rng.choice(list(table))
        yield i, f"{cases.sentence(rng, 4)}. {form.format(table[form]())} {cases.sentence(rng, 3)}."


def test_malformed_identifiers_are_found_by_context(spark, tmp_path):
    rows = list(contextual(random.Random(9)))
    expected, score = brute(rows)
    found = queried(spark, tmp_path, rows)
    assert found == expected
    added = {k for _, _, _, _, _, spans in found.values() for k in re.findall("[a-z]+", spans)}
    assert added == {"email", "ip", "phone"} and len(score) > 15
    said = dict(rows)
    for doc, (*n, _, spans) in found.items():
        if "year" in said[doc] or "order number" in said[doc] or "percent" in said[doc]:
            assert spans == "" and sum(n) == 0, said[doc]
    for text, spans in ((said[d], v[-1]) for d, v in found.items()):
        if "@localhost" in text:
            a, b = map(int, re.search(r"email:(\d+):(\d+)", spans).groups())
            assert text[a:b].endswith("@localhost")


def test_base_spans_equal_pythons(spark, tmp_path):
    rng = random.Random(3)
    bits = ["a.b@c.d", "@", "x", "é𝒳", " ", "\n", "+1", "+49 (30) 12-34.56", "255.255.0.1", "1.2.3.400", "00012.1.1.1", "4111 1111 1111 1111",
            "4111-1111-1111-1112", "0", "12", ".", "-", "_b@e-f.g.h", "+", "(", ")", "5500000000000004", "%", "@d.e", "555", "\t", ", "]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))) for i in range(1500)]
    rows += [(2000 + i, t) for i, (_, t, _, _) in enumerate(cases.awkward())]
    rows += [(3000, "1 " * 30_000), (3001, "7" * 40_000), (3002, "a" * 60_000 + "@"), (3003, "a@b.c_d@e.f " * 700),
             (3004, "1.2.3.4.5.6.7.8.9"), (3005, "+1" * 20_000), (3006, "(" * 30_000 + "1"), (3007, "a@b" + ".c" * 20_000)]
    found = queried(spark, tmp_path, rows)
    for doc, text in rows:
        own = base(text or "")
        said = ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(own))
        assert found[doc][:4] == tuple(sum(k == kind for _, _, k, _ in own) for kind in cp.KINDS), text
        assert found[doc][4] == hashlib.sha256(said.encode()).hexdigest(), text
        assert set(filter(None, said.split(","))) <= set(found[doc][5].split(","))
    assert sum(sum(v[:4]) for v in found.values()) > 1000
    assert found == brute(rows)[0]


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1500])
def test_running_sums(spark, n):
    df = spark.range(1).select(F.expr(f"transform(sequence(1, {n + 1}), x -> cast(x as int))").alias("xs"))
    out = df.select(cp.running(F.expr(f"slice(xs, 1, {n})")).alias("s")).first().s
    assert out == [i * (i + 1) // 2 for i in range(n)]


def test_awkward_tables_and_plans(spark):
    assert cp.find(cases.empty(spark)).count() == 0
    df = cases.clashing(cases.frame(spark, cases.awkward()), "rid", "row", "found", "email_spans", "instances", "_salt")
    out = cp.find(df).collect()
    assert len(out) == len(cases.awkward()) and {r.rid for r in out} == {"mine"} and {tuple(r.found) for r in out} == {()}
    assert "Python" not in cp.find(df)._jdf.queryExecution().toString()
