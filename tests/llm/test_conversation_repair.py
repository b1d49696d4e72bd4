"""Faults, cheapest repairs and digests against direct computation."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from polarity.llm import conversation_repair as cr
from polarity.llm.queries import QUERIES
from polarity.llm.role_grammar import Repairer

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """Dijkstra over (rows taken, last role): (cost, audit, output lines)."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, last, out = heapq.heappop(heap)
        if (at, last) in seen:
            continue
        seen.add((at, last))
        if at == len(rows) and last in ("", "a"):
            return cost, audit, out
        for new, role in (("u", "user"), ("a", "assistant")):
            if (last, new) in NEXT:
                heapq.heappush(heap, (cost + 3, audit + "I", at, new, out + ((role, ""),)))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, last, out))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 * (fault == "truncated")
            if (last, role[:1]) in NEXT:
                heapq.heappush(heap, (cost + more, audit + "K", at + 1, role[:1], out + ((role, text),)))
            for new, named in (("u", "user"), ("a", "assistant")):
                if (last, new) in NEXT:
                    heapq.heappush(heap, (cost + 3 + more, audit + "R", at + 1, new, out + ((named, text),)))


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        said = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(said.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        yield from [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)


def same(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    by_conv = {r[0]: [] for r in rows}
    for conv, *rest in damaged(rows):
        by_conv[conv].append(rest)
    out = {}
    for conv, own in by_conv.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, same(r[1], r[2])))
        turns = [r[0] for r in own if r[0] is not None]
        count, seen, marked = defaultdict(int), set(), []
        for _, role, text in own:
            shown = VISIBLE.findall(text)
            fault = ("blank" if not shown else "duplicate" if (role, text) in seen
                     else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
            count[fault] += 1
            marked.append((role, text, fault))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, lines = cheapest(marked)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest)
    return out


def queried(spark, tmp_path, rows, parts=5):
    path = str(tmp_path / f"sf{random.random()}")
    (spark.createDataFrame(rows, SCHEMA).repartition(parts).selectExpr("*", "'mine' as head", "1 as same", "2 as cost")
     .write.parquet(f"{path}/conversations.parquet"))
    out = QUERIES["op11_conversation_repair"](spark, path).collect()
    found = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in out}
    assert len(found) == len(out)
    return found


def some_rows(seed, convs=120):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "well", "  ", "", "ok then. ", "à bientôt.\n", "unfinished,", None, "x" * 50_000 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "", "umpire"]
    rows = []
    for conv in [None, *range(convs)]:
        for turn in range(rng.randint(0, 9)):
            role = ("user", "assistant")[turn % 2] if rng.random() < 0.6 else rng.choice(roles)
            text = rng.choice(texts) if rng.random() < 0.5 else f"line {rng.randint(0, 40)} of {conv}."
            rows.append((conv, None if rng.random() < 0.05 else turn + rng.choice([0, 0, 0, 3]), role, text))
    return rows


def test_whole_query_equals_brute_force(spark, tmp_path):
    rows = some_rows(1) + [(1000 + i, 0, "user", "Alone.") for i in range(60)]
    expected = brute(rows)
    assert queried(spark, tmp_path, rows) == expected
    assert {e for *_, audit, _ in expected.values() for e in audit} == set("KRDI")
    assert any(audit == "" for *_, audit, _ in expected.values())


def test_long_conversations_cross_pieces_and_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cr, "PIECE_ROWS", 7)
    rng = random.Random(2)
    rows = [(7, t, rng.choice(["user", "assistant", "system", "tool"]), f"{rng.randint(0, 300)}{rng.choice('.,')}")
            for t in range(1500)] + some_rows(3, 20) + [(8, 5, "user", "the same.")] * 600
    assert queried(spark, tmp_path, rows, 9) == brute(rows)


def test_repaired_rows_are_legal_and_empty_tables_work(spark):
    rows = cr.damage(spark.createDataFrame(some_rows(4), SCHEMA))
    found = cr.repairs(rows)
    lines = defaultdict(dict)
    for r in cr.repaired_rows(rows, found).collect():
        lines[r.conv_id][r.place] = r
    audits = {r.conv_id: r.audit for r in found.collect()}
    for conv, own in lines.items():
        said = [own[i] for i in range(len(own))]
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in said))
        assert [r.edit for r in said] == [e for e in audits[conv] if e != "D"]
        assert all(r.text == "" for r in said if r.edit == "I")
    nothing = spark.createDataFrame([], SCHEMA)
    assert cr.repairs(nothing).count() == 0 and cr.repaired_digests(nothing, cr.repairs(nothing)).count() == 0
    assert cr.with_all(nothing, cr.repairs(nothing)).count() == 0


def test_grammar_repair_is_cheapest_and_least():
    repairer = Repairer()
    row = {"s": ("system", "a.", ""), "u": ("user", "a.", ""), "a": ("assistant", "a.", ""), "?": ("tool", "a.", ""),
           "x": ("user", "", "blank"), "S": ("system", "a", "truncated"), "U": ("user", "a", "truncated"),
           "A": ("assistant", "a", "truncated"), "!": ("tool", "a", "truncated")}
    rng = random.Random(6)
    cases = ["".join(s) for n in range(5) for s in itertools.product("suaxU?", repeat=n)]
    cases += ["".join(rng.choice("suaSUAx?!uaua") for _ in range(rng.randint(5, 24))) for _ in range(1500)]
    for said in cases:
        cut = rng.randint(0, len(said))
        assert repairer.repair([said[:cut], said[cut:]]) == cheapest([row[c] for c in said])[:2], said
    assert len(repairer.known) < 5000          # steps repeat, however long the input
    pairs = Repairer((("S", ""), ("S", "Sua")))
    assert pairs.repair(["uuaa"]) == (6, "KIKKIK")


def test_long_run_is_linear():
    rng = random.Random(8)
    said = "".join(rng.choice("suaSUAx?uaua") for _ in range(200_000))
    cost, audit = Repairer().repair([said[i:i + 4096] for i in range(0, len(said), 4096)])
    assert len(audit.replace("I", "")) == len(said) and cost > 0


def test_damage_by_crc(spark):
    rows = [(i, j, "assistant", "One. Two! Three?") for i in range(60) for j in range(3)] + [(None, None, None, None)] * 2
    out = cr.damage(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, damaged(rows)))
    assert cr.damage(spark.createDataFrame([], SCHEMA)).agg(F.count("*")).first()[0] == 0
