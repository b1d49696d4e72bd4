"""Sharding and mixing against direct computation."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from polarity.llm import mixing, sharding
from tests.llm import cases


def test_shards_are_contiguous_near_equal_and_gapless(spark):
    rng = random.Random(1)
    rows = [(i, "é" * rng.randint(0, 90), "s", "en") for i in rng.sample(range(10_000), 700)]
    out = sharding.shard_by_bytes(cases.frame(spark, rows).repartition(5), 7).collect()
    assert len(out) == 700 and {r.law for r in out} == {"bytes"} and {r.grown_shard for r in out} == {None}
    ordered = sorted(out, key=lambda r: r.doc_id)
    total, before = sum(r.size for r in out), 0
    for r in ordered:
        assert r["size"] == len(r.text.encode()) + 1 and r.text_crc32 == zlib.crc32(r.text.encode())
        assert r.shard == before * 7 // total
        before += r["size"]
    for s in range(7):
        own = [r for r in ordered if r.shard == s]
        assert [r.slot for r in own] == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 7) <= 2 * max(r["size"] for r in out)


def test_shards_of_awkward_rows(spark):
    rows = cases.awkward()
    df = cases.clashing(cases.frame(spark, rows), "shard", "slot", "rank", "_part", "size")
    out = sharding.shard_by_bytes(df, 4).collect()
    assert len(out) == len(rows) and {r["rank"] for r in out} == {"mine"}
    assert sorted(r["size"] for r in out) == sorted(len((t or "").encode()) + 1 for _, t, _, _ in rows)
    assert all(r.text_crc32 == zlib.crc32((r.text or "").encode()) for r in out)
    for s, n in Counter(r.shard for r in out).items():
        assert sorted(r.slot for r in out if r.shard == s) == list(range(n))
    assert sharding.shard_by_bytes(cases.empty(spark), 4).count() == 0


def test_one_repeated_row_is_spread_over_shards(spark):
    df = cases.frame(spark, [(7, "same", "a", "en")] * 400)
    assert set(Counter(r.shard for r in sharding.shard_by_bytes(df, 8).collect()).values()) == {50}
    with pytest.raises(ValueError):
        sharding.shard_by_bytes(df, 0)


def brute_targets(sizes):
    """Share by weight again and again until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, free, target = sum(sizes.values()), set(names), {}
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 3 * sizes[s]
            left -= target[s]
            free.discard(s)
    return target


def brute_mix(rows):
    size = [len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t or "") if w]) for _, t, _, _ in rows]
    by = defaultdict(list)
    for i, (d, _, s, _) in enumerate(rows):
        by[s].append((hashlib.md5(f"mix:{'null' if d is None else d}".encode()).hexdigest(), size[i], i))
    totals = {s: sum(x[1] for x in v) for s, v in by.items()}
    target, taken = brute_targets(totals), [0] * len(rows)
    for s, own in by.items():
        epochs = int(target[s] // totals[s]) if totals[s] else 0
        rest, before = target[s] - epochs * totals[s], 0
        for _, n, i in sorted(own):
            taken[i] = n * (epochs + (2 * before + n <= 2 * rest and rest > 0))
            before += n
    return size, totals, target, taken


def test_mix_equals_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, cases.sentence(rng, rng.randint(0, 40)), rng.choice("aaaaaaabcd") if i % 11 else None, "en") for i in range(300)]
    rows += [(1000 + i, "x", "tiny", "en") for i in range(2)]
    size, totals, target, taken = brute_mix(rows)
    got = {r.doc_id: r for r in mixing.mix(cases.frame(spark, rows).repartition(6)).collect()}
    for (d, _, s, _), n, k in zip(rows, size, taken):
        r = got[d]
        assert (r["size"], r.source_size, r.taken) == (n, totals[s], k)
        assert abs(r.target - target[s]) < 1e-6 and r.taken <= 3 * n
    for s in totals:
        mixed = sum(r.taken for r in got.values() if r.source == s)
        assert abs(mixed - target[s]) <= max(n for (_, _, x, _), n in zip(rows, size) if x == s)
    again = {r.doc_id: r.taken for r in mixing.mix(cases.frame(spark, rows).repartition(2, "lang")).collect()}
    assert again == {d: r.taken for d, r in got.items()}


def test_mix_of_awkward_rows(spark):
    rows = cases.awkward()
    df = cases.clashing(cases.frame(spark, rows), "size", "target", "key", "of", "copies")
    out = mixing.mix(df).collect()
    assert len(out) == len(rows) and {r.key for r in out} == {"mine"}
    assert all(r.taken == r.copies * r["size"] and r.copies <= 3 for r in out)
    back = mixing.repeated(mixing.mix(df), ["doc_id", "text"])
    assert back.count() == sum(r.copies for r in out)
    assert mixing.mix(cases.empty(spark)).count() == 0
