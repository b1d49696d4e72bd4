"""WARC round trip and salvage."""

import gzip
import hashlib
import random

from polarity.llm import warc
from polarity.llm.tables import new_folder
from tests.llm import cases

PAGES = "page_id long, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES)


def sample():
    rng = random.Random(8)
    big = "<p>" + cases.sentence(rng, 400) + "</p>"
    rows = [(i, f"http://h/{i}", f"<p>{cases.sentence(rng, rng.randint(1, 300))}</p>") for i in range(60)]
    rows += [(100 + i, f"http://c/{i}", big) for i in range(9)] + [(200, "http://s", "tiny"), (201, None, "tiny")]
    return rows + [(300, "http://n", None), (301, "http://e", ""), (302, "bad\r\nWARC-Type: x", "é" * 3000), (None, "http://z", "no id")]


def brute(rows):
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        same = [j for j, _, h in rows if h == html and j is not None]
        refers = max(same) if len(raw) >= 1000 and len(same) > 1 and max(same) != i else None
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def test_round_trip(spark):
    rows = sample()
    manifest = warc.write_archives(pages(spark, rows).repartition(4), new_folder(spark, "warc"), archive_bytes=4_000)
    paths = [r.path for r in manifest.collect()]
    assert len(paths) > 4 and manifest.agg({"records": "sum"}).first()[0] == len(rows)
    read = warc.read_archives(spark, paths, with_payload=True).collect()
    assert {r.kind for r in read} == {"record"}
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read), key=str) == brute(rows)
    texts = {i: (h or "").encode() for i, _, h in rows}
    assert all(bytes(r.payload) == texts[r.page_id] for r in read if r.record_type == "response")
    with gzip.open(paths[0].removeprefix("file:"), "rb") as f:      # any gzip reader takes it
        assert f.read(8) == b"WARC/1.1"
    assert warc.read_archives(spark, []).count() == 0
    assert warc.write_archives(pages(spark, []), new_folder(spark, "warc")).count() == 0


def records(n, seed=9):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = cases.sentence(rng, 40)
        out.append(warc._record({"page_id": i, "uri": "http://x", "digest": hashlib.sha1(text.encode()).hexdigest(),
                                 "size": len(text.encode()), "refers_to": None, "payload": text}))
    return out


def test_damage_costs_only_the_records_it_touches():
    rng = random.Random(10)
    for plain in (False, True):
        parts = [r if plain else warc._member(r) for r in records(20)]
        starts = [sum(map(len, parts[:i])) for i in range(21)]
        for _ in range(30):
            data = bytearray(b"".join(parts))
            hurt = rng.randrange(20)
            # a plain header has no digest: there the block is hurt
            head = parts[hurt].find(b"\r\n\r\n") + 4 if plain else 0
            at = rng.randrange(starts[hurt] + head, starts[hurt + 1] - 1)
            data[at] ^= 0x55
            found = list(warc.salvage(bytes(data)))
            good = [r["page_id"] for r in found if r["kind"] == "record"]
            assert set(good) >= set(range(20)) - {hurt} and len(good) == len(set(good))
            if hurt not in good:
                gap, = [r for r in found if r["kind"] == "gap"]
                assert (gap["offset"], gap["length"]) == (starts[hurt], len(parts[hurt])) and gap["problem"]


def test_cut_junk_and_mixed_archives():
    parts = [warc._member(r) for r in records(4)]
    data = b"junk \x1f\x8b\x08 junk" + parts[0] + records(6)[5] + b"WARC/1.1\r\nbroken" + parts[1] + parts[2][:-7]
    found = list(warc.salvage(data))
    assert [r["page_id"] for r in found if r["kind"] == "record"] == [0, 5, 1]
    gaps = [(r["offset"], r["length"]) for r in found if r["kind"] == "gap"]
    whole = sum(n for _, n in gaps) + len(parts[0]) + len(records(6)[5]) + len(parts[1])
    assert len(gaps) == 3 and whole == len(data)
    assert list(warc.salvage(b"")) == []


def test_user_columns_do_not_matter(spark):
    df = cases.clashing(pages(spark, sample()[:5]), "digest", "payload", "kind")
    assert warc.write_archives(df, new_folder(spark, "warc")).agg({"records": "sum"}).first()[0] == 5


def test_a_long_url_is_read_back():
    row = {"page_id": 7, "uri": "data:text/html," + "x" * 200_000, "digest": "d", "size": 2, "refers_to": None, "payload": "ab"}
    record = warc._record(row)
    for data in (warc._member(record), record, b"WARC/1.1\r\nno end" + b"\r\n" + record):
        *gaps, got = warc.salvage(data)
        assert (got["kind"], got["page_id"], got["uri"]) == ("record", 7, row["uri"])
        assert [g["kind"] for g in gaps] == ["gap"] * len(gaps) and sum(g["length"] for g in gaps) + got["length"] == len(data)
