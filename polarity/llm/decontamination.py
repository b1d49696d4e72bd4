"""Benchmark decontamination by winnowing (operator 8).

Both sides keep the least hash of each run of neighbouring k-grams, so any
shared span of a whole window leaves a common fingerprint.  Document
fingerprints are screened by a bit table of fixed size; the windows around a
hit are then extended and compared as whole word sequences by a join.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polarity.llm import words as wd
from polarity.llm.screen import bit_table, marked
from polarity.llm.tables import packed, unpacked, written

WINDOW = 10          # words of a window
GRAM = 5             # words of a fingerprinted gram

FOUND = "array<struct<at:int,len:int,key:binary>>"


def _kept(grams: np.ndarray, inside: np.ndarray, run: int) -> np.ndarray:
    """Places of the fingerprints: the rightmost least gram of each ``run``
    neighbours that lie in one text."""
    n = len(grams) - run + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    whole = inside[:n].copy()
    least, place = grams[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, run):
        whole &= inside[j:j + n]
        lower = grams[j:j + n] <= least
        least[lower] = grams[j:j + n][lower]
        place[lower] = j
    return np.unique((np.arange(n) + place)[whole])


def _key(block: wd.Block, at: int, size: int) -> bytes:
    return hashlib.md5(b" ".join(block.words(at, at + size))).digest()


def _items(batches, window: int, gram: int):
    """benchmark rows -> windows (key) and fingerprints (print) of each item."""
    for batch in batches:
        ids, keys, prints, sizes = [], [], [], []
        texts = batch.column("text")
        for b in wd.blocks(texts):
            grams, inside = b.grams(gram)
            kept = _kept(grams, inside, window - gram + 1)
            owner = b.text_of(kept)
            by_size = {}
            for i, n in enumerate(b.counts()):
                if n == 0:
                    continue
                begin, size = int(b.bounds[i]), min(int(n), window)
                ids.append(b.first + i)
                sizes.append(size)
                keys.append([_key(b, begin + j, size) for j in range(int(n) - size + 1)])
                if size < window:
                    by_size.setdefault(size, b.grams(size)[0])
                    prints.append([int(by_size[size][begin:begin + 1].view(np.int64)[0])])
                else:
                    prints.append(grams[kept[owner == i]].view(np.int64).tolist())
        yield pa.RecordBatch.from_arrays(
            [batch.column("item").take(pa.array(ids, pa.int64())), pa.array(sizes, pa.int32()),
             pa.array(keys, pa.list_(pa.binary())), pa.array(prints, pa.list_(pa.int64()))],
            names=["item", "size", "keys", "prints"])


def _candidates(batches, screen: bytes, short: list[int], window: int, gram: int):
    """Document rows -> word count and the windows that may be an item's."""
    table = np.frombuffer(screen, dtype=np.uint8)

    for batch in batches:
        counts = np.zeros(batch.num_rows, np.int64)
        found = [[] for _ in range(batch.num_rows)]
        for b in wd.blocks(batch.column("text")):
            counts[b.first:b.first + len(b.counts())] = b.counts()
            grams, inside = b.grams(gram)
            kept = _kept(grams, inside, window - gram + 1)
            kept = kept[marked(table, grams[kept])]
            # every window that holds the gram, within the text
            starts = (kept[:, None] - np.arange(window - gram + 1)[None, :])
            owner = b.text_of(kept)[:, None]
            fits = (starts >= b.bounds[owner]) & (starts + window <= b.bounds[owner + 1])
            spans = [(window, np.unique(starts[fits]))]
            for size in short:
                grams, inside = b.grams(size)
                spans.append((size, np.flatnonzero(inside & marked(table, grams))))
            for size, places in spans:
                texts = b.text_of(places)
                for at, i in zip(places.tolist(), texts.tolist()):
                    found[b.first + i].append(
                        {"at": at - int(b.bounds[i]), "len": size, "key": _key(b, at, size)})
        kind = pa.list_(pa.struct([("at", pa.int32()), ("len", pa.int32()), ("key", pa.binary())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("rid"), pa.array(counts), pa.array(found, kind)],
            names=["row", "rid", "n_words", "found"])


def contamination(df: DataFrame, benchmark: DataFrame, carry: list[str] | None = None,
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``carry`` columns (default: all) of ``df`` plus n_words, n_hit, n_items,
    items_sha256, contaminated.

    Words as in ``words``; a window is ``window`` consecutive words of an
    item, or all of a shorter one.  Shared spans of ``window`` words share a
    fingerprint for certain (runs of window - gram + 1 grams); shorter items
    are looked up as whole grams of their own length.  Null and empty texts
    have no words and are clean; items without words have no window; repeated
    item ids count once and a null id reads "null".  Rows are matched by a row
    number, so repeated document ids stay apart.  An empty benchmark marks
    nothing.  Carried columns named like an added one are replaced.
    """
    carry = list(carry or df.columns)
    items = written(
        benchmark.select(F.coalesce(benchmark[item_col].cast("string"), F.lit("null")).alias("item"),
                         benchmark[item_text].cast("string").alias("text"))
        .mapInArrow(lambda it: _items(it, window, gram),
                    "item string, size int, keys array<binary>, prints array<bigint>"))
    windows = items.select("item", F.explode("keys").alias("item_key")).distinct()
    screen = bit_table(items.select(F.explode("prints")))
    short = sorted(r[0] for r in items.filter(F.col("size") < window).select("size").distinct().collect())

    rows = packed(df, carry, rid=F.monotonically_increasing_id(), text=df[text_col].cast("string"))
    kind = rows.schema["row"].dataType.simpleString()
    scanned = written(rows.mapInArrow(
        lambda it: _candidates(it, screen, short, window, gram),
        f"row {kind}, rid bigint, n_words bigint, found {FOUND}"))
    spans = scanned.filter(F.size("found") > 0).select("rid", F.explode("found").alias("f")).select("rid", "f.*")
    hits = spans.join(windows, F.col("key") == F.col("item_key"))
    of_items = (hits.select("rid", "item").distinct().groupBy(F.col("rid").alias("of"))
                .agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("item")).alias("items")))
    of_words = (hits.select("rid", "at", "len").distinct().groupBy(F.col("rid").alias("in"))
                .agg(F.array_sort(F.collect_list(F.struct("at", "len"))).alias("hit")))
    counted = (scanned.drop("found").join(of_items, F.col("rid") == F.col("of"), "left")
              .join(of_words, F.col("rid") == F.col("in"), "left"))
    n_hit = F.coalesce(_covered(F.col("hit")), F.lit(0)).cast("bigint")
    return unpacked(
        counted, carry, n_words=F.col("n_words"), n_hit=n_hit,
        n_items=F.coalesce(F.col("n"), F.lit(0)).cast("bigint"),
        items_sha256=F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256),
        contaminated=n_hit > 0)


def _covered(spans):
    """Words inside any of the sorted spans (at, len)."""
    start = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("reach"))

    def add(acc, s):
        end = s["at"] + s["len"]
        return F.struct((acc["covered"] + F.greatest(F.lit(0), end - F.greatest(s["at"], acc["reach"]))).alias("covered"),
                        F.greatest(acc["reach"], end).alias("reach"))

    return F.aggregate(spans, start, add)["covered"]
