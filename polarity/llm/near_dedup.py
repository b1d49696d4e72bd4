"""Near duplicates by consistent weighted sampling (operator 5).

A text is its set of five-word shingles, weighted tf * idf.  Each consistent
weighted draw chooses among all shingles of a text; equal draws are as likely
as the weighted Jaccard similarity.  Bands of draws make buckets, pairs of a bucket are verified by exact weighted Jaccard on
whole texts, and verified links make the classes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polarity.llm import words as wd
from polarity.llm.components import components
from polarity.llm.screen import bit_table, may_match
from polarity.llm.tables import packed, unpacked, written

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 26, 6         # misses 4 in 10,000 pairs of similarity 0.8
BINS = BANDS * ROWS
FINE = 1024                 # draws that decide which pairs of a sweep are read
FEATURES = 1 << 18          # hashed words that document frequencies are kept for
PART = 256                  # of them in a row of the count table
CELL = 8.0                  # weight whose points come from one hash
POINTS = 1 << 16            # made at once, once so few cells are left


def word_weights(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """idf of each hashed word over all rows: ln((1 + N) / (1 + df)) + 1.

    A word counts once per text.  Words share FEATURES places, so the result
    has a fixed size (1 MB) whatever the corpus; tasks send their counts in
    rows of PART places, which are summed up by place."""
    def count(batches):
        seen, texts = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            texts += batch.num_rows
            for b in wd.blocks(batch.column(0)):
                owner = np.repeat(np.arange(len(b.counts())), b.counts()).astype(np.uint64)
                pairs = np.unique(owner * np.uint64(FEATURES) + b.hashes % np.uint64(FEATURES))
                seen += np.bincount((pairs % np.uint64(FEATURES)).astype(np.int64), minlength=FEATURES)
        parts = seen.reshape(-1, PART)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *range(len(parts))], pa.int32()),
             pa.array([np.int64(texts).tobytes(), *[p.tobytes() for p in parts]], pa.binary())],
            names=["place", "counts"])

    def add(part: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.int64) for c in part["counts"])
        return pd.DataFrame({"place": [part["place"].iloc[0]], "counts": [total.tobytes()]})

    summed = (df.select(df[text_col].cast("string").alias("text")).mapInArrow(count, "place int, counts binary")
              .groupBy("place").applyInPandas(add, "place int, counts binary"))
    rows = {r.place: np.frombuffer(r.counts, np.int64) for r in summed.collect()}  # FEATURES / PART + 1 rows
    texts = int(rows.pop(-1, np.zeros(1))[0])
    seen = np.concatenate([rows[k] for k in sorted(rows)]) if rows else np.zeros(FEATURES)
    return (np.log((1 + texts) / (1 + seen)) + 1).astype(np.float32)


def shingles(b: wd.Block, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight) of all texts of a block, sorted, each once.

    weight = occurrences * mean idf of the words.  A text of one to four words
    is one shingle."""
    value = idf[(b.hashes % np.uint64(len(idf))).astype(np.int64)]
    grams, inside = b.grams(SHINGLE)
    at = np.flatnonzero(inside)
    ids, texts = [grams[at]], [b.text_of(at)]
    summed = np.concatenate(([0.0], np.cumsum(value, dtype=np.float64)))
    mean = [(summed[at + SHINGLE] - summed[at]) / SHINGLE]
    counts = b.counts()
    for size in range(1, SHINGLE):
        few = np.flatnonzero(counts == size)
        if len(few):
            start = b.bounds[few]
            ids.append(b.grams(size)[0][start])
            texts.append(few)
            mean.append((summed[start + size] - summed[start]) / size)
    keys = (np.concatenate(texts).astype(np.uint64) << np.uint64(48)) | (np.concatenate(ids) >> np.uint64(16))
    keys, first, times = np.unique(keys, return_index=True, return_counts=True)
    return ((keys >> np.uint64(48)).astype(np.int64), keys & np.uint64((1 << 48) - 1),
            times * np.round(np.concatenate(mean)[first], 4))


def draws(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int, bins: int = BINS) -> np.ndarray:
    """(texts, bins) codes of the consistent weighted draws; 0: no shingle.

    A shingle is a strip of its weight, cut into cells of width CELL.  The hash
    of a cell gives points in the order of time (a Poisson process), each with
    a place across the cell and a draw that it belongs to.  A text has the
    points whose place lies within its weight, and the earliest of each draw
    wins.  So every draw sees all shingles, is independent of the others, and
    is equal for two texts with their weighted Jaccard similarity, however
    short they are."""
    cells = np.maximum(np.ceil(weight / CELL), 1).astype(np.int64)
    of = np.repeat(np.arange(len(shingle)), cells)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(cells) - cells, cells)
    seed = wd.mixed(shingle[of] + wd.mixed(nth.astype(np.uint64) + np.uint64(1)))
    room, row = weight[of] / CELL - nth, text[of]
    time, step = np.zeros(len(of)), 0
    least = np.full(texts * bins, np.inf)
    codes = np.zeros(texts * bins, np.uint64)
    while len(seed):
        k = max(1, min(POINTS, POINTS // len(seed)))
        z = wd.mixed(seed[:, None] + np.arange(step + 1, step + k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        gaps = -np.log(((z >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53))
        gaps[:, 0] += time
        times = np.cumsum(gaps, axis=1)
        other = wd.mixed(z ^ np.uint64(0xD1B54A32D192ED03))
        inside = ((other & np.uint64(0xFFFFFFFF)).astype(np.float64) + 0.5) / (1 << 32) < room[:, None]
        slot = (row[:, None] * bins + ((other >> np.uint64(32)) % np.uint64(bins)).astype(np.int64))[inside]
        at, point = times[inside], z[inside]
        np.minimum.at(least, slot, at)
        won = at == least[slot]
        codes[slot[won]] = wd.mixed(point[won] + np.uint64(1)) | np.uint64(1)
        # later points of a cell can win no draw once all draws have earlier ones
        open_ = times[:, -1] < least.reshape(texts, bins).max(axis=1)[row]
        seed, room, row, time, step = seed[open_], room[open_], row[open_], times[open_, -1], step + k
    return codes.reshape(texts, bins)


def sketches(df: DataFrame, idf: np.ndarray, carry: list[str], id_col: str, text_col: str) -> DataFrame:
    """Per row: a row number, the digest of its words, band keys, short codes."""
    rows = packed(df, [c for c in carry if c != text_col], id=df[id_col], rid=F.monotonically_increasing_id(),
                  text=df[text_col].cast("string"))
    band_key = wd.GRAM_KEY[:ROWS]

    def run(batches):
        for batch in batches:
            n, parts = batch.num_rows, []
            for b in wd.blocks(batch.column("text")):
                counts = b.counts()
                text, shingle, weight = shingles(b, idf)
                codes = draws(text, shingle, weight, len(counts))
                keys = wd.mixed((codes.reshape(-1, BANDS, ROWS) * band_key).sum(axis=2)
                                + np.arange(1, BANDS + 1, dtype=np.uint64))
                place = wd.mixed((np.arange(len(b.hashes)) - np.repeat(b.bounds[:-1], counts)).astype(np.uint64))
                words = [_sums(wd.mixed(b.hashes + np.uint64(salt)) * (place | np.uint64(1)), b) for salt in (1, 2)]
                parts.append((counts, words[0], words[1], keys, _short(codes)))
            if n == 0:
                continue
            counts, d1, d2, keys, codes = (np.concatenate(x) for x in zip(*parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), batch.column("rid"), batch.column("text"),
                 pa.array(counts.astype(np.int64)),
                 pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                 _lists(keys.view(np.int64)), _lists(codes)],
                names=["row", "id", "rid", "text", "n_words", "d1", "d2", "keys", "codes"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, (
        f"row {kinds['row']}, id {kinds['id']}, rid bigint, text string, n_words bigint, "
        "d1 bigint, d2 bigint, keys array<bigint>, codes array<tinyint>"))


def _sums(values: np.ndarray, b: wd.Block) -> np.ndarray:
    """The sum of the values of each text's words, 0 without words."""
    out, some = np.zeros(len(b.counts()), np.uint64), b.counts() > 0
    if some.any():
        out[some] = np.add.reduceat(values, b.bounds[:-1][some])
    return out


def _short(codes: np.ndarray) -> np.ndarray:
    """One byte of each code: enough to count equal draws."""
    return ((codes >> np.uint64(8)) & np.uint64(0xFF)).astype(np.uint8).view(np.int8)


def _lists(table: np.ndarray) -> pa.Array:
    offsets = np.arange(0, table.size + 1, table.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(table).ravel()))


def similarities(pairs: DataFrame, idf: np.ndarray) -> DataFrame:
    """(u, v, text_u, text_v) -> (u, v, similarity): exact weighted Jaccard."""
    def bags(texts) -> list:
        out = []
        for b in wd.blocks(texts):
            text, shingle, weight = shingles(b, idf)
            cut = np.searchsorted(text, np.arange(len(b.counts()) + 1))
            out += [(shingle[i:j], weight[i:j]) for i, j in zip(cut[:-1], cut[1:])]
        return out

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                values = []
                for (s, w), (s2, w2) in zip(bags(part.column("text_u")), bags(part.column("text_v"))):
                    _, i, j = np.intersect1d(s, s2, assume_unique=True, return_indices=True)
                    shared = np.minimum(w[i], w2[j]).sum()
                    values.append(float(shared / max(w.sum() + w2.sum() - shared, 1e-300)))
                yield pa.RecordBatch.from_arrays([part.column("u"), part.column("v"), pa.array(values, pa.float64())],
                                                 names=["u", "v", "similarity"])

    return pairs.select("u", "v", "text_u", "text_v").mapInArrow(run, "u bigint, v bigint, similarity double")


def _texts_of(rids: DataFrame, texts: DataFrame) -> DataFrame:
    """(rid, text) of the given rows (one column); a bit table keeps the other
    texts out of the shuffle."""
    rids = written(rids.distinct())
    near = texts.select("rid", "text").filter(may_match(F.col("rid"), bit_table(rids)))
    return written(near.join(rids, near["rid"] == rids[rids.columns[0]], "left_semi"))


def _verified(pairs: DataFrame, texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """The pairs (u, v) with their similarity, read from whole texts."""
    pairs = written(pairs)
    own = _texts_of(pairs.select(F.col("u").alias("w")).union(pairs.select(F.col("v").alias("w"))), texts)
    left = own.select(F.col("rid").alias("ru"), F.col("text").alias("text_u"))
    right = own.select(F.col("rid").alias("rv"), F.col("text").alias("text_v"))
    both = pairs.join(left, F.col("u") == F.col("ru")).join(right, F.col("v") == F.col("rv"))
    return written(similarities(both, idf))


def _links(reps: DataFrame, texts: DataFrame, idf: np.ndarray, similar: float) -> DataFrame:
    """Roots (node, root) of the classes of representatives.

    1. The hub of a bucket is its most popular member: the one that shares
       most buckets with others, hence lies where copies are dense.  Every
       member is compared with the hub that it shares most buckets with.
    2. Buckets that then still hold several classes, those of two texts too,
       are swept: of their pairs between classes, each at its first common
       bucket, those that FINE draws leave possible are compared too.  So a
       pair of a bucket is in one class already, compared, or ruled out by its
       draws.  All common buckets of a pair between classes hold several
       classes, so the first one is among those swept.
    """
    member = reps.select("rid", F.explode(F.array_distinct("keys")).alias("key"))
    shared = member.groupBy(F.col("key").alias("k")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    inside = written(member.join(shared, F.col("key") == F.col("k")).select("rid", "key", "n"))
    popular = inside.groupBy(F.col("rid").alias("r")).agg(F.sum("n").alias("popular"))
    ranked = inside.join(popular, F.col("rid") == F.col("r"))
    hubs = ranked.groupBy(F.col("key").alias("k")).agg(
        F.max(F.struct("popular", (-F.col("rid")).alias("least"))).alias("hub"))
    nearest = (inside.join(hubs, F.col("key") == F.col("k"))
               .select(F.col("rid").alias("x"), (-F.col("hub.least")).alias("h")).filter("x <> h")
               .groupBy("x", "h").agg(F.count(F.lit(1)).alias("together"))
               .groupBy("x").agg(F.max(F.struct("together", (-F.col("h")).alias("least"))).alias("best")))
    stars = nearest.select("x", (-F.col("best.least")).alias("h")).select(
        F.greatest("x", "h").alias("u"), F.least("x", "h").alias("v")).distinct()
    checked = _verified(stars, texts, idf)
    found = checked.filter(F.col("similarity") >= similar).select("u", "v")
    roots = written(components(found))

    placed = inside.join(roots, F.col("rid") == F.col("node"), "left").select(
        "rid", "key", F.coalesce("root", "rid").alias("root"))
    several = placed.groupBy(F.col("key").alias("k")).agg(
        F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("k")
    unsettled = written(placed.join(several, F.col("key") == F.col("k")).select("rid", "key", "root"))
    fine = written(_fine_draws(_texts_of(unsettled.select("rid"), texts), idf)
                   .join(reps.select(F.col("rid").alias("r"), "keys", "codes"), F.col("rid") == F.col("r")).drop("rid"))
    open_ = written(unsettled.join(fine, F.col("rid") == F.col("r")).drop("r"))
    a, b = open_.alias("a"), open_.alias("b")
    first = F.array_min(F.array_intersect("a.keys", "b.keys")) == F.col("a.key")
    sweep = (a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.rid") > F.col("b.rid"))
                    & (F.col("a.root") != F.col("b.root")) & first
                    & _possible("codes", BINS, similar) & _possible("fine", FINE, similar))
             .select(F.col("a.rid").alias("u"), F.col("b.rid").alias("v"))
             .join(checked.select("u", "v"), ["u", "v"], "left_anti"))
    more = _verified(sweep, texts, idf).filter(F.col("similarity") >= similar).select("u", "v")
    return components(found.unionByName(more))


def _fine_draws(own: DataFrame, idf: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                codes = [draws(*shingles(b, idf), len(b.counts()), FINE) for b in wd.blocks(part.column("text"))]
                yield pa.RecordBatch.from_arrays([part.column("rid"), _lists(_short(np.concatenate(codes)))],
                                                 names=["rid", "fine"])

    return own.select("rid", "text").mapInArrow(run, "rid bigint, fine array<tinyint>")


def _possible(codes: str, bins: int, similar: float) -> Column:
    """The share of equal draws is no more than five deviations below ``similar``."""
    equal = F.aggregate(F.zip_with(f"a.{codes}", f"b.{codes}", lambda x, y: (x == y).cast("int")),
                        F.lit(0), lambda s, x: s + x)
    return equal >= bins * (similar - 5 * (similar * (1 - similar) / bins) ** 0.5)


def classes(df: DataFrame, carry: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text",
            similar: float = SIMILAR) -> DataFrame:
    """``carry`` columns (default: all) plus n_words, class_id, class_size, kept.

    Rows are of one class when links of similarity >= ``similar`` connect
    them; texts with equal words always are.  class_id is the least id of the
    class (null last), kept marks its row (of repeated ids the first).  Texts
    without words (null, empty, signs only) link to nothing: each is a class
    of its own.  One row comes out per row that goes in; an empty table stays
    empty.  Carried columns named like an added one are replaced.
    """
    carry = list(carry or df.columns)
    idf = word_weights(df, text_col)
    table = written(sketches(df, idf, carry, id_col, text_col))
    least = F.min(F.struct(F.col("id").isNull().alias("void"), F.col("id"), F.col("rid").alias("first"))).alias("least")
    reps = written(table.filter("n_words > 0").groupBy("d1", "d2", "n_words").agg(
        least, F.count(F.lit(1)).alias("copies"), F.first("keys").alias("keys"), F.first("codes").alias("codes")).withColumn("rid", F.col("least.first")))
    roots = _links(reps, table, idf, similar)
    rooted = reps.join(roots, F.col("rid") == F.col("node"), "left").select(
        "d1", "d2", "n_words", "least", "copies", F.coalesce("root", "rid").alias("root"))
    groups = rooted.groupBy(F.col("root").alias("g")).agg(
        F.min("least").alias("first"), F.sum("copies").alias("size"))
    by_words = rooted.join(groups, F.col("root") == F.col("g")).select(
        F.col("d1").alias("e1"), F.col("d2").alias("e2"), F.col("n_words").alias("e3"), "first", "size")
    narrow = [c for c in table.columns if c not in ("keys", "codes", *([] if text_col in carry else ["text"]))]
    joined = table.select(*narrow).join(
        by_words, (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")) & (F.col("n_words") == F.col("e3")), "left")
    added = {"n_words": F.col("n_words"), "class_id": F.when(F.col("first").isNull(), F.col("id")).otherwise(F.col("first.id")),
             "class_size": F.coalesce("size", F.lit(1)).cast("bigint"),
             "kept": F.coalesce(F.col("rid") == F.col("first.first"), F.lit(True))}
    if text_col in carry:
        added[text_col] = F.col("text")
    out = unpacked(joined, [c for c in carry if c != text_col], **added)
    own = {"n_words", "class_id", "class_size", "kept"}
    return out.select(*[c for c in carry if c.lower() not in own], *[n for n in added if n in own])
