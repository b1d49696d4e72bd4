"""Vector code compression by exact integer products (operator 13).

Vectors become integers, are cut into equal parts, and each part is coded by
the nearest of a few codebook entries, which rounds of k-means refine.  All
distances are exact: integers are broken into limbs so short that a float64
matrix product of limbs stays below 2^53, and the products are recombined in
int64.  Tasks assign whole blocks and return sums per entry; the driver holds
the codebooks only (entries x vector length).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polarity.llm.salting import salted_join
from polarity.llm.tables import packed, unpacked, written

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6

Books = list[np.ndarray]        # one (entries x width) matrix a part


def limb_bits(width: int) -> int:
    """Bits of a limb: ``width`` products of two limbs sum to at most 2^53."""
    return (53 - max(width - 1, 0).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """``x`` = sum of limb i << (i * bits); all but the last are in [0, 2^bits),
    the last one carries the sign."""
    out = []
    while x.size and int(np.abs(x).max()) >= 1 << bits:
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return out + [x.astype(np.float64)]


def exact_products(x: np.ndarray, c: np.ndarray, bits: int | None = None) -> np.ndarray:
    """``x @ c.T`` of int64 matrices, exact whenever the result fits int64."""
    bits = bits or limb_bits(x.shape[1])
    out = np.zeros((len(x), len(c)), dtype=np.int64)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(limbs(c, bits)):
            out += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return out


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest row of ``c``, the first of equals; squared distance).

    Integers whose distances might not fit int64 are compared as Python's.
    """
    top = max([int(np.abs(m).max()) for m in (x, c) if m.size], default=0)
    if x.dtype != object and c.dtype != object and 4 * x.shape[1] * top * top < 1 << 62:
        score = (c * c).sum(axis=1)[None, :] - 2 * exact_products(x, c)
    else:
        x, c = x.astype(object), c.astype(object)
        score = (c * c).sum(axis=1)[None, :] - 2 * x.dot(c.T)
    best = np.argmin(score, axis=1)
    return best, (x * x).sum(axis=1) + score[np.arange(len(x)), best]


def cuts(length: int, parts: int) -> list[tuple[int, int]]:
    return [(p * length // parts, (p + 1) * length // parts) for p in range(parts)]


def matrix(vectors: pa.Array, length: int) -> np.ndarray:
    """Rows of whole numbers (held as doubles) as an integer matrix."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), length)
    if flat.size and float(np.abs(flat).max()) >= 2.0 ** 62:
        return np.array([[int(v) for v in row] for row in flat], dtype=object).reshape(len(vectors), length)
    return flat.astype(np.int64)


def whole_vectors(df: DataFrame, carry: list[str], id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """(row, id, label, vec): vectors without null or non-finite components, as
    floor(scale * x) held in doubles, which are exact for them."""
    def scaled(x):
        y = x.cast("double") * F.lit(float(scale))
        return F.when(F.abs(y) < F.lit(2.0 ** 52), F.floor(y).cast("double")).otherwise(y)

    def bad(x):
        return x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf")))

    sound = df.filter(F.col(vec_col).isNotNull() & ~F.exists(vec_col, bad))
    return packed(sound, carry, id=F.col(id_col), label=F.col(label_col), vec=F.transform(vec_col, scaled))


def _sums(books: Books, length: int):
    where = cuts(length, len(books))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [np.zeros(len(b), dtype=object) for b in books]
        total = [np.zeros(b.shape, dtype=object) for b in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = matrix(batch.column(0), length)
            for p, (a, b) in enumerate(where):
                part = whole[:, a:b]
                code, _ = nearest(part, books[p])
                for e in np.unique(code):
                    own = part[code == e]
                    count[p][e] += len(own)
                    total[p][e] += own.sum(axis=0)
        rows = [(p, e, at, Decimal(int(value)))
                for p in range(len(books)) for e in range(len(books[p])) if count[p][e]
                for at, value in [(-1, count[p][e]), *enumerate(total[p][e])]]
        part, entry, place, value = zip(*rows) if rows else ((),) * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(place, pa.int32()),
             pa.array(value, pa.decimal128(38, 0))], names=["part", "entry", "place", "value"])

    return run


def refined(vectors: DataFrame, books: Books, length: int) -> Books:
    """One round: every entry becomes the floored mean of the parts nearest to
    it; entries without parts stay.  Tasks send one row per component."""
    sums = (vectors.select("vec").mapInArrow(_sums(books, length), "part int, entry int, place int, value decimal(38,0)")
            .groupBy("part", "entry", "place").agg(F.sum("value").alias("value")).collect())
    value = {(r.part, r.entry, r.place): int(r.value) for r in sums}
    out = []
    for p, book in enumerate(books):
        rows = [[value[p, e, i] // value[p, e, -1] for i in range(book.shape[1])] if (p, e, -1) in value else list(book[e])
                for e in range(len(book))]
        out.append(_book(rows, book.shape[1]))
    return out


def _book(rows: list, width: int) -> np.ndarray:
    big = any(abs(int(v)) >= 1 << 62 for row in rows for v in row)
    return np.array(rows, dtype=object if big else np.int64).reshape(len(rows), width)


def _codes(books: Books, length: int):
    where = cuts(length, len(books))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = matrix(batch.column(2), length)
            found = [nearest(whole[:, a:b], books[p]) for p, (a, b) in enumerate(where)]
            code = np.stack([c for c, _ in found], axis=1) if found else np.zeros((len(whole), 0), int)
            error = [int(e) for e in sum(e for _, e in found)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(["".join(f"{c:02x}" for c in row) for row in code.tolist()]),
                 pa.array(error, pa.int64())], names=["row", "label", "code", "error"])

    return run


def compress(df: DataFrame, carry: list[str] | None = None, id_col: str = "vec_id", vec_col: str = "embedding",
             label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> DataFrame:
    """``carry`` columns (default: all) of the kept rows plus code, error,
    label_error and codebooks_sha256.

    Kept are vectors that are not null and hold no null or non-finite
    component.  Codebooks start as the parts of the first ``entries`` kept rows
    by id (null ids last, equal ids by vector); with fewer rows they are
    shorter.  Repeated rows count as often as they occur.  The first of these
    vectors sets the length; a vector of another length is returned with null
    code and error.  A length that ``parts`` doesn't divide is cut as evenly as
    can be; empty vectors get entry 0 and error 0.  label_error sums the errors
    of equal labels, null labels together.  An error beyond 2^63 raises.  An
    empty table gives an empty result.  Carried columns named like an added
    one are replaced.
    """
    if not 1 <= entries <= 256:
        raise ValueError("two hex digits name 1 to 256 entries")
    spark, carry = df.sparkSession, list(carry or df.columns)
    kept = written(whole_vectors(df, carry, id_col, vec_col, label_col, scale))
    seeds = kept.select("id", "vec").orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).collect()
    length = len(seeds[0].vec) if seeds else 0
    fit = kept.filter(F.size("vec") == length)
    start = [[int(v) for v in s.vec] for s in seeds if len(s.vec) == length]
    books = [_book([row[a:b] for row in start], b - a) for a, b in cuts(length, parts)]
    if seeds:
        for _ in range(rounds):
            books = refined(fit, books, length)
    said = ",".join(str(int(v)) for book in books for v in book.reshape(-1))
    digest = hashlib.sha256(said.encode()).hexdigest()
    out = f"row {kept.schema['row'].dataType.simpleString()}, label {kept.schema['label'].dataType.simpleString()}, code string, error long"
    coded = fit.select("row", "label", "vec").mapInArrow(_codes(books, length), out)
    odd = kept.filter(F.size("vec") != length).select("row", "label", F.lit(None).cast("string").alias("code"),
                                                      F.lit(None).cast("long").alias("error"))
    coded = written(coded.unionByName(odd))
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    return unpacked(salted_join(coded, by_label, ["label"], F.xxhash64("code", "error")), carry, code=F.col("code"),
                    error=F.col("error"), label_error=F.col("label_error"), codebooks_sha256=F.lit(digest))
