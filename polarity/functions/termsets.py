"""Weights of all terms of a corpus without a shuffle of its (row, term) pairs.

Rows are dealt out in blocks.  A block sends each of its distinct terms once, as
numbers into a list of its words, compressed (``asking``); one task per bucket of
terms adds up the blocks' document frequencies and sends back the totals, without
the terms (``answering``); the block is cut again in the same order and weighed
(``weighed``).  Counts are exact: terms are compared by their words.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from polarity.functions.grams import CELLS, char_terms, word_terms
from polarity.session import ship_with_tasks

ship_with_tasks(__name__)

ASKED = "_place int, _block int, _bucket int, _use int, _units binary, _terms binary"
ANSWERED = "_block int, _bucket int, _totals binary"
COUNTS, ASKS = 1, 2         # what a block's terms are sent for


def spark_places(n: int) -> list[int]:
    """Integers that Spark's hash partitioning deals into the partitions 0 to n - 1, one each."""
    u32, found, at = np.uint32, np.full(n, -1, np.int64), 0
    rotl = lambda x, r: (x << u32(r)) | (x >> u32(32 - r))
    while (found < 0).any():
        values = np.arange(at, at + 16 * n, dtype=np.int64)
        k = rotl(values.astype(u32) * u32(0xCC9E2D51), 15) * u32(0x1B873593)
        h = (rotl(u32(42) ^ k, 13) * u32(5) + u32(0xE6546B64)) ^ u32(4)
        h = (h ^ (h >> u32(16))) * u32(0x85EBCA6B)
        h = (h ^ (h >> u32(13))) * u32(0xC2B2AE35)
        goes, first = np.unique((h ^ (h >> u32(16))).astype(np.int32) % np.int64(n), return_index=True)
        new = found[goes] < 0
        found[goes[new]] = values[first[new]]
        at += 16 * n
    return found.tolist()


def _packed(*numbers: np.ndarray) -> bytes:
    """Arrays of numbers from 0 on, each in the smallest type that holds it."""
    parts = []
    for x in numbers:
        kind = np.min_scalar_type(int(x.max())) if len(x) else np.dtype(np.uint8)
        parts.append(struct.pack("<BI", kind.itemsize, len(x)) + x.astype(kind).tobytes())
    whole = b"".join(parts)
    return struct.pack("<I", len(whole)) + pa.compress(whole, codec="zstd", asbytes=True)


def _unpacked(packed: bytes) -> list[np.ndarray]:
    whole, at, out = pa.decompress(packed[4:], struct.unpack_from("<I", packed)[0], codec="zstd", asbytes=True), 0, []
    while at < len(whole):
        size, n = struct.unpack_from("<BI", whole, at)
        out.append(np.frombuffer(whole, f"u{size}", n, at + 5).astype(np.int64))
        at += 5 + size * n
    return out


def _packed_units(units: pa.StringArray) -> bytes:
    _, ends, said = units.buffers()
    ends = np.frombuffer(ends, np.int32)[units.offset:units.offset + len(units) + 1]
    return _packed(np.diff(ends), np.frombuffer(said or b"", np.uint8)[ends[0]:ends[-1]])


def _unpacked_units(packed: bytes) -> pa.StringArray:
    sizes, said = _unpacked(packed)
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(said.astype(np.uint8)))


@dataclass
class Block:
    """The terms of some rows: ``first`` and ``second`` number a term's words from 1 on
    (second 0: a term of one word); a cell is a (term, row) with its frequency."""

    units: pa.StringArray
    first: np.ndarray
    second: np.ndarray
    df: np.ndarray
    cell_term: np.ndarray
    cell_doc: np.ndarray
    tf: np.ndarray
    ids: pa.Array

    def buckets(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(terms in the order of their buckets, where each bucket begins)"""
        own = np.array([0, *(zlib.crc32(u.encode()) for u in self.units.to_pylist())], np.uint64)
        x = own[self.first] * np.uint64(0x9E3779B97F4A7C15) + own[self.second] * np.uint64(0xC2B2AE3D27D4EB4F)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        goes = ((x ^ (x >> np.uint64(32))) % np.uint64(n)).astype(np.uint16 if n <= 1 << 16 else np.uint32)
        return np.argsort(goes, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(goes, minlength=n))])

    def terms(self) -> pa.StringArray:
        second = self.units.take(pa.array(self.second - 1, mask=self.second == 0))
        return pc.binary_join_element_wise(self.units.take(pa.array(self.first - 1)), second, " ", null_handling="skip")


def _flat(texts: pa.Array, analyzer: str, lo: int, hi: int) -> tuple[pa.Array, np.ndarray, bool]:
    """(units, their rows, whether two in a row are a term too)"""
    if analyzer == "word" and hi <= 2:
        lists = pc.split_pattern(texts, " ")
        flat, row = lists.flatten(), pc.list_parent_indices(lists)
        said = pc.not_equal(flat, "")
        return flat.filter(said), row.filter(said).to_numpy(), hi == 2
    cut = [word_terms(t.split(), lo, hi) if analyzer == "word" else [g for w in t.split() for g in char_terms(w, lo, hi)] for t in texts.to_pylist()]
    return pa.array([t for own in cut for t in own], pa.string()), np.repeat(np.arange(len(cut)), [len(own) for own in cut]), False


def block(ids: pa.Array, texts: pa.Array, analyzer: str, lo: int, hi: int) -> Block:
    """Rows of one id count as one row.  The order of the terms does not depend on that of the rows."""
    pa.default_memory_pool().release_unused()       # of the block before
    flat, row, pairs = _flat(pc.fill_null(texts, ""), analyzer, lo, hi)
    coded, docs = flat.dictionary_encode(), ids.dictionary_encode(null_encoding="encode")
    del flat
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    word, doc, units = rank[coded.indices.to_numpy()], docs.indices.to_numpy()[row], coded.dictionary.take(pa.array(order))
    base, many, names = len(order) + 1, max(1, len(docs.dictionary)), None
    next_to = np.flatnonzero(row[1:] == row[:-1]) if pairs else np.empty(0, np.int64)
    ones = 0 if pairs and lo == 2 else len(word)
    cells = np.empty(ones + len(next_to), np.int64)
    cells[:ones] = word[:ones] * base
    cells[ones:] = word[next_to] * base + word[next_to + 1]
    if base * base * many >= 1 << 63:
        names, cells = np.unique(cells, return_inverse=True)
    cells *= many
    cells[:ones] += doc[:ones]
    cells[ones:] += doc[next_to]
    del coded, row, word, doc, next_to
    cells.sort()
    at = np.flatnonzero(_new(cells))
    tf = np.diff(np.append(at, len(cells))).astype(np.int32)
    cells = cells[at]
    keys = cells // many
    whose = (cells - keys * many).astype(np.int32)
    new = np.flatnonzero(_new(keys))
    df, keys = np.diff(np.append(new, len(keys))), keys[new]
    first, second = np.divmod(keys if names is None else names[keys], base)
    return Block(units, first, second, df, np.repeat(np.arange(len(df), dtype=np.int32), df), whose, tf, docs.dictionary)


def _new(x: np.ndarray) -> np.ndarray:
    """Where a sorted array has another value than before."""
    return np.concatenate([[True], x[1:] != x[:-1]])[:len(x)]


def _whole(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def asking(analyzer: str, lo: int, hi: int, places: list[int], use: int) -> Callable:
    """(row, block, text) -> ASKED: each block's distinct terms, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        del held
        names = pc.unique(rows.column(1)).to_pylist()
        for name in names:
            own = rows if len(names) == 1 else rows.filter(pc.equal(rows.column(1), name))
            b = block(_whole(own.column(0)), _whole(own.column(2)), analyzer, lo, hi)
            order, begins = b.buckets(len(places))
            out, number = [], np.zeros(len(b.units) + 1, np.int64)
            for k in np.flatnonzero(np.diff(begins)).tolist():
                at = order[begins[k]:begins[k + 1]]
                first, second, said = b.first[at], b.second[at], np.zeros(len(number), bool)
                said[first] = said[second] = True
                said[0] = False
                used = np.flatnonzero(said)
                number[used] = np.arange(1, len(used) + 1)
                numbers = _packed(np.diff(number[first], prepend=1), number[second], b.df[at])
                out.append((places[k], name, k, use, _packed_units(b.units.take(pa.array(used - 1))), numbers))
            if out:
                kinds = [pa.int32()] * 4 + [pa.binary()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], ["_place", "_block", "_bucket", "_use", "_units", "_terms"])

    return run


def answering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """ASKED rows -> ANSWERED: document frequencies over all blocks, in the order of a block's terms."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held)
    for bucket in pc.unique(rows.column("_bucket")).to_pylist():
        own = rows.filter(pc.equal(rows.column("_bucket"), bucket))
        use, units = own.column("_use").to_numpy(), [_unpacked_units(u) for u in own.column("_units").to_pylist()]
        coded = pa.concat_arrays(units).dictionary_encode()
        base, begin, keys, dfs = len(coded.dictionary) + 1, 0, [], []
        names = coded.indices.to_numpy().astype(np.int64) + 1
        for said, numbers, u in zip(units, own.column("_terms").to_pylist(), use):
            first, second, df = _unpacked(numbers)
            name = np.concatenate([[0], names[begin:begin + len(said)]])
            begin += len(said)
            keys.append(name[np.cumsum(first) + 1] * base + name[second])
            dfs.append(df if u & COUNTS else np.zeros(len(df), np.int64))
        _, same = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(same, np.concatenate(dfs)).astype(np.int64)[same]
        ends = np.cumsum([len(k) for k in keys])
        sent = [(b, bucket, _packed(totals[end - len(k):end])) for b, k, end, u in zip(own.column("_block").to_pylist(), keys, ends, use) if u & ASKS]
        if sent:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*sent), (pa.int32(), pa.int32(), pa.binary()))], ["_block", "_bucket", "_totals"])


def rounded(x: np.ndarray, digits: int) -> np.ndarray:
    """Numbers from 0 to 1 as Spark's ``round`` gives them: half up, by their shortest decimals."""
    scale = 10.0 ** digits
    scaled = x * scale
    whole = np.floor(scaled)
    over = scaled - whole
    whole += over >= 0.5
    for i in np.flatnonzero(np.abs(over - 0.5) < 1e-6).tolist():
        whole[i] = float(Decimal(repr(float(x[i]))).scaleb(digits).quantize(Decimal(1), ROUND_HALF_UP))
    return whole / scale


def weighed(analyzer: str, lo: int, hi: int, buckets: int, limits: tuple[float, float], n_docs: int, names: list[str],
            digits: int | None = None) -> Callable:
    """A block's rows (row, block, text) and the answers to it -> (row, term, weight of length 1)."""

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        schema = pa.schema([(names[0], rows.schema.field(0).type), (names[1], pa.string()), (names[2], pa.float64())])
        if not rows.num_rows:
            return schema.empty_table()
        b = block(_whole(rows.column(0)), _whole(rows.column(2)), analyzer, lo, hi)
        order, begins = b.buckets(buckets)
        totals = np.full(len(order), -1, np.int64)
        for bucket, packed in zip(answers.column("_bucket").to_pylist(), answers.column("_totals").to_pylist()):
            totals[order[begins[bucket]:begins[bucket + 1]]] = _unpacked(packed)[0]
        if (totals < 0).any():
            raise RuntimeError("a block of rows changed between two readings of the input")
        idf = np.log((1.0 + n_docs) / (1.0 + totals)) + 1.0
        idf[(totals < max(1, limits[0])) | (totals > limits[1])] = np.nan
        w = b.tf * idf[b.cell_term]
        term, doc, kept = b.cell_term, b.cell_doc, ~np.isnan(w)
        if not kept.all():
            term, doc, w = term[kept], doc[kept], w[kept]
        norm, said, out = np.sqrt(np.bincount(doc, w * w, len(b.ids))), b.terms(), []
        for at in range(0, len(w), CELLS):
            end = at + CELLS
            own = w[at:end] / norm[doc[at:end]]
            out.append(pa.RecordBatch.from_arrays([b.ids.take(pa.array(doc[at:end])), said.take(pa.array(term[at:end])),
                                                   pa.array(own if digits is None else rounded(own, digits))], schema=schema))
        return pa.Table.from_batches(out, schema)

    return run
