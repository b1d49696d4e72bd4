"""Terms of a row counted and weighed inside tasks (Arrow in, Arrow out).

A row comes as one string: the preprocessed text (``char_wb``), or its tokens
joined by blanks (``word``); both are made by Column expressions.  The character
n-grams of a text are integers (a few bits for each character of a small
alphabet), which numpy sorts and counts; where they don't fit, each distinct
word is cut once.  Spark deals out the rows and adds up the tasks' counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from polarity.session import ship_with_tasks

ship_with_tasks(__name__)

KEPT = 1 << 18              # distinct terms or words that a task holds at once
KEYS = 1 << 21              # n-grams that are sorted together
CELLS = 1 << 18             # cells of a batch that a task gives back
CHARS = 1 << 18             # characters whose n-grams are sorted together

COUNTS = "term string, df long, tf_total long, docs long"


def word_terms(tokens: list[str], lo: int, hi: int) -> list[str]:
    """Token n-grams."""
    out: list[str] = []
    for n in range(lo, hi + 1):
        out += tokens if n == 1 else map(" ".join, zip(*(tokens[k:] for k in range(n))))
    return out


def char_terms(word: str, lo: int, hi: int) -> list[str]:
    """Character n-grams of one word, padded by a space on each side."""
    padded, out = f" {word} ", []
    for n in range(lo, hi + 1):
        if n < len(padded):
            out += [padded[i:i + n] for i in range(len(padded) - n + 1)]
        elif n == max(lo, len(padded)):
            out.append(padded)
    return out


def _texts(batch: pa.RecordBatch, at: int) -> list[str]:
    return [t or "" for t in batch.column(at).to_pylist()]


class Alphabet:
    """Characters as numbers from 1 on (1: space), so that n-grams of up to
    ``hi`` characters are exact 62-bit keys.  ``letters`` None: it grows."""

    def __init__(self, hi: int, letters: set[str] | None = None):
        self.bits = 62 // hi
        self.most = (1 << self.bits) - 2            # the number above stands for any other character
        self.fixed, self.codes = letters is not None, [0]
        self.table = np.zeros(0x110000, np.int64)
        self.fits = self._add(np.array(sorted({32, *map(ord, letters or ())}), np.int64))
        if self.fixed:
            self.table[self.table == 0] = self.most + 1

    def _add(self, codes: np.ndarray) -> bool:
        if len(self.codes) + len(codes) - 1 > self.most:
            return False
        codes = np.concatenate([codes[codes == 32], codes[codes != 32]])
        self.table[codes] = np.arange(len(codes)) + len(self.codes)
        self.codes += codes.tolist()
        return True

    def numbers(self, text: str) -> np.ndarray | None:
        """None: the text has more characters than there are numbers left."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        out = self.table[codes]
        if not self.fixed and not out.all():
            if not self._add(np.unique(codes[out == 0]).astype(np.int64)):
                return None
            out = self.table[codes]
        return out

    def key(self, term: str) -> int:
        return sum(int(self.table[ord(c)]) << (self.bits * i) for i, c in enumerate(term))

    def keys(self, text: str, hi: int) -> np.ndarray | None:
        """Keys of the n-grams (3 to ``hi``) of a text's words: windows of the
        padded words, one after the other, that have no space inside."""
        a = self.numbers(f" {'  '.join(text.split())} ")
        if a is None:
            return None
        inside, key, good, out = a != 1, a, np.ones(len(a), bool), [np.empty(0, np.int64)]
        for n in range(2, min(hi, len(a)) + 1):
            key, good = key[:-1] | (a[n - 1:] << (self.bits * (n - 1))), good[:-1]
            if n > 2:
                good = good & inside[n - 2:-1]
                out.append(key[good])
        return np.concatenate(out)

    def terms(self, keys: np.ndarray, hi: int) -> tuple[list[str], np.ndarray]:
        """(terms, order of their keys)"""
        codes, mask, out, order = np.array(self.codes, np.uint32), (1 << self.bits) - 1, [], []
        for n in range(3, hi + 1):
            own = np.flatnonzero((keys >> (self.bits * (n - 1)) > 0) & (keys >> (self.bits * n) == 0))
            cells = codes[(keys[own, None] >> (self.bits * np.arange(n))) & mask]
            said = cells.tobytes().decode("utf-32-le")
            out += [said[i:i + n] for i in range(0, len(said), n)]
            order.append(own)
        return out, np.concatenate(order)


def _keyed(hi: int) -> Callable[[Iterator[str]], Iterator[pa.RecordBatch]]:
    """Counts of the character n-grams of 3 to ``hi`` characters."""

    def run(texts: Iterator[str]) -> Iterator[pa.RecordBatch]:
        letters, parts, held = Alphabet(hi), [], 0

        def merge():
            nonlocal parts, held
            if parts:
                key, df, tf = (np.concatenate(x) for x in zip(*parts))
                order = np.argsort(key)
                key = key[order]
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
                parts = [(key[first], np.add.reduceat(df[order], first), np.add.reduceat(tf[order], first))] if len(key) else []
            held = 0

        def sums() -> Iterator[pa.RecordBatch]:
            nonlocal letters, parts
            merge()
            for key, df, tf in parts:
                terms, order = letters.terms(key, hi)
                yield _rows(terms, df[order], tf[order], np.zeros(len(order), np.int64))
            letters, parts = Alphabet(hi), []

        for text in texts:
            keys = letters.keys(text, hi)
            if keys is None:
                yield from sums()
                keys = letters.keys(text, hi)
            if keys is None:                        # more characters than numbers in one text
                own = Counter(g for w in text.split() for g in char_terms(w, 3, hi))
                yield _rows(list(own), [1] * len(own), list(own.values()), [0] * len(own))
                continue
            key, tf = np.unique(keys, return_counts=True)
            parts.append((key, np.ones(len(key), np.int64), tf))
            held += len(key)
            if held > KEYS:
                merge()
                if len(parts[0][0]) > KEPT * 4:
                    yield from sums()
        yield from sums()

    return run


class Places:
    """Places of the character n-grams of a text's words, kept by word.

    Without ``index`` every new n-gram gets the next place."""

    def __init__(self, lo: int, hi: int, index: dict[str, int] | None = None):
        self.range, self.fixed = (lo, hi), index is not None
        self.index, self.known = index if self.fixed else {}, {}

    def of(self, word: str) -> np.ndarray:
        found = self.known.get(word)
        if found is None:
            grams, at = char_terms(word, *self.range), self.index
            found = [at[g] for g in grams if g in at] if self.fixed else [at.setdefault(g, len(at)) for g in grams]
            found = self.known[word] = np.array(found, np.int64)
            if self.fixed and len(self.known) > KEPT:
                self.known = {}
        return found


def _rows(terms: list, df, tf, docs) -> pa.RecordBatch:
    long = pa.int64()
    return pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(df, long), pa.array(tf, long), pa.array(docs, long)],
                                      ["term", "df", "tf_total", "docs"])


def counting(analyzer: str, lo: int, hi: int) -> Callable:
    """(text) -> a task's sums of COUNTS; a row without a term counts its rows."""

    def words(texts: Iterator[str]) -> Iterator[pa.RecordBatch]:
        df, tf = Counter(), Counter()
        for text in texts:
            terms = word_terms(text.split(), lo, hi)
            df.update(set(terms))
            tf.update(terms)
            if len(df) > KEPT:
                yield _rows(list(df), list(df.values()), [tf[t] for t in df], [0] * len(df))
                df, tf = Counter(), Counter()
        yield _rows(list(df), list(df.values()), [tf[t] for t in df], [0] * len(df))

    def chars(texts: Iterator[str]) -> Iterator[pa.RecordBatch]:
        def sums() -> pa.RecordBatch:
            n, own = len(places.index), [places.known[w] for w in seen]
            times = np.repeat(np.fromiter(seen.values(), np.float64, len(seen)), [len(x) for x in own])
            tf = np.bincount(np.concatenate([*own, np.empty(0, np.int64)]), times, n).astype(np.int64)
            return _rows(list(places.index), df[:n], tf, np.zeros(n, np.int64))

        places, seen, df = Places(lo, hi), Counter(), np.zeros(KEPT, np.int64)
        for text in texts:
            own = text.split()
            seen.update(own)
            found = [places.of(w) for w in set(own)]
            if len(places.index) > len(df):
                df = np.concatenate([df, np.zeros(len(places.index), np.int64)])
            if found:
                df[np.unique(np.concatenate(found))] += 1
            if len(places.index) > KEPT or len(seen) > KEPT:
                yield sums()
                places, seen, df = Places(lo, hi), Counter(), np.zeros(KEPT, np.int64)
        yield sums()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = 0

        def texts() -> Iterator[str]:
            nonlocal docs
            for batch in batches:
                docs += batch.num_rows
                yield from _texts(batch, 0)

        yield from (words if analyzer == "word" else _keyed(hi) if lo == 3 else chars)(texts())
        yield _rows([None], [0], [0], [docs])

    return run


def _frequencies(analyzer: str, lo: int, hi: int, terms: list[str]) -> Callable:
    """text -> (places of its known terms; how often each occurs)."""
    if not terms:
        return lambda text: (np.empty(0, np.int64), np.empty(0))
    index = {t: i for i, t in enumerate(terms)}
    letters = Alphabet(hi, {c for t in terms for c in t}) if analyzer != "word" and lo == 3 else None
    if letters is not None and letters.fits:
        known = np.array([letters.key(t) for t in terms], np.int64)
        order = np.argsort(known)
        known = known[order]

        def of(text: str):
            key, tf = np.unique(letters.keys(text, hi), return_counts=True)
            at = np.minimum(np.searchsorted(known, key), len(known) - 1)
            hit = known[at] == key
            return order[at[hit]], tf[hit].astype(np.float64)
        return of
    if analyzer == "word":
        def of(text: str):
            own = Counter(index[t] for t in word_terms(text.split(), lo, hi) if t in index)
            at = np.fromiter(own, np.int64, len(own))
            order = np.argsort(at)
            return at[order], np.fromiter(own.values(), np.float64, len(own))[order]
        return of
    places, total = Places(lo, hi, index), np.zeros(len(terms))

    def of(text: str):
        own = Counter(text.split())
        found = [places.of(w) for w in own]
        if not found:
            return np.empty(0, np.int64), np.empty(0)
        each = np.concatenate(found)
        np.add.at(total, each, np.repeat(np.fromiter(own.values(), np.float64, len(own)), [len(x) for x in found]))
        at = np.unique(each)
        tf = total[at]
        total[at] = 0.0
        return at, tf
    return of


def _cells(ids: pa.Array, rows: list[int] | np.ndarray, terms: pa.Array, values: pa.Array, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids.take(pa.array(rows, pa.int64())), terms, values], names)


def weighing(analyzer: str, lo: int, hi: int, terms: list[str], idf: list[float], names: list[str]) -> Callable:
    """(row, text) -> (row, term, weight of length 1) for the terms of a vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, idfs, said = _frequencies(analyzer, lo, hi, terms), np.array(idf), pa.array(terms, pa.string())

        def made(ids, rows, at, weights):
            where = np.repeat(np.array(rows, np.int64), [len(x) for x in at])
            return _cells(ids, where, said.take(pa.array(np.concatenate(at))), pa.array(np.concatenate(weights)), names)

        for batch in batches:
            rows, at, weights, n = [], [], [], 0
            for row, text in enumerate(_texts(batch, 1)):
                places, tf = of(text)
                if len(places):
                    w = tf * idfs[places]
                    rows.append(row), at.append(places), weights.append(w / np.sqrt(w @ w))
                    n += len(places)
                if n > CELLS:
                    yield made(batch.column(0), rows, at, weights)
                    rows, at, weights, n = [], [], [], 0
            if n:
                yield made(batch.column(0), rows, at, weights)

    return run


def _strings(cells: list[np.ndarray]) -> pa.StringArray:
    """The rows of matrices of code points as strings."""
    sizes = [(1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)).sum(1) for c in cells]
    ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
    said = b"".join(c.astype("<u4").tobytes().decode("utf-32-le").encode() for c in cells)
    return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(said))


def listing(lo: int, hi: int, names: list[str]) -> Callable:
    """(row, text) -> (row, n-gram of ``lo`` = 3 to ``hi`` characters, how often).

    Texts are taken together: an n-gram's key and its row make one number, so
    one sort counts all, and each distinct n-gram is spelled once."""
    assert lo == 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(0x110000, np.int64)

        def counted(ids: pa.Array, begin: int, padded: list[str]) -> Iterator[pa.RecordBatch]:
            codes = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32)
            seen = np.zeros(len(table), bool)
            seen[codes] = True
            seen[32] = False
            letters = np.concatenate([[0, 32], np.flatnonzero(seen)])       # 0: no character
            bits, rows = int(len(letters) - 1).bit_length(), (len(padded) - 1).bit_length()
            if bits * hi + rows > 63:
                if len(padded) > 1:
                    half = len(padded) // 2
                    yield from counted(ids, begin, padded[:half])
                    yield from counted(ids, begin + half, padded[half:])
                    return
                own = Counter(g for w in padded[0].split() for g in char_terms(w, lo, hi))
                yield _cells(ids, [begin] * len(own), pa.array(list(own), pa.string()), pa.array(list(own.values()), pa.int64()), names)
                return
            table[letters] = np.arange(len(letters))
            a, row = table[codes], np.repeat(np.arange(len(padded)), [len(p) for p in padded])
            # windows without a space inside: none reaches into the next word or text, which two spaces part
            inside, key, good, parts = a != 1, a, np.ones(len(a), bool), []
            for n in range(2, min(hi, len(a)) + 1):
                key, good = key[:-1] | (a[n - 1:] << (bits * (n - 1))), good[:-1]
                if n > 2:
                    good = good & inside[n - 2:-1]
                    at = np.flatnonzero(good)
                    parts.append((key[at] << rows) | row[at])
            cells = np.concatenate([np.empty(0, np.int64), *parts])
            del a, row, inside, key, good, parts
            if not len(cells):
                return
            cells.sort()
            first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
            tf, cells = np.diff(np.append(first, len(cells))), cells[first]
            row, key = cells & ((1 << rows) - 1), cells >> rows
            new = np.concatenate([[True], key[1:] != key[:-1]])
            known, term = key[new], np.cumsum(new) - 1
            # shorter n-grams have smaller keys
            ends = np.searchsorted(known, [1 << (bits * n) for n in range(lo - 1, hi + 1)])
            said = _strings([letters[(known[i:j, None] >> (bits * np.arange(n))) & ((1 << bits) - 1)] for n, i, j in zip(range(lo, hi + 1), ends[:-1], ends[1:])])
            for i in range(0, len(cells), CELLS):
                j = i + CELLS
                yield _cells(ids, row[i:j] + begin, said.take(pa.array(term[i:j])), pa.array(tf[i:j]), names)

        for batch in batches:
            ids, begin, padded, n = batch.column(0), 0, [], 0
            for at, text in enumerate(_texts(batch, 1)):
                padded.append(f" {'  '.join(text.split())} ")
                n += len(padded[-1])
                if n > CHARS:
                    yield from counted(ids, begin, padded)
                    begin, padded, n = at + 1, [], 0
            if padded:
                yield from counted(ids, begin, padded)

    return run
