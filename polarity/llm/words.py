"""Word and k-gram hashes of Arrow text batches, in numpy inside tasks.

A word is a run of digits, ASCII letters (A-Z lower-cased) and characters
beyond ASCII.  All words of a block of texts are hashed at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
BLOCK_TEXTS = 1 << 15


def _tables():
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    word = np.zeros(256, dtype=bool)
    word[48:58] = word[97:123] = word[128:] = True
    rng = np.random.default_rng(20240501)
    byte_key = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
    place_key = rng.integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)
    gram_key = rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
    return lower, word, byte_key, place_key, gram_key


LOWER, WORD, BYTE_KEY, PLACE_KEY, GRAM_KEY = _tables()


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


@dataclass
class Block:
    """Texts ``first`` .. of a batch: their words, one after the other."""
    first: int
    low: np.ndarray        # lower-cased bytes
    start: np.ndarray      # byte range of each word
    stop: np.ndarray
    hashes: np.ndarray     # uint64, one for each word
    bounds: np.ndarray     # words bounds[i]:bounds[i + 1] belong to text i
    raw: np.ndarray        # bytes as they came
    cuts: np.ndarray       # bytes cuts[i]:cuts[i + 1] belong to text i

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def words(self, begin: int, end: int) -> list[bytes]:
        return [self.low[a:b].tobytes() for a, b in zip(self.start[begin:end], self.stop[begin:end])]

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``k`` words from each word on, and whether they all
        belong to one text."""
        n = len(self.hashes)
        if n < k:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        g = np.full(n - k + 1, k, dtype=np.uint64)
        for j in range(k):
            g += self.hashes[j:n - k + 1 + j] * GRAM_KEY[j]
        inside = np.ones(n, dtype=bool)
        for j in range(1, k):
            last = self.bounds[1:] - j
            inside[last[last >= self.bounds[:-1]]] = False
        return mixed(g), inside[:n - k + 1]

    def text_of(self, words: np.ndarray) -> np.ndarray:
        """Index of the text that holds each word."""
        return np.searchsorted(self.bounds, words, side="right") - 1


def blocks(texts: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a batch into runs of whole texts of about ``block_bytes``.

    Nulls count as empty.  A longer text makes a block of its own.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    at, n = 0, len(texts)
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + block_bytes, side="right")) - 1)
        to = min(to, at + BLOCK_TEXTS)
        yield _block(at, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at])
        at = to


def _block(first: int, data: np.ndarray, offsets: np.ndarray) -> Block:
    low = LOWER[data]
    inside = WORD[low]
    edge = np.zeros(len(low) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1])) if len(low) else inside
    after = np.concatenate((inside[1:], [False])) if len(low) else inside
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    stop = np.flatnonzero(inside & (~after | edge[1:])) + 1
    bounds = np.searchsorted(start, offsets)
    if len(start) == 0:
        return Block(first, low, start, stop, np.zeros(0, np.uint64), bounds, data, offsets)
    size = stop - start
    head = np.cumsum(size) - size
    place = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(head, size)
    part = BYTE_KEY[low[inside]] * PLACE_KEY[place & 4095]
    return Block(first, low, start, stop, mixed(np.add.reduceat(part, head)), bounds, data, offsets)
