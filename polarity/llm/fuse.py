"""Static three-wise binary fuse filters over 64-bit keys (numpy).

A key maps to one slot in each of three neighbouring segments; the XOR of the
three one-byte slots equals the key's fingerprint.  About 9 bits a key, no
false negatives, false positives near 1 in 256.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

from polarity.llm.words import mixed


@dataclass
class Fuse:
    seed: int
    segment: int          # slots of a segment, a power of two
    starts: int           # slots in which a key's first place may lie
    slots: np.ndarray     # uint8

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mixed(keys + np.uint64(self.seed) * np.uint64(0x9E3779B97F4A7C15))
        low = np.uint64(self.segment - 1)
        first = ((h >> np.uint64(32)) * np.uint64(self.starts)) >> np.uint64(32)
        second = (first + np.uint64(self.segment)) ^ ((h >> np.uint64(14)) & low)
        third = (first + np.uint64(2 * self.segment)) ^ (h & low)
        print_ = (h ^ (h >> np.uint64(56)) ^ (h >> np.uint64(41))).astype(np.uint8)
        return np.stack([first, second, third]).astype(np.int64), print_

    def holds(self, keys: np.ndarray) -> np.ndarray:
        if len(self.slots) == 0:
            return np.zeros(len(keys), dtype=bool)
        p, print_ = self.places(keys)
        return (self.slots[p[0]] ^ self.slots[p[1]] ^ self.slots[p[2]]) == print_


def build(keys: np.ndarray) -> Fuse:
    """The filter of a set of uint64 keys (repeats don't matter)."""
    keys = np.unique(keys.astype(np.uint64))
    n = len(keys)
    if n == 0:
        return Fuse(0, 4, 4, np.zeros(0, np.uint8))
    segment = 1 << max(2, min(18, int(math.log(n + 1) / math.log(3.33) + 2.25)))
    room = n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2))) + 32
    starts = max(1, math.ceil(room / segment) - 2) * segment
    seed = 0
    while True:
        fuse = Fuse(seed, segment, starts, np.zeros(starts + 2 * segment, np.uint8))
        places, prints = fuse.places(keys)
        layers = _peel(places, len(fuse.slots))
        if layers is not None:
            break
        seed += 1
        if seed % 20 == 0:      # unlucky sizes get more room
            starts += segment
    for key, slot in reversed(layers):
        p = places[:, key]
        fuse.slots[slot] = 0
        fuse.slots[slot] = prints[key] ^ fuse.slots[p[0]] ^ fuse.slots[p[1]] ^ fuse.slots[p[2]]
    return fuse


def _peel(places: np.ndarray, size: int):
    """Layers of (keys, slots): each key owns its slot once the layers before
    are gone.  None when some keys hold each other."""
    n = places.shape[1]
    users = np.bincount(places.ravel(), minlength=size)
    who = np.bincount(places.ravel(), weights=np.tile(np.arange(n), 3), minlength=size).astype(np.int64)
    layers, left, free = [], n, np.flatnonzero(users == 1)
    while len(free):
        key, at = np.unique(who[free], return_index=True)
        layers.append((key, free[at]))
        left -= len(key)
        touched = places[:, key].ravel()
        np.subtract.at(users, touched, 1)
        np.subtract.at(who, touched, np.tile(key, 3))
        touched = np.unique(touched)
        free = touched[users[touched] == 1]
    return layers if left == 0 else None
