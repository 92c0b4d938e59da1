"""Hashes of words and of runs of words, vectorised. Words are runs without white space, A-Z lower-cased."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words whose hashes a worker remembers before it starts anew.
MEMORY = 500_000
_M1, _M2, ODD = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _SHIFT)) * _M1
    x = (x ^ (x >> _SHIFT)) * _M2
    return x ^ (x >> _SHIFT)


class Hashes(dict):
    """word -> its hash; a new word is hashed once."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def word_hashes(text: str | None, known: Hashes) -> np.ndarray:
    if not text:
        return np.empty(0, np.uint64)
    if len(known) > MEMORY:
        known.clear()
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def run_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of `width` values along the last axis, order included."""
    out = np.zeros((*h.shape[:-1], max(0, h.shape[-1] - width + 1)), np.uint64)
    for k in range(width):
        out = out * ODD + h[..., k : k + out.shape[-1]]
    return mix(out)


def shingle_set(text: str | None, shingle: int, known: Hashes) -> np.ndarray:
    """The distinct shingles' hashes in order. Fewer words than a shingle are one; no words have the one hash 0."""
    h = word_hashes(text, known)
    return np.unique(run_hashes(h, min(shingle, len(h)))) if len(h) else np.zeros(1, np.uint64)


def sequence_hash(h: np.ndarray) -> int:
    """One hash of a whole sequence of hashes, as a signed long."""
    return int(np.array(xxhash.xxh64_intdigest(h.tobytes()), np.uint64).view(np.int64))
