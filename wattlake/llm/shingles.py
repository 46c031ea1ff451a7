"""Sets of hashed word shingles, computed for many texts at once."""

from __future__ import annotations

import numpy as np

from wattlake.llm.common import mix, ragged
from wattlake.llm.repeats import Prefixes

WIDTH = 5
STRETCH = 2 << 20
U64 = np.uint64
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lowered) of all texts in order, and the number of words of each text."""
    sizes = np.array([len(text) + 1 for text in texts], np.int64)
    data = LOWER[np.frombuffer(b"".join(text + b" " for text in texts), np.uint8)]
    inside = np.concatenate([[False], ~IS_SPACE[data], [False]])
    edges = np.nonzero(inside[1:] != inside[:-1])[0]
    starts, ends = edges[::2], edges[1::2]
    hashes = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(starts, starts[at] + STRETCH)))
        base = starts[at]
        length = ends[at:stop] - starts[at:stop]
        hashes[at:stop] = mix(Prefixes(data[base:ends[stop - 1]]).of(starts[at:stop] - base, length) + length.astype(U64))
        at = stop
    return hashes, np.diff(np.searchsorted(starts, np.append(0, np.cumsum(sizes))))


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted, one text after another, and their number for each text.

    A text of fewer than ``WIDTH`` words has its whole sequence as its only shingle, one without words has none.
    """
    if not texts:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    words, counts = word_hashes(texts)
    first = np.cumsum(counts) - counts
    n = np.where(counts >= WIDTH, counts - WIDTH + 1, (counts > 0).astype(np.int64))
    at = ragged(first, n)
    owner = np.repeat(np.arange(len(texts)), n)
    value = np.zeros(len(at), U64)
    with np.errstate(over="ignore"):
        for j in range(WIDTH):
            there = j < counts[owner]
            value[there] += mix(words[at[there] + j] + U64(j + 1) * U64(0xD1B54A32D192ED03))
        value = mix(value + np.minimum(counts[owner], WIDTH).astype(U64))
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.bincount(owner[new], minlength=len(texts))


def set_numbers(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 63-bit number for each set; equal sets have equal numbers."""
    sums = np.zeros(len(counts), U64)
    full = np.nonzero(counts)[0]
    if len(full):
        starts = (np.cumsum(counts) - counts)[full]
        with np.errstate(over="ignore"):
            sums[full] = np.add.reduceat(mix(values ^ U64(0x5851F42D4C957F2D)), starts)
    return (mix(sums + counts.astype(U64)) >> U64(1)).astype(np.int64)
