"""Words and word shingles of many texts at once, as 64-bit numbers, in numpy.

A word is a run of bytes outside `[\\x20\\x09-\\x0D]`. Words and shingles are told apart by 64-bit hashes: two
different ones of a document pair agree with a chance of about 2^-60.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

STEP = 1 << 20
SPACES = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]
IS_WORD = np.ones(256, bool)
IS_WORD[SPACES] = False
U = np.uint64
BASE, ROLL = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)
EXACT = np.random.Generator(np.random.PCG64(20240601)).integers(1, 2**64 - 1, 256, np.uint64, endpoint=True)
EXACT[SPACES] = 0
FOLDED = EXACT.copy()
FOLDED[65:91] = EXACT[97:123]


def mixed(h: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def sorted_distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def word_bounds(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word and the byte after its last. bounds: those of the texts; no word crosses one."""
    inside = is_word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    return starts, np.flatnonzero(inside & (~after | edge[1:])) + 1


def hashes_between(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Hash of each word. values: a number for each byte, 0 for those that part words."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    first, last = starts[0], ends[-1]
    value = values[data[first:last]]
    runs = np.diff(starts, append=last)
    place = np.ones(last - first, np.int32)  # counts up from 0 in each word
    place[0] = 0
    place[starts[1:] - first] = 1 - runs[:-1]
    value *= powers(BASE, int(runs.max()))[np.cumsum(place, dtype=np.int32)]
    return mixed(np.add.reduceat(value, starts - first) + (ends - starts).astype(np.uint64) * ROLL)


def steps(data: np.ndarray, is_inner: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of about STEP bytes that end after a byte that is not an inner one."""
    at = 0
    while at < len(data):
        end = min(len(data), at + STEP)
        while end < len(data) and is_inner[data[end - 1]]:
            gap = np.flatnonzero(~is_inner[data[end : end + STEP]])
            end = min(len(data), end + (int(gap[0]) + 1 if len(gap) else STEP))
        yield at, end
        at = end


def bounds_in(bounds: np.ndarray, at: int, end: int) -> np.ndarray:
    """Those bounds that lie in a part, counted from its start."""
    return bounds[np.searchsorted(bounds, at) : np.searchsorted(bounds, end, "right")] - at


def word_runs(data: np.ndarray, bounds: np.ndarray, fold: bool = False) -> Iterator[tuple[np.ndarray, ...]]:
    """First bytes, ends and hashes of all words in order, a part at a time. fold: A-Z count as a-z."""
    for at, end in steps(data, IS_WORD):
        starts, ends = word_bounds(data[at:end], bounds_in(bounds, at, end))
        yield starts + at, ends + at, hashes_between(data[at:end], starts, ends, FOLDED if fold else EXACT)


def words(data: np.ndarray, bounds: np.ndarray, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the n + 1 bounds of the texts in them."""
    runs = list(word_runs(data, bounds, fold))
    if not runs:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    return np.concatenate([r[2] for r in runs]), np.searchsorted(np.concatenate([r[0] for r in runs]), bounds)


def shingles(word: np.ndarray, size: int) -> np.ndarray:
    """Hashes of a text's runs of `size` words; a shorter text is one run, an empty one has none."""
    width = min(size, len(word))
    if not width:
        return word
    out = np.zeros(len(word) - width + 1, np.uint64)
    for k in range(width):
        out = out * ROLL + word[k : len(word) - width + 1 + k]
    return mixed(out + U(width))
