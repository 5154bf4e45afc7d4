"""Words, shingles and their 64-bit hashes, for whole slices of text at once.

Words are runs of bytes other than space and 0x09-0x0D, after A-Z became a-z.
A word's hash is a polynomial over a random table, taken from running sums, so
that no word becomes a Python object; a bijective mixer follows.
"""

from __future__ import annotations

import hashlib

import numpy as np

SHINGLE_WORDS = 5
# Longer words are digested one by one; the rule goes by the word alone.
LONG_WORD = 4096
_WINDOW = 1 << 20

_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = _random.integers(1, 1 << 63, SHINGLE_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _power_table(base: int, size: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < size:
        table = np.full(max(size, _WINDOW + 1), base, np.uint64)
        table[0] = 1
        table = _powers[base] = np.multiply.accumulate(table)
    return table[:size]


def word_borders(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; none crosses the border of a text."""
    inside = ~SPACE[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    starting = inside & ~before
    starting[firsts] = inside[firsts]
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    ending = inside & ~after
    lasts = offsets[1:][offsets[1:] > 0] - 1
    ending[lasts] = inside[lasts]
    return np.flatnonzero(starting), np.flatnonzero(ending) + 1


def _hash_window(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power_table(_BASE, len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power_table(_INVERSE, len(data) + 1)[starts])


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and where each text's words begin and end."""
    data = LOWER[data]
    starts, ends = word_borders(data, offsets)
    return hashes_at(data, starts, ends), np.searchsorted(starts, offsets)


def hashes_at(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hashes of given ranges of bytes, ascending and apart, as they are; about `_WINDOW` bytes are worked on at a
    time, whatever the text's size."""
    hashes = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        base = starts[low]
        high = max(int(np.searchsorted(ends, base + _WINDOW, side="right")), low + 1)
        if high == low + 1 and ends[low] - base > _WINDOW:
            hashes[low] = 0  # set below
        else:
            window = slice(low, high)
            hashes[window] = _hash_window(data[base:ends[high - 1]], starts[window] - base, ends[window] - base)
        low = high
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        digest = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest()
        hashes[i] = int.from_bytes(digest, "little")
    return hashes


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of the runs of five words of one text, with repeats; a shorter
    text is one run, a text without words none."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    width = min(n, SHINGLE_WORDS)
    total = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        total += words[i:n - width + 1 + i] * _PLACE[i]
    return mix(total)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """The distinct shingles of one text, ascending."""
    return distinct(shingle_hashes(words))


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    return values[keep]


def distinct_counts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and how often each occurs."""
    values = np.sort(values)
    firsts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, int)
    return values[firsts], np.diff(np.append(firsts, len(values)))
