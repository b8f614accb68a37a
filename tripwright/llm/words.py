"""Words of many texts at once: their places and hashes, from arrays over the joined bytes."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
MODULUS = 1 << 64

_letters = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
_tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def letter_values(lower: bool = False) -> np.ndarray:
    """A random value for each byte; A-Z can have those of a-z."""
    values = _letters.copy()
    if lower:
        values[65:91] = values[97:123]
    return values


def power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_tables[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for k, base in enumerate((BASE, pow(BASE, -1, MODULUS))):
            out, step = np.ones(1, np.uint64), base
            while len(out) < size:
                out = np.concatenate([out, out * np.uint64(step)])
                step = step * step % MODULUS
            _tables[k] = out
    return _tables


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the first word of each text (one more than texts)."""
    inside = ~is_space(data)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]  # a text's end ends a word
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word."""
    powers, inverse = power_tables(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(letter_values(lower)[data] * powers[: len(data)], out=prefix[1:])
    return mixed((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` words."""
    n = max(0, len(words) - length + 1)
    out = np.full(n, length, np.uint64)
    for k in range(length):
        out = mixed(out * np.uint64(3) + words[k : k + n])
    return out


#: Windows whose places are found at once; a place inside them fits in 20 bits.
PLACES = 1 << 19


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value, the first of equal ones, in each window of ``width``, which is at most ``PLACES``.

    The upper 44 bits of values decide. Places are counted from the first of some windows, so that they ascend in all.
    """
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    return np.concatenate([at + least_inside(values[at : min(at + PLACES, n) + width - 1], width) for at in range(0, n, PLACES)])


def least_inside(values: np.ndarray, width: int) -> np.ndarray:
    """``least_places`` of few enough windows, by doubling steps."""
    n = len(values) - width + 1
    best = (values >> np.uint64(20) << np.uint64(20)) | np.arange(len(values), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    if span < width:
        best = np.minimum(best[:n], best[width - span : width - span + n])
    return (best[:n] & np.uint64((1 << 20) - 1)).astype(np.int64)
