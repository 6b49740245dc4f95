"""Word and shingle hashes of many texts at once, on the bytes of an Arrow column."""

from __future__ import annotations

import numpy as np

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def mix(x: np.ndarray) -> np.ndarray:
    """The SplitMix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def place_factors(size: int) -> np.ndarray:
    """An odd factor for each byte of a word."""
    return mix(np.arange(1, size + 1, dtype=np.uint64) * _GOLDEN) | np.uint64(1)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, and the row it is in.

    A word hash is a sum of byte times factor of its place, so equal words are equal and others
    differ but for a chance of 2^-64 or so.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    opening = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[opening] = solid[opening]
    at = np.flatnonzero(solid)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    begins = np.flatnonzero(first)
    runs = np.flatnonzero(first[at])
    place = at - np.repeat(begins, np.diff(np.append(runs, len(at))))
    letters = data[at]
    letters = letters + (((letters >= 65) & (letters <= 90)).astype(np.uint8) << 5)
    values = (letters.astype(np.uint64) + np.uint64(1)) * place_factors(int(place.max()) + 1)[place]
    hashes = mix(np.add.reduceat(values, runs))
    return hashes, np.searchsorted(offsets, begins, side="right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 3) -> list[np.ndarray]:
    """Per row, the sorted distinct hashes of its runs of ``width`` words, as signed integers.

    A row of fewer words, but not none, has one hash of all of them; a row without words has none.
    """
    words, rows = word_hashes(data, offsets)
    count = len(offsets) - 1
    begin = np.searchsorted(rows, np.arange(count + 1))
    if len(words) >= width:
        last = len(words) - width + 1
        joined = sum((words[k : last + k] * _FACTORS[k % 3] + np.uint64(k) for k in range(1, width)), words[:last] * _FACTORS[0])
        joined = mix(joined).view(np.int64)
    else:
        joined = np.zeros(0, np.int64)
    found = []
    for row in range(count):
        a, b = begin[row], begin[row + 1]
        if b - a >= width:
            found.append(np.unique(joined[a : b - width + 1]))
        elif b > a:
            short = words[a:b] * np.array(_FACTORS * width, np.uint64)[: b - a]
            found.append(mix(short.sum(keepdims=True) + np.array([b - a], np.uint64) * _GOLDEN).view(np.int64))
        else:
            found.append(np.zeros(0, np.int64))
    return found


def fingerprint(values: np.ndarray) -> tuple[int, int]:
    """128 bits of a set of hashes, whatever their order."""
    x = values.view(np.uint64)
    low, high = mix(x + _GOLDEN).sum(), mix(x ^ _FACTORS[1]).sum()
    return int(low.view(np.int64)), int(high.view(np.int64))
