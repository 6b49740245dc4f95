"""Words of many texts at once: every distinct word is looked at once, all words side by side in arrays."""

from __future__ import annotations

import functools
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORDS = re.compile(r"[^\W\d_]+")


@functools.cache
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter of ``WORDS``."""
    every = "".join(map(chr, range(sys.maxunicode + 1)))
    found = np.zeros(len(every), bool)
    for run in WORDS.finditer(every):
        found[run.start() : run.end()] = True
    return found


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def distinct_words(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words, the number of the one at each place, and where the places of each text begin.

    The places of a text are what ``WORDS.findall`` returns for it; the last bound is the number of places.
    """
    codes = code_points("\n".join(texts))
    inside = np.zeros(len(codes) + 2, bool)
    inside[1:-1] = _letters()[codes]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edges[::2], edges[1::2]
    letters = codes[inside[1:-1]]
    rows = np.cumsum([0, *(len(text) + 1 for text in texts)])
    bounds = np.searchsorted(begin, rows)
    del codes, inside
    size = np.ones(len(letters), np.uint8)
    for more in (0x7F, 0x7FF, 0xFFFF):
        size += letters > more
    offsets = np.zeros(len(begin) + 1, np.int64)
    offsets[1:] = np.cumsum(size, dtype=np.int64)[np.cumsum(end - begin) - 1]
    data = letters.tobytes().decode("utf-32-le").encode()
    every = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
    return every.dictionary.to_pylist(), every.indices.to_numpy(), bounds


def in_runs(texts: pa.Array, limit: int, longest_first: bool = False) -> Iterator[np.ndarray]:
    """Numbers of the rows in runs of about ``limit`` bytes of texts, in their order or the longest texts first."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(-sizes, kind="stable") if longest_first else np.arange(len(sizes))
    run = np.cumsum(sizes[order]) // limit
    yield from np.split(order, np.flatnonzero(run[1:] != run[:-1]) + 1) if len(order) else ()
