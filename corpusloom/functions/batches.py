"""Batches of texts cut by bytes, for helpers whose results are many times as large as the texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(texts: pa.Array, limit: int) -> Iterator[pa.Array]:
    """``texts`` in order, in slices of at most ``limit`` bytes and one text more; null texts count none."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = [0, *(np.flatnonzero(np.diff(upto // limit)) + 1).tolist(), len(texts)]
    for first, last in zip(cuts, cuts[1:]):
        if first < last:
            yield texts.slice(first, last - first)
