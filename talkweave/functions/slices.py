"""Arrow arrays of texts, a few at a time: what a batch becomes in Python is held for one slice only."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text in a slice. A longer text is a slice of its own.
SLICE_BYTES = 1 << 20


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Neighbouring texts that take `most` bytes together, at least one; an empty array is one slice."""
    at, sizes = 0, np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype="int64")
    while True:
        before = int(sizes[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + most, "right")))
        yield texts.slice(at, end - at)
        at = end
        if at >= len(texts):
            return


def by_slices(texts: pa.Array, function: Callable[[list], pa.Array]) -> pa.Array:
    """function of the texts of each slice, as one array."""
    return pa.concat_arrays([function(part.to_pylist()) for part in slices(texts)])
