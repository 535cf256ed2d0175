"""Python work on Arrow batches a slice at a time, so that a worker holds one slice's texts as Python objects, not a batch's."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text in a slice; a longer text is a slice of its own.
SLICE = 1 << 20


def trim() -> None:
    """Give the memory of finished batches back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def slices(*texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges (first row, number of rows) of string columns of one length."""
    sizes = sum(pc.binary_length(t).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + 64 for t in texts)
    ends = np.cumsum(sizes)
    block, long = (ends - 1) // SLICE, sizes > SLICE
    cuts = np.flatnonzero((block[1:] != block[:-1]) | long[1:] | long[:-1]) + 1
    bounds = [0, *cuts.tolist(), len(sizes)] if len(sizes) else []
    for a, b in zip(bounds, bounds[1:], strict=False):
        yield a, b - a


def by_slices(make: Callable[..., list], kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """What `make` gives for the values of string columns, slice after slice, as one array."""
    parts = [pa.array(make(*(c.slice(*at).to_pylist() for c in columns)), kind) for at in slices(*columns)]
    out = pa.concat_arrays(parts) if parts else pa.array([], kind)
    del parts
    trim()
    return out


def batches_by_slices(run: Callable[[pa.RecordBatch], pa.RecordBatch], *texts: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: `run` on slices of each batch, by the sizes of the named string columns."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in slices(*(batch.column(t) for t in texts)):
                yield run(batch.slice(*at))
            del batch
            trim()

    return each
