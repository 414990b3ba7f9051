"""Arrow batches and memory of Python tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

_kept: dict[tuple[str, str], object] = {}


def kept(kind: str, path: str, make: Callable[[str], object]) -> object:
    """This worker's object for a file, kept from task to task; of all kinds and files only the last is kept."""
    if (kind, path) not in _kept:
        _kept.clear()
        _kept[kind, path] = make(path)
    return _kept[kind, path]


def give_back() -> None:
    """Return freed memory to the system: workers live on and are many, their peaks should not add up."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES, keeps: bool = False) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of about ``limit`` bytes of the text column (one row at least), so that a
    task's memory follows neither the batch size nor the length of most rows. Unless the task ``keeps`` an object
    of its worker, what an earlier task kept is dropped."""
    if not keeps:
        _kept.clear()
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64))
        start = 0
        while start < batch.num_rows:
            base = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    give_back()
