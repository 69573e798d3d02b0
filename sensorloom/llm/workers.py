"""Memory of Python workers, which live on after a task and serve other stages."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

#: Rows that a function gets, and mostly gives back, at once.
ROWS = 1024

Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def sliced(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """All rows in their order, at most so many at once; a slice copies nothing."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sparing(run: Run) -> Run:
    """``run`` on slices of its batches; what it has freed leaves the process with the task.

    Else a worker keeps the most that any of its tasks held at once, for as long as it
    lives, and the workers of an executor add up to that over all stages.
    """

    def over_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(sliced(batches))
        finally:
            released()

    return over_slices


def released() -> None:
    """Hand freed memory back to the system, as far as the allocators can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)
