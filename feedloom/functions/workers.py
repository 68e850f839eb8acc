"""Memory of the Python workers of Arrow stages."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa


def lean(run: Callable) -> Callable:
    """A stage over batches whose worker gives freed memory back when it has
    done its task: workers wait for the next stage, and what one stage has
    freed would count beside what the next one needs."""
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):
                pass  # not every C library has it
    return wrapped
