"""Memory of Python workers, which live on between tasks and stages.

What a task frees stays with Arrow's pool and the C library unless it is asked back; an
executor's workers then hold the peaks of all stages before.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import pyarrow as pa


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # not the GNU C library
        return None


def give_back() -> None:
    """Returns freed memory to the system."""
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim:
        trim(0)


def gives_back(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``work`` of ``mapInArrow``, after which the worker returns what it has freed."""
    @wraps(work)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()
    return whole
