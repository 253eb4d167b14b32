"""Memory of Python workers between tasks: Spark keeps idle workers, and they keep what they hold."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa


def give_back() -> None:
    """Return memory that this worker no longer uses to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def given_back(run: Callable[[Iterator], Iterator], forget: Callable[[], None] = lambda: None
               ) -> Callable[[Iterator], Iterator]:
    """``run`` over batches; after the last one ``forget`` is called and memory given back."""
    def both(batches: Iterator) -> Iterator:
        yield from run(batches)
        forget()
        give_back()

    return both
