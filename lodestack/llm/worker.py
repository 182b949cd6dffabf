"""What a Python worker keeps between tasks, and when it lets go of it.

Workers are reused by later stages, which may be another operator's. An operator that starts drops
what others keep, so a worker holds one operator's cache at most.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa

_kept: dict[str, Callable[[], bool]] = {}


def keeps(owner: str, drop: Callable[[], bool]) -> None:
    """drop() empties the owner's cache and says whether there was one."""
    _kept[owner] = drop


def use(owner: str) -> None:
    """Called where an operator's task starts: what others keep goes, and so does memory that allocators hold free."""
    for other, drop in _kept.items():
        if other != owner:
            drop()
    trim()


def trim() -> None:
    """Give memory back that allocators hold free."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library; the memory is free for reuse all the same
        pass


def task(owner: str) -> Callable:
    """Makes a task's function (batches to batches) tell use() when it starts, and trim() when it ends: the worker may be idle for long."""

    def wrapped(rows: Callable) -> Callable:
        def run(batches):
            use(owner)
            try:
                yield from rows(batches)
            finally:
                trim()

        return run

    return wrapped
