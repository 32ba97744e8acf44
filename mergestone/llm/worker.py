"""What a Python worker keeps from task to task, and what it gives back.

Workers outlive their tasks and serve one operator after the other. Each keeps
one large object at most, and at a task's end returns freed memory to the
system, so an executor's workers don't add up what all operators once needed.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa

_kept: dict[Any, Any] = {}
try:
    _trim = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):  # another C library: nothing to ask for
    _trim = None


def keep(key: Any, make: Callable[[], Any]) -> Any:
    """The object made for this key, made once in a worker; another key's object goes first."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
        settle()
    return _kept[key]


def settle() -> None:
    """Gives freed memory back."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def tidy(run: Callable[[Iterator], Iterator], keeps: bool = False) -> Callable[[Iterator], Iterator]:
    """``run`` for mapInArrow; at its end its tables go, and with ``keeps`` only what ``keep`` holds stays."""

    def wrapped(batches: Iterator) -> Iterator:
        if not keeps:
            _kept.clear()
        yield from run(batches)
        settle()

    return wrapped
