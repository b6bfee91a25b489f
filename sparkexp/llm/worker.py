"""What a Python worker keeps from task to task: one operator's things at a time.

Spark reuses its workers, so without this the memory of every operator that ever
ran in one would add up.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable
from typing import TypeVar

import pyarrow as pa

T = TypeVar("T")

_kept: dict[Hashable, object] = {}


def kept(name: Hashable, make: Callable[[], T]) -> T:
    """The worker's object of this name; making it drops what is kept under any other."""
    if name not in _kept:
        release()
        _kept[name] = make()
    return _kept[name]


def release() -> None:
    """Drop what other operators kept and give the memory back to the system."""
    if _kept:
        _kept.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def _find_trim() -> Callable[[int], int] | None:
    """The C library's call that returns freed memory, where there is one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return None


_trim = _find_trim()
