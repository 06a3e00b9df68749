"""Memory of Python workers, which Spark keeps for later tasks."""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from typing import TypeVar

import pyarrow as pa

T = TypeVar("T")


@cache
def _trim() -> Callable[[int], int] | None:
    name = ctypes.util.find_library("c")
    return getattr(ctypes.CDLL(name), "malloc_trim", None) if name else None


_caches: list[Callable[[], None]] = []


def on_release(drop: Callable[[], None]) -> None:
    """Registers what empties a cache that only some tasks of a worker use."""
    _caches.append(drop)


def release() -> None:
    """Empties caches and hands freed memory back to the system, where the C library can do so."""
    for drop in _caches:
        drop()
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim:
        trim(0)


def released(parts: Iterable[T]) -> Iterator[T]:
    """``parts``, with freed memory handed back after each."""
    for part in parts:
        yield part
        release()
