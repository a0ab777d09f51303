"""What a Python worker keeps from one task to the next.

Workers are used again by later tasks of any operator, and what an earlier one left in memory adds
to what the next one needs.  So a worker holds one resident object (a tokenizer, a model) at a
time: whoever asks for another one, or for none, lets the former go and hands freed memory back.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from typing import TypeVar

import pyarrow as pa

T = TypeVar("T")
_held: dict[str, object] = {}


def resident(key: str, build: Callable[[], T]) -> T:
    """The object of this key, built on first use; an object of another key goes."""
    if key not in _held:
        vacate()
        _held[key] = build()
    return _held[key]  # type: ignore[return-value]


def vacate() -> None:
    """Let the resident object go."""
    _held.clear()
    gc.collect()
    relieve()


def relieve() -> None:
    """Hand memory that nothing uses back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(batches: Iterable[T]) -> Iterator[T]:
    """The batches, with freed memory handed back after each."""
    for batch in batches:
        yield batch
        del batch
        relieve()


class Memo:
    """A dict (`known`) of texts to bytes that is emptied when it outgrows a number of bytes."""

    ENTRY = 170  # a pair's own size besides its bytes

    def __init__(self, most_bytes: int):
        self.known: dict = {}
        self.most, self.size = most_bytes, 0

    def put(self, key, value: bytes) -> None:
        self.known[key] = value
        self.size += self.ENTRY + len(key) + len(value)

    def put_all(self, keys: list, values: list[bytes]) -> None:
        self.known.update(zip(keys, values))
        self.size += self.ENTRY * len(keys) + sum(map(len, keys)) + sum(map(len, values))

    def bound(self) -> None:
        if self.size > self.most:
            self.known.clear()
            self.size = 0
