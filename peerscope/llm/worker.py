"""Tables that a Python worker keeps between tasks: those of one operator at a time."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa

_held: dict[str, Callable[[], None]] = {}


def claim(owner: str, empty: Callable[[], None] = lambda: None) -> None:
    """Called as a task of ``owner`` begins: what other operators left in this worker is emptied (``empty`` does so for this one)."""
    others = [o for o in _held if o != owner]
    for o in others:
        _held.pop(o)()
    if others:
        pa.default_memory_pool().release_unused()
    _held[owner] = empty
