"""Memory of Python workers, which Spark reuses from one stage to the next."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa

_kept: dict[str, Callable[[], None]] = {}


def keeps(owner: str, clear: Callable[[], None]) -> None:
    """State that an operator keeps caches in its workers, and how they are dropped."""
    _kept[owner] = clear


def claim(owner: str | None = None) -> None:
    """At the start of a partition: drop what other operators keep in this worker, and give unused memory back."""
    for name, clear in _kept.items():
        if name != owner:
            clear()
    pa.default_memory_pool().release_unused()
