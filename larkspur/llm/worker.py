"""What a Python worker keeps between tasks.

Workers are reused from task to task and from query to query.  A function that Spark sends to them
is pickled by value with the globals that it names, so a cache in its module would start empty in
every task; this module is imported by name instead.  One value is kept at a time: what an earlier
stage had loaded makes room, and memory is that of one model.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import TypeVar

Model = TypeVar("Model")
_held: dict[Hashable, object] = {}


def held(key: Hashable, make: Callable[[], Model]) -> Model:
    """The value of key, made on first use in this process."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]
