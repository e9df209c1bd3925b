"""What a Python worker keeps between tasks: the cache of one operator at a time.

Workers are reused by later stages; without this, the word tables of every operator that ran before would
stay in memory beside the current one's.
"""

from __future__ import annotations

from collections.abc import Callable

_HELD: dict = {}


def held(name, make: Callable):
    """The worker's object of that name; making a new one lets go of the others."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]
