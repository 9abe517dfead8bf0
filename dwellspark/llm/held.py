"""What a Python worker holds from one task to the next: the state of one operator.

Spark uses its workers again, so what an operator has left there would stay for all that follow.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

_HELD: dict[str, Any] = {}


def held(name: str, make: Callable[[], Any]) -> Any:
    """The state of this name, made if there is none; others go."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


def forget() -> None:
    """For operators that hold nothing themselves."""
    _HELD.clear()
