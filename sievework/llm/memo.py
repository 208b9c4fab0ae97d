"""Values of recurring keys, bounded in bytes."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

# About what a key and its place in a dict take besides the characters.
_ENTRY = 160


class Memo:
    """Values worked out before. When the newer half is full it becomes the older one, whose entries stay
    until they are met again or the next half is full; long keys are never held."""

    def __init__(self, most_bytes: int = 32 << 20, longest: int = 64) -> None:
        self.newer: dict[Any, Any] = {}
        self.older: dict[Any, Any] = {}
        self.half, self.longest, self.size = most_bytes // 2, longest, 0

    def get(self, key: Any) -> Any:
        value = self.newer.get(key)
        if value is None and self.older:
            value = self.older.get(key)
            if value is not None:
                self.put(key, value, 0)
        return value

    def put(self, key: Any, value: Any, more: int) -> None:
        """``more``: bytes of the value."""
        if len(key) > self.longest:
            return
        if self.size >= self.half:
            self.older, self.newer, self.size = self.newer, {}, 0
        self.newer[key] = value
        self.size += _ENTRY + 2 * len(key) + more


class Made(dict):
    """A :class:`Memo` that makes missing values itself, so that what is held is found without a call."""

    def __init__(self, make: Callable[[str], Any], most_bytes: int, longest: int = 64) -> None:
        super().__init__()
        self.make, self.half, self.longest = make, most_bytes // 2, longest
        self.older: dict[str, Any] = {}
        self.size = 0

    def forget(self) -> None:
        self.clear()
        self.older, self.size = {}, 0

    def __missing__(self, key: str) -> Any:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if self.size >= self.half:
                self.older, self.size = dict(self), 0
                self.clear()
            self[key] = value
            self.size += _ENTRY + 2 * len(key) + 40 + 8 * len(value)
        return value
