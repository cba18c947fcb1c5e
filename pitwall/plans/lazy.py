"""A mapping whose values are built on first access (and then kept).

Model functions take "all upstream tables" as a dict; building every DataFrame eagerly
costs driver time (each transformation is analysed on creation) for tables a query never
touches. ``Lazy`` defers each one until it is looked up.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping
from typing import Any


class Lazy(Mapping):
    def __init__(self, builders: dict[str, Callable[[], Any]]):
        self._builders = dict(builders)
        self._built: dict[str, Any] = {}
        self._lock = threading.RLock()   # queries may be started from several threads

    def __getitem__(self, key: str) -> Any:
        with self._lock:
            if key not in self._built:
                self._built[key] = self._builders[key]()
            return self._built[key]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def once(fn: Callable[[], Any]) -> Callable[[], Any]:
    """Memoise a zero-argument builder."""
    box: list = []
    lock = threading.Lock()

    def get():
        with lock:
            if not box:
                box.append(fn())
            return box[0]
    return get
