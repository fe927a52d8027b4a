"""Repeating what may fail for a while."""

from __future__ import annotations

import time
from collections.abc import Callable


def retried[T](call: Callable[[], T], attempts: int, wait: float, errors: type[Exception] | tuple[type[Exception], ...] = OSError) -> T:
    """What ``call`` gives. One of ``errors`` is waited out, ``wait`` seconds longer each time; the last one, and any other, is raised."""
    for n in range(1, attempts):
        try:
            return call()
        except errors:
            time.sleep(wait * n)
    return call()
