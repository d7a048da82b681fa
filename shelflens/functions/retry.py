"""Repeat a call that may fail for a while."""

from __future__ import annotations

import time
from collections.abc import Callable


def retrying(call: Callable, attempts: int = 3, pause: float = 5.0) -> Callable:
    """``call`` tried up to ``attempts`` times with a pause between; the last error is raised."""

    def run(*args):
        for attempt in range(attempts):
            try:
                return call(*args)
            except Exception:
                if attempt == attempts - 1:
                    raise
                time.sleep(pause)

    return run
