"""A call tried again, with growing pauses."""

from __future__ import annotations

import functools
import random
import time
from collections.abc import Callable


def retrying(times: int = 3, base: float = 1.0, most: float = 30.0, jitter: float = 0.0, when: Callable[[Exception], bool] = lambda e: True, sleep: Callable[[float], None] = time.sleep) -> Callable:
    """A decorator: errors that `when` takes are met by another try, at most `times` in all, after base, 2 * base, 4 * base ...
    seconds (at most `most`, and up to `jitter` more); others, and the last one, are raised."""

    def wrap(call: Callable) -> Callable:
        @functools.wraps(call)
        def run(*args, **more):
            for attempt in range(1, times + 1):
                try:
                    return call(*args, **more)
                except Exception as e:
                    if attempt == times or not when(e):
                        raise
                    sleep(min(base * 2 ** (attempt - 1), most) + random.uniform(0, jitter))

        return run

    return wrap
