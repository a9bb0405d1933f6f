"""Waits, retries and the rolling rate limit. Clocks and sleeps are parameters, so nothing waits in tests."""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import Column
from pyspark.sql import functions as F

T = TypeVar("T")
RETRIED = frozenset({429, 500, 502, 503, 504})


def backoff(attempt: int, base: float, most: float) -> float:
    """Seconds to wait after the attempt of that number, from 1."""
    return min(most, base * 2 ** (attempt - 1))


def backoff_column(attempt: Column, base: float, most: float) -> Column:
    return F.least(F.lit(float(most)), F.lit(float(base)) * F.pow(F.lit(2.0), attempt - 1))


class RateLimited(Exception):
    """The service still refused for its rate after all retries."""


class Limiter:
    """At most max_rpm starts in any window of 60 seconds; a start leaves the window at exactly 60."""

    def __init__(self, max_rpm: int = 60, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.most, self.clock, self.sleep = max(1, int(max_rpm)), clock, sleep
        self.lock, self.starts = threading.Lock(), deque()

    def acquire(self) -> None:
        while True:
            with self.lock:
                now = self.clock()
                while self.starts and now - self.starts[0] >= 60.0:
                    self.starts.popleft()
                if len(self.starts) < self.most:
                    self.starts.append(now)
                    return
                left = 60.0 - (now - self.starts[0])
            self.sleep(min(max(left, 0.01), 0.5))


def share(max_rpm: int, tasks: int) -> int:
    """Quota of one of so many tasks, so that all together keep to max_rpm; 1 at least."""
    return max(1, max_rpm // max(1, tasks))


def recognise(call: Callable[[], tuple[int, str]], retries: int = 3, base: float = 0.8, limiter: Limiter | None = None, sleep: Callable[[float], None] = time.sleep) -> str:
    """Text of one segment: call gives (status, text) and may raise.

    Errors and busy statuses are retried, retries + 1 calls in all. A rate refusal that lasts raises RateLimited;
    any other failure gives an empty text.
    """
    for attempt in range(1, retries + 2):
        if limiter:
            limiter.acquire()
        try:
            status, text = call()
        except Exception:  # noqa: BLE001 - whatever a client raises counts as passing trouble
            status, text = -1, ""
        if status == 200:
            return text.strip()
        if (status in RETRIED or status == -1) and attempt <= retries:
            sleep(backoff(attempt, base, 8.0))
            continue
        if status == 429:
            raise RateLimited
        return ""
    return ""


def recognise_all(segments: Iterable[T], call: Callable[[T], str], rounds: int = 3, base: float = 0.8, sleep: Callable[[float], None] = time.sleep, threads: int = 4) -> list[str]:
    """Texts in the order of the segments, asked for from a pool of threads: those refused for the rate go another round, what is left is empty."""
    segments = list(segments)
    out = [""] * len(segments)
    left = list(range(len(segments)))
    for turn in range(1, rounds + 1):

        def ask(i: int) -> bool:
            try:
                out[i] = call(segments[i])
            except RateLimited:
                return False
            return True

        with ThreadPoolExecutor(max(1, threads)) as pool:
            left = [i for i, told in zip(left, pool.map(ask, left)) if not told]
        if not left or turn == rounds:
            break
        sleep(backoff(turn, base, 15.0))
    return out


def extract(call: Callable[[], T | None], allow_failure: bool = False, attempts: int = 5, first: float = 5.0, most: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> T | None:
    """The first result that isn't None; after all attempts None if failure is allowed, else RuntimeError."""
    error: Exception | None = None
    for attempt in range(1, attempts + 1):
        try:
            found = call()
            if found is not None:
                return found
        except Exception as e:  # noqa: BLE001
            error = e
        if attempt < attempts:
            sleep(backoff(attempt, first, most))
    if allow_failure:
        return None
    raise RuntimeError(f"gave up after {attempts} attempts") from error
