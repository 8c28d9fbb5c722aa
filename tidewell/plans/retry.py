"""Retries of driver-side steps; tasks are retried by Spark itself."""

from __future__ import annotations

import random
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import SparkSession

Result = TypeVar("Result")
#: Parts of messages of errors that may pass.
TRANSIENT_MARKS = ("timeout", "connection reset", "temporarily unavailable", "deadlock", "could not connect")
MOST_ATTEMPTS = 3


def is_transient(error: BaseException) -> bool:
    if isinstance(error, (TimeoutError, ConnectionError)):
        return True
    text = str(error).lower()
    return any(mark in text for mark in TRANSIENT_MARKS)


@dataclass(frozen=True)
class Retry:
    """Up to three attempts in all; waits double up to a limit and get some jitter."""

    attempts: int = MOST_ATTEMPTS
    first_wait: float = 1.0
    longest_wait: float = 30.0
    jitter: float = 0.1

    def __post_init__(self):
        if not 1 <= self.attempts <= MOST_ATTEMPTS:
            raise ValueError(f"attempts must be 1 to {MOST_ATTEMPTS}")
        if not 0 < self.first_wait <= self.longest_wait or self.jitter < 0:
            raise ValueError("waits must be positive and in order, jitter must not be negative")

    def wait(self, failures: int, draw: float | None = None) -> float:
        share = random.random() if draw is None else draw
        return min(self.longest_wait, self.first_wait * 2 ** (failures - 1)) * (1 + self.jitter * share)

    def run(self, step: Callable[[], Result], sleep: Callable[[float], None] = time.sleep, on_retry: Callable[[int, BaseException], None] | None = None) -> Result:
        failures = 0
        while True:
            try:
                return step()
            except Exception as error:
                failures += 1
                if failures >= self.attempts or not is_transient(error):
                    raise
                if on_retry:
                    on_retry(failures, error)
                sleep(self.wait(failures))


@contextmanager
def cancelled_after(spark: SparkSession, seconds: float, what: str) -> Iterator[None]:
    """Ends the Spark jobs that this thread starts inside once the time is up, and raises; those of other
    threads, with other tags, go on."""
    context, tag, late = spark.sparkContext, f"tidewell-{uuid.uuid4().hex}", threading.Event()

    def stop() -> None:
        late.set()
        while not done.wait(0.5):  # a job may start just after the others were ended
            context.cancelJobsWithTag(tag)

    done, timer = threading.Event(), threading.Timer(seconds, stop)
    timer.daemon = True
    context.addJobTag(tag)
    timer.start()
    try:
        yield
    except Exception as error:
        if late.is_set():
            raise TimeoutError(f"{what} took more than {seconds:g} seconds: timeout") from error
        raise
    finally:
        done.set()
        timer.cancel()
        context.removeJobTag(tag)


class Deadline:
    """A time limit that steps check between actions; what runs then, ``cancelled_after`` ends."""

    def __init__(self, seconds: float, what: str, clock: Callable[[], float] = time.monotonic):
        self.what, self.seconds, self.clock = what, seconds, clock
        self.until = clock() + seconds

    def left(self) -> float:
        return max(0.0, self.until - self.clock())

    def check(self) -> None:
        if self.clock() > self.until:
            raise TimeoutError(f"{self.what} took more than {self.seconds:g} seconds: timeout")
