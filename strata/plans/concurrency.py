"""Submit independent Spark jobs from a few driver threads.

Spark schedules jobs from different threads side by side, so independent
writes (one per Gold table, one per ingested dataset) overlap instead of
leaving the cluster idle while a small job finishes. Results come back in
submission order.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

T = TypeVar("T")


def run_all(tasks: list[Callable[[], T]], max_workers: int = 4) -> list[T]:
    if max_workers <= 1 or len(tasks) <= 1:
        return [task() for task in tasks]
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        return [f.result() for f in [pool.submit(task) for task in tasks]]
