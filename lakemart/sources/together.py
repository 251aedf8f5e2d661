"""Independent jobs submitted a few at a time, so that a small one does not wait for a large one."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

T = TypeVar("T")

# Jobs in flight at once; Spark shares the executors between them.
TOGETHER = 4


def run_together(work: Mapping[str, Callable[[], T]], together: int = TOGETHER) -> dict[str, T]:
    """Results by name, in the order given; the first error is raised once all have ended."""
    with ThreadPoolExecutor(together) as pool:
        running = {name: pool.submit(job) for name, job in work.items()}
    return {name: done.result() for name, done in running.items()}
