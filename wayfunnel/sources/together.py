"""Independent writes submitted at the same time, so that small jobs do not leave a cluster idle."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")


def run_together(
    spark: SparkSession, jobs: dict[str, Callable[[], Result]], at_once: int = 4
) -> dict[str, Result]:
    """Run actions from a few threads; results by name, the first failure is raised."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        running = {
            name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()
        }
        return {name: future.result() for name, future in running.items()}
