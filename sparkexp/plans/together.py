"""Running independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


def run_together(*tasks: Callable[[], T]) -> list[T]:
    """Call each task in a thread of its own and return their results in order.

    Each task starts Spark jobs and waits for them. Side by side, the tail of
    one job leaves no cores idle. The first error is raised once all are done.
    """
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(tasks)) as pool:
        started = [pool.submit(inherit(task)) for task in tasks]
    return [task.result() for task in started]
