"""Run one Spark job per table, several at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")

#: Tables worked on at the same time.
CONCURRENCY = 10


def map_tables(spark: SparkSession, job: Callable[[Item], Result], items: Iterable[Item],
               concurrency: int = CONCURRENCY) -> list[Result]:
    """Results of ``job`` per item, in order.

    The threads only submit jobs and wait; each should bring back little, such as
    one report row.
    """
    def submit(item: Item) -> Result:
        return inheritable_thread_target(spark)(job)(item)

    with ThreadPoolExecutor(max_workers=concurrency) as pool:
        return list(pool.map(submit, items))
