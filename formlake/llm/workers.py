"""What Python workers need: this package by name, so that vocabularies and caches outlive a
task, and Arrow batches of a few megabytes, so that texts in flight stay small beside them."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable

from pyspark.sql import SparkSession

import formlake


BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def share_package(spark: SparkSession) -> None:
    """Put the folder that holds this package on the path of Python workers started from now on.

    Where the code is shipped to a cluster in another way, the path does no harm. The
    session's Arrow batches are bounded from here on, as its lazy results run later.
    """
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.abspath(formlake.__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


_held: dict[str, list[Callable[[], None]]] = {}  # in a worker: what frees the memory of an operator
_now: list[str] = [""]


def holds(operator: str, free: Callable[[], None]) -> None:
    """Name what a worker keeps for an operator between tasks."""
    _held.setdefault(operator, []).append(free)


def enter(operator: str) -> None:
    """Called at the start of a task: a worker that last served another operator frees its memory."""
    if _now[0] == operator:
        return
    _now[0] = operator
    for name, frees in _held.items():
        if name != operator:
            for free in frees:
                free()
    give_back()


def give_back() -> None:
    """Hand memory that is free again to the system."""
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library gives memory back by itself
        pass
