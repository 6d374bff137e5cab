"""Memory of Python workers, which outlive the tasks they run."""

from __future__ import annotations

import ctypes
import gc

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import SparkSession

_HELD: dict[tuple, Any] = {}


def held(key: tuple, make: Callable[[], Any]) -> Any:
    """What this worker keeps from task to task under ``key``: one thing at a time, made when first asked for."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def release_memory(keep: tuple | None = None) -> None:
    """Give back what earlier tasks of this worker have left, but for what is held under ``keep``; called at the start of tasks that need much."""
    for key in [k for k in _HELD if k != keep]:
        del _HELD[key]
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only glibc has it
        pass


@contextmanager
def rows_at_a_time(spark: SparkSession, n: int) -> Iterator[None]:
    """Jobs that run inside hand Python at most ``n`` rows at a time: for rows of megabytes each."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, before)
