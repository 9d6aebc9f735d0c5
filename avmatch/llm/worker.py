"""What a Python worker keeps between tasks, and how it gives memory back."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes of an Arrow batch that a task takes at once.
BATCH = 4 << 20
#: The one table that this worker keeps: by key.
_held: dict[Any, Any] = {}


def kept(key: Any, make: Callable[[], Any]) -> Any:
    """make()'s result, kept for later tasks with the same key; whatever another key held goes first."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def release() -> None:
    """Return freed memory to the system: Python's, Arrow's and the C library's (where it can)."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not glibc


def bounded(rows: Iterator, keep: bool = False) -> Iterator:
    """rows of a task; at its end memory is given back, and without `keep` the kept table too."""
    if not keep:
        _held.clear()
    try:
        yield from rows
    finally:
        release()


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of this session are bounded by bytes, unless it says how: a batch of very long texts is a short one."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, BATCH)
