"""What several operators share: reading tables, sizes, and slices of text as bytes."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

WORD = r"[^\x20\x09-\x0D]+"
"""A word, wherever an operator counts or compares words."""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(docs: DataFrame, most: int = 4 << 20) -> DataFrame:
    """``docs``, with Arrow batches of at most about 4 MB (or one row) from now on in its session.

    A batch is held several times at once on its way between the JVM and Python, so Spark's
    default of 64 MB takes much of a small executor.
    """
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(conf.get(key).rstrip("bB")) > most:
        conf.set(key, str(most))
    return docs


_KEPT: dict[str, Any] = {}


def kept(key: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, once per Python worker: it outlives a task, until ``let_go``."""
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def let_go() -> None:
    """Frees what tasks of other operators have kept: a worker that goes on to other work holds it for nothing."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()
    release()


def release() -> None:
    """Gives memory that nothing uses back to the system: Arrow's own, and the C library's, which would stay with the idle worker."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a whole column, from one scan of it."""
    return docs.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0


def bytes_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a string or binary column as one byte array and their n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[ends[0]:ends[-1]], ends - ends[0]


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of consecutive values of about ``most`` bytes, at least one value each."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to
        at = to


def distinct(values: np.ndarray) -> np.ndarray:
    """The different values in rising order, by one sort: NumPy's own function hashes them first, which takes many times as long."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for every (start, length), one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
