"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vitrine.session import materialize


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later jobs don't depend on this one's executors."""
    return materialize(df, f"llm-{label}")


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Batches of at most ``rows`` rows for the Python workers of what is run inside: for rows that may be large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hex_sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


SLICE_BYTES = 2 << 20  # of text that is worked on at once


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for row, size in enumerate(sizes):
        if row > start and total + size > most:
            yield start, row
            start, total = row, 0
        total += int(size)
    if start < len(sizes):
        yield start, len(sizes)


def give_back() -> None:
    """Freed memory goes back to the system, where allocators would keep it in the process."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def tidy(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task over batches that gives memory back at its end: Python workers stay, idle, beside those of later stages."""

    @functools.wraps(task)
    def run(batches):
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def per_worker(key: tuple, make: Callable[[], object]):
    """``make()`` once for a Python worker, which gives it up for the objects of another operator (the key's first entry).

    Task functions travel by value, so a module's own globals don't outlive a task; ``sys.modules`` does.
    """
    name = "_vitrine_worker_objects"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
    kept = sys.modules[name].__dict__.setdefault("kept", {})
    if key not in kept:
        for other in [k for k in kept if k[0] != key[0]]:
            del kept[other]
        kept[key] = make()
        give_back()  # what making it took
    return kept[key]
