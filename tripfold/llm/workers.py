"""Python workers import this package from where the driver did."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent.parent)


BATCH_CONF, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "2000"  # rows are whole texts


def share_path(spark: SparkSession) -> None:
    """For sessions whose workers start elsewhere. Where the package is installed, no path changes.

    Where the session leaves the size of Arrow batches at its default, they get smaller.
    """
    if spark.conf.get(BATCH_CONF) == "10000":
        spark.conf.set(BATCH_CONF, BATCH_ROWS)
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([ROOT, *filter(None, paths)])


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that few texts at a time become Python objects.

    Behind the last one, what the task has freed goes back to the system: workers outlive their tasks, and an
    executor's memory is that of all its workers.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    release_freed()


def release_freed() -> None:
    """Hands freed memory that Arrow and, where there is glibc, the C library still hold back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
