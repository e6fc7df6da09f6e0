"""Counters per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def counters(has_warning: bool = False) -> list:
    """Aggregate columns over rows that carry a `reason`.

    A change without an image is `skipped`: nothing failed, there was nothing to forward.
    """
    is_empty = F.coalesce(F.col("reason") == "empty_image", F.lit(False))
    columns = [
        F.count("*").alias("records"),
        F.count_if(F.col("reason").isNull()).alias("success"),
        F.count_if(F.col("reason").isNotNull() & ~is_empty).alias("failed"),
        F.count_if(is_empty).alias("skipped"),
    ]
    if has_warning:
        columns.append(F.count_if(F.col("warning").isNotNull()).alias("warnings"))
    return columns


def observed(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Counts rows while another action reads them: no extra pass."""
    observation = Observation(name)
    return rows.observe(observation, *counters("warning" in rows.columns)), observation


def batch_counters(rows: DataFrame) -> DataFrame:
    """The same counters as a one-row table."""
    return rows.agg(*counters("warning" in rows.columns))


def reasons(rows: DataFrame) -> DataFrame:
    """Rejected rows per reason."""
    return rows.where("reason is not null").groupBy("reason").agg(F.count("*").alias("rows"))
