"""File sinks that stand in for the event log and the message queue."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripfold.operators.envelope import encode_envelopes
from tripfold.operators.staging import to_bodies


def write_envelopes(events: DataFrame, path: str) -> None:
    """Appends events to an envelope log, one JSON line each.

    Files follow the input partitions; readers order a trip by `sequence`.
    """
    encode_envelopes(events).write.mode("append").json(path)


def write_bodies(trips: DataFrame, path: str) -> None:
    """Appends completed trips to a message folder, one body per line."""
    to_bodies(trips).withColumnRenamed("body", "value").write.mode("append").text(path)
