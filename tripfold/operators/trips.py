"""Folding of start and end events into trips.

An event log has `trip_id`, `kind` ('start' or 'end'), `sequence` (any orderable
column, unique within a trip up to exact repeats) and the payload columns. A
write replaces its whole payload group, nulls included, and the latest sequence
wins whatever the order of arrival.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    NumericType,
    TimestampNTZType,
    TimestampType,
)
from pyspark.sql.window import Window

from tripfold.operators.skew import HotKeys, find_hot_keys, with_chunk
from tripfold.schemas import END_FIELDS, START_FIELDS


def _write(kind: str, fields: Sequence[str]) -> Column:
    """The payload group an event writes, led by its sequence; NULL for the other kind."""
    image = F.struct(*fields) if fields else F.struct(F.lit(True).alias("present"))
    return F.when(F.col("kind") == kind, F.struct("sequence", image.alias("image")))


def event_writes(
    events: DataFrame,
    start_fields: Sequence[str] = START_FIELDS,
    end_fields: Sequence[str] = END_FIELDS,
) -> DataFrame:
    """Events as writes to the two payload groups of their trip."""
    return events.select(
        "trip_id",
        "kind",
        "sequence",
        _write("start", start_fields).alias("start_write"),
        _write("end", end_fields).alias("end_write"),
    )


def images(start_fields: Sequence[str], end_fields: Sequence[str], start: str = "start_write", end: str = "end_write") -> list[Column]:
    """The payload columns of two writes."""
    groups = ((start, start_fields), (end, end_fields))
    return [F.col(f"{g}.image.{f}").alias(f) for g, fields in groups for f in fields]


def assemble_trips(
    events: DataFrame,
    start_fields: Sequence[str] = START_FIELDS,
    end_fields: Sequence[str] = END_FIELDS,
    unique_sequence: bool = False,
) -> DataFrame:
    """Current state of every trip: one combined aggregate, one shuffle, no join.

    Name only the fields you need, so that the others are neither read nor
    shuffled. `has_start` and `has_end` tell which events were seen. Of writes with
    the same sequence the one with the greatest payload wins, as a whole. Where
    no two events of a trip share a sequence, say so: fixed-width fields are
    then folded one by one, without a sort.
    """
    groups = {"start": start_fields, "end": end_fields}
    fields = [f for group in groups.values() for f in group]
    if unique_sequence and all(_fixed_width(events.schema[c].dataType) for c in ["sequence", *fields]):
        # values that fit an aggregation buffer in place: hash aggregation, no sort
        newest = [
            F.max_by(f, F.when(F.col("kind") == kind, F.col("sequence"))).alias(f)
            for kind, group in groups.items()
            for f in group
        ]
        seen = [F.bool_or(F.col("kind") == kind).alias(f"has_{kind}") for kind in groups]
        return events.groupBy("trip_id").agg(*newest, *seen)

    writes = event_writes(events, start_fields, end_fields).groupBy("trip_id")
    folded = writes.agg(*[F.max(c).alias(c) for c in ("start_write", "end_write")])
    return folded.select(
        "trip_id",
        *images(start_fields, end_fields),
        F.col("start_write").isNotNull().alias("has_start"),
        F.col("end_write").isNotNull().alias("has_end"),
    )


def _fixed_width(dtype: DataType) -> bool:
    return isinstance(dtype, (NumericType, DateType, TimestampType, TimestampNTZType, BooleanType))


def completed_trips(trips: DataFrame) -> DataFrame:
    """Trips with both events."""
    return trips.where("has_start and has_end").drop("has_start", "has_end")


def open_trips(trips: DataFrame) -> DataFrame:
    """Trips still waiting for their start or their end."""
    return trips.where("not (has_start and has_end)")


def trip_history(
    events: DataFrame,
    start_fields: Sequence[str] = START_FIELDS,
    end_fields: Sequence[str] = END_FIELDS,
    carry: DataFrame | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """State of the trip before and after every event, in sequence order.

    `carry` holds the state of trips from earlier batches (`trip_id`,
    `start_write`, `end_write`). Trips too large for one task are split into
    ranges of their sequence that run side by side; every range starts from the
    combined writes of the ranges before it. Exact repeats of an event give one row.
    """
    if hot is None:
        hot = find_hot_keys(events, "trip_id", "sequence")
    rows = event_writes(events, start_fields, end_fields)
    if carry is not None:
        rows = rows.unionByName(carry.withColumn("kind", F.lit("carry")), allowMissingColumns=True)
    rows = with_chunk(rows, "trip_id", "sequence", hot)
    key = ["trip_id", "chunk"] if hot else ["trip_id"]
    order = [
        F.when(F.col("kind") == "carry", 0).otherwise(1),
        F.col("sequence"),
        F.when(F.col("kind") == "start", 0).otherwise(1),
        F.col("start_write"),  # equal sequences: still the same order in every run
        F.col("end_write"),
    ]
    before = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)

    previous = {c: F.max(c).over(before) for c in ("start_write", "end_write")}
    event = F.struct("kind", "sequence", "start_write", "end_write")
    repeated = F.coalesce(F.lag(event).over(Window.partitionBy(*key).orderBy(*order)) == event, F.lit(False))
    if hot:
        # exact repeats change nothing, and could fill a chunk; those of other trips are dropped below, without a shuffle
        rows = rows.where("not is_hot").unionByName(rows.where("is_hot").distinct())
        rows = rows.join(F.broadcast(_state_before_chunk(rows)), ["trip_id", "chunk"], "left")
        previous = {c: F.greatest(p, F.col(f"chunk_{c}")) for c, p in previous.items()}
    return (
        rows.withColumns({**{f"prev_{c}": p for c, p in previous.items()}, "repeated": repeated})
        .where("kind <> 'carry' and not repeated")
        .select(
            "trip_id",
            "kind",
            "sequence",
            "prev_start_write",
            "prev_end_write",
            F.greatest("prev_start_write", "start_write").alias("start_write"),
            F.greatest("prev_end_write", "end_write").alias("end_write"),
        )
    )


def _state_before_chunk(rows: DataFrame) -> DataFrame:
    """Writes accumulated before each chunk of a hot trip: one row per chunk."""
    before = Window.partitionBy("trip_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.where("is_hot")
        .groupBy("trip_id", "chunk")
        .agg(F.max("start_write").alias("s"), F.max("end_write").alias("e"))
        .select(
            "trip_id",
            "chunk",
            F.max("s").over(before).alias("chunk_start_write"),
            F.max("e").over(before).alias("chunk_end_write"),
        )
    )


def first_completion(
    history: DataFrame,
    start_fields: Sequence[str] = START_FIELDS,
    end_fields: Sequence[str] = END_FIELDS,
) -> DataFrame:
    """Every trip once, as it stood when its second kind of event came in."""
    complete = "start_write is not null and end_write is not null"
    was_open = "(prev_start_write is null or prev_end_write is null)"
    return history.where(f"{complete} and {was_open}").select(
        "trip_id", "sequence", *images(start_fields, end_fields)
    )


def change_feed(
    history: DataFrame,
    start_fields: Sequence[str] = START_FIELDS,
    end_fields: Sequence[str] = END_FIELDS,
) -> DataFrame:
    """One record per effective write: INSERT for a trip's first, then MODIFY.

    A write that changes no field leaves no record; the passenger count is no part of
    the change images, so it is not compared. Build the history with all
    payload fields, or changes to the missing ones go unseen.
    """
    is_new = F.col("prev_start_write").isNull() & F.col("prev_end_write").isNull()
    same = F.lit(True)
    for write, fields in (("start_write", start_fields), ("end_write", end_fields)):
        same = same & F.col(write).isNull().eqNullSafe(F.col(f"prev_{write}").isNull())
        for name in (f for f in fields if f != "passenger_count"):
            same = same & F.col(f"{write}.image.{name}").eqNullSafe(F.col(f"prev_{write}.image.{name}"))
    changed = ~same
    return (
        history.withColumn("event_name", F.when(is_new, "INSERT").when(changed, "MODIFY"))
        .where("event_name is not null")
        .select("trip_id", "sequence", "event_name", *images(start_fields, end_fields))
    )


def modified(changes: DataFrame) -> DataFrame:
    """Only the changes to an existing trip."""
    return changes.where("event_name = 'MODIFY'").drop("event_name")
