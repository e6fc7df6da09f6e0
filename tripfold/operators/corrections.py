"""KPIs that follow later writes to finished trips.

A trip counts on its pickup day as it stands now. When a batch moves it to another
day or changes its fare, what it counted for is taken back and what it counts for is
added: sums and counts do so with a sign. Greatest and least fares cannot be
subtracted, so the store keeps how often each fare counts on each day, and finds
the extremes of a day anew from that when a fare is taken back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.operators.kpi import dated
from tripfold.operators.trips import event_writes
from tripfold.schemas import END_FIELDS, MONEY, START_FIELDS, TOTAL

PREVIOUS = ("pickup_datetime", "fare_amount")


def current_trips(
    events: DataFrame,
    carry: DataFrame | None = None,
    start_fields: Sequence[str] = START_FIELDS,
    end_fields: Sequence[str] = END_FIELDS,
) -> DataFrame:
    """Trips with an event, if complete, in their current state, with what they counted for before.

    `carry` holds the trips' state from earlier batches (`trip_id`, `start_write`,
    `end_write`). `was_complete` tells whether the trip counted before these events,
    `previous_pickup_datetime` and `previous_fare_amount` what for. One combined aggregate, one
    shuffle; a trip with very many events costs one row per task.
    """
    writes = ("start_write", "end_write")
    rows = event_writes(events, start_fields, end_fields).select("trip_id", *writes, F.lit(False).alias("old"))
    if carry is not None:
        rows = rows.unionByName(carry.select("trip_id", *writes, F.lit(True).alias("old")))
    folded = rows.groupBy("trip_id").agg(
        *[F.max(w).alias(w) for w in writes],
        *[F.max(F.when(F.col("old"), F.col(w))).alias(f"old_{w}") for w in writes],
        F.bool_or(~F.col("old")).alias("touched"),
    )
    was = F.expr("old_start_write is not null and old_end_write is not null")
    before = {"pickup_datetime": "old_start_write", "fare_amount": "old_end_write"}
    return folded.where("touched and start_write is not null and end_write is not null").select(
        "trip_id",
        *[F.col(f"start_write.image.{f}").alias(f) for f in start_fields],
        *[F.col(f"end_write.image.{f}").alias(f) for f in end_fields],
        was.alias("was_complete"),
        *[F.when(was, F.col(f"{before[f]}.image.{f}")).alias(f"previous_{f}") for f in PREVIOUS],
    )


def fare_changes(trips: DataFrame) -> DataFrame:
    """How often each fare is added to (n > 0) or taken from (n < 0) each day by `current_trips`."""
    now = dated(trips).withColumn("n", F.lit(1).cast("bigint"))
    before = trips.where("was_complete").select(*[F.col(f"previous_{f}").alias(f) for f in PREVIOUS])
    back = dated(before).withColumn("n", F.lit(-1).cast("bigint"))
    rows = now.unionByName(back).where("pickup_date is not null")
    return rows.groupBy("pickup_date", "fare").agg(F.sum("n").alias("n")).where("n <> 0")


def signed_partials(changes: DataFrame) -> DataFrame:
    """Partial rows of `fare_changes`, sums and counts with their sign, extremes of what was added.

    `takes_back` marks days on which a fare was taken back.
    """
    some = F.col("fare").isNotNull()
    added = F.when(F.col("n") > 0, F.col("fare"))
    return changes.groupBy("pickup_date").agg(
        F.sum((F.col("fare") * F.col("n")).cast(TOTAL)).cast(TOTAL).alias("total_fare"),
        F.sum("n").alias("count_trips"),
        F.coalesce(F.sum(F.when(some, F.col("n"))), F.lit(0)).cast("bigint").alias("fare_count"),
        F.max(added).cast(MONEY).alias("max_fare"),
        F.min(added).cast(MONEY).alias("min_fare"),
        F.coalesce(F.bool_or(some & (F.col("n") < 0)), F.lit(False)).alias("takes_back"),
    )


def net_fares(changes: DataFrame) -> DataFrame:
    """How often each fare counts on each day, over all the changes."""
    return changes.groupBy("pickup_date", "fare").agg(F.sum("n").alias("n")).where("n <> 0")


def extremes(fares: DataFrame) -> DataFrame:
    """(pickup_date, max_fare, min_fare) of the fares that count."""
    counted = net_fares(fares).where("n > 0")
    return counted.groupBy("pickup_date").agg(F.max("fare").alias("max_fare"), F.min("fare").alias("min_fare"))
