"""Daily fare KPIs from mergeable partial aggregates.

A partial row is (total, trips, fares, max, min) per pickup day. Merging is
re-aggregation: associative and commutative, so any split of the trips into
batches gives the same table. Averages are derived last and never merged.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.schemas import MONEY, TOTAL


def dated(trips: DataFrame, *keep: str) -> DataFrame:
    """`pickup_date` and `fare` of typed trips."""
    return trips.select(
        *keep,
        F.col("pickup_datetime").cast("date").alias("pickup_date"),
        F.col("fare_amount").cast(MONEY).alias("fare"),
    )


def partials(fares: DataFrame, *extra_keys: str) -> DataFrame:
    """Partial KPIs per pickup day; trips without a day are left to the quarantine."""
    return (
        fares.where("pickup_date is not null")
        .groupBy(*extra_keys, "pickup_date")
        .agg(
            F.sum("fare").cast(TOTAL).alias("total_fare"),
            F.count("*").alias("count_trips"),
            F.count("fare").alias("fare_count"),
            F.max("fare").alias("max_fare"),
            F.min("fare").alias("min_fare"),
        )
    )


def merge_partials(*parts: DataFrame) -> DataFrame:
    """Folds partial rows of any number of batches into one row per day."""
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("pickup_date").agg(
        F.sum("total_fare").cast(TOTAL).alias("total_fare"),
        F.sum("count_trips").alias("count_trips"),
        F.sum("fare_count").alias("fare_count"),
        F.max("max_fare").alias("max_fare"),
        F.min("min_fare").alias("min_fare"),
    )


def finalize(merged: DataFrame) -> DataFrame:
    """Published KPI columns. The average is over trips that have a fare."""
    total = F.col("total_fare").cast("double")
    return merged.select(
        "pickup_date",
        total.alias("total_fare"),
        "count_trips",
        F.try_divide(total, F.col("fare_count")).alias("average_fare"),
        F.col("max_fare").cast("double").alias("max_fare"),
        F.col("min_fare").cast("double").alias("min_fare"),
    )


def daily_kpis(trips: DataFrame) -> DataFrame:
    return finalize(partials(dated(trips)))
