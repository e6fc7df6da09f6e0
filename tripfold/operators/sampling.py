"""Matched samples of trips and shuffled event logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RANGES_A_TASK = 4


def _digest(seed: int, *parts: Column) -> Column:
    """Repeatable pseudo-random text for a row; the same in any engine with md5."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))


def matched_sample(events: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """All events of `n` randomly chosen trips that have both a start and an end.

    The ids come from one combined aggregate and a top-n, not from joining starts
    with ends, so a trip with very many events emits no pairs. All matched trips
    are returned when there are no more than `n`.
    """
    kinds = events.groupBy("trip_id").agg(
        F.bool_or(F.col("kind") == "start").alias("has_start"),
        F.bool_or(F.col("kind") == "end").alias("has_end"),
    )
    chosen = (
        kinds.where("has_start and has_end")
        .select("trip_id")
        .orderBy(_digest(seed, F.col("trip_id")), "trip_id")
        .limit(n)
    )
    return events.join(chosen, "trip_id", "left_semi")


def interleaved(events: DataFrame, tie: str, seed: int = 0) -> DataFrame:
    """Replaces `sequence` by a repeatable random order without gaps, from 1.

    Rows are dealt into ranges of their digest (see `shuffled`), which are about equal because digests are. The
    rows of each range are counted, the ranges' first numbers are sums over that small table,
    and rows are numbered within their range: no task sees more than one range. Rows equal in
    trip, kind and `tie` are numbered in any order.
    """
    ranges = RANGES_A_TASK * int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = shuffled(events, tie, seed).withColumnRenamed("sequence", "_digest")
    at = F.floor(F.col("_digest") / F.lit(float(1 << 60)) * ranges).cast("int")
    keyed = keyed.withColumn("_range", at)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = keyed.groupBy("_range").agg(F.count("*").alias("n"))
    firsts = counts.select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_skip"))  # one row per range
    within = Window.partitionBy("_range").orderBy("_digest", "trip_id", "kind", tie)
    ranked = keyed.withColumn("_rank", F.row_number().over(within)).join(F.broadcast(firsts), "_range")
    return ranked.withColumn("sequence", F.col("_skip") + F.col("_rank")).select(*events.columns)


def shuffled(events: DataFrame, tie: str, seed: int = 0) -> DataFrame:
    """Replaces `sequence` by a repeatable random order.

    The order key is a 60-bit digest of trip, kind and `tie` (a text that tells a
    trip's events apart). `interleaved` numbers the rows in this order.
    """
    digest = _digest(seed, F.col("trip_id"), F.col("kind"), F.col(tie))
    return events.withColumn("sequence", F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"))
