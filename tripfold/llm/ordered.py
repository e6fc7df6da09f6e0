"""Splits a table into key-ordered buckets without ordering its wide columns twice."""

from __future__ import annotations

import uuid
from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripfold.sources.paths import scratch_root


SAMPLED = 64  # rows looked at for each bucket
IN_ORDER = ("doc_id", "hash", "salt")


def partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def placed(docs: DataFrame) -> DataFrame:
    """doc_id, text (empty for null), and with it `hash` and `salt`, the further keys of the order of rows.

    Rows order by doc_id (null first), then by a hash of their text; of equal rows, any order will do, and the
    salt settles one. So rows of one id, or without one, are an order like any other, and can be cut anywhere.
    """
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"), F.xxhash64(F.monotonically_increasing_id()).alias("salt")
    )


def row_bounds(rows: DataFrame, buckets: int, least_bytes: int = 0) -> list[tuple]:
    """At most `buckets` - 1 ascending places in the order of the `placed` rows that cut them into shares of about one size.

    The size is bytes of text; with `least_bytes`, shares hold at least so many on average. One scan; the driver gets
    SAMPLED narrow rows for each bucket, chosen by their salt. They only steer the cut: results are the same for any bounds.
    """
    if buckets < 2:
        return []
    size, sizes = F.octet_length("text").cast("long"), Observation(f"bounds-{uuid.uuid4().hex}")
    counted = rows.select("doc_id", "hash", "salt", size.alias("size")).observe(sizes, F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    sample = counted.orderBy(F.xxhash64("salt"), "hash").limit(SAMPLED * buckets).collect()
    if least_bytes:
        buckets = int(max(1, min(buckets, (sizes.get["bytes"] or 0) // least_bytes)))
    keys = sorted((r.doc_id is not None, r.doc_id or 0, r.hash, r.salt, r.size + 16) for r in sample)
    whole, done, bounds = sum(k[-1] for k in keys), 0, []
    for key in keys:
        if len(bounds) + 1 < buckets and done * buckets >= whole * (len(bounds) + 1):
            bounds.append(key[:-1])
        done += key[-1]
    return sorted(set(bounds))


def bucket_of(bounds: list[tuple]) -> Column:
    """Number of bounds up to the place of a `placed` row, by binary search."""
    if not bounds:
        return F.lit(0)
    # flat arrays of longs are folded to constants; arrays of structs were built anew for every look
    known = [F.lit([int(x) for x in c]).cast("array<bigint>") for c in zip(*bounds, strict=True)]
    own = [F.col("doc_id").isNotNull().cast("long"), F.coalesce("doc_id", F.lit(0)), F.col("hash"), F.col("salt")]

    def halve(at: Column, _: Column) -> Column:
        middle = F.shiftright(at["low"] + at["high"], 1)
        up = F.lit(True)  # whether the bound in the middle lies at or below the row
        for values, mine in reversed(list(zip(known, own, strict=True))):
            value = F.get(values, middle)
            up = (value < mine) | ((value == mine) & up)
        moved = F.when(up, F.struct((middle + 1).alias("low"), at["high"].alias("high"))).otherwise(F.struct(at["low"].alias("low"), middle.alias("high")))
        return F.when(at["low"] < at["high"], moved).otherwise(at)

    start = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(len(bounds).bit_length() + 1)), start, halve, lambda at: at["low"])


def bucket_of_place(bounds: list[tuple], doc_id: int | None, text_hash: int, salt: int) -> int:
    """`bucket_of` for one row outside Spark's expressions."""
    return bisect_right(bounds, (doc_id is not None, doc_id or 0, text_hash, salt))


def by_bucket(df: DataFrame, bucket: str, bounds: list[tuple]) -> DataFrame:
    """One partition for each bucket."""
    return df.repartitionById(len(bounds) + 1, F.col(bucket).cast("int"))


def offsets(counts: DataFrame, order: str, size: str, name: str) -> DataFrame:
    """Adds the sum of `size` over the rows before. For tables of one row per bucket or file."""
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum(size).over(before), F.lit(0)))


def kept(df: DataFrame) -> DataFrame:
    """Written to a new folder of the shared scratch space and read from there: lineage ends here."""
    path = f"{scratch_root(df.sparkSession)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
