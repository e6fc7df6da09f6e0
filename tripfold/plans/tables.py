"""Event logs derived from the generated tables.

orders are starts and lineitem rows are ends of trip `orderkey`; in the second
log users are trips, sign-ups and views start them and purchases end them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfold.functions.scalars import wire_datetime
from tripfold.operators.events import tag_and_union
from tripfold.schemas import END_FIELDS, END_PAYLOAD, START_FIELDS, START_PAYLOAD

EVENT_COLUMNS = ["trip_id", "kind", "sequence", *START_FIELDS, *END_FIELDS]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sequence(at: str, rank: int, line="0", part="0L", supp="0L", price="0.0") -> str:
    """Order of an event: its time, starts before ends, then the line's own columns."""
    return (
        f"named_struct('at', {at}, 'rank', {rank}, 'line', int({line}), 'part', {part}, "
        f"'supp', {supp}, 'price', double({price})) as sequence"
    )


def order_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) as trip_id",
        _sequence("o_orderdate", 0),
        "cast(o_custkey as string) as pickup_location_id",
        "o_orderstatus as dropoff_location_id",
        "cast(1 + o_orderkey % 2 as string) as vendor_id",
        "o_orderdate as pickup_datetime",
        "o_orderdate + interval 1 hour as estimated_dropoff_datetime",
        "cast(o_totalprice as decimal(18,2)) as estimated_fare_amount",
    )


def line_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey as string) as trip_id",
        _sequence("l_shipdate", 1, "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"),
        "l_shipdate as dropoff_datetime",
        "cast(l_linenumber as decimal(18,2)) as rate_code",
        "cast(null as int) as passenger_count",
        "cast(l_quantity as decimal(18,2)) as trip_distance",
        "cast(l_extendedprice as decimal(18,2)) as fare_amount",
        "cast(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2)) as decimal(18,2))"
        " as tip_amount",
        "case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end as payment_type",
        "case l_linestatus when 'F' then 1 else 2 end as trip_type",
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from orders, ends from lineitem, as one log."""
    log = tag_and_union(order_starts(spark, sf_dir), line_ends(spark, sf_dir))
    return log.select(*EVENT_COLUMNS)


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of users over time."""
    return user_log(spark, sf_dir).where("kind is not null")


def user_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All user events; clicks and errors have neither time, and so no kind."""
    rows = table(spark, sf_dir, "events")
    is_start, is_end = F.expr("event_type in ('signup', 'view')"), F.expr("event_type = 'purchase'")
    at = F.col("ts").cast("timestamp_ntz")
    values = {
        "vendor_id": F.col("event_type"),
        "pickup_datetime": at,
        "estimated_fare_amount": F.col("value").cast("decimal(18,2)"),
        "dropoff_datetime": at,
        "fare_amount": F.col("value").cast("decimal(18,2)"),
    }

    def column(field, mine):
        value = values.get(field.name, F.lit(None))
        return F.when(mine, value).cast(field.dataType).alias(field.name)

    return rows.select(
        F.col("user_id").cast("string").alias("trip_id"),
        F.when(is_end, "end").when(is_start, "start").alias("kind"),
        F.col("event_id").alias("sequence"),
        *[column(f, is_start) for f in START_PAYLOAD],
        *[column(f, is_end) for f in END_PAYLOAD],
    )


def presented(df: DataFrame) -> DataFrame:
    """Dates and times as text and numbers as double, for comparing engines."""

    def column(name, dtype):
        col = F.col(name)
        if dtype == "date":
            col = col.cast("string")
        elif dtype.startswith("timestamp"):
            col = wire_datetime(col)
        elif dtype.startswith("decimal") or dtype == "int":
            col = col.cast("double")
        return col.alias(name)

    return df.select(*[column(n, t) for n, t in df.dtypes])
