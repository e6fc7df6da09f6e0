"""Change records and completed-trip messages: unwrap, parse, stage and cast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.functions.scalars import (
    computed_once,
    json_reason,
    to_day,
    to_number,
    unwrap_attributes,
    wire_datetime,
    with_json_object,
)
from tripfold.schemas import STAGING_FIELDS

IMAGE_TYPE = "map<string,map<string,string>>"


def unwrap_changes(records: DataFrame) -> DataFrame:
    """Flat `message` map for every MODIFY record, with a `reason` for the rest.

    `records` has `event_name` and `image` (typed-attribute JSON text). Other
    change kinds are dropped before the image is parsed.
    """
    # in brackets, as in `with_json_object`: text behind the object counts as an error
    in_brackets = F.concat(F.lit("["), F.col("image"), F.lit("]"))
    parsed = (
        records.where("event_name = 'MODIFY'")
        .withColumn("_images", F.from_json(in_brackets, f"array<{IMAGE_TYPE}>"))
        .withColumn("_image", F.when(F.size("_images") == 1, F.get("_images", F.lit(0))))
        .drop("_images")
    )
    empty = F.col("image").isNull() | F.trim("image").isin("", "null", "{}")
    broken = F.col("_image").isNull() | F.exists(
        F.map_values("_image"), lambda v: v.isNull() | (F.size(v) == 0)
    )
    return computed_once(
        parsed.withColumn("reason", F.when(empty, "empty_image").when(broken, "bad_image"))
        .withColumn("message", F.when(F.col("reason").isNull(), unwrap_attributes(F.col("_image"))))
        .drop("_image")
    )


def messages_to_staging(unwrapped: DataFrame) -> DataFrame:
    """The 14 staging strings of every message; extra keys are dropped, `reason` is kept."""
    others = [c for c in unwrapped.columns if c != "message"]
    return unwrapped.select(
        *others, *[F.try_element_at("message", F.lit(f)).alias(f) for f in STAGING_FIELDS]
    )


def wrap_trips(trips: DataFrame) -> DataFrame:
    """Typed-attribute image text of each row (`S` and `N` attributes, nulls as `NULL`)."""
    attributes = []
    for field in trips.schema:
        col, name = F.col(field.name), field.name
        tag = "N" if field.dataType.typeName() in ("decimal", "integer", "long", "double") else "S"
        text = (
            wire_datetime(col)
            if field.dataType.typeName() == "timestamp_ntz"
            else col.cast("string")
        )
        null_tag = F.to_json(F.struct(F.lit(True).alias("NULL")))
        tagged = F.coalesce(F.when(col.isNotNull(), F.to_json(F.struct(text.alias(tag)))), null_tag)
        attributes.append(F.concat(F.lit(f'"{name}":'), tagged))
    return trips.withColumn("image", F.concat(F.lit("{"), F.concat_ws(",", *attributes), F.lit("}")))


def parse_bodies(bodies: DataFrame) -> DataFrame:
    """Staging strings from message bodies, with a `reason` for unusable ones."""
    fields = ", ".join(f"{f}: string" for f in STAGING_FIELDS)
    return computed_once(
        with_json_object(bodies, "_m", "body", fields)
        .withColumn("reason", json_reason(F.col("body"), F.col("_m")))
        .select(*bodies.columns, "reason", *[F.col(f"_m.{f}").alias(f) for f in STAGING_FIELDS])
    )


def to_bodies(trips: DataFrame) -> DataFrame:
    """Message bodies of completed trips."""
    return trips.select(
        F.to_json(F.struct(*stage_columns(trips)), {"ignoreNullFields": "false"}).alias("body")
    )


def stage_columns(trips: DataFrame) -> list:
    """The 14 staging columns as strings; missing ones are NULL, others are dropped."""
    types = dict(trips.dtypes)

    def text(name):
        if name not in types:
            return F.lit(None).cast("string").alias(name)
        if types[name] == "timestamp_ntz":
            return wire_datetime(F.col(name)).alias(name)
        return F.col(name).cast("string").alias(name)

    return [text(f) for f in STAGING_FIELDS]


def to_staging(trips: DataFrame) -> DataFrame:
    return trips.select(*stage_columns(trips))


def cast_staging(staging: DataFrame) -> DataFrame:
    """Adds `fare`, `pickup_date`, and a `reason` (no day) or `warning` (unreadable fare)."""
    earlier = F.col("reason") if "reason" in staging.columns else F.lit(None).cast("string")
    no_day = F.when(F.col("pickup_date").isNull(), "bad_pickup_datetime")
    bad_fare = F.expr("reason is null and fare_amount is not null and fare is null")
    return (
        staging.withColumn("fare", to_number(F.col("fare_amount")))
        .withColumn("pickup_date", to_day(F.col("pickup_datetime")))
        .withColumn("reason", F.coalesce(earlier, no_day))
        .withColumn("warning", F.when(bad_fare, "bad_fare"))
    )
