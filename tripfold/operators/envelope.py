"""Event-log envelopes: base64 of one UTF-8 JSON object per event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.functions.scalars import (
    base64_bytes,
    computed_once,
    json_reason,
    utf8_text,
    wire_datetime,
    with_json_object,
)
from tripfold.schemas import END_FIELDS, START_FIELDS

# Fields whose JSON type matters stay typed; the others are read as text.
TYPED_FIELDS = ("trip_id", "pickup_datetime", "dropoff_datetime")
DOC_FIELDS = ", ".join(
    f"{f}: {'variant' if f in TYPED_FIELDS else 'string'}"
    for f in ["trip_id", *START_FIELDS, *END_FIELDS]
)


def encode_envelopes(events: DataFrame) -> DataFrame:
    """One envelope per event, keyed by trip.

    Narrow on purpose: the key and the sequence travel as columns, so no shuffle
    by trip is needed and a very large trip does not end up in one file.
    """
    payload = [
        (wire_datetime(F.col(c)) if dtype == "timestamp_ntz" else F.col(c)).alias(c)
        for c, dtype in events.dtypes
        if c not in ("kind", "sequence")
    ]
    body = F.to_json(F.struct(*payload))
    return events.select(
        F.base64(F.encode(body, "UTF-8")).alias("data"),
        F.col("trip_id").alias("partition_key"),
        "sequence",
    )


def decode_envelopes(envelopes: DataFrame) -> DataFrame:
    """Adds `doc` (the event's fields) and `reason` (NULL when decoding worked)."""
    reason = (
        F.when(F.col("_bytes").isNull(), "bad_base64")
        .when(F.col("_text").isNull(), "bad_utf8")
        .otherwise(json_reason(F.col("_text"), F.col("doc")))
    )
    texts = envelopes.withColumn("_bytes", base64_bytes(F.col("data"))).withColumn(
        "_text", utf8_text(F.col("_bytes"))
    )
    parsed = with_json_object(texts, "doc", "_text", DOC_FIELDS)
    return computed_once(parsed.withColumn("reason", reason).drop("_bytes", "_text"))
