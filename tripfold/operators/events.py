"""Validation and routing of decoded events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.functions.scalars import computed_once, field_warning, is_truthy, joined_warnings, typed, variant_text
from tripfold.operators.envelope import TYPED_FIELDS
from tripfold.schemas import END_PAYLOAD, END_TEXTS, START_PAYLOAD, START_TEXTS
from tripfold.session import compile_in_parts


def route_events(decoded: DataFrame, keep_texts: bool = False) -> DataFrame:
    """Types the payload, adds `kind`, and extends `reason` and `warning`.

    A truthy pickup time makes a start, else a truthy dropoff time makes an end.
    Only the fields of the routed kind are filled. Rows with a `reason` are out,
    among them events whose own time is unreadable; a `warning` names the other
    fields that are unreadable (and count as missing) or lose digits. With `keep_texts`, the
    times' wire texts stay beside them (`START_TEXTS`, `END_TEXTS`).
    """
    compile_in_parts(decoded.sparkSession)
    doc = F.col("doc")
    # the texts of the typed fields are columns of their own: each is mentioned often, and read once
    flagged = decoded.withColumns({f"_{f}_text": variant_text(doc[f]) for f in TYPED_FIELDS}).withColumns(
        {
            "_has_id": is_truthy(doc["trip_id"], F.col("_trip_id_text")),
            "_has_pickup": is_truthy(doc["pickup_datetime"], F.col("_pickup_datetime_text")),
            "_has_dropoff": is_truthy(doc["dropoff_datetime"], F.col("_dropoff_datetime_text")),
        }
    ).withColumn("kind", F.when(F.col("_has_pickup"), "start").when(F.col("_has_dropoff"), "end"))

    warnings, texts = [], {}
    columns = {"trip_id": F.when(F.col("_has_id"), F.col("_trip_id_text"))}
    for kind, payload in (("start", START_PAYLOAD), ("end", END_PAYLOAD)):
        for field in payload:
            text = doc[field.name]
            if field.name in TYPED_FIELDS:
                text = F.col(f"_{field.name}_text")
            columns[field.name] = F.when(F.col("kind") == kind, typed(text, field.dataType))
            if keep_texts and f"{field.name}_text" in (*START_TEXTS, *END_TEXTS):
                texts[f"{field.name}_text"] = F.when(F.col("kind") == kind, text)
            # over the typed column, which is computed once in the projection below
            warning = field_warning(text, F.col(field.name), field.name, field.dataType)
            if warning is not None:
                warnings.append(F.when(F.col("kind") == kind, warning))

    unordered = F.col("sequence").isNull() if "sequence" in decoded.columns else F.lit(False)
    no_pickup = (F.col("kind") == "start") & F.col("pickup_datetime").isNull()
    no_dropoff = (F.col("kind") == "end") & F.col("dropoff_datetime").isNull()
    reason = (
        F.when(F.col("reason").isNotNull(), F.col("reason"))
        .when(~F.col("_has_id"), "missing_trip_id")
        .when(F.col("kind").isNull(), "missing_datetimes")
        .when(unordered, "missing_sequence")
        .when(no_pickup, "bad_pickup_datetime")
        .when(no_dropoff, "bad_dropoff_datetime")
    )
    return computed_once(
        flagged.withColumns({**columns, **texts})
        .withColumns({"reason": reason, "_warnings": joined_warnings(warnings)})
        .withColumn("warning", F.when(F.col("reason").isNull(), F.col("_warnings")))
        .withColumn("kind", F.when(F.col("reason").isNull(), F.col("kind")))
        .drop("doc", "_has_id", "_has_pickup", "_has_dropoff", "_warnings", *[f"_{f}_text" for f in TYPED_FIELDS])
    )


def good_events(routed: DataFrame) -> DataFrame:
    texts = [c for c in (*START_TEXTS, *END_TEXTS) if c in routed.columns]
    return routed.where("reason is null").select(
        "trip_id", "kind", "sequence", *START_PAYLOAD.names, *END_PAYLOAD.names, *texts
    )


def quarantine(rows: DataFrame, stage: str, raw: str = "data") -> DataFrame:
    """Rejected rows and warnings, in the quarantine layout."""

    def column(name):
        return F.col(name) if name in rows.columns else F.lit(None)

    sequence = column("sequence")
    if "sequence" in rows.columns and rows.schema["sequence"].dataType.typeName() == "struct":
        sequence = F.to_json(sequence)
    return rows.select(
        F.lit(stage).alias("stage"),
        F.coalesce(column("reason"), column("warning")).alias("reason"),
        column("trip_id").cast("string").alias("trip_id"),
        F.col(raw).cast("string").alias("raw"),
        sequence.cast("string").alias("sequence"),
    ).where("reason is not null")


def tag_and_union(starts: DataFrame, ends: DataFrame) -> DataFrame:
    """One event log from typed start and end tables (the tag is `kind`)."""
    return starts.withColumn("kind", F.lit("start")).unionByName(
        ends.withColumn("kind", F.lit("end")), allowMissingColumns=True
    )
