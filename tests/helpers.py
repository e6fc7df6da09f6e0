"""Event builders and a brute-force fold to compare with."""

from __future__ import annotations

import base64
import json
from datetime import datetime
from decimal import Decimal

from pyspark.sql.types import LongType, StringType, StructType

from tripfold.schemas import END_PAYLOAD, START_PAYLOAD

EVENT_SCHEMA = StructType()
EVENT_SCHEMA = (
    EVENT_SCHEMA.add("trip_id", StringType()).add("kind", StringType()).add("sequence", LongType())
)
for _field in [*START_PAYLOAD.fields, *END_PAYLOAD.fields]:
    EVENT_SCHEMA = EVENT_SCHEMA.add(_field)


def when(text):
    """'05-25 13:19' in 2024."""
    return None if text is None else datetime.strptime(f"2024-{text}", "%Y-%m-%d %H:%M")


def money(value):
    return None if value is None else Decimal(str(value)).quantize(Decimal("0.01"))


def start(trip_id, pickup, est=None, vendor=None):
    return {
        "trip_id": trip_id,
        "kind": "start",
        "pickup_datetime": when(pickup),
        "estimated_fare_amount": money(est),
        "vendor_id": vendor,
    }


def end(trip_id, dropoff, fare):
    return {
        "trip_id": trip_id,
        "kind": "end",
        "dropoff_datetime": when(dropoff),
        "fare_amount": money(fare),
    }


def numbered(events):
    return [{**e, "sequence": i} for i, e in enumerate(events)]


def event_log(spark, events):
    rows = [tuple(e.get(c) for c in EVENT_SCHEMA.names) for e in events]
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def envelope(payload) -> str:
    text = payload if isinstance(payload, (str, bytes)) else json.dumps(payload)
    return base64.b64encode(text.encode() if isinstance(text, str) else text).decode()


def wire(event) -> str:
    """An event as envelope data."""
    fields = {k: v for k, v in event.items() if k not in ("kind", "sequence") and v is not None}
    for name, value in fields.items():
        if isinstance(value, datetime):
            fields[name] = value.strftime("%Y-%m-%d %H:%M:%S")
        elif isinstance(value, Decimal):
            fields[name] = float(value)
    return envelope(fields)


def brute_force(events):
    """(first completions, change records, final states) by replaying the log per trip."""
    first, changes, state = [], [], {}
    for e in sorted(events, key=lambda e: e["sequence"]):
        payload = START_PAYLOAD if e["kind"] == "start" else END_PAYLOAD
        before = state.get(e["trip_id"], {})
        after = {**before, e["kind"]: tuple(e.get(f) for f in payload.names)}
        state[e["trip_id"]] = after
        if not before:
            changes.append((e["trip_id"], e["sequence"], "INSERT"))
        elif before != after:
            changes.append((e["trip_id"], e["sequence"], "MODIFY"))
        if len(after) == 2 and len(before) < 2:
            first.append((e["trip_id"], e["sequence"], *after["start"], *after["end"]))
    return first, changes, state
