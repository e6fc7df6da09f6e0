"""Column lists and schemas shared by every stage.

Datetimes are TIMESTAMP_NTZ: events carry wall-clock times without a zone, so a
pickup day must not move with the session time zone. Money is decimal(18,2),
which Spark sums exactly and keeps in a single machine word.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampNTZType,
)

MONEY = DecimalType(18, 2)
TOTAL = DecimalType(38, 2)
STRING, LONG, DOUBLE = StringType(), LongType(), DoubleType()
DATETIME, INT, DATE = TimestampNTZType(), IntegerType(), DateType()


def _struct(**fields: DataType) -> StructType:
    schema = StructType()
    for name, dtype in fields.items():
        schema = schema.add(name, dtype)
    return schema


# --- fixed values: field names, order and types of the two event kinds ---
START_PAYLOAD = _struct(
    pickup_location_id=STRING,
    dropoff_location_id=STRING,
    vendor_id=STRING,
    pickup_datetime=DATETIME,
    estimated_dropoff_datetime=DATETIME,
    estimated_fare_amount=MONEY,
)
END_PAYLOAD = _struct(
    dropoff_datetime=DATETIME,
    rate_code=MONEY,
    passenger_count=INT,
    trip_distance=MONEY,
    fare_amount=MONEY,
    tip_amount=MONEY,
    payment_type=INT,
    trip_type=INT,
)
# --- fixed values: completed-trip message, all strings, in message order ---
STAGING_FIELDS = (
    "trip_id",
    "fare_amount",
    "estimated_fare_amount",
    "estimated_dropoff_datetime",
    "pickup_location_id",
    "pickup_datetime",
    "dropoff_location_id",
    "rate_code",
    "trip_distance",
    "payment_type",
    "trip_type",
    "vendor_id",
    "tip_amount",
    "dropoff_datetime",
)

START_FIELDS = START_PAYLOAD.names
END_FIELDS = END_PAYLOAD.names
# Wire texts of the times, for a change feed that sees a time written in another way as a change.
START_TEXTS = [f"{f.name}_text" for f in START_PAYLOAD if f.dataType == DATETIME]
END_TEXTS = [f"{f.name}_text" for f in END_PAYLOAD if f.dataType == DATETIME]

_ID = _struct(trip_id=STRING)
START_SCHEMA = StructType(_ID.fields + START_PAYLOAD.fields)
END_SCHEMA = StructType(_ID.fields + END_PAYLOAD.fields)
TRIP_SCHEMA = StructType(START_SCHEMA.fields + END_PAYLOAD.fields)
STAGING_SCHEMA = _struct(**dict.fromkeys(STAGING_FIELDS, STRING))

# One envelope per row; the batched form nests them in a `Records` array.
ENVELOPE_SCHEMA = _struct(data=STRING, partition_key=STRING, sequence=LONG)
RECORDS_SCHEMA = _struct(
    Records=ArrayType(
        _struct(kinesis=_struct(data=STRING, partitionKey=STRING, sequenceNumber=STRING))
    )
)
CHANGE_RECORDS_SCHEMA = _struct(
    Records=ArrayType(
        _struct(eventName=STRING, dynamodb=_struct(NewImage=STRING, SequenceNumber=STRING))
    )
)

PARTIAL_SCHEMA = _struct(
    pickup_date=DATE,
    total_fare=TOTAL,
    count_trips=LONG,
    fare_count=LONG,
    max_fare=MONEY,
    min_fare=MONEY,
)
# A partial row in the store. Where `as_of` is set, the extremes are those of the pipeline's whole
# day up to that batch, and earlier rows' extremes no longer count.
STORED_SCHEMA = StructType([*PARTIAL_SCHEMA.fields, *_struct(batch=LONG, as_of=LONG).fields])
# How often a fare counts on a day; a taken-back one counts negative until it is merged.
FARES_SCHEMA = _struct(pickup_date=DATE, fare=MONEY, n=LONG)
KPI_SCHEMA = _struct(
    pickup_date=DATE,
    total_fare=DOUBLE,
    count_trips=LONG,
    average_fare=DOUBLE,
    max_fare=DOUBLE,
    min_fare=DOUBLE,
)
