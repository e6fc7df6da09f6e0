"""Batch and streaming sources. `reader` is `spark.read` or `spark.readStream`."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripfold.functions.scalars import field_warning, joined_warnings, sequence_order, typed
from tripfold.schemas import (
    CHANGE_RECORDS_SCHEMA,
    END_SCHEMA,
    ENVELOPE_SCHEMA,
    RECORDS_SCHEMA,
    START_SCHEMA,
)
from tripfold.sources.paths import first_lines

CORRUPT = "_corrupt_record"
KEEP_ALL = "36500d"  # no file is too old for a stream to read


def csv_headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files under `path` by their header."""
    found: dict[tuple[str, ...], list[str]] = {}
    for file, line in sorted(first_lines(spark, path).items()):
        names = next(csv.reader([line.removeprefix("\ufeff")]), [])
        found.setdefault(tuple(names), []).append(file)
    return found


def _csv(reader, path: str, schema: StructType, time: str) -> DataFrame:
    """CSV with a header, read by column name, typed, with `reason` and `warning`.

    Columns may come in any order and unknown ones are ignored. Batch: files of one folder may have
    different headers; there is one scan for each header, and a column that a file
    lacks is null. Streams: all files must have the header of those that are there at the start. A line that
    does not fit its header, has no trip id or no
    readable `time` gets a `reason` and keeps its text in `_corrupt_record` if it
    could not be split; other unreadable fields give a `warning`.
    """
    spark = SparkSession.active()
    headers = csv_headers(spark, path)
    if not isinstance(reader, DataFrameReader) or not headers:
        headers = {tuple(spark.read.csv(path, header=True).columns): [path]}
    for names, files in headers.items():
        if "trip_id" not in names:
            raise ValueError(f"no trip_id column in {files[0]}")
    reader = reader.option("maxFileAge", KEEP_ALL)
    parts = [_csv_of_one_header(reader, names, files, schema, time) for names, files in headers.items()]
    return reduce(DataFrame.unionByName, parts)


def _csv_of_one_header(reader, names: tuple[str, ...], files: list[str], schema: StructType, time: str) -> DataFrame:
    texts = StructType([StructField(n, StringType()) for n in [*names, CORRUPT]])
    lines = reader.csv(
        files if isinstance(reader, DataFrameReader) else files[0],
        schema=texts, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, enforceSchema=False,
    )
    columns, warnings = {}, []
    for f in schema:
        text = F.col(f"`{f.name}`") if f.name in names else F.lit(None).cast("string")
        columns[f.name] = typed(text, f.dataType)
        if f.name not in ("trip_id", time):
            warnings.append(field_warning(text, columns[f.name], f.name, f.dataType))
    reason = (
        F.when(F.col(CORRUPT).isNotNull(), "bad_line")
        .when(F.coalesce(F.col("trip_id"), F.lit("")) == "", "missing_trip_id")
        .when(columns[time].isNull(), f"bad_{time}")
    )
    read = lines.select(
        *[c.alias(n) for n, c in columns.items()],
        reason.alias("reason"),
        joined_warnings(warnings).alias("warning"),
        F.col(CORRUPT),
    )
    return read.withColumn("warning", F.when(F.col("reason").isNull(), F.col("warning")))


def read_starts_csv(reader, path: str) -> DataFrame:
    return _csv(reader, path, StructType(START_SCHEMA.fields), "pickup_datetime")


def read_ends_csv(reader, path: str) -> DataFrame:
    return _csv(reader, path, StructType(END_SCHEMA.fields), "dropoff_datetime")


def retiring(reader, archive: str):
    """A streaming reader whose files Spark moves to the folder `archive`, outside of the source, once they are consumed."""
    return reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)


def read_envelopes(reader, path: str) -> DataFrame:
    """Flat envelopes, one JSON object per line."""
    return reader.option("maxFileAge", KEEP_ALL).schema(ENVELOPE_SCHEMA).json(path)


def read_envelope_batches(reader, path: str) -> DataFrame:
    """Envelopes delivered as `Records` arrays; a missing or empty array gives no rows."""
    record = F.col("r.kinesis")
    return (
        reader.option("maxFileAge", KEEP_ALL).schema(RECORDS_SCHEMA)
        .json(path)
        .select(F.explode("Records").alias("r"))
        .select(
            record["data"].alias("data"),
            record["partitionKey"].alias("partition_key"),
            sequence_order(record["sequenceNumber"]).alias("sequence"),
        )
    )


def read_change_batches(reader, path: str) -> DataFrame:
    """Change records delivered as `Records` arrays; images stay JSON text."""
    return (
        reader.option("maxFileAge", KEEP_ALL).schema(CHANGE_RECORDS_SCHEMA)
        .json(path)
        .select(F.explode("Records").alias("r"))
        .select(
            F.col("r.eventName").alias("event_name"),
            F.col("r.dynamodb.NewImage").alias("image"),
            sequence_order(F.col("r.dynamodb.SequenceNumber")).alias("sequence"),
        )
    )


def read_bodies(reader, path: str) -> DataFrame:
    """Completed-trip messages, one body per line."""
    return reader.option("maxFileAge", KEEP_ALL).text(path).withColumnRenamed("value", "body")
