"""Registered queries: each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfold.functions.scalars import wire_datetime
from tripfold.operators import kpi, metrics, sampling, staging, trips
from tripfold.operators.envelope import decode_envelopes, encode_envelopes
from tripfold.operators.events import good_events, quarantine
from tripfold.operators.events import route_events as route
from tripfold.operators.skew import FLOOR_CONF
from tripfold.plans.tables import (
    line_ends,
    order_events,
    order_starts,
    presented,
    table,
    user_events,
    user_log,
)
from tripfold.schemas import END_FIELDS, END_TEXTS, STAGING_FIELDS, START_FIELDS, START_TEXTS
from tripfold.sources import readers
from tripfold.sources.kpi_store import KpiStore
from tripfold.sources.paths import make_dir, rename, scratch_root
from tripfold.sources.trip_table import TripTable
from tripfold.sources.writers import write_bodies, write_envelopes
from tripfold.streaming.jobs import TripJob, run_batch, start_message_stream, start_stream

PICKUP, FARE = ["pickup_datetime"], ["fare_amount"]
SAMPLE_TRIPS = 10  # fixed value: default size of a matched sample

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    """Registers a query under the function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return presented(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return build


def fares_of_trips(events: DataFrame, unique_sequence: bool = False) -> DataFrame:
    """Completed trips in their current state, pickup time and fare only."""
    return trips.completed_trips(trips.assemble_trips(events, PICKUP, FARE, unique_sequence))


# --- trips -----------------------------------------------------------------


@query
def assemble_trips(spark, sf_dir):
    folded = trips.assemble_trips(order_events(spark, sf_dir))
    return folded.withColumns(
        {c: F.col(c).cast("int").cast("bigint") for c in ("has_start", "has_end")}
    )


@query
def assemble_trips_table(spark, sf_dir):
    """The same through four deliveries into the table of trips; each rewrites the slots of its trips."""
    events = order_events(spark, sf_dir)
    name = f"trips_{uuid.uuid4().hex}"
    table_of_trips = TripTable(spark, scratch_root(spark), name, slots=4, buckets=8)
    for n in range(4):
        table_of_trips.update(events.where(F.pmod(F.xxhash64("trip_id", "kind"), F.lit(4)) == n))
    return table_of_trips.trips().withColumns({c: F.col(c).cast("int").cast("bigint") for c in ("has_start", "has_end")})


@query
def completed_trips(spark, sf_dir):
    return trips.completed_trips(trips.assemble_trips(order_events(spark, sf_dir)))


@query
def open_trips(spark, sf_dir):
    folded = trips.assemble_trips(order_events(spark, sf_dir), PICKUP, ["dropoff_datetime"])
    return trips.open_trips(folded).select("trip_id", "pickup_datetime", "dropoff_datetime")


@query
def first_completion(spark, sf_dir):
    done = trips.first_completion(trips.trip_history(order_events(spark, sf_dir)))
    return done.drop("sequence")


@query
def change_feed(spark, sf_dir):
    return trips.change_feed(trips.trip_history(user_events(spark, sf_dir)))


@query
def modified_trips(spark, sf_dir):
    changes = trips.change_feed(trips.trip_history(order_events(spark, sf_dir)))
    return trips.modified(changes).drop("sequence")


# --- daily KPIs ------------------------------------------------------------


@query
def kpi_daily(spark, sf_dir):
    return kpi.daily_kpis(fares_of_trips(order_events(spark, sf_dir)))


@query
def kpi_first_completion(spark, sf_dir):
    history = trips.trip_history(order_events(spark, sf_dir), PICKUP, FARE)
    return kpi.daily_kpis(trips.first_completion(history, PICKUP, FARE))


@query
def kpi_change_feed_mode(spark, sf_dir):
    changes = trips.change_feed(trips.trip_history(order_events(spark, sf_dir)))
    return kpi.daily_kpis(trips.modified(changes))


@query
def kpi_null_fares(spark, sf_dir):
    events = order_events(spark, sf_dir)
    no_fare = F.expr("kind = 'end' and rate_code = 7")
    events = events.withColumn("fare_amount", F.when(~F.coalesce(no_fare, F.lit(False)), F.col("fare_amount")))
    return kpi.daily_kpis(fares_of_trips(events))


def _ledger_batches(spark: SparkSession, fares: DataFrame, batches: int) -> tuple[str, list[DataFrame]]:
    """Completed trips, written once and read back as `batches` disjoint parts."""
    root = scratch_root(spark)
    parts = fares.withColumn("part", F.pmod(F.xxhash64("trip_id"), F.lit(batches)))
    parts.write.partitionBy("part").parquet(f"{root}/completed")
    ledger = spark.read.schema(parts.schema).parquet(f"{root}/completed")
    return root, [ledger.where(F.col("part") == n) for n in range(batches)]


@query
def kpi_incremental(spark, sf_dir):
    """Four batches through the KPI store, with a replay and a compaction."""
    root, batches = _ledger_batches(spark, fares_of_trips(order_events(spark, sf_dir)), 4)
    store = KpiStore(spark, f"{root}/kpi", "incremental")
    for batch_id, batch in enumerate(batches):
        store.append(kpi.partials(kpi.dated(batch)), batch_id)
    store.append(kpi.partials(kpi.dated(batches[3])), 3)
    store.compact(1)
    return store.kpis()


@query
def kpi_merge(spark, sf_dir):
    """Partials of three kinds of trips, merged without a store."""
    fares = trips.completed_trips(
        trips.assemble_trips(order_events(spark, sf_dir), PICKUP, ["fare_amount", "payment_type"])
    )
    keyed = kpi.dated(fares, "payment_type")
    return kpi.finalize(kpi.merge_partials(kpi.partials(keyed, "payment_type")))


@query
def kpi_published(spark, sf_dir):
    """KPIs of the users' trips as the table partitioned by pickup day."""
    fares = fares_of_trips(user_events(spark, sf_dir), unique_sequence=True)  # event ids: folded without a sort
    store = KpiStore(spark, f"{scratch_root(spark)}/kpi", "published")
    moved = fares.withColumn("pickup_datetime", F.expr("pickup_datetime - interval 4000 days"))
    store.append(kpi.partials(kpi.dated(moved)), 0)  # a first version of the batch, on other days
    store.publish([0])
    store.append(kpi.partials(kpi.dated(fares)), 0)
    store.publish([0])
    return store.published()


# --- envelopes and routing -------------------------------------------------


@query
def envelope_roundtrip(spark, sf_dir):
    events = good_events(route(decode_envelopes(encode_envelopes(order_events(spark, sf_dir)))))
    return events.drop("sequence")


def mixed_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope per row of `events`; most kinds are broken in some way."""
    start = F.format_string(
        '{"trip_id": "u%d", "pickup_datetime": "%s"}',
        F.col("user_id"),
        wire_datetime(F.col("ts")),
    )
    cut_short = F.expr("substring(props, 1, length(props) - 1)")
    text = (
        F.when(F.expr("event_type = 'signup'"), start)
        .when(F.expr("event_type = 'view'"), cut_short)
        .when(F.expr("event_type = 'purchase'"), F.concat(F.lit("["), "props", F.lit("]")))
    )
    data = (
        F.when(F.expr("event_type = 'error'"), F.concat(F.lit("%%"), F.col("props")))
        .when(F.expr("event_type = 'click'"), F.base64(F.unhex(F.lit("FFFE"))))
        .otherwise(F.base64(F.encode(text, "UTF-8")))
    )
    return table(spark, sf_dir, "events").select(
        data.alias("data"),
        F.col("user_id").cast("string").alias("partition_key"),
        F.col("event_id").alias("sequence"),
    )


@query
def decode_quarantine(spark, sf_dir):
    routed = route(decode_envelopes(mixed_envelopes(spark, sf_dir)))
    return quarantine(routed, "ingest").select("stage", "reason", "sequence")


@query
def batch_counters(spark, sf_dir):
    return metrics.batch_counters(route(decode_envelopes(mixed_envelopes(spark, sf_dir))))


@query
def quarantine_reasons(spark, sf_dir):
    return metrics.reasons(route(decode_envelopes(mixed_envelopes(spark, sf_dir))))


@query
def route_events(spark, sf_dir):
    """Events whose ids are JSON numbers (0 is no id) and whose times may be empty."""
    at = wire_datetime(F.col("ts"))
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("sequence"),
        F.base64(
            F.encode(
                F.to_json(
                    F.struct(
                        F.col("user_id").alias("trip_id"),
                        F.expr("case when event_type = 'view' then '' end").alias("note"),
                        F.when(F.expr("event_type in ('signup', 'click')"), at)
                        .when(F.expr("event_type = 'view'"), "")
                        .when(F.expr("event_type = 'error'"), "25/05/2024")
                        .alias("pickup_datetime"),
                        F.when(F.expr("event_type in ('purchase', 'click')"), at).alias("dropoff_datetime"),
                    )
                ),
                "UTF-8",
            )
        ).alias("data"),
    )
    routed = route(decode_envelopes(rows))
    return routed.groupBy("kind", "reason").agg(F.count("*").alias("events"))


# --- staging and messages --------------------------------------------------


@query
def unwrap_image(spark, sf_dir):
    """Change records with typed attributes, unwrapped and staged."""
    images = staging.wrap_trips(user_events(spark, sf_dir).drop("kind"))
    records = images.select(
        "sequence",
        F.expr("case when vendor_id = 'signup' then 'INSERT' else 'MODIFY' end").alias("event_name"),
        F.expr("case when fare_amount < 10 then '{}' else image end").alias("image"),
    )
    return staging.messages_to_staging(staging.unwrap_changes(records)).drop("image", "event_name")


@query
def staging_cast(spark, sf_dir):
    """All-string rows with unreadable fares and days, cast tolerantly."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("trip_id"),
        F.expr(
            "case l_linenumber when 7 then 'abc' when 6 then 'NaN' when 5 then '' when 4 then null "
            "else concat(' ', cast(cast(l_extendedprice as decimal(18,2)) as string), ' ') end"
        ).alias("fare_amount"),
        F.expr(
            "case l_returnflag when 'R' then '25/05/2024' "
            "else substring(cast(l_shipdate as string), 1, 19) end"
        ).alias("pickup_datetime"),
    )
    cast = staging.cast_staging(staging.to_staging(rows))
    return cast.select("trip_id", "fare_amount", "fare", "pickup_date", "reason", "warning")


@query
def message_bodies(spark, sf_dir):
    """Completed trips as JSON bodies, parsed back into the 14 staging strings."""
    done = trips.completed_trips(trips.assemble_trips(order_events(spark, sf_dir)))
    return staging.parse_bodies(staging.to_bodies(done)).select(*STAGING_FIELDS)


# --- sources ---------------------------------------------------------------


@query
def csv_scan(spark, sf_dir):
    """CSV files of one folder with their columns in different orders, integers as `1.0` and unreadable lines."""
    root = scratch_root(spark)
    order_starts(spark, sf_dir).drop("sequence").write.csv(f"{root}/starts", header=True)
    ends = line_ends(spark, sf_dir).drop("sequence")
    ends = ends.withColumns(
        {
            "trip_type": F.concat(F.col("trip_type").cast("string"), F.lit(".0")),
            "dropoff_datetime": F.expr("case when rate_code = 7 then '25/05/2024' else cast(dropoff_datetime as string) end"),
            "tip_amount": F.expr("case when rate_code = 6 then 'abc' else cast(tip_amount as string) end"),
        }
    )
    even = F.col("rate_code") % 2 == 0
    ends.where(~even).select(*[c for c in ends.columns if c != "trip_id"], "trip_id").write.csv(f"{root}/ends", header=True)
    ends.where(even).drop("passenger_count").withColumn("other", F.lit("x,y")).write.mode("append").csv(f"{root}/ends", header=True)
    starts = readers.read_starts_csv(spark.read, f"{root}/starts")
    ends = readers.read_ends_csv(spark.read, f"{root}/ends")
    rows = starts.select("trip_id", F.lit("start").alias("kind"), "pickup_datetime", "estimated_fare_amount", "reason", "warning")
    return rows.unionByName(
        ends.select("trip_id", F.lit("end").alias("kind"), "dropoff_datetime", "fare_amount", "tip_amount", "trip_type", "reason", "warning"),
        allowMissingColumns=True,
    )


@query
def envelope_batches(spark, sf_dir):
    """Envelopes delivered as `Records` arrays with text sequences, folded into trips."""
    root = scratch_root(spark)
    encoded = encode_envelopes(user_log(spark, sf_dir))
    record = F.struct(
        F.struct(
            "data",
            F.col("partition_key").alias("partitionKey"),
            F.col("sequence").cast("string").alias("sequenceNumber"),
        ).alias("kinesis")
    )
    encoded.select(F.array(record).alias("Records")).write.json(f"{root}/records")
    events = readers.read_envelope_batches(spark.read, f"{root}/records")
    return trips.assemble_trips(good_events(route(decode_envelopes(events))), PICKUP, FARE).select(
        "trip_id", "pickup_datetime", "fare_amount"
    )


@query
def change_batches(spark, sf_dir):
    """Change records delivered as `Records` arrays, some without an image, counted per outcome."""
    root = scratch_root(spark)
    changes = trips.change_feed(trips.trip_history(user_events(spark, sf_dir)))
    image = F.from_json("image", "map<string,map<string,string>>")
    record = F.struct(
        F.col("event_name").alias("eventName"),
        F.struct(
            F.when(F.expr("sequence % 5 <> 0"), image).alias("NewImage"),
            F.col("sequence").cast("string").alias("SequenceNumber"),
        ).alias("dynamodb"),
    )
    images = staging.wrap_trips(changes)
    images.select(F.array(record).alias("Records")).write.json(f"{root}/changes")
    unwrapped = staging.unwrap_changes(readers.read_change_batches(spark.read, f"{root}/changes"))
    numbers = unwrapped.agg(F.min("sequence.number").alias("any"), F.max("sequence").alias("last")).select("last.number")
    return metrics.batch_counters(unwrapped).crossJoin(numbers.withColumnRenamed("number", "last_sequence"))


@query
def field_warnings(spark, sf_dir):
    """Events with unreadable times and amounts, and amounts and times with more digits than usual."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("trip_id"),
        F.expr("case l_linenumber when 7 then '25/05/2024' else substring(cast(l_shipdate as string), 1, 19) || '.25' end").alias("dropoff_datetime"),
        F.expr("case l_linenumber when 6 then 'abc' when 5 then '12.345' else '1.5' end").alias("tip_amount"),
        F.expr("case l_linenumber when 6 then 'x' when 4 then '1.0' else '1' end").alias("payment_type"),
    )
    data = F.base64(F.encode(F.to_json(F.struct(*rows.columns)), "UTF-8"))
    routed = route(decode_envelopes(rows.select(data.alias("data"))))
    return routed.groupBy("reason", "warning", "dropoff_datetime").agg(
        F.count("*").alias("events"), F.sum("tip_amount").alias("tips"), F.sum("payment_type").alias("payments")
    )


@query
def repeated_sequences(spark, sf_dir):
    """Writes of one sequence: the greatest payload wins as a whole."""
    rows = line_ends(spark, sf_dir).select("trip_id", F.lit("end").alias("kind"), F.lit(1).alias("sequence"), "fare_amount", "tip_amount")
    rows = rows.withColumn("tip_amount", F.expr("case when tip_amount > 100 then tip_amount end"))
    return trips.assemble_trips(rows, [], ["fare_amount", "tip_amount"]).select("trip_id", "fare_amount", "tip_amount")


@query
def change_feed_coded(spark, sf_dir):
    """Every third write is repeated but for the passenger count, and every fifth with its time spelled in another way.

    The first is no change, the second is one, though the time is the same.
    """
    events = user_events(spark, sf_dir)
    wire = events.withColumns({c: wire_datetime(F.col(c)) for c, t in events.dtypes if t == "timestamp_ntz"})
    again = wire.where("sequence % 3 = 0").withColumns(
        {"sequence": F.expr("sequence * 10 + 3"), "passenger_count": F.expr("case when kind = 'end' then 4 end")}
    )
    respelled = wire.where("sequence % 5 = 0").withColumns(
        {"sequence": F.expr("sequence * 10 + 5"), **{c: F.translate(c, " ", "T") for c in ("pickup_datetime", "dropoff_datetime")}}
    )
    wire = wire.withColumn("sequence", F.expr("sequence * 10")).unionByName(again).unionByName(respelled)
    events = good_events(route(decode_envelopes(encode_envelopes(wire)), keep_texts=True))
    fields = [*START_FIELDS, *START_TEXTS], [*END_FIELDS, *END_TEXTS]
    changes = trips.change_feed(trips.trip_history(events, *fields), *fields)
    return changes.groupBy("trip_id").agg(F.count("*").alias("changes"), F.max("sequence").alias("last_sequence"))


@query
def hot_trip(spark, sf_dir):
    """A third of all events in one trip, at one moment, split over tasks."""
    rows = order_events(spark, sf_dir).where("kind = 'end'")
    hot = F.expr("cast(trip_id as bigint) % 3 = 0")
    rows = rows.withColumn("trip_id", F.when(hot, "hot").otherwise(F.col("trip_id")))
    before = spark.conf.get(FLOOR_CONF, None)
    spark.conf.set(FLOOR_CONF, "1")
    try:
        changes = trips.change_feed(trips.trip_history(rows, [], ["fare_amount"]), [], ["fare_amount"])
    finally:
        spark.conf.unset(FLOOR_CONF) if before is None else spark.conf.set(FLOOR_CONF, before)
    return changes.groupBy("trip_id").agg(F.sum(F.expr("cast(event_name = 'INSERT' as bigint)")).alias("inserts"), F.max_by("fare_amount", "sequence").alias("fare_amount"))


# --- sampling --------------------------------------------------------------


@query
def matched_sample(spark, sf_dir):
    sample = sampling.matched_sample(order_events(spark, sf_dir), SAMPLE_TRIPS, seed=42)
    return sample.select("trip_id", "kind", "pickup_datetime", "dropoff_datetime", "fare_amount")


@query
def interleave(spark, sf_dir):
    events = user_events(spark, sf_dir).withColumn("event", F.col("sequence").cast("string"))
    return sampling.interleaved(events, tie="event", seed=42).select("trip_id", "kind", "event", "sequence")


@query
def interleave_keys(spark, sf_dir):
    events = user_events(spark, sf_dir).withColumn("event", F.col("sequence").cast("string"))
    return sampling.shuffled(events, tie="event", seed=42).select("trip_id", "kind", "event", "sequence")


# --- streams ---------------------------------------------------------------


def _slices(df: DataFrame, order: str, n: int) -> list[DataFrame]:
    """The rows as `n` consecutive ranges of `order`."""
    low, high = df.agg(F.min(order), F.max(order)).first()
    at = F.least(F.lit(n - 1), F.floor((F.col(order) - low) * n / (high - low + 1)))
    return [df.where(at == i) for i in range(n)]


def _run_stream(spark: SparkSession, log: DataFrame, mode: str) -> TripJob:
    """Lands the events in three deliveries; one running stream folds each as it comes."""
    root = scratch_root(spark)
    job = TripJob(f"{root}/job", "users", mode)
    make_dir(spark, f"{root}/log")
    source = readers.retiring(spark.readStream, f"{root}/consumed").option("recursiveFileLookup", True)
    stream = start_stream(readers.read_envelopes(source, f"{root}/log"), job, processingTime="100 milliseconds")
    try:
        for n, part in enumerate(_slices(log, "sequence", 3)):
            write_envelopes(part, f"{root}/staged/{n}")
            rename(spark, f"{root}/staged/{n}", f"{root}/log/{n}")  # in one step: one batch
            stream.processAllAvailable()
    finally:
        stream.stop()
    return job


@query
def stream_kpi(spark, sf_dir):
    return _run_stream(spark, user_log(spark, sf_dir), "documented").store(spark).kpis()


@query
def stream_kpi_change_feed(spark, sf_dir):
    return _run_stream(spark, user_log(spark, sf_dir), "change_feed").store(spark).kpis()


@query
def kpi_corrections_stream(spark, sf_dir):
    """Trips that later events move to other days and fares, published."""
    return _run_stream(spark, user_log(spark, sf_dir), "corrected").store(spark).published()


@query
def open_trips_stream(spark, sf_dir):
    """Open trips of a stopped stream, from its state store. A user's events make up many trips."""
    log = user_log(spark, sf_dir).withColumn("trip_id", F.expr("concat(trip_id, '/', cast(sequence % 50 as string))"))
    waiting = _run_stream(spark, log, "documented").open_trips(spark)
    return waiting.select("trip_id", "vendor_id", "pickup_datetime", "dropoff_datetime", "fare_amount")


@query
def stream_counters(spark, sf_dir):
    """Counters of four batches of envelopes, mostly broken, over two restarts of the stream."""
    root = scratch_root(spark)
    job = TripJob(f"{root}/job", "users", publish=False)
    for part in _slices(mixed_envelopes(spark, sf_dir), "sequence", 4):
        part.write.mode("append").json(f"{root}/log")
        start_stream(readers.read_envelopes(spark.readStream, f"{root}/log"), job).awaitTermination()
    return job.counters(spark)


@query
def kpi_two_pipelines(spark, sf_dir):
    """Trips split over two jobs on one root, each with its own numbers and state."""
    root, events = scratch_root(spark), user_log(spark, sf_dir)
    for part in (0, 1):
        job = TripJob(f"{root}/job", f"p{part}")
        run_batch(encode_envelopes(events.where(F.pmod(F.col("trip_id").cast("bigint"), F.lit(2)) == part)), job)
    return job.store(spark).published()


@query
def kpi_batch_then_stream(spark, sf_dir):
    """One batch, one without events, then a stream, all of one job."""
    root = scratch_root(spark)
    job = TripJob(f"{root}/job", "users")
    first, second = _slices(user_log(spark, sf_dir), "sequence", 2)
    run_batch(encode_envelopes(first), job)
    run_batch(encode_envelopes(first.limit(0)), job)
    write_envelopes(second, f"{root}/log")
    start_stream(readers.read_envelopes(spark.readStream, f"{root}/log"), job).awaitTermination()
    return job.store(spark).kpis()


@query
def message_stream_kpi(spark, sf_dir):
    """Completed-trip messages as a file stream, folded into the KPI table."""
    root = scratch_root(spark)
    done = trips.completed_trips(trips.assemble_trips(user_events(spark, sf_dir)))
    write_bodies(done.repartition(10), f"{root}/messages")
    bodies = readers.read_bodies(spark.readStream.option("maxFilesPerTrigger", 2), f"{root}/messages")
    staged = staging.parse_bodies(bodies)
    start_message_stream(staged, f"{root}/job", "messages", compact_every=2).awaitTermination()
    return KpiStore(spark, f"{root}/job/kpi", "messages").kpis()
