"""Continuous trip KPIs.

Every micro-batch runs the batch operators; only the state of trips from earlier
batches is streaming state. Under `root`, with P the pipeline:

    runs/P/N               which batch of which run is number N of the pipeline
    landed/P/batch=N       routed events, one pass over the source
    rejected/P/batch=N     of these, the ones with a reason or a warning
    counters/P/N.json      one row: batch, records, success, failed, skipped, warnings
    state_in/P/batch=N     input of the state query (see TripStates)
    carry/P/batch=N        state, before batch N, of the trips that batch N touches
    completed/P/batch=N    completed trips (or changes), the forwarded messages
    kpi/...                see KpiStore
    checkpoints/P/...

A pipeline numbers its batches through, whichever run they come from: one stream,
a stream that starts over, or single batches. A number belongs to one batch of one run,
so nothing ever reuses or skips another run's folder.

All folders are shared storage, each is written whole for its batch, and a
replayed batch rewrites or reuses them: a crash at any point counts no trip
twice. `landed`, `state_in`, `carry` and old run files are removed once nothing can ask for
them again; `completed`, `rejected` and `counters` are results, whose retention is the storage's.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripfold.operators.corrections import current_trips, fare_changes
from tripfold.operators.envelope import decode_envelopes
from tripfold.operators.events import good_events, quarantine, route_events
from tripfold.operators.kpi import dated, partials
from tripfold.operators.metrics import batch_counters, counters, observed
from tripfold.operators.skew import HotKeys, hot_floor
from tripfold.operators.staging import cast_staging
from tripfold.operators.trips import (
    change_feed,
    event_writes,
    first_completion,
    modified,
    trip_history,
)
from tripfold.schemas import END_FIELDS, END_TEXTS, START_FIELDS, START_TEXTS
from tripfold.sources.kpi_store import KpiStore
from tripfold.sources.paths import child_names, create_file, is_complete, make_dir, numbered, remove
from tripfold.streaming.batch_log import BatchLog
from tripfold.streaming.states import WRITES, TripStates

DOCUMENTED = "documented"  # a trip counts once, at its first completion
CHANGE_FEED = "change_feed"  # every change to an existing trip counts
CORRECTED = "corrected"  # a trip counts as it stands now; later writes move it
MODES = (DOCUMENTED, CHANGE_FEED, CORRECTED)


def write_once(df: DataFrame, path: str) -> None:
    """Writes a batch's folder unless an earlier attempt at the same batch finished it."""
    if not is_complete(df.sparkSession, path):
        df.write.mode("overwrite").parquet(path)


def checkpoint_run(spark: SparkSession, checkpoint: str) -> str:
    """The run that a checkpoint belongs to; a new checkpoint starts a new run."""
    names = [n for n in child_names(spark, checkpoint) if n.startswith("run=")]
    if not names:
        names = [f"run={uuid.uuid4().hex}"]
        make_dir(spark, f"{checkpoint}/{names[0]}")
    return names[0].removeprefix("run=")


def remove_checkpoint(spark: SparkSession, job: TripJob, query: str) -> None:
    """Lets a stream start over: the next start is a new run, and reads its source from the begin."""
    remove(spark, job.checkpoint(query))


class TripJob:
    """Applies micro-batches of routed events to the tables under `root`."""

    def __init__(
        self,
        root: str,
        pipeline_id: str,
        mode: str = DOCUMENTED,
        compact_every: int = 50,
        publish: bool = True,
    ):
        if mode not in MODES:
            raise ValueError(f"unknown mode {mode!r}")
        self.root = root.rstrip("/")
        self.pipeline_id = pipeline_id
        self.mode = mode
        self.compact_every = compact_every
        self.publish = publish  # keep the table partitioned by pickup day up to date

    def folder(self, table: str) -> str:
        return f"{self.root}/{table}/pipeline_id={self.pipeline_id}"

    def path(self, table: str, batch_id: int) -> str:
        return f"{self.folder(table)}/batch={batch_id}"

    def checkpoint(self, query: str) -> str:
        return f"{self.root}/checkpoints/pipeline_id={self.pipeline_id}/{query}"

    def store(self, spark: SparkSession) -> KpiStore:
        return KpiStore(spark, f"{self.root}/kpi", self.pipeline_id)

    def log(self, spark: SparkSession) -> BatchLog:
        return BatchLog(spark, self.root, self.pipeline_id, self.store(spark).is_written)

    def states(self, spark: SparkSession) -> TripStates:
        return TripStates.of(spark, self.root, self.pipeline_id, self.checkpoint("state"), *self.fields())

    def fields(self) -> tuple[list[str], list[str]]:
        """The fields of starts and ends that the state holds."""
        if self.mode == CHANGE_FEED:  # a time that is written in another way is a change
            return [*START_FIELDS, *START_TEXTS], [*END_FIELDS, *END_TEXTS]
        return START_FIELDS, END_FIELDS

    def process(self, routed: DataFrame, batch_id: int) -> None:
        spark = routed.sparkSession
        store = self.store(spark)
        if store.is_written(batch_id) and not is_complete(spark, store.batch_path(batch_id)):
            return  # long done: its rows are part of a base
        found = self._land(routed, batch_id)
        if found["failed"] + found["skipped"] + found["warnings"]:
            landed = spark.read.parquet(self.path("landed", batch_id))
            self._write_once(landed.where("reason is not null or warning is not null"), "rejected", batch_id)
        events = self.events(spark, batch_id)
        if not is_complete(spark, self.path("completed", batch_id)):
            carry = self._carry(spark, events, batch_id)
            hot = None if found["records"] >= hot_floor(spark) else HotKeys()  # too few rows for any trip to be split
            self._write_once(self._output(events, carry, hot), "completed", batch_id)

        done = spark.read.parquet(self.path("completed", batch_id))
        if self.mode == CORRECTED:
            store.append_changes(fare_changes(done), batch_id)
        else:
            store.append(partials(dated(done)), batch_id)
        if self.publish:
            store.publish([batch_id])
        self._retire(spark, batch_id)

    def _land(self, routed: DataFrame, batch_id: int) -> dict[str, int]:
        """Writes the batch's events, and its counters, which are counted in the same pass."""
        spark, path = routed.sparkSession, f"{self.folder('counters')}/{batch_id:09d}.json"
        landed = self.path("landed", batch_id)
        if is_complete(spark, landed):
            found = batch_counters(spark.read.parquet(landed)).first().asDict()
        else:
            rows, observation = observed(routed, f"landed-{batch_id}")
            write_once(rows, landed)
            found = observation.get
        create_file(spark, path, json.dumps({"batch": batch_id, **found}), overwrite=True)
        return found

    def _output(self, events: DataFrame, carry: DataFrame | None, hot: HotKeys | None) -> DataFrame:
        if self.mode == CORRECTED:
            return current_trips(events, carry)
        history = trip_history(events, *self.fields(), carry=carry, hot=hot)
        if self.mode == DOCUMENTED:
            return first_completion(history)
        return modified(change_feed(history, *self.fields())).drop(*START_TEXTS, *END_TEXTS)

    def _retire(self, spark: SparkSession, batch_id: int) -> None:
        """Batch `batch_id` has been counted: earlier ones are committed and never replayed."""
        if batch_id and batch_id % self.compact_every == 0:
            self.store(spark).compact(batch_id - 1)
            self.log(spark).fold()
        self.states(spark).retire(batch_id - 1)
        for name in child_names(spark, self.folder("landed")):
            number = int(name.removeprefix("batch="))
            if number < batch_id - 1:  # the one before is the state query's next input, should this batch be repeated
                remove(spark, self.path("landed", number))

    def events(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return good_events(spark.read.parquet(self.path("landed", batch_id)))

    def _write_once(self, df: DataFrame, table: str, batch_id: int) -> None:
        write_once(df, self.path(table, batch_id))

    def _carry(self, spark: SparkSession, events: DataFrame, batch_id: int) -> DataFrame | None:
        """State before this batch of the trips it touches."""
        if not batch_id:
            return None
        finished = None
        if self.mode == DOCUMENTED:  # a trip that was forwarded never comes again
            finished = spark.read.parquet(self.path("completed", batch_id - 1))
        return self.states(spark).before(batch_id, self.events(spark, batch_id - 1), finished, events)

    # --- results -----------------------------------------------------------------

    def completed(self, spark: SparkSession) -> DataFrame:
        """Forwarded trips of all batches."""
        return spark.read.parquet(*self._paths(spark, "completed"))

    def counters(self, spark: SparkSession) -> DataFrame:
        """One row per batch: batch, records, success, failed, skipped, warnings. A repeated batch has one row."""
        return spark.read.schema("batch long, records long, success long, failed long, skipped long, warnings long").json(self.folder("counters"))

    def open_trips(self, spark: SparkSession) -> DataFrame:
        """trip_id and all fields of the trips that wait for their start or their end, after the last finished batch.

        Read from the state store of the stopped (or idle) stream and the events of the last batch, which the state
        gets with the next one. No event is read again but those.
        """
        last = max(numbered(spark, self.folder("landed"), "batch"), default=-1)
        rows = event_writes(self.events(spark, last)).select("trip_id", *WRITES) if last >= 0 else None
        if rows is None:
            raise ValueError("the pipeline has no batch yet")
        if last:
            state = self.states(spark).stored()
            finished = F.coalesce(F.col("start_write.finished"), F.lit(False)) | F.coalesce(F.col("end_write.finished"), F.lit(False))
            known = state.select("trip_id", finished.alias("finished"), *[F.when(F.col(w).isNotNull(), F.struct(f"{w}.sequence", f"{w}.image")).alias(w) for w in WRITES])
            rows = rows.withColumn("finished", F.lit(False)).unionByName(known)
        else:
            rows = rows.withColumn("finished", F.lit(False))
        folded = rows.groupBy("trip_id").agg(*[F.max(w).alias(w) for w in WRITES], F.bool_or("finished").alias("finished"))
        waiting = folded.where("not finished and (start_write is null or end_write is null)")
        return waiting.select(
            "trip_id",
            *[F.col(f"start_write.image.{f}").alias(f) for f in START_FIELDS],
            *[F.col(f"end_write.image.{f}").alias(f) for f in END_FIELDS],
        )

    def quarantine(self, spark: SparkSession) -> DataFrame:
        """Rejected events and warnings, and forwarded trips without a pickup day."""
        paths = self._paths(spark, "rejected")
        dateless = self.completed(spark).where("pickup_datetime is null")
        dateless = quarantine(dateless.withColumn("reason", F.lit("bad_pickup_datetime")), "kpi", "trip_id")
        return quarantine(spark.read.parquet(*paths), "ingest").unionByName(dateless) if paths else dateless

    def _paths(self, spark: SparkSession, table: str) -> list[str]:
        return [self.path(table, n) for n in numbered(spark, self.folder(table), "batch")]


def routed(envelopes: DataFrame, job: TripJob) -> DataFrame:
    """Decoded and routed events; the text of good rows is not kept."""
    rows = route_events(decode_envelopes(envelopes), keep_texts=job.mode == CHANGE_FEED)
    return rows.withColumn("data", F.when(F.expr("reason is not null or warning is not null"), F.col("data")))


def run_batch(envelopes: DataFrame, job: TripJob, run_id: str | None = None) -> DataFrame:
    """One batch over all envelopes, after whatever the pipeline saw before; returns the KPI table.

    Every call counts its envelopes. To repeat a call that failed half-way, name
    it with `run_id` in both calls: it then counts once.
    """
    spark = envelopes.sparkSession
    number = job.log(spark).number(run_id or uuid.uuid4().hex, 0)
    try:
        job.process(routed(envelopes, job), number)
    finally:
        job.states(spark).stop()
    return job.store(spark).kpis()


class TripStream:
    """A running stream: its query, and the state query that ends with it."""

    def __init__(self, query: StreamingQuery, states: TripStates):
        self.query, self.states = query, states

    def awaitTermination(self, timeout: float | None = None) -> bool | None:
        try:
            return self.query.awaitTermination(timeout) if timeout else self.query.awaitTermination()
        finally:
            if not self.query.isActive:
                self.states.stop()

    def stop(self) -> None:
        self.query.stop()
        self.states.stop()

    def __getattr__(self, name: str):
        return getattr(self.query, name)


def start_stream(envelopes: DataFrame, job: TripJob, **trigger) -> TripStream:
    """Folds a stream of envelopes into the KPI table.

    A trip's events must reach the batches in sequence order for the stream to
    equal one batch over all events; within a batch any order will do. An older
    write that comes in a later batch never replaces a newer one. In mode `corrected` the order of arrival
    does not matter.

    `trigger` is that of `DataStreamWriter.trigger`: `availableNow=True` (the
    default) runs once over what is there, `processingTime="10 minutes"` goes on.
    Bound the batch size with the source's own option, e.g. `maxFilesPerTrigger`, and let Spark
    move files away once they are consumed with `cleanSource`.
    Counters of every batch are in `job.counters`, and in the query progress under `batch`.
    """
    spark = envelopes.sparkSession
    rows = routed(envelopes, job).observe("batch", *counters(has_warning=True))
    run = checkpoint_run(spark, job.checkpoint("ingest"))

    def process(batch: DataFrame, batch_id: int) -> None:
        job.process(batch, job.log(batch.sparkSession).number(run, batch_id))

    query = (
        rows.writeStream.foreachBatch(process)
        .option("checkpointLocation", f"{job.checkpoint('ingest')}/query")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    return TripStream(query, job.states(spark))


def start_message_stream(
    staged: DataFrame, root: str, pipeline_id: str, compact_every: int = 50, **trigger
) -> StreamingQuery:
    """Folds a stream of completed-trip messages (staging columns, `reason`) into KPIs.

    Unusable messages stay in `root/messages` with their reason, once each. Every
    `compact_every` batches the partial rows so far are merged into one base.
    """
    spark = staged.sparkSession
    rows = cast_staging(staged).observe("batch", *counters(has_warning=True))
    checkpoint = f"{root}/checkpoints/pipeline_id={pipeline_id}/messages"
    run = checkpoint_run(spark, checkpoint)

    def process(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        store = KpiStore(session, f"{root}/kpi", pipeline_id)
        log = BatchLog(session, root, pipeline_id, store.is_written)
        number = log.number(run, batch_id)
        path = f"{root}/messages/pipeline_id={pipeline_id}/batch={number}"
        write_once(batch, path)
        store.append(partials(session.read.parquet(path).where("reason is null")), number)
        store.publish([number])
        if number and number % compact_every == 0:
            store.compact(number - 1)
            log.fold()

    make_dir(spark, root)
    return (
        rows.writeStream.foreachBatch(process)
        .option("checkpointLocation", f"{checkpoint}/query")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
