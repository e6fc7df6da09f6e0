"""State of a pipeline's trips: one streaming query that keeps running beside the pipeline.

The query is a native streaming aggregate: it keeps the newest writes of every trip. Its
input for batch N is the events of batch N-1, which become part of the state, and a marker for
every trip in batch N; in update mode the marked trips come out with the state of the
batches before N. Spark combines both before the shuffle, so a hot trip costs one row per
task. A trip that needs no more than the fact that it is finished keeps a flag in place of its
payloads. The input of a batch appears under its name in one step, once it is whole, and is removed
when the batch is done.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from tripfold.operators.trips import event_writes
from tripfold.sources.paths import child_names, is_complete, make_dir, remove, rename

WRITES = ("start_write", "end_write")
POLL = "100 milliseconds"  # how often the running query looks for its next input
INPUT_AGE = "30d"  # the query forgets the names of inputs that much older than its newest
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.minBatchesToRetain": "5",  # of checkpoints; a batch is repeated from the last
    "spark.sql.streaming.noDataProgressEventInterval": "3600000",
}

_running: dict[str, TripStates] = {}  # by checkpoint: a checkpoint bears one query at a time


def state_write(write: str, finished: bool) -> Column:
    """A write as the state holds it: greater ones are newer, and a flag is greater than any."""
    kept = F.struct(F.lit(False).alias("finished"), F.col(f"{write}.sequence"), F.col(f"{write}.image"))
    flag = F.struct(F.lit(True).alias("finished"), F.lit(None).alias("sequence"), F.lit(None).alias("image"))
    return (flag if finished else F.when(F.col(write).isNotNull(), kept)).alias(write)


def save_wanted(states: TripStates, state: DataFrame, part: int) -> None:
    """Keeps the state of the trips that the batch asked for."""
    known = F.col("start_write").isNotNull() | F.col("end_write").isNotNull()
    wanted = state.where(F.col("wanted_by") == states.number).where(known)
    wanted.drop("wanted_by").write.mode("overwrite").parquet(f"{states.carry_path(states.number)}/part={part}")


class TripStates:
    def __init__(self, spark: SparkSession, root: str, pipeline_id: str, checkpoint: str, start_fields: list[str], end_fields: list[str]):
        self.spark = spark
        self.fields = (start_fields, end_fields)
        self.inputs = f"{root}/state_in/pipeline_id={pipeline_id}"
        self.staged = f"{root}/state_staged/pipeline_id={pipeline_id}"
        self.carries = f"{root}/carry/pipeline_id={pipeline_id}"
        self.checkpoint = checkpoint
        self.number = -1  # the batch that asks
        self.query: StreamingQuery | None = None

    @classmethod
    def of(cls, spark: SparkSession, root: str, pipeline_id: str, checkpoint: str, start_fields: list[str], end_fields: list[str]) -> TripStates:
        """The pipeline's states; the running ones where there are some."""
        return _running.setdefault(checkpoint, cls(spark, root, pipeline_id, checkpoint, start_fields, end_fields))

    def carry_path(self, number: int) -> str:
        return f"{self.carries}/batch={number}"

    def _start(self, schema: StructType) -> None:
        make_dir(self.spark, self.inputs)
        before = {k: self.spark.conf.get(k, None) for k in SETTINGS}
        for k, v in SETTINGS.items():
            self.spark.conf.set(k, v)
        try:
            self.query = (
                self.spark.readStream.schema(schema)
                .option("recursiveFileLookup", True)
                .option("maxFileAge", INPUT_AGE)
                .parquet(self.inputs)
                .groupBy("trip_id")
                .agg(*[F.max(c).alias(c) for c in (*WRITES, "wanted_by")])
                .writeStream.outputMode("update")
                .foreachBatch(lambda state, part: save_wanted(self, state, part))
                .option("checkpointLocation", self.checkpoint)
                .trigger(processingTime=POLL)
                .start()
            )
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)

    def stop(self) -> None:
        _running.pop(self.checkpoint, None)
        if self.query:
            self.query.stop()
            self.query = None

    def before(self, number: int, earlier: DataFrame, finished: DataFrame | None, events: DataFrame) -> DataFrame:
        """State before batch `number` of the trips it touches: trip_id, start_write, end_write.

        `earlier` are the events of the batch before, `finished` the trips (trip_id) of which only
        that fact is still needed; their writes come back without sequence and image.
        """
        self.number = number
        rows = event_writes(earlier, *self.fields).select("trip_id", *[state_write(w, False) for w in WRITES])
        if finished is not None:
            flags = finished.select("trip_id", *[state_write(w, True) for w in WRITES])
            rows = rows.unionByName(flags.select("trip_id", *[F.col(w).cast(rows.schema[w].dataType).alias(w) for w in WRITES]))
        markers = events.select("trip_id", F.lit(number).cast("bigint").alias("wanted_by"))
        rows = rows.unionByName(markers, allowMissingColumns=True)
        target = f"{self.inputs}/batch={number}"
        if not is_complete(self.spark, target):
            remove(self.spark, target)
            rows.write.mode("overwrite").parquet(f"{self.staged}/batch={number}")
            rename(self.spark, f"{self.staged}/batch={number}", target)
        if self.query is None or not self.query.isActive:
            self._start(rows.schema)
        self.query.processAllAvailable()

        fields = StructType([f for f in rows.schema if f.name in ("trip_id", *WRITES)])
        paths = [f"{self.carry_path(number)}/{n}" for n in child_names(self.spark, self.carry_path(number))]
        found = self.spark.read.schema(fields).parquet(*paths) if paths else self.spark.createDataFrame([], fields)
        if len(paths) > 1:  # a repeated batch: the later part has seen at least as much
            found = found.groupBy("trip_id").agg(*[F.max(w).alias(w) for w in WRITES])
        return found.select("trip_id", *[plain_write(w) for w in WRITES])

    def retire(self, number: int) -> None:
        """Removes what batches up to `number` left here."""
        for folder in (self.inputs, self.carries):
            for name in child_names(self.spark, folder):
                if int(name.removeprefix("batch=")) <= number:
                    remove(self.spark, f"{folder}/{name}")

    def stored(self) -> DataFrame:
        """trip_id, start_write, end_write of all trips as the query last left them, read from its state store.

        Writes of finished trips are there without sequence and image.
        """
        rows = self.spark.read.format("statestore").load(self.checkpoint)
        # the aggregates' buffers all bear the name `max`: renamed as a whole, in their order
        names = (*WRITES, "wanted_by")
        renamed = StructType([StructField(n, f.dataType) for n, f in zip(names, rows.schema["value"].dataType, strict=True)])
        rows = rows.select("key.trip_id", F.col("value").cast(renamed).alias("value"))
        return rows.select("trip_id", *[F.col(f"value.{w}").alias(w) for w in WRITES])


def plain_write(write: str) -> Column:
    """A write as the operators take it."""
    return F.when(F.col(write).isNotNull(), F.struct(f"{write}.sequence", f"{write}.image")).alias(write)
