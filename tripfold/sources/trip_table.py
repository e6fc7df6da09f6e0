"""The current state of all trips as a table that batches bring up to date.

The table is partitioned by `slot`, a hash of the trip id, and bucketed by trip id in each slot. A
batch reads and rewrites the slots of its trips and no others; its own events are
the only rows that are shuffled, because the table's buckets are where they belong already.
The new slots are written once, in the table's own layout, and take the old ones' place as folders.
Folding is idempotent, so a batch may be repeated.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfold.operators.trips import event_writes, images
from tripfold.schemas import END_FIELDS, START_FIELDS
from tripfold.sources.paths import child_names, create_file, exists, make_dir, read_file, remove, rename

WRITES = ("start_write", "end_write")


class TripTable:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        name: str,
        slots: int = 64,
        buckets: int = 64,
        start_fields: Sequence[str] = START_FIELDS,
        end_fields: Sequence[str] = END_FIELDS,
    ):
        """`name` is the table's name in the session's catalog; its files are under `root`, where other sessions find them.

        `slots` bounds how finely batches are told apart, `buckets` how many tasks share a slot's work;
        both belong to the table for good. One writer at a time.
        """
        self.spark, self.root, self.name = spark, root.rstrip("/"), name
        self.slots, self.buckets = slots, buckets
        self.fields = (start_fields, end_fields)
        self.pending = f"{self.root}/pending"

    def _slot(self):
        return F.pmod(F.xxhash64("trip_id"), F.lit(self.slots)).cast("int").alias("slot")

    def _open(self, rows: DataFrame) -> DataFrame:
        """The table, created on first use or found again; an update that was cut off is finished first."""
        if not self.spark.catalog.tableExists(self.name):
            self._create(self.name, f"{self.root}/trips", rows)
            self.spark.catalog.recoverPartitions(self.name)
        if exists(self.spark, self.pending):
            self._insert(read_file(self.spark, self.pending))
        return self.spark.table(self.name)

    def _create(self, name: str, path: str, rows: DataFrame) -> None:
        make_dir(self.spark, path)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
        self.spark.sql(
            f"create table {name} ({columns}) using parquet partitioned by (slot) "
            f"clustered by (trip_id) into {self.buckets} buckets location '{path}'"
        )

    @contextmanager
    def _dealt_to_buckets(self) -> Iterator[None]:
        """Has jobs shuffle the events into one partition per bucket: with more partitions Spark shuffles the old rows too."""
        conf, before = "spark.sql.shuffle.partitions", self.spark.conf.get("spark.sql.shuffle.partitions")
        self.spark.conf.set(conf, str(self.buckets))
        try:
            yield
        finally:
            self.spark.conf.set(conf, before)

    def _stage(self, rows: DataFrame, staged: str) -> None:
        """Writes rows as folders of slots that can stand in the table as they are."""
        name = f"staged_{uuid.uuid4().hex}"
        self._create(name, staged, rows)
        try:
            with self._dealt_to_buckets():
                rows.write.insertInto(name)
        finally:
            self.spark.sql(f"drop table {name}")  # the files stay: they are under a location of their own

    def _insert(self, staged: str) -> None:
        """Puts the staged slots in the place of the table's. One that was moved before is no longer staged."""
        for slot in child_names(self.spark, staged):
            if slot.startswith("slot="):
                remove(self.spark, f"{self.root}/trips/{slot}")
                rename(self.spark, f"{staged}/{slot}", f"{self.root}/trips/{slot}")
        self.spark.catalog.recoverPartitions(self.name)
        self.spark.catalog.refreshTable(self.name)
        remove(self.spark, self.pending)
        remove(self.spark, staged)

    def _touched(self, events: DataFrame) -> list[int]:
        """Slots of the events, at most `slots` numbers. If some rows name every slot already, the others are not read for it."""
        slots = events.select(self._slot())
        for rows in (slots.limit(64 * self.slots), slots):
            touched = [r.slot for r in rows.distinct().collect()]
            if len(touched) == self.slots:
                break
        return touched

    def updated(self, events: DataFrame) -> DataFrame:
        """Rows of the slots that the events touch, with the events folded in. The old rows are not shuffled."""
        folded = event_writes(events, *self.fields).groupBy("trip_id").agg(*[F.max(w).alias(w) for w in WRITES])
        new = folded.withColumn("slot", self._slot())
        table = self._open(new)
        old = table.where(F.col("slot").isin(self._touched(events))).select("trip_id", *[F.col(w).alias(f"old_{w}") for w in WRITES])
        both = old.join(new.drop("slot").hint("merge"), "trip_id", "full_outer")
        return both.select("trip_id", *[F.greatest(f"old_{w}", w).alias(w) for w in WRITES], self._slot())

    def update(self, events: DataFrame) -> None:
        """Folds a batch of events (`trip_id`, `kind`, `sequence`, payload) into the table. An empty batch changes nothing.

        The new slots are written aside before the old ones are replaced, and a marker names them, so an update
        that is cut off anywhere is either undone or finished by the next.
        """
        staged = f"{self.root}/staged/{uuid.uuid4().hex}"
        self._stage(self.updated(events), staged)
        create_file(self.spark, self.pending, staged)
        self._insert(staged)

    def trips(self) -> DataFrame:
        """All trips as `assemble_trips` gives them: one scan, no shuffle."""
        rows = self.spark.table(self.name)
        return rows.select(
            "trip_id",
            *images(*self.fields),
            F.col("start_write").isNotNull().alias("has_start"),
            F.col("end_write").isNotNull().alias("has_end"),
        )
