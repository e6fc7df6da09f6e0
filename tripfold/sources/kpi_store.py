"""Incremental KPI table on plain Parquet.

Layout under `root`:

    partials/pipeline_id=P/batch_id=N/   partial rows of one batch
    base/pipeline_id=P/v=N/              all batches up to N, merged
    fares/pipeline_id=P/batch_id=N/      how often each fare counts on each day, changes of one batch
    fare_base/pipeline_id=P/v=N/         the same of all batches up to N
    days/pipeline_id=P/batch_id=N/       days that any version of the batch had, until they are published
    published/pickup_date=D/             KPI rows, a view rebuilt from the above

A batch owns its folder, so writing it again replaces it and counts nothing
twice. `pipeline_id` keeps runs apart whose batch numbers start again at zero. `fares` is
only there for pipelines that take fares back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tripfold.operators.corrections import extremes, net_fares, signed_partials
from tripfold.operators.kpi import finalize
from tripfold.schemas import FARES_SCHEMA, KPI_SCHEMA, PARTIAL_SCHEMA, STORED_SCHEMA, TOTAL
from tripfold.sources.paths import child_names, is_complete, numbered, remove

PUBLISH_ROUNDS = 20  # other pipelines may append while this one publishes


def merged(stored: DataFrame, *keep: str) -> DataFrame:
    """One row per day of stored rows with `pipeline`; `keep` (batch, as_of) for a new base of one pipeline.

    Extremes count from the pipeline's last row that has them for the whole day.
    """
    last = F.max("as_of").over(Window.partitionBy("pipeline", "pickup_date"))
    rows = stored.withColumn("counts", F.col("batch") >= F.coalesce(last, F.lit(-1)))
    return rows.groupBy("pickup_date").agg(
        F.sum("total_fare").cast(TOTAL).alias("total_fare"),
        F.sum("count_trips").alias("count_trips"),
        F.sum("fare_count").alias("fare_count"),
        F.max(F.when(F.col("counts"), F.col("max_fare"))).alias("max_fare"),
        F.min(F.when(F.col("counts"), F.col("min_fare"))).alias("min_fare"),
        *[F.max(c).alias(c) for c in keep],
    )


class KpiStore:
    def __init__(self, spark: SparkSession, root: str, pipeline_id: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.pipeline_id = pipeline_id

    def _folder(self, kind: str, pipeline_id: str | None = None) -> str:
        return f"{self.root}/{kind}/pipeline_id={pipeline_id or self.pipeline_id}"

    def batch_path(self, batch_id: int) -> str:
        return f"{self._folder('partials')}/batch_id={batch_id}"

    def is_written(self, batch_id: int) -> bool:
        """Whether the batch's rows are there, in a folder of its own or merged into a base."""
        return is_complete(self.spark, self.batch_path(batch_id)) or any(
            v >= batch_id for v in numbered(self.spark, self._folder("base"), "v")
        )

    # --- writing ---------------------------------------------------------------

    def append(self, partial_rows: DataFrame, batch_id: int) -> None:
        """Writes a batch's partial rows; an empty batch leaves an empty folder."""
        rows = partial_rows.select(*PARTIAL_SCHEMA.names, F.lit(None).cast("bigint").alias("as_of"))
        self._write(rows, batch_id)

    def append_changes(self, changes: DataFrame, batch_id: int) -> None:
        """Writes a batch's `fare_changes`. Days from which it takes a fare back get their extremes anew.

        Only those days are looked up, in the fares of all batches; their rows lie together in each folder.
        """
        path = f"{self._folder('fares')}/batch_id={batch_id}"
        days = changes.select(*FARES_SCHEMA.names).sortWithinPartitions("pickup_date")
        days.write.mode("overwrite").parquet(path)
        own = self.spark.read.schema(FARES_SCHEMA).parquet(path)
        parts = signed_partials(own)
        found = [r.pickup_date for r in parts.where("takes_back").select("pickup_date").collect()]  # a row per day
        if found:
            paths = self._live_paths("fares", "fare_base", self.pipeline_id, batch_id)
            fares = self._read(paths, FARES_SCHEMA).where(F.col("pickup_date").isin(found))
            anew = extremes(fares).select("pickup_date", F.col("max_fare").alias("most"), F.col("min_fare").alias("least"))
            parts = parts.join(anew, "pickup_date", "left").withColumns(
                {
                    "max_fare": F.when(F.col("takes_back"), F.col("most")).otherwise(F.col("max_fare")),
                    "min_fare": F.when(F.col("takes_back"), F.col("least")).otherwise(F.col("min_fare")),
                }
            )
        as_of = F.when(F.col("takes_back"), F.lit(batch_id).cast("bigint")).alias("as_of")
        self._write(parts.select(*PARTIAL_SCHEMA.names, as_of), batch_id)

    def _write(self, rows: DataFrame, batch_id: int) -> None:
        path, days = self.batch_path(batch_id), f"{self._folder('days')}/batch_id={batch_id}"
        if is_complete(self.spark, path):  # another version: its days must be published again
            self._read([path]).select("pickup_date").distinct().write.mode("append").parquet(days)
        stored = rows.withColumn("batch", F.lit(batch_id).cast("bigint")).select(*STORED_SCHEMA.names)
        stored.write.mode("overwrite").parquet(path)

    # --- reading ---------------------------------------------------------------

    def _live_paths(self, batches: str, bases: str, pipeline_id: str, up_to: int | None = None) -> list[str]:
        """Newest base and the batches after it."""
        folder, base = self._folder(batches, pipeline_id), self._folder(bases, pipeline_id)
        last = float("inf") if up_to is None else up_to
        versions = [v for v in numbered(self.spark, base, "v") if v <= last]
        newest = versions[-1] if versions else -1
        later = [n for n in numbered(self.spark, folder, "batch_id", newest) if n <= last]
        return [f"{base}/v={newest}"] * bool(versions) + [f"{folder}/batch_id={n}" for n in later]

    def _read(self, paths: list[str], schema: StructType = STORED_SCHEMA) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def pipelines(self) -> list[str]:
        names = {
            n
            for kind in ("partials", "base")
            for n in child_names(self.spark, f"{self.root}/{kind}")
            if n.startswith("pipeline_id=")
        }
        return sorted(n.split("=", 1)[1] for n in names)

    def _all_paths(self) -> dict[str, list[str]]:
        return {p: self._live_paths("partials", "base", p) for p in self.pipelines()}

    def _stored(self, paths: dict[str, list[str]]) -> DataFrame:
        rows = self._read([])
        rows = rows.withColumn("pipeline", F.lit(""))
        for pipeline, own in paths.items():
            if own:
                rows = rows.unionByName(self._read(own).withColumn("pipeline", F.lit(pipeline)))
        return rows

    def snapshot(self) -> DataFrame:
        """Merged partial rows of all pipelines."""
        return merged(self._stored(self._all_paths())).where("count_trips <> 0")

    def kpis(self) -> DataFrame:
        return finalize(self.snapshot())

    def compact(self, up_to: int) -> None:
        """Merges batches up to `up_to` into a new base.

        Pass only batches that can no longer be replayed. Readers move to the new base once its
        write has finished; the folders that the base before it replaced are removed. A base that is there
        stays as it is: it would be read and overwritten at once.
        """
        base, fares = f"{self._folder('base')}/v={up_to}", f"{self._folder('fare_base')}/v={up_to}"
        paths = self._live_paths("fares", "fare_base", self.pipeline_id, up_to)
        if paths and not is_complete(self.spark, fares):
            net = net_fares(self._read(paths, FARES_SCHEMA))
            net.repartitionByRange("pickup_date").sortWithinPartitions("pickup_date").write.mode("overwrite").parquet(fares)
        if not is_complete(self.spark, base):
            paths = self._live_paths("partials", "base", self.pipeline_id, up_to)
            rows = merged(self._stored({self.pipeline_id: paths}), "batch", "as_of")
            rows.select(*STORED_SCHEMA.names).write.mode("overwrite").parquet(base)
        for batches, bases in (("partials", "base"), ("fares", "fare_base")):
            self._retire(batches, bases, up_to)

    def _retire(self, batches: str, bases: str, up_to: int) -> None:
        """Removes what the base before `up_to` replaced: no reader that began since needs it."""
        versions = [v for v in numbered(self.spark, self._folder(bases), "v") if v < up_to]
        if versions:
            for v in versions[:-1]:
                remove(self.spark, f"{self._folder(bases)}/v={v}")
            for n in numbered(self.spark, self._folder(batches), "batch_id"):
                if n <= versions[-1]:
                    remove(self.spark, f"{self._folder(batches)}/batch_id={n}")

    # --- the published table -----------------------------------------------------

    def publish(self, batch_ids: list[int] | None = None) -> None:
        """Rewrites the published rows of the days that any version of the given batches has, or of all days.

        No other day is touched, so pipelines on one root may publish in any order. Where another one
        appended in the meantime, the days are written again: whoever is last has seen the batches of both.
        A touched day without trips is removed.
        """
        for _ in range(PUBLISH_ROUNDS):
            paths = self._all_paths()
            self._publish(paths, batch_ids)
            if paths == self._all_paths():
                break
        for n in batch_ids or []:
            remove(self.spark, f"{self._folder('days')}/batch_id={n}")

    def _publish(self, paths: dict[str, list[str]], batch_ids: list[int] | None) -> None:
        stored = self._stored(paths)
        touched = None
        if batch_ids is not None:
            again = [f"{self._folder('days')}/batch_id={n}" for n in batch_ids]
            folders = [p for p in [*map(self.batch_path, batch_ids), *again] if is_complete(self.spark, p)]
            if not folders:
                return
            touched = {r.pickup_date for r in self._read(folders).select("pickup_date").distinct().collect()}  # a row per day
            stored = stored.where(F.col("pickup_date").isin(list(touched)))
        found = finalize(merged(stored).where("count_trips <> 0")).select(*KPI_SCHEMA.names).collect()  # a row per day
        present = {r.pickup_date for r in found}
        if touched is None:
            names = child_names(self.spark, f"{self.root}/published")
            stale = {n for n in names if n.startswith("pickup_date=")} - {f"pickup_date={d}" for d in present}
        else:
            stale = {f"pickup_date={d}" for d in touched - present}
        for name in stale:
            remove(self.spark, f"{self.root}/published/{name}")
        # ranges in an explicit number are not merged into one task: folders are written side by side
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        (
            self.spark.createDataFrame(found, KPI_SCHEMA)
            .repartitionByRange(tasks, "pickup_date")
            .write.option("partitionOverwriteMode", "dynamic")
            .partitionBy("pickup_date")
            .mode("overwrite")
            .parquet(f"{self.root}/published")
        )

    def published(self) -> DataFrame:
        table = self.spark.read.schema(KPI_SCHEMA).parquet(f"{self.root}/published")
        return table.select(*KPI_SCHEMA.names)
