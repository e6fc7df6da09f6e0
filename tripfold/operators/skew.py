"""Splitting of keys that hold too many rows for one task.

Grouped aggregates need none of this: Spark combines them before the shuffle.
Operators that must see a key's rows in order do. They split a hot key's rows
into consecutive ranges of their order ("chunks"), work on every chunk in its
own task, and pass each chunk the combined state of the chunks before it.

The number of hot keys and of chunks is bounded by the number of shuffle
partitions, not by the data, so both can be broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FLOOR_CONF = "tripfold.hotKey.minRows"
FLOOR_ROWS = 1_000_000
PER_CHUNK = 64  # orders looked at for each chunk
SHARE = 2  # a key is hot from this many times an even share of the rows


@dataclass
class HotKeys:
    """Ascending chunk bounds per hot key, values of the order itself; no entries means nothing is hot."""

    bounds: dict[str, list] = field(default_factory=dict)

    def __bool__(self) -> bool:
        return bool(self.bounds)

    def frame(self, df: DataFrame, key: str, order: str) -> DataFrame:
        kind = df.schema[order].dataType.simpleString()
        return df.sparkSession.createDataFrame(
            list(self.bounds.items()), f"{key} string, _bounds array<{kind}>"
        )


def hot_floor(spark: SparkSession) -> int:
    """Rows of the smallest key to split."""
    return int(spark.conf.get(FLOOR_CONF, str(FLOOR_ROWS)))


def find_hot_keys(df: DataFrame, key: str, order: str) -> HotKeys:
    """Hot keys of `df` with chunk bounds along `order`.

    One scan of the key column with a bounded frequent-items sketch (no shuffle
    of keys), and only if that finds a hot key, one scan for bounds: quantiles of
    a part of its distinct orders, chosen by their hash. The answer only steers
    how rows are split: results are the same for any answer. Where no key reaches
    FLOOR_CONF rows, nothing is split.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    floor_rows = hot_floor(spark)
    tracked = min(1_000_000, max(1024, 16 * tasks))
    most = max(1, tasks // SHARE)
    row = (
        df.select(F.col(key).cast("string").alias("k"))
        .agg(F.expr(f"approx_top_k(k, {most}, {tracked})").alias("top"), F.count("*").alias("n"))
        .first()
    )
    limit = max(floor_rows, SHARE * row["n"] / tasks)
    counts = {e["item"]: e["count"] for e in row["top"] if e["item"] is not None and e["count"] >= limit}
    if not counts:
        return HotKeys()

    steps = {k: max(2, -(-2 * n * tasks // row["n"])) for k, n in counts.items()}
    sparse = {k: max(1, n // (PER_CHUNK * steps[k])) for k, n in counts.items()}

    def of_key(values: dict[str, int]):
        return F.try_element_at(F.create_map(*[F.lit(x) for item in values.items() for x in item]), F.col("k"))

    orders = df.select(F.col(key).cast("string").alias("k"), F.col(order).alias("o")).where(
        F.col("k").isin(list(counts)) & F.col("o").isNotNull()
    )
    chosen = orders.where(F.pmod(F.xxhash64("o"), of_key(sparse)) == 0).distinct()
    cuts = F.transform(
        F.sequence(F.lit(1), of_key(steps) - 1),
        lambda i: F.get("os", F.floor(i * F.size("os") / of_key(steps)).cast("int")),
    )
    found = chosen.groupBy("k").agg(F.array_sort(F.collect_list("o")).alias("os"))
    rows = found.select("k", F.array_distinct(cuts).alias("cuts")).collect()  # one row per hot key
    return HotKeys({r.k: [c for c in r.cuts if c is not None] for r in rows})


def with_chunk(df: DataFrame, key: str, order: str, hot: HotKeys) -> DataFrame:
    """Adds `chunk` (0 for every row of a key that is not hot) and `is_hot`."""
    if not hot:
        return df.withColumns({"chunk": F.lit(0), "is_hot": F.lit(False)})
    joined = df.join(F.broadcast(hot.frame(df, key, order)), key, "left")
    below = F.size(F.filter("_bounds", lambda bound: bound < F.col(order)))
    unplaced = F.col("_bounds").isNull() | F.col(order).isNull()
    return joined.withColumns(
        {"chunk": F.when(unplaced, 0).otherwise(below), "is_hot": F.col("_bounds").isNotNull()}
    ).drop("_bounds")
