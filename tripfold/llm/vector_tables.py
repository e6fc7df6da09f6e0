"""What the operators on vectors share: which rows count, and exact sums over all rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = 4096  # vectors at a time
EXACT = pa.decimal128(38, 0)


def usable(vectors: DataFrame, *columns: str) -> DataFrame:
    """vec_id, `columns`, and `vector` as doubles, of the rows whose vector is there and finite throughout."""
    vector = F.col("embedding").cast("array<double>")
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), *columns, vector.alias("vector")).where(F.col("vector").isNotNull() & ~odd)


def common_length(rows: DataFrame) -> int:
    """The commonest length above 0 (of several, the greatest); 0 if there is none."""
    sizes = rows.groupBy(F.size("vector").alias("size")).count().where("size > 0")
    found = sizes.orderBy(F.col("count").desc(), F.col("size").desc()).first()
    return found["size"] if found else 0


def scaled(batch: pa.RecordBatch, column: str, scale: int, most: int) -> np.ndarray:
    """floor(scale * x) of a column of vectors of one length, row by row; `scale` is a power of two, `most` bounds the size."""
    values = batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * float(scale)), -float(most), float(most)).astype(np.int64)


def total(rows: DataFrame, add: Callable[[pa.RecordBatch], dict[int, int] | np.ndarray], slots: int, exact: bool = True) -> list:
    """Sums of `slots` numbers over all batches: added up within a task, then per slot. The driver gets one row per slot."""
    kind, name = (EXACT, "decimal(38,0)") if exact else (pa.float64(), "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(slots, object if exact else float)
        some = False
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                sums += add(batch.slice(at, ROWS))
                some = True
        if some:
            for at in range(0, slots, 100_000):
                part = [int(x) for x in sums[at : at + 100_000]] if exact else sums[at : at + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(range(at, at + len(part))), pa.array(part, kind)], ["slot", "total"])

    found = rows.mapInArrow(run, f"slot long, total {name}").groupBy("slot").agg(F.sum("total").alias("total")).collect()
    out = [0] * slots
    for r in found:
        out[r.slot] = int(r.total) if exact else r.total
    return out
