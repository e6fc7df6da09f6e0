"""Whitening of embeddings: the leading principal components, each scaled to unit variance.

The covariance is built from exact integer sums over the distinct vectors, added up
in the tasks that hold them; its leading eigenpairs come from spectrum slicing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripfold.llm import vector_tables as vt
from tripfold.llm.ordered import kept
from tripfold.llm.spectrum import leading

SCALE = 64  # fixed values: an entry c counts as floor(SCALE * c) + SHIFT; the covariance does not see the shift
SHIFT = 1_000_000
MOST = 1 << 50  # larger entries are held at this size
COMPONENTS = 16
LONG = (1 << 63) - 1
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Whitening:
    n: int  # distinct vectors
    sums: list[int]  # per dimension, of floor(SCALE * c)
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # columns
    trace: float

    def apply(self, x: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Whitened rows, and the exact sum of (n x - S) ** 2 of each."""
        most = max(int(np.abs(x).max(initial=0)), -(-max(map(abs, self.sums), default=0) // self.n))
        exact = np.int64 if (2 * most * self.n) ** 2 * max(1, len(self.sums)) < LONG else object  # integers of any length where they may not fit
        off = x.astype(exact) * self.n - np.array(self.sums, exact)
        deviation = (off * off).sum(axis=1).tolist()
        return (off.astype(float) / self.n) @ self.vectors / np.sqrt(self.values), [min(d, LONG) for d in deviation]


def _packed(rows: DataFrame) -> DataFrame:
    """Every distinct vector once, as little-endian integers: 32 bits each if all of them fit, else 64."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, vt.ROWS):
                found = vt.scaled(batch.slice(at, vt.ROWS), "vector", SCALE, MOST)
                small = (np.abs(found) < 1 << 31).all(axis=1) if found.size else np.zeros(0, bool)
                out = [r.astype("<i4").tobytes() if s else r.astype("<i8").tobytes() for r, s in zip(found, small, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["x"])

    return rows.select("vector").mapInArrow(run, "x binary").distinct()


def _unpacked(batch: pa.RecordBatch, length: int) -> np.ndarray:
    rows = batch.column(0).to_pylist()
    if all(len(r) == 4 * length for r in rows):
        return np.frombuffer(b"".join(rows), "<i4").reshape(-1, length).astype(np.int64)
    return np.array([np.frombuffer(r, "<i4" if len(r) == 4 * length else "<i8") for r in rows], np.int64)


def _moments(x: np.ndarray) -> np.ndarray:
    """n, the sums and the upper triangle of the products, as exact integers."""
    if (int(np.abs(x).max()) ** 2) * len(x) < 1 << 53:  # doubles hold all sums exactly
        products = x.T.astype(float) @ x.astype(float)
        products = products.astype(np.int64).astype(object)
    else:
        products = x.astype(object).T @ x.astype(object)
    return np.concatenate([[len(x)], x.sum(axis=0).astype(object) if len(x) else [], products[np.triu_indices(x.shape[1])]])


def fit(rows: DataFrame, length: int, most: int) -> tuple[Whitening, DataFrame]:
    """The whitening of the distinct vectors, and their table. Covariances divide by their number."""
    table = kept(_packed(rows))
    upper = np.triu_indices(length)
    found = vt.total(table, lambda b: _moments(_unpacked(b, length)), 1 + length + len(upper[0]))
    n, sums, products = found[0], found[1 : 1 + length], found[1 + length :]
    covariance = np.zeros((length, length))
    for i, j, q in zip(*upper, products, strict=True):  # n q - S S is exact: nothing cancels in the one division
        covariance[i, j] = covariance[j, i] = (n * q - sums[i] * sums[j]) / (n * n)
    return Whitening(n, sums, *leading(covariance, most), float(np.trace(covariance))), table


def identity_error(table: DataFrame, found: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    m = len(found.values)

    def add(batch: pa.RecordBatch) -> np.ndarray:
        z, _ = found.apply(_unpacked(batch, len(found.sums)))  # centred exactly, before any product
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

    sums = np.array(vt.total(table, add, m + m * m, exact=False)) / found.n
    covariance = sums[m:].reshape(m, m) - np.outer(sums[:m], sums[:m])
    return float(np.abs(covariance - np.eye(m)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row and component.

    Every distinct vector counts once in the fit, but all rows are whitened, repeated ones too, and
    null ids stay. Dropped: rows whose vector is null or empty, holds a null or non-finite entry, or is not of the commonest
    length. Components without variance do not exist, so a table of equal vectors, like an
    empty one, gives no rows. Entries beyond MOST are held there, deviations at the largest
    long. More columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vt.usable(vectors)
    length = vt.common_length(rows)
    if not length:
        return spark.createDataFrame([], SCHEMA)
    rows = rows.where(f"size(vector) = {length}")
    found, table = fit(rows, length, components)
    m = len(found.values)
    if not m:
        return spark.createDataFrame([], SCHEMA)
    error, explained = identity_error(table, found), found.values / found.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, vt.ROWS):
                some = batch.slice(at, vt.ROWS)
                z, deviation = found.apply(vt.scaled(some, "vector", SCALE, MOST))
                n = len(z)
                every = pa.array(np.repeat(np.arange(n), m))
                columns = [
                    some.column("vec_id").take(every), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), n)), pa.array(np.full(n * m, found.n)),
                    pa.array(deviation, pa.int64()).take(every), pa.array(z.ravel()), pa.array(np.tile(explained, n)), pa.array(np.full(n * m, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, SCHEMA)
