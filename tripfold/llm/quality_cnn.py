"""Byte-level convolutional network for document quality, in numpy.

Filters of WIDTH bytes slide over the text byte by byte. A document is covered
by chunks of CHUNK bytes, each overlapping the next by half; every filter is
max-pooled over each chunk. The mean, largest and smallest pooled value of a filter over
the chunks are combined by one logistic unit into the probability of label 1. A
filter is a weight for each byte at each of its places, so a convolution is a sum of
table rows; the scorer merges two places into one table of byte pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold.llm.workers import slices

FILTERS = 16
WIDTH = 8  # bytes, an even number
CHUNK = 512
HALF = CHUNK // 2
THRESHOLD = 0.7  # of a predicted 1
SCORED_BYTES = 1 << 17  # bytes convolved at a time

TRAIN_ROWS = 800  # bound of the training sample, for each label
TRAIN_BYTES = 1 << 16  # longer texts are not trained on (all are scored, whole); 3 in 1,000 of the generated ones
EPOCHS = 8
BATCH = 32
RATE = 0.01
DECAY = 1e-4
HELD_OUT, FOLDS = 2, 4  # fixed values: rows of this remainder are never learned from

SCHEMA = "doc_id long, score double"


@dataclass
class Network:
    filters: np.ndarray  # WIDTH, 256, FILTERS
    bias: np.ndarray  # FILTERS
    weights: np.ndarray  # 3 * FILTERS
    offset: float

    def pair_tables(self) -> list[np.ndarray]:
        """For places 0-1, 2-3, ...: a row per little-endian byte pair."""
        low, high = np.arange(65536) & 255, np.arange(65536) >> 8
        return [(self.filters[k][low] + self.filters[k + 1][high]).astype(np.float32) for k in range(0, WIDTH, 2)]


def padded_size(size: int) -> int:
    """Whole half chunks, one chunk at least, with room for a filter that starts at the last byte."""
    return max(CHUNK, -(-(size + WIDTH) // HALF) * HALF)


def lay_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, each padded with zeros; the half chunks of each."""
    sizes = [padded_size(len(t)) for t in texts]
    data = np.frombuffer(b"".join(t.ljust(n, b"\0") for t, n in zip(texts, sizes, strict=True)) + bytes(WIDTH), np.uint8)
    return data, np.array(sizes) // HALF


def shut_ends(by_half: np.ndarray, last: np.ndarray, places: int) -> None:
    """Leaves out the last places, all in the padding, from which a filter would reach into the next text."""
    by_half[last, -places:] = -np.inf


def half_maxima(data: np.ndarray, counts: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """Largest value of each filter over the places that start in each half chunk.

    Byte pairs serve as table rows: once for the places at even offsets, once for those at odd ones.
    """
    steps = HALF // 2
    last, halves = np.cumsum(counts) - 1, int(counts.sum())
    out = np.empty((halves, FILTERS), np.float32)
    for i in range(0, halves, SCORED_BYTES // HALF):
        n = min(halves - i, SCORED_BYTES // HALF)
        some = data[i * HALF : (i + n) * HALF + WIDTH]
        for odd in (0, 1):
            pairs = np.ascontiguousarray(some[odd : len(some) - odd]).view("<u2")
            total = tables[0][pairs[: n * steps]]
            for k in range(1, len(tables)):
                total += tables[k][pairs[k : n * steps + k]]
            by_half = total.reshape(n, steps, FILTERS)
            shut_ends(by_half, last[(last >= i) & (last < i + n)] - i, WIDTH // 2 - 1 + odd)
            most = by_half.max(axis=1)
            out[i : i + n] = np.maximum(out[i : i + n], most) if odd else most
    return out


def features(pooled: np.ndarray, chunks: np.ndarray) -> np.ndarray:
    """Mean, largest and smallest pooled value over each document's chunks."""
    starts = np.concatenate([[0], np.cumsum(chunks)[:-1]])
    mean = np.add.reduceat(pooled, starts, axis=0) / chunks[:, None]
    return np.concatenate([mean, np.maximum.reduceat(pooled, starts, axis=0), np.minimum.reduceat(pooled, starts, axis=0)], axis=1)


def pool_chunks(halves: np.ndarray, counts: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunks are neighbouring half chunks of one document; a rectifier follows the maximum."""
    first = np.ones(len(halves), bool)
    first[np.cumsum(counts) - 1] = False  # a document's last half chunk starts no chunk
    starts = np.flatnonzero(first)
    return np.maximum(np.maximum(halves[starts], halves[starts + 1]) + bias, 0), counts - 1


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score_texts(net: Network, tables: list[np.ndarray], texts: list[bytes]) -> np.ndarray:
    data, counts = lay_out(texts)
    pooled, chunks = pool_chunks(half_maxima(data, counts, tables), counts, net.bias)
    return logistic(features(pooled, chunks) @ net.weights + net.offset)


class Adam:
    def __init__(self, *values: np.ndarray):
        self.values, self.t = values, 0
        self.m, self.v = [np.zeros_like(x) for x in values], [np.zeros_like(x) for x in values]

    def step(self, *gradients: np.ndarray) -> None:
        self.t += 1
        for x, g, m, v in zip(self.values, gradients, self.m, self.v, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= RATE * (m / (1 - 0.9**self.t) / (np.sqrt(v / (1 - 0.99**self.t)) + 1e-8) + DECAY * x)


def best_places(filters: np.ndarray, data: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest value of each filter in each half chunk, and the place it comes from."""
    last, halves = np.cumsum(counts) - 1, int(counts.sum())
    values, where = np.empty((halves, FILTERS), np.float32), np.empty((halves, FILTERS), np.int64)
    for i in range(0, halves, SCORED_BYTES // HALF):
        n = min(halves - i, SCORED_BYTES // HALF)
        conv = np.zeros((n * HALF, FILTERS), np.float32)
        for k in range(WIDTH):
            conv += filters[k][data[i * HALF + k : (i + n) * HALF + k]]
        by_half = conv.reshape(n, HALF, FILTERS)
        shut_ends(by_half, last[(last >= i) & (last < i + n)] - i, WIDTH - 1)
        best = by_half.argmax(axis=1)
        values[i : i + n] = np.take_along_axis(by_half, best[:, None, :], axis=1)[:, 0]
        where[i : i + n] = best + HALF * np.arange(i, i + n)[:, None]
    return values, where


def gradients(net: Network, texts: list[bytes], wanted: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the weighted mean logistic loss, by filters, bias, weights and offset."""
    data, counts = lay_out(texts)
    halves, where = best_places(net.filters, data, counts)
    pooled, chunks = pool_chunks(halves, counts, net.bias)
    x = features(pooled, chunks)
    error = (logistic(x @ net.weights + net.offset) - wanted) * weights / len(texts)

    up = (error[:, None] * net.weights).reshape(len(texts), 3, FILTERS)
    doc = np.repeat(np.arange(len(texts)), chunks)
    back = up[doc, 0] / chunks[doc][:, None]
    for part, extreme in ((1, FILTERS), (2, 2 * FILTERS)):
        hit = pooled == x[doc, extreme : extreme + FILTERS]
        ties = np.add.reduceat(hit, np.concatenate([[0], np.cumsum(chunks)[:-1]]), axis=0)
        back += up[doc, part] * hit / ties[doc]
    back *= pooled > 0
    first = np.ones(len(halves), bool)
    first[np.cumsum(counts) - 1] = False
    starts = np.flatnonzero(first)
    chosen = np.where(halves[starts] >= halves[starts + 1], where[starts], where[starts + 1])
    column = np.broadcast_to(np.arange(FILTERS), chosen.shape)
    grad = np.empty_like(net.filters)
    for k in range(WIDTH):
        flat = data[chosen + k].astype(np.int64) * FILTERS + column
        grad[k] = np.bincount(flat.ravel(), back.ravel(), 256 * FILTERS).reshape(256, FILTERS)
    return grad, back.sum(axis=0).astype(np.float32), x.T @ error, error.sum(keepdims=True)


def train(texts: list[bytes], labels: np.ndarray, seed: int = 7) -> Network:
    """Filters and unit together, on whole texts; both labels weigh the same."""
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), rng.normal(0, 0.1, 3 * FILTERS), 0.0)
    offset = np.zeros(1)
    adam = Adam(net.filters, net.bias, net.weights, offset)
    balance = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for i in range(0, len(order), BATCH):
            some = order[i : i + BATCH]
            net.offset = float(offset[0])
            adam.step(*gradients(net, [texts[j] for j in some], labels[some], balance[some]))
    net.offset = float(offset[0])
    return net


def held_out() -> Column:
    """A null doc_id is not held out, and has no label to learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, most_rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES) -> tuple[list[bytes], np.ndarray]:
    """At most `most_rows` texts of each label, chosen by a hash of doc_id among rows that are not held out.

    Of rows that share a doc_id, the least text and the least label serve. Texts above `most_bytes` are passed over. The
    driver gets the chosen texts and no more.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    short = docs.select(F.col("doc_id").cast("long"), "text").where(F.octet_length("text") <= most_bytes)
    chosen = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * most_rows) for q in (0, 1)]
    rows = short.join(F.broadcast(chosen[0].union(chosen[1])), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    first = [F.crc32(F.col("doc_id").cast("string").cast("binary")), F.col("doc_id")]
    picked = [r for q in (0, 1) for r in rows.where(F.col("quality") == q).orderBy(*first).limit(most_rows).collect()]
    return [r.text.encode() for r in picked], np.array([r.quality for r in picked])


def learn(docs: DataFrame, labels: DataFrame, most_rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES) -> Network | None:
    """None if the sample lacks one of the labels."""
    texts, y = training_sample(docs, labels, most_rows, most_bytes)
    return train(texts, y) if len(set(y.tolist())) == 2 else None


def _scorer(net: Network | None):
    """Iterator function from (key, text) batches to (key, score) batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.pair_tables() if net else []
        for batch in slices(batches):
            texts = [t.encode() for t in batch.column(1).to_pylist()]
            out = score_texts(net, tables, texts) if net and texts else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["doc_id", "score"])

    return run


def score_documents(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, held_out, score, predicted of every text, from its bytes alone.

    Null text counts as empty, and an empty text is one chunk of zeros. Without a
    network (labels of one kind only, or none) all scores are 0.5. Rows stay as they are,
    repeated and null ids too; an empty table gives no rows; other columns are ignored. Very long texts are
    convolved in parts and scored as a whole. No shuffle.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(_scorer(net), SCHEMA).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, net: Network | None) -> DataFrame:
    """The rows that score THRESHOLD or more, with all their columns; all rows if there is no network.

    Null text counts as empty and is scored like any other; repeated rows stay or go together; an
    empty table gives no rows. Texts are scored whole, in parts of SCORED_BYTES.
    """
    if net is None:
        return docs
    run = _scorer(net)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            pairs = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows)), batch.column(batch.num_columns - 1)], ["row", "text"])
            for scored in run(iter([pairs])):
                good = pa.array(scored.column(1).to_numpy() >= THRESHOLD)
                yield batch.select(list(range(batch.num_columns - 1))).filter(good)

    names = docs.columns  # the text to score goes behind them, under a name that none of them has
    scored = "text " + "_" * max(map(len, names))
    return docs.withColumn(scored, F.coalesce("text", F.lit(""))).mapInArrow(keep, docs.schema)
