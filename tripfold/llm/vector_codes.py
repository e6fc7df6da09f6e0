"""Product quantisation with exact integer k-means over Hilbert-sorted blocks.

Vectors are cut into PARTS parts, and each part position has a codebook. Chunks of
vectors stay together; within a chunk, the parts of one position are sorted along a Hilbert
curve and laid out flat, in blocks of BLOCK neighbours with their smallest and largest
components and their sum. A round compares each block's box with the codebook: an entry whose
least distance to the box is above the greatest distance of another can be nearest to
none of its parts, nor one that is farther than another from the corner that lies best for it. The entries that remain are the block's shortlist. A shortlist of
one takes the block's sum as a whole; the others are evaluated part by part in integers. So a
round moves nothing but sums, and the chunks are written once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.llm import vector_tables as vt
from tripfold.llm.ordered import kept

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256  # fixed values of the production codes
CHUNK = 1 << 14  # vectors at most; a place fits 16 bits
BLOCK = 16  # parts
CURVE_BITS = 8  # of each dimension on the curve; order only
SMALL = 1 << 27  # components below: squared distances of up to 64 of them fit 64 bits
MOST = (1 << 63) - 1024  # larger components are held at this size; the greatest double below 2 ** 63
LONG = (1 << 63) - 1
CHUNKS = "vec_ids array<long>, labels array<string>, wide boolean, points binary, place binary, low binary, high binary, sums binary"


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points (n, dimensions) of `bits` bits each; dimensions * bits is at most 63."""
    axes = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    q = 1 << (bits - 1)
    while q > 1:  # from the coarsest cell down, undo how the curve turns within it
        for i in range(len(axes)):
            high = (axes[i] & q) != 0
            swap = np.where(high, 0, (axes[0] ^ axes[i]) & (q - 1))
            axes[0] = np.where(high, axes[0] ^ (q - 1), axes[0] ^ swap)
            axes[i] = axes[i] ^ swap
        q >>= 1
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    turn, q = np.zeros(len(points), np.int64), 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((axes[-1] & q) != 0, q - 1, 0)
        q >>= 1
    key = np.zeros(len(points), np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | (((axis ^ turn) >> bit) & 1)
    return key


def curve_order(points: np.ndarray) -> np.ndarray:
    """The points along a Hilbert curve through their box; of wide points, the first dimensions decide."""
    points = points[:, :63]
    bits = max(1, min(CURVE_BITS, 63 // points.shape[1]))
    low = points.min(axis=0)
    over = max(0, int((points - low).max()).bit_length() - bits)
    return np.argsort(hilbert_keys((points - low) >> over, bits), kind="stable")


class Blocks:
    """The parts of one position in a chunk, along the curve. The last block is filled up with its last part."""

    def __init__(self, points: np.ndarray, low: np.ndarray, high: np.ndarray, sums: np.ndarray):
        self.n = len(points)
        self.low, self.high, self.sums = low, high, sums
        short = -self.n % BLOCK
        self.points = np.concatenate([points, np.repeat(points[-1:], short, axis=0)]).reshape(-1, BLOCK, points.shape[1])
        self.sizes = np.full(len(self.points), BLOCK)
        self.sizes[-1] -= short

    @staticmethod
    def boxes(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts = np.arange(0, len(points), BLOCK)
        return np.minimum.reduceat(points, starts), np.maximum.reduceat(points, starts), np.add.reduceat(points, starts)

    def shortlists(self, book: np.ndarray) -> np.ndarray:
        """(blocks, entries): whether an entry may be nearest to a part of the block."""
        least = most = 0
        for j in range(book.shape[1]):
            below, above = self.low[:, j, None] - book[None, :, j], book[None, :, j] - self.high[:, j, None]
            gap, reach = np.maximum(np.maximum(below, above), 0), np.maximum(-below, -above)
            least, most = least + gap * gap, most + reach * reach
        # of what remains, only entries that beat the one of least reach at that corner of the box which lies best for them
        rival = book[most.argmin(axis=1)]
        ahead = 0
        for j in range(book.shape[1]):
            corner = np.where(book[None, :, j] > rival[:, j, None], self.high[:, j, None], self.low[:, j, None])
            own, other = corner - book[None, :, j], corner - rival[:, j, None]
            ahead = ahead + other * other - own * own
        return (least <= most.min(axis=1)[:, None]) & (ahead >= 0)

    def nearest(self, blocks: np.ndarray, listed: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance for the parts of the blocks, over ascending shortlists of equal length."""
        distance = 0
        for j in range(book.shape[1]):
            apart = self.points[blocks, :, None, j] - book[listed, j][:, None, :]
            distance = distance + apart * apart
        best = distance.argmin(axis=2)  # the first of equal ones
        entry = np.take_along_axis(np.broadcast_to(listed[:, None, :], distance.shape), best[:, :, None], axis=2)[:, :, 0]
        return entry, np.take_along_axis(distance, best[:, :, None], axis=2)[:, :, 0]

    def evaluated(self, book: np.ndarray, whole: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(blocks, entry, distance) for the blocks with several entries listed; with `whole`, for all blocks."""
        listed = self.shortlists(book)
        sizes = listed.sum(axis=1)
        rank = np.argsort(~listed, axis=1, kind="stable")  # listed entries first, ascending; those behind are never nearer
        k = 1 if whole else 2
        done = np.zeros(len(sizes), bool) if whole else sizes == 1
        while not done.all():
            now = np.flatnonzero(~done & (sizes <= k))
            for at in range(0, len(now), 64):
                some = now[at : at + 64]
                yield some, *self.nearest(some, rank[some, :k], book)
            done[now] = True
            k *= 2

    def add_to(self, sums: np.ndarray, counts: np.ndarray, book: np.ndarray) -> None:
        """Adds the parts, and their number, to their nearest entries."""
        listed = self.shortlists(book)
        alone = np.flatnonzero(listed.sum(axis=1) == 1)
        only = listed[alone].argmax(axis=1)
        np.add.at(sums, only, self.sums[alone])
        np.add.at(counts, only, self.sizes[alone])
        for blocks, entry, _ in self.evaluated(book, whole=False):
            real = np.arange(BLOCK) < self.sizes[blocks][:, None]
            np.add.at(sums, entry[real], self.points[blocks][real])
            np.add.at(counts, entry[real], 1)

    def codes(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of every part, along the curve."""
        entries, distances = np.zeros(self.points.shape[:2], np.int64), np.zeros(self.points.shape[:2], self.points.dtype)
        for blocks, entry, distance in self.evaluated(book, whole=True):
            entries[blocks], distances[blocks] = entry, distance
        return entries.ravel()[: self.n], distances.ravel()[: self.n]


def _lay_out(whole: np.ndarray, parts: int) -> tuple[bool, list[bytes]]:
    """Whether components are large, and the flat blocks of all positions: points, place of each in the chunk, low, high, sums."""
    wide = bool(len(whole)) and int(np.abs(whole).max()) >= SMALL
    kind = "<i8" if wide else "<i4"
    cut = whole.reshape(len(whole), parts, -1)
    out: list[list[bytes]] = [[], [], [], [], []]
    for p in range(parts):
        order = np.arange(len(cut)) if wide else curve_order(cut[:, p])
        points = cut[order, p]
        low, high, sums = Blocks.boxes(points)
        for into, values, dtype in zip(out, (points, order, low, high, sums), (kind, "<u2", kind, kind, "<i8"), strict=True):
            into.append(values.astype(dtype).tobytes())
    return wide, [b"".join(x) for x in out]


def _positions(row: dict, books: np.ndarray) -> Iterator[tuple[Blocks, np.ndarray, np.ndarray]]:
    """The blocks of each position of a chunk, where each part's vector lies, and the position's codebook."""
    parts, _, width = books.shape
    kind, n = ("<i8" if row["wide"] else "<i4"), len(row["vec_ids"])
    blocks = -(-n // BLOCK)
    arrays = [np.frombuffer(row[c], k).reshape(parts, *shape) for c, k, shape in (("points", kind, (n, width)), ("place", "<u2", (n,)), ("low", kind, (blocks, width)), ("high", kind, (blocks, width)), ("sums", "<i8", (blocks, width)))]
    wide = row["wide"] or int(np.abs(books).max()) >= SMALL
    number = object if wide else np.int64  # without a bound on their size, integers of any length
    for points, place, low, high, sums, book in zip(*arrays, books, strict=True):
        points = points.astype(number)
        blocks = Blocks(points, low.astype(number), high.astype(number), Blocks.boxes(points)[2] if wide else sums)
        yield blocks, place, book.astype(number)


def chunks(rows: DataFrame, parts: int) -> DataFrame:
    """The table of chunks. `rows` has vec_id, label (text) and vector, all of one length."""

    def laid_out(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        some = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        wide, flat = _lay_out(vt.scaled(some, "vector", SCALE, MOST), parts)
        ids, labels = ([some.column(c).to_pylist()] for c in ("vec_id", "label"))
        columns = [pa.array(ids, pa.list_(pa.int64())), pa.array(labels, pa.list_(pa.string())), pa.array([wide])]
        return pa.RecordBatch.from_arrays([*columns, *(pa.array([x], pa.binary()) for x in flat)], ["vec_ids", "labels", "wide", "points", "place", "low", "high", "sums"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                some = batch.slice(at, CHUNK)
                if held and sum(b.num_rows for b in held) + some.num_rows > CHUNK:
                    yield laid_out(held)
                    held = []
                held.append(some)
        if held:
            yield laid_out(held)

    return rows.select("vec_id", "label", "vector").mapInArrow(run, CHUNKS)


def updated(table: DataFrame, books: np.ndarray) -> np.ndarray:
    """Every entry replaced by the mean, rounded down, of the parts nearest to it. `books`: (parts, entries, width)."""
    parts, entries, width = books.shape

    def add(batch: pa.RecordBatch) -> np.ndarray:
        sums, counts = np.zeros((parts, entries, width), object), np.zeros((parts, entries), object)
        for row in batch.to_pylist():
            for p, (blocks, _, book) in enumerate(_positions(row, books)):
                s, c = np.zeros((entries, width), book.dtype), np.zeros(entries, np.int64)
                blocks.add_to(s, c, book)
                sums[p] += s
                counts[p] += c
        return np.concatenate([sums.ravel(), counts.ravel()])

    found = np.array(vt.total(table, add, books.size + parts * entries), object)
    sums, counts = found[: books.size].reshape(books.shape), found[books.size :].reshape(parts, entries)
    out = books.copy()
    used = counts > 0
    out[used] = (sums[used] // counts[used][:, None]).astype(np.int64)
    return out


def _coded(table: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code, error of every vector."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["vec_ids"])
                codes, errors = np.zeros((n, parts), np.uint8), np.zeros(n, object)
                for p, (blocks, place, book) in enumerate(_positions(row, books)):
                    entry, distance = blocks.codes(book)
                    codes[place, p] = entry
                    errors[place] += distance.astype(object)
                digits = codes.tobytes().hex()
                texts = [digits[i : i + 2 * parts] for i in range(0, len(digits), 2 * parts)]
                columns = [pa.array(row["vec_ids"], pa.int64()), pa.array(row["labels"], pa.string()), pa.array(texts), pa.array([min(int(e), LONG) for e in errors], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    return table.mapInArrow(run, "vec_id long, label string, code string, error long")


def quantize(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every usable row of vec_id, embedding, label.

    Components are floor(SCALE * x). The codebooks start from the rows with the least vec_ids
    (of one id, the lesser vector first; rows without an id come last) and are moved `rounds`
    times; ties go to the lower entry. With fewer rows than entries the codebooks are
    smaller. Dropped: rows whose vector is null or empty, holds a null or non-finite component, or is not of the
    commonest length; a commonest length that `parts` does not divide raises ValueError. Components that do not fit 64 bits are
    held at the largest that do, and so are errors. Repeated rows all count; null labels are one label; an empty table
    gives no rows; more columns are ignored.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hexadecimal digits")
    spark = vectors.sparkSession
    rows = vt.usable(vectors, F.col("label").cast("string").alias("label"))
    length = vt.common_length(rows)
    rows = rows.where(F.size("vector") == length) if length else rows.limit(0)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    if not first:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    if length % parts:
        raise ValueError(f"vectors of length {length} have no {parts} equal parts")
    start = pa.RecordBatch.from_arrays([pa.array([r.vector for r in first], pa.list_(pa.float64()))], ["vector"])
    books = vt.scaled(start, "vector", SCALE, MOST).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()

    table = kept(chunks(rows, parts))
    for _ in range(rounds):
        books = updated(table, books)
    digest = hashlib.sha256(",".join(str(x) for x in books.ravel().tolist()).encode()).hexdigest()

    coded = kept(_coded(table, books).withColumn("label", F.coalesce(F.concat(F.lit("="), "label"), F.lit(""))))
    error = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy("label").agg(F.least(error, F.lit(LONG).cast("decimal(38,0)")).cast("long").alias("label_error"))
    return coded.join(sums, "label").select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
