"""Token ids in files of fixed-width packed integers.

A file, all numbers little-endian:

    header   8 bytes magic, uint32 bits of an id, uint32 ids of a block
    blocks   ids packed `bits` wide, lowest bit first; every block starts on a byte
    footer   uint64 block offsets | int64 doc ids | uint8 doc id is null | uint64 doc starts
    trailer  uint64 blocks, documents, ids, place of the footer; 8 bytes magic

A reader finds any id from the block offsets, and unpacks whole blocks with numpy.
Files go wherever pyarrow can write, under names that a repeated task attempt
gives again, with a rename at the end; so a lost executor leaves nothing half done.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfold.llm.encoded import as_ids, encode_documents, id_bits
from tripfold.llm.ordered import IN_ORDER, by_bucket, offsets, partitions, placed, row_bounds
from tripfold.llm.wordcodec import load_tokenizer
from tripfold.llm.workers import slices
from tripfold.sources.paths import make_dir

MAGIC = b"TFTOKEN1"
BLOCK_IDS = 4096
FILE_IDS = 8_000_000  # a file is closed at the first document that reaches this
MANIFEST = "file string, n_docs long, n_ids long"
ROWS = "file string, place long, doc_id long, start long, n_tokens long, ids_crc32 long"


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(spread[:, :bits], bitorder="little").tobytes()


def unpack(data: bytes | memoryview, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype("<u4")
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = flat
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


def file_bytes(doc_ids: list[int | None], docs: list[np.ndarray], bits: int, block: int = BLOCK_IDS) -> bytes:
    ids = np.concatenate(docs) if docs else np.zeros(0, "<u4")
    packed = [pack(ids[i : i + block], bits) for i in range(0, len(ids), block)]
    head = MAGIC + np.array([bits, block], "<u4").tobytes()
    places = len(head) + np.cumsum([0, *map(len, packed)], dtype="<u8")
    starts = np.cumsum([0, *map(len, docs)], dtype="<u8")
    footer = [
        places[:-1].tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        starts.tobytes(),
    ]
    trailer = np.array([len(packed), len(docs), len(ids), places[-1]], "<u8").tobytes() + MAGIC
    return b"".join([head, *packed, *footer, trailer])


class TokenFile:
    """Reads from `read(place, size)`, so that a remote file is read in parts."""

    def __init__(self, read, size: int):
        self.read = read
        trailer = read(size - 40, 40)
        if trailer[32:] != MAGIC:
            raise ValueError("not a token file, or cut short")
        n_blocks, self.n_docs, self.n_ids, footer = (int(x) for x in np.frombuffer(trailer, "<u8", 4))
        self.bits, self.block = (int(x) for x in np.frombuffer(read(8, 8), "<u4"))
        data = memoryview(read(footer, size - 40 - footer))
        self.blocks = np.append(np.frombuffer(data, "<u8", n_blocks), np.uint64(footer)).astype(np.int64)
        at = 8 * n_blocks
        ids = np.frombuffer(data, "<i8", self.n_docs, at).tolist()
        null = np.frombuffer(data, np.uint8, self.n_docs, at + 8 * self.n_docs)
        self.doc_ids = [None if x else d for d, x in zip(ids, null, strict=True)]
        self.starts = np.frombuffer(data, "<u8", self.n_docs + 1, at + 9 * self.n_docs).astype(np.int64)

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids begin..end-1 of the file, from the blocks that hold them."""
        if end <= begin:
            return np.zeros(0, "<u4")
        first, last = begin // self.block, (end - 1) // self.block
        place = int(self.blocks[first])
        data = memoryview(self.read(place, int(self.blocks[last + 1]) - place))
        parts = []
        for b in range(first, last + 1):
            n = min(self.block, self.n_ids - b * self.block)
            at = int(self.blocks[b]) - place
            parts.append(unpack(data[at : at + (n * self.bits + 7) // 8], self.bits, n))
        return np.concatenate(parts)[begin - first * self.block : end - first * self.block]

    def document(self, place: int) -> np.ndarray:
        return self.ids(int(self.starts[place]), int(self.starts[place + 1]))


def open_file(path: str) -> TokenFile:
    """Random access to one file by path or URI."""
    fs, inner = pafs.FileSystem.from_uri(path)
    source = fs.open_input_file(inner)
    return TokenFile(lambda place, size: source.read_at(size, place), source.size())


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int) -> DataFrame:
    """Encodes all texts and writes them in ascending doc_id order; returns one row per file.

    File names ascend with doc_id (null ids first; rows of one id are ordered by
    a hash of their text). Null text is empty and so holds the end id alone. An empty
    table writes no file. Texts stay where they are: only ids, two bytes each, are
    shuffled, once, into one partition per range of that order, which may cut among rows of one id.
    """
    spark = docs.sparkSession
    vocabulary = load_tokenizer(path).get_vocab_size()
    bits = id_bits(vocabulary)
    rows = placed(docs)
    bounds = row_bounds(rows, partitions(docs))
    make_dir(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, inner = pafs.FileSystem.from_uri(folder)
        names, keys, held, size = 0, [], [], 0

        def close(bucket: int) -> pa.RecordBatch:
            name = f"{bucket:08d}-{names:06d}.tok"
            target, attempt = f"{inner}/{name}", f"{inner}/_{name}.{np.random.default_rng().integers(2**62)}"
            with fs.open_output_stream(attempt) as out:
                out.write(file_bytes(keys, held, bits))
            fs.move(attempt, target)
            return pa.RecordBatch.from_pydict({"file": [name], "n_docs": [len(keys)], "n_ids": [size]})

        bucket = 0
        for batch in slices(batches):
            for key, bucket, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys.append(key)
                held.append(as_ids(ids, vocabulary))
                size += len(held[-1])
                if size >= FILE_IDS:
                    yield close(bucket)
                    names, keys, held, size = names + 1, [], [], 0
        if keys:
            yield close(bucket)

    encoded = encode_documents(rows, path, end_id, True, bounds)
    ordered = by_bucket(encoded, "bucket", bounds).sortWithinPartitions(*IN_ORDER).select("doc_id", "bucket", "ids")
    return ordered.mapInArrow(run, MANIFEST)


def read_token_files(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    `files` is what `write_token_files` returned, kept in a table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            for path, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = memoryview(content)
                file = TokenFile(lambda place, size, data=data: bytes(data[place : place + size]), len(data))
                ids, ends = file.ids(0, file.n_ids), file.starts
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                n = file.n_docs
                yield pa.RecordBatch.from_pydict(
                    {"file": [path.rpartition("/")[2]] * n, "place": range(n), "doc_id": pa.array(file.doc_ids, pa.int64()), "start": ends[:-1], "n_tokens": np.diff(ends), "ids_crc32": pa.array(crc, pa.int64())}
                )

    names = spark.read.schema("path string, modificationTime timestamp, length long, content binary").format("binaryFile")
    found = names.option("pathGlobFilter", "[0-9]*.tok").load(folder).select("path", "content").mapInArrow(run, ROWS)
    before = offsets(files, "file", "n_ids", "before").select("file", "before")
    return found.join(before, "file").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
