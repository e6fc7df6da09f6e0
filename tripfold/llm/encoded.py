"""Documents as token ids, marked with the bucket of their place in the doc_id order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripfold.llm.ordered import IN_ORDER, bucket_of_place
from tripfold.llm.wordcodec import codec, load_tokenizer
from tripfold.llm.workers import slices


def id_bits(vocabulary: int) -> int:
    """Least width that holds every id below `vocabulary`."""
    return max(1, (vocabulary - 1).bit_length())


def encode_documents(rows: DataFrame, path: str, end_id: int, spaces_matter: bool, bounds: list[tuple]) -> DataFrame:
    """doc_id, hash, salt, bucket and ids (little-endian, 16 bits each if the vocabulary allows, else 32) of `placed` rows, the end id included."""
    width = 16 if id_bits(load_tokenizer(path).get_vocab_size()) <= 16 else 32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = codec(path, spaces_matter)
        end = np.array([end_id], f"<u{width // 8}").tobytes()
        for batch in slices(batches):
            found = words.encode(batch.column(3).to_pylist())
            ids = [x.astype(f"<u{width // 8}").tobytes() + end for x in found]
            buckets = [bucket_of_place(bounds, *place) for place in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(buckets, pa.int32()), pa.array(ids, pa.binary())], [*IN_ORDER, "bucket", "ids"])

    return rows.select(*IN_ORDER, "text").mapInArrow(run, "doc_id long, hash long, salt long, bucket int, ids binary")


def as_ids(data: bytes, vocabulary: int) -> np.ndarray:
    """The ids of a row of `encode_documents`."""
    return np.frombuffer(data, "<u2" if id_bits(vocabulary) <= 16 else "<u4")
