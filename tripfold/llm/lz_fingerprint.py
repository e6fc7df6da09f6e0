"""Lempel-Ziv phrase fingerprints.

A text is parsed into the phrases of an incremental dictionary (each the longest
known phrase plus one character). The set of phrases is hashed, and the least hash
under each of SIGNATURE permutations makes the fingerprint. The share of equal
places estimates how much of their dictionaries two texts share, as a compressor
would find it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.llm.ordered import bucket_of, by_bucket, partitions, placed, row_bounds
from tripfold.llm.workers import slices

SIGNATURE = 64
PLACE_BITS = 16  # kept of each minimum
LONGEST = 1 << 16  # powers of the phrase hash, more than a phrase of a text below 2 GB can have
SLICE = 4096  # phrases hashed at a time
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


class Phrases:
    """Parses text piece by piece; a copy goes on independently."""

    def __init__(self):
        self.known: set[str] = set()
        self.open = ""  # the phrase begun, known so far
        self.ends: list[int] = []  # where phrases end in the text
        self.at = 0

    def copy(self) -> Phrases:
        other = Phrases()
        other.known, other.open, other.ends, other.at = self.known.copy(), self.open, self.ends.copy(), self.at
        return other

    def read(self, text: str) -> Phrases:
        known, phrase, at = self.known, self.open, self.at
        learn, end = known.add, self.ends.append
        for character in text:
            at += 1
            phrase += character
            if phrase not in known:
                learn(phrase)
                end(at)
                phrase = ""
        self.open, self.at = phrase, at
        return self


@lru_cache(maxsize=1)
def _constants() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(78)
    powers = np.full(LONGEST, 0x9E3779B97F4A7C15, np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64), rng.integers(1, 2**63, SIGNATURE).astype(np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, SIGNATURE).astype(np.uint64)


def phrase_hashes(text: str, ends: list[int]) -> np.ndarray:
    """A 64-bit hash of every phrase: the phrases are the stretches of the text between the ends."""
    powers = _constants()[0]
    last = ends[-1]
    codes = np.frombuffer(text[:last].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    stops = np.array(ends)
    starts = np.concatenate([[0], stops[:-1]])
    inside = np.arange(last) - np.repeat(starts, stops - starts)
    h = np.add.reduceat(codes * powers[inside], starts)
    h ^= h >> np.uint64(32)  # spread the low bits, which carry the polynomial, over the word
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def signature(text: str, phrases: Phrases) -> np.ndarray:
    if not phrases.ends:
        return np.full(SIGNATURE, (1 << PLACE_BITS) - 1, np.uint16)
    _, factors, shifts = _constants()
    hashes = phrase_hashes(text, phrases.ends)
    least = np.full(SIGNATURE, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), SLICE):
        some = hashes[i : i + SLICE]
        np.minimum(least, (some[None, :] * factors[:, None] + shifts[:, None]).min(axis=1), out=least)
    mixed = least * np.uint64(0x9E3779B97F4A7C15)  # minima are small: their top bits say little
    return (mixed >> np.uint64(64 - PLACE_BITS)).astype(np.uint16)


def as_text(places: np.ndarray) -> str:
    return places.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def fingerprint_pair(text: str, other: str) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of two texts; what they begin with alike is parsed once."""
    third = len(text) // 3
    shared = Phrases().read(text[: len(text) - third])
    second = shared.copy().read(other[len(text) - third :])
    return signature(text, shared.read(text[len(text) - third :])), signature(other, second)


def fingerprint(text: str) -> np.ndarray:
    return signature(text, Phrases().read(text))


def _in_order(docs: DataFrame) -> DataFrame:
    """doc_id, text and extra, one partition per range of rows, in descending doc_id order.

    Behind its last row a partition has the first row of the range below as an extra
    one; the lowest has that of the highest.
    """
    rows = placed(docs)
    bounds = row_bounds(rows, partitions(docs))
    rows = rows.withColumn("bucket", bucket_of(bounds))
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "hash")
    tops = {r.bucket: tuple(r.top) for r in rows.groupBy("bucket").agg(F.max(place).alias("top")).collect()}  # one narrow row per range
    used = sorted(tops)
    above = dict(zip(used, [*used[1:], *used[:1]], strict=True))
    spark = docs.sparkSession
    ends = spark.createDataFrame([(b, d, h, above[b]) for b, (_, d, h) in tops.items()], "bucket int, top long, top_hash long, above int")
    same = (rows.bucket == ends.bucket) & rows.doc_id.eqNullSafe(ends.top) & (rows.hash == ends.top_hash)
    # of equal rows at the top of a range, one is enough
    firsts = rows.join(F.broadcast(ends), same).select("doc_id", "text", "hash", "salt", F.col("above").alias("bucket")).dropDuplicates(["bucket"])
    both = rows.withColumn("extra", F.lit(False)).unionByName(firsts.withColumn("extra", F.lit(True)))
    return by_bucket(both, "bucket", bounds).sortWithinPartitions("extra", F.desc_nulls_last("doc_id"), F.desc("hash"), F.desc("salt")).select("doc_id", "text", "extra")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one behind in descending doc_id order (null ids last, rows of
    one id by a hash of their text), for the last one the first. Null text counts as empty. An empty text has
    the fingerprint of no phrases, alike only to itself. An empty table gives no
    rows; a single row is its own next. Other columns are ignored. Texts are shuffled
    once, into ranges of that order, which may cut among rows of one id; a task holds one batch of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        current: tuple | None = None  # doc_id and text still without a next text
        waiting: tuple | None = None  # a row, and its fingerprint, still without the next fingerprint

        def finish(places: np.ndarray) -> None:
            if waiting:
                row, own = waiting
                done.append(row | {"near_next": likeness(own, places)})

        for batch in slices(batches):
            for doc_id, text, extra in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if current:
                    changed = edited(current[1], text)
                    own, other = fingerprint_pair(current[1], changed)
                    finish(own)
                    waiting = (
                        {
                            "doc_id": current[0],
                            "n_chars": len(current[1]),
                            "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(),
                            "fingerprint": as_text(own),
                            "edited_fingerprint": as_text(other),
                            "near_edited": likeness(own, other),
                        },
                        own,
                    )
                if extra:  # closes the range
                    if current:
                        finish(fingerprint(text))
                    current = waiting = None
                    break
                current = (doc_id, text)
            if done:
                yield pa.RecordBatch.from_pylist(done)
                done = []

    return _in_order(docs).mapInArrow(run, SCHEMA)
