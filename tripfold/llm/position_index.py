"""Positional inverted index over a corpus, and exact phrase and proximity search in it.

The index is a table on shared storage. Consecutive documents of an input partition form
segments of about SEGMENT_WORDS words; a row holds the positions of one term in one segment,
and one more row per segment says where its documents lie. Building it moves no text. A document
longer than a segment goes on in the next one, which repeats the last words before its own as
context; a match belongs to the segment that owns its last word.

A search fetches only the postings of the terms asked for. Each phrase visits the segments of
its rarest term; there the lists of its terms, moved by their places in the phrase, are
intersected from the shortest one on.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripfold.llm.ordered import kept
from tripfold.llm.workers import slices
from tripfold.sources.paths import scratch_root

SEGMENT_WORDS = 1 << 20  # words of a segment, about: 4 MB of positions
SEGMENT_DOCS = 200_000  # documents of a segment at most
PIECE_BYTES = 1 << 20  # text cut into words at a time
BLOCK_PHRASES = 200_000  # phrases that meet a segment in one task
LONGEST = 64  # words of the longest phrase or span that an index can find by default

#: ASCII letters in lower case and digits stay, as do all bytes of other characters; the rest parts words.
PARTS_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

DOC = pa.struct([("doc_key", pa.int64()), ("doc_id", pa.int64()), ("first", pa.int64()), ("context", pa.int64()), ("own", pa.int64()), ("before", pa.int64())])
INDEX_SCHEMA = "segment long, term string, n long, positions binary, docs array<struct<doc_key: long, doc_id: long, first: long, context: long, own: long, before: long>>"
MATCHES = "doc_key long, phrase_id long, start long, length long"


@dataclass(frozen=True)
class PositionIndex:
    path: str
    longest: int  # words of the longest phrase or span it can find

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(INDEX_SCHEMA).parquet(self.path)

    def documents(self, spark: SparkSession) -> DataFrame:
        """doc_key (one per row of the corpus), doc_id, n_words."""
        rows = self.table(spark).where("term is null").select(F.inline("docs"))
        return rows.groupBy("doc_key").agg(F.first("doc_id").alias("doc_id"), F.sum("own").alias("n_words"))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(PARTS_WORDS).split()


def word_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time. A word longer than a piece stays whole."""
    if len(text) <= 2 * PIECE_BYTES:
        yield words_of(text)
        return
    text, at = text.translate(PARTS_WORDS), 0
    while at < len(text):
        end = text.find(b" ", at + PIECE_BYTES)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


class Segment:
    """Words of consecutive documents, numbered as they come."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.terms: dict[bytes, int] = defaultdict(count().__next__)
        self.parts: list[np.ndarray] = []
        self.docs: list[dict] = []

    def open(self, doc_key: int, doc_id: int | None, context: list[bytes], before: int) -> None:
        """Begins a document, `before` words of which lie in earlier segments, the last of them as context."""
        self.docs.append({"doc_key": doc_key, "doc_id": doc_id, "first": self.size, "context": len(context), "own": 0, "before": before - len(context)})
        self._put(context)

    def add(self, words: list[bytes]) -> None:
        self.docs[-1]["own"] += len(words)
        self._put(words)

    def _put(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.terms.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def rows(self) -> Iterator[pa.RecordBatch]:
        names = ["segment", "term", "n", "positions", "docs"]
        docs = pa.array([self.docs], pa.list_(DOC))
        yield pa.RecordBatch.from_arrays([pa.array([self.number], pa.int64()), pa.nulls(1, pa.string()), pa.array([0], pa.int64()), pa.nulls(1, pa.binary()), docs], names)
        words = np.concatenate(self.parts) if self.parts else np.zeros(0, np.int32)
        order = np.argsort(words, kind="stable").astype("<i4")  # positions, term by term
        sizes = np.bincount(words, minlength=len(self.terms))
        stops = np.cumsum(sizes)
        steps = np.diff(order, prepend=np.int32(0))
        steps[(stops - sizes)[sizes > 0]] = order[(stops - sizes)[sizes > 0]]
        terms = pa.array(list(self.terms), pa.binary()).cast(pa.string())
        for a in range(0, len(terms), 50_000):
            b = min(a + 50_000, len(terms))
            begin = int(stops[a] - sizes[a])
            borders = ((np.concatenate([[begin], stops[a:b]]) - begin) * 4).astype(np.int32)
            lists = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(borders), pa.py_buffer(steps[begin : stops[b - 1]].tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(b - a, self.number)), terms[a:b], pa.array(sizes[a:b].astype(np.int64)), lists, pa.nulls(b - a, pa.list_(DOC))], names)


def _indexer(longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        numbers, keys = count(task), count(task)
        segment = Segment(next(numbers))
        for batch in slices(batches, 200):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if segment.size >= SEGMENT_WORDS or len(segment.docs) >= SEGMENT_DOCS:
                    yield from segment.rows()
                    segment = Segment(next(numbers))
                key, done, tail = next(keys), 0, []
                segment.open(key, doc_id, [], 0)
                for words in word_pieces(text):
                    at = 0
                    while at < len(words):
                        if segment.size >= SEGMENT_WORDS + longest:
                            yield from segment.rows()
                            segment = Segment(next(numbers))
                            segment.open(key, doc_id, tail, done)
                        some = words[at : at + SEGMENT_WORDS + longest - segment.size]
                        segment.add(some)
                        at, done = at + len(some), done + len(some)
                        tail = (some if len(some) >= longest else tail + some)[-(longest - 1) :] if longest > 1 else []
        if segment.docs:
            yield from segment.rows()

    return run


def build_index(docs: DataFrame, longest: int = LONGEST) -> PositionIndex:
    """Writes the index of all texts to a new folder of the shared scratch space.

    A row of `docs` (doc_id, text; more columns are ignored) is a document of its own, repeated and
    null ids too. Null and empty texts have no words and no postings. An empty table gives an empty index.
    """
    index = PositionIndex(f"{scratch_root(docs.sparkSession)}/index", longest)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows.mapInArrow(_indexer(longest), INDEX_SCHEMA).write.parquet(index.path)
    return index


class Lists:
    """The postings of one segment that a search asked for, and where its documents lie."""

    def __init__(self, table: pa.Table):
        self.found: dict[str, bytes | np.ndarray] = {}
        docs: list[dict] = []
        for term, positions, inside in zip(*(table.column(c).to_pylist() for c in ("term", "positions", "docs")), strict=True):
            if term is None:
                docs = inside
            else:
                self.found[term] = positions
        self.key, self.first, self.context, self.own, self.before = (np.array([d[c] for d in docs], np.int64) for c in ("doc_key", "first", "context", "own", "before"))

    def of(self, term: str) -> np.ndarray:
        """Ascending positions."""
        found = self.found[term]
        if not isinstance(found, np.ndarray):
            found = self.found[term] = np.cumsum(np.frombuffer(found, "<i4"), dtype=np.int64)
        return found

    def size(self, term: str) -> int:
        return len(self.found[term]) // 4 if isinstance(self.found[term], bytes) else len(self.found[term])

    def inside(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """doc_key, first word and length of the spans that lie in one document, and whose last word this segment owns."""
        doc = np.searchsorted(self.first, starts, side="right") - 1
        good = (ends <= self.first[doc] + self.context[doc] + self.own[doc]) & (ends > self.first[doc] + self.context[doc])
        doc, starts, ends = doc[good], starts[good], ends[good]
        return self.key[doc], self.before[doc] + starts - self.first[doc], ends - starts


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Values of `a` that are in `b`; both ascend."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return a[b[at] == a]


def phrase_spans(lists: Lists, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Where the words follow each other."""
    places: dict[str, list[int]] = {}
    for i, w in enumerate(words):
        places.setdefault(w, []).append(i)
    starts = None
    for term in sorted(places, key=lists.size):
        for place in places[term]:
            moved = lists.of(term) - place
            starts = moved if starts is None else _common(starts, moved)
            if not len(starts):
                return starts, starts
    return starts, starts + len(words)


def near_spans(lists: Lists, words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest spans of at most `width` words that hold all the words, in any order."""
    terms = sorted(set(words), key=lists.size)
    rare = lists.of(terms[0])
    near = []
    for term in terms:
        own = lists.of(term)
        left = np.searchsorted(rare, own - width + 1)
        near.append(own[(left < len(rare)) & (rare[np.minimum(left, len(rare) - 1)] < own + width)])
    ends = np.unique(np.concatenate(near))
    starts = ends.copy()
    for own in near:
        at = np.searchsorted(own, ends, side="right") - 1
        starts = np.where(at < 0, np.iinfo(np.int64).min // 2, np.minimum(starts, own[at] if len(own) else 0))
        ends, starts = ends[at >= 0], starts[at >= 0]
    first = np.concatenate([[True], starts[1:] > starts[:-1]]) if len(starts) else np.zeros(0, bool)
    good = first & (ends - starts < width)
    return starts[good], ends[good] + 1


def _search(index: PositionIndex, phrases: DataFrame, spans: Callable[[Lists, list[str]], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """doc_key, phrase_id, start, length of all spans. `phrases` has phrase_id and phrase, words parted by spaces."""
    spark = phrases.sparkSession
    phrases = phrases.select("phrase_id", "phrase").where("phrase <> ''")
    if not phrases.where(F.size(F.split("phrase", " ")) > index.longest).isEmpty():
        raise ValueError(f"the index finds phrases of at most {index.longest} words")
    asked = phrases.select("phrase_id", F.explode(F.array_distinct(F.split("phrase", " "))).alias("term"))
    terms = kept(asked.select("term").distinct())

    def postings() -> DataFrame:
        return index.table(spark).where("term is not null").join(terms, "term", "left_semi")

    sizes = kept(postings().groupBy("term").agg(F.sum("n").alias("n")))  # terms asked for that occur at all
    rarest = asked.join(sizes, "term", "left").groupBy("phrase_id").agg(
        F.min_by("term", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term")).alias("term"), F.count("n").alias("known"), F.count("*").alias("terms")
    )
    rarest = rarest.where("known = terms").select("phrase_id", "term")  # a phrase with an unknown word is nowhere

    blocks = max(1, math.ceil(phrases.count() / BLOCK_PHRASES))
    block = F.pmod(F.xxhash64("phrase_id"), F.lit(blocks)).alias("block")
    visits = postings().select("segment", "term").join(rarest, "term").join(phrases, "phrase_id").select("segment", block, "phrase_id", "phrase")
    lists = index.table(spark).where("term is null").unionByName(postings()).select("segment", "term", "positions", "docs")
    lists = lists.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def run(asked_here: pa.Table, listed: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if asked_here.num_rows:
            there = Lists(listed)
            for phrase_id, phrase in zip(asked_here.column("phrase_id").to_pylist(), asked_here.column("phrase").to_pylist(), strict=True):
                words = phrase.split(" ")
                if all(w in there.found for w in words):
                    starts, ends = spans(there, words)
                    if len(starts):
                        key, start, length = there.inside(starts, ends)
                        out.append((key, np.full(len(key), phrase_id), start, length))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["doc_key", "phrase_id", "start", "length"])

    return visits.groupBy("segment", "block").cogroup(lists.groupBy("segment", "block")).applyInArrow(run, MATCHES)


def phrase_matches(index: PositionIndex, phrases: DataFrame) -> DataFrame:
    """doc_key, phrase_id, start (word of the document, from 0), length of every occurrence of every phrase.

    `phrases` has phrase_id and phrase: words as the index has them, parted by single spaces. An
    empty or null phrase occurs nowhere; a phrase that comes twice is found under each of its ids.
    """
    return _search(index, phrases, phrase_spans)


def near_matches(index: PositionIndex, phrases: DataFrame, width: int) -> DataFrame:
    """Like phrase_matches, for the words of each phrase in any order within `width` words: the smallest such spans."""
    if not 0 < width <= index.longest:
        raise ValueError(f"the index finds spans of at most {index.longest} words")
    return _search(index, phrases, lambda lists, words: near_spans(lists, words, width))


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """item (its id as text, empty for null) and phrase: every run of `window` words of its text, or the whole of fewer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 100):
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = words_of(text)
                for at in range(0, max(len(words) - window, 0) + 1 if words else 0, 10_000):
                    found = [b" ".join(words[i : i + window]) for i in range(at, min(at + 10_000, max(len(words) - window, 0) + 1))]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(found), pa.string()), pa.array(found, pa.binary()).cast(pa.string())], ["item", "phrase"])

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "item string, phrase string").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document.

    A document word is hit if it lies in an occurrence of a window of a benchmark item: `window`
    consecutive words, or all words of an item with fewer. n_items counts the items with occurring
    windows; items_sha256 digests their ids, sorted as texts and joined by commas. Null and empty texts
    have no words, on both sides. Rows that repeat an id are documents of their own (items: one
    item); a null item id is the empty text. Empty documents give no rows, an empty benchmark hits nothing. More
    columns are ignored. Very long texts are indexed in parts; a document's matches are combined in one task.
    """
    spark = docs.sparkSession
    index = build_index(docs, window)
    windows = kept(item_windows(benchmark, window))
    phrases = kept(windows.select("phrase").distinct().withColumn("phrase_id", F.monotonically_increasing_id()))
    matches = kept(phrase_matches(index, phrases))

    earlier = Window.partitionBy("doc_key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = matches.groupBy("doc_key", "start").agg(F.max(F.col("start") + F.col("length")).alias("end"))
    fresh = F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(earlier), F.lit(0)))
    hits = spans.withColumn("fresh", F.greatest(fresh, F.lit(0))).groupBy("doc_key").agg(F.sum("fresh").alias("n_hit"))

    named = windows.join(phrases, "phrase").select("phrase_id", "item")
    items = matches.select("doc_key", "phrase_id").distinct().join(named, "phrase_id").groupBy("doc_key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    found = index.documents(spark).join(hits, "doc_key", "left").join(items, "doc_key", "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return found.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
