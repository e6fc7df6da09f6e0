"""Order-preserving packing: window cuts by dynamic programming with a monotone queue.

The documents, in doc_id order, form one stream of tokens. A window may end behind
a document (free), behind a sentence, or, where sentences are long, at a fixed step
inside one; the last two cut a document and cost a penalty, counted in padding
tokens. best[j], the least padding plus penalties of all windows up to cut j, is the
minimum of best[i] + limit - (pos[j] - pos[i]) + penalty[j] over the cuts i at most
`limit` tokens back: a sliding-window minimum of best[i] + pos[i].
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.llm.encoded import as_ids, encode_documents
from tripfold.llm.ordered import IN_ORDER, by_bucket, kept, offsets, partitions, placed, row_bounds
from tripfold.llm.wordcodec import load_tokenizer
from tripfold.llm.workers import slices

SENTENCE_CUT = 8  # penalties, in tokens of padding
INNER_CUT = 48
INNER_GAP = 128  # a stretch without a sentence end longer than this gets inner cuts,
INNER_STEP = 32  # so far apart
RANGE_BYTES = 4 << 20  # least text of a range of documents that one task packs, about 500 sequences
BLOCK_TOKENS = 1 << 20  # the programme runs over so many tokens at a time;
HELD_WINDOWS = 16  # its last windows are planned again with the next block
COLUMNS = ["bucket", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "window", "offset"]
SCHEMA = "bucket int, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, window long, offset long"


def choose_cuts(places: list[int], penalties: list[int], limit: int) -> list[int]:
    """Indices of the chosen cuts, first and last place included. No gap between places may exceed `limit`."""
    best, back, keys = [0] * len(places), [0] * len(places), [places[0]] + [0] * (len(places) - 1)
    queue = deque([0])
    for j in range(1, len(places)):
        place = places[j]
        while places[queue[0]] < place - limit:
            queue.popleft()
        i = queue[0]
        back[j] = i
        best[j] = cost = keys[i] + limit - place + penalties[j]
        keys[j] = key = cost + place
        while queue and keys[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(places) - 1
    while j:
        cuts.append(j)
        j = back[j]
    return [0, *reversed(cuts)]


@lru_cache(maxsize=2)
def sentence_ends(path: str) -> np.ndarray:
    """For each id: whether the token is a word's end that closes a sentence."""
    tokenizer = load_tokenizer(path)
    ends = np.zeros(tokenizer.get_vocab_size(), bool)
    for token, i in tokenizer.get_vocab().items():
        ends[i] = token.removesuffix("</w>")[-1:] in (".", "!", "?") and token.endswith("</w>")
    return ends


def cut_places(ids: np.ndarray, ends: np.ndarray, closed: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places behind which a part of a document may be cut, and their penalties. `closed`: the document ends here."""
    stops = np.flatnonzero(ends[ids]) + 1
    if not len(stops) or stops[-1] != len(ids):
        stops = np.append(stops, len(ids))
    gaps = np.diff(stops, prepend=0)
    inner = [np.arange(stop - gap + INNER_STEP, stop, INNER_STEP) for stop, gap in zip(stops[gaps > INNER_GAP], gaps[gaps > INNER_GAP], strict=True)]
    inner = np.concatenate(inner) if inner else np.zeros(0, np.int64)
    places = np.concatenate([stops, inner])
    penalties = np.concatenate([np.full(len(stops), SENTENCE_CUT), np.full(len(inner), INNER_CUT)])
    order = np.argsort(places, kind="stable")
    places, penalties = places[order], penalties[order]
    if closed:
        penalties[-1] = 0
    elif not ends[ids[-1]]:
        penalties[-1] = INNER_CUT
    return places, penalties


class Packer:
    """Packs a stream of documents; holds about one block of tokens, whatever the length of a document."""

    def __init__(self, limit: int, ends: np.ndarray):
        self.limit, self.ends = limit, ends
        self.parts: list[tuple] = []  # doc_id, place in its document, ids, whether it ends there, doc_tokens
        self.size = self.windows = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        for at in range(0, len(ids), BLOCK_TOKENS):
            part = ids[at : at + BLOCK_TOKENS]
            self.parts.append((doc_id, at, part, at + len(part) == len(ids), len(ids)))
            self.size += len(part)
            if self.size >= BLOCK_TOKENS:
                yield from self.flush(HELD_WINDOWS * self.limit)

    def flush(self, hold: int = 0) -> Iterator[tuple]:
        """Rows of the windows that end at least `hold` tokens before the end of what there is."""
        if not self.parts:
            return
        places, penalties, at = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 0
        for _, _, ids, closed, _ in self.parts:
            p, c = cut_places(ids, self.ends, closed)
            places.append(p + at)
            penalties.append(c)
            at += len(ids)
        flat = np.concatenate(places).tolist()
        cuts = [flat[i] for i in choose_cuts(flat, np.concatenate(penalties).tolist(), self.limit)]
        cuts = [c for c in cuts if c <= at - hold] if hold else cuts
        yield from self._rows(cuts)

    def _rows(self, cuts: list[int]) -> Iterator[tuple]:
        parts, k, used = self.parts, 0, 0  # `used` ids of part k are placed
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            at = begin
            row = None
            while at < end:
                doc_id, place, ids, _, total = parts[k]
                n = min(end - at, len(ids) - used)
                data = ids[used : used + n].astype("<u4").tobytes()
                if row and place:  # the next part of the same document
                    row = (doc_id, row[1], row[2] + n, zlib.crc32(data, row[3]), *row[4:])
                else:
                    if row:
                        yield row
                    row = (doc_id, place + used, n, zlib.crc32(data), total, self.windows, at - begin)
                at, used = at + n, used + n
                if used == len(ids):
                    k, used = k + 1, 0
            if row:
                yield row
            self.windows += 1
        if used:
            doc_id, place, ids, closed, total = parts[k]
            parts[k] = (doc_id, place + used, ids[used:], closed, total)
        self.parts = parts[k:]
        self.size -= cuts[-1]


def pack_documents(docs: DataFrame, path: str, limit: int, end_id: int) -> DataFrame:
    """Packs the ids of every text, with `end_id` behind each, into sequences of at most `limit` ids.

    One row per piece: doc_id, start (its document's ids before it), length,
    ids_crc32 (of the ids as little-endian uint32), doc_tokens, sequence_id (gapless),
    offset. Documents keep their doc_id order (null ids first, rows of one id by
    a hash of their text), each id lies in exactly one piece. Null text is empty: a piece with
    the end id. An empty table gives no rows; other columns are ignored.

    Only ids are shuffled, once, into one partition per range of that order, which may cut among rows of one
    id; a very long text is read in parts of BLOCK_TOKENS ids. A range ends its last
    sequence early, which costs at most one sequence's padding per range.
    """
    if limit < INNER_GAP:
        raise ValueError(f"sequences need room for {INNER_GAP} ids")
    rows = placed(docs)
    bounds = row_bounds(rows, partitions(docs), RANGE_BYTES)
    vocabulary = load_tokenizer(path).get_vocab_size()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, bucket = Packer(limit, sentence_ends(path)), 0

        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(COLUMNS, (bucket, *r), strict=True)) for r in rows], pa.schema([(c, pa.int32() if c == "bucket" else pa.int64()) for c in COLUMNS]))

        for batch in slices(batches):
            rows = []
            for key, bucket, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows += packer.add(key, as_ids(ids, vocabulary))
            yield table(rows)
        yield table(list(packer.flush()))

    encoded = encode_documents(rows, path, end_id, False, bounds)
    ordered = by_bucket(encoded, "bucket", bounds).sortWithinPartitions(*IN_ORDER).select("doc_id", "bucket", "ids")
    pieces = kept(ordered.mapInArrow(run, SCHEMA))
    sizes = pieces.groupBy("bucket").agg((F.max("window") + 1).alias("windows"))
    first = offsets(sizes, "bucket", "windows", "before").select("bucket", "before")
    return pieces.join(first, "bucket").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("window")).alias("sequence_id"), "offset")
