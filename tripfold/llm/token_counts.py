"""Token counts of a sentencepiece model with a whole-token shortcut.

No piece of the vocabulary holds a word-start mark behind another character, and
none holds a line feed, so no merge crosses from one word into the next: a text
costs the sum of its words. `whole_tokens` proves, once and by the library itself,
which words are a single token; those are counted by a lookup, and only the other
words are merged by the library, each once per cache life.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.llm.workers import slices

MARK = "▁"  # fixed value: the model's sign for a space
UNITS = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")
CACHED_WORDS = 600_000  # bounds a worker's memory; speed only
UNITS_A_CALL = 2_000
SCHEMA = "doc_id long, n_bytes long, n_tokens long"


@lru_cache(maxsize=2)
def load_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def count_units(model, units: list[str]) -> list[int]:
    """Tokens of each unit alone. Units hold no line feed; many go to the library at once, each behind a line feed."""
    counts: list[int] = []
    for i in range(0, len(units), UNITS_A_CALL):
        some = units[i : i + UNITS_A_CALL]
        ids = np.array(model.encode("\n" + "\n".join(some).replace(MARK, " "), num_threads=1))
        feeds = np.append(np.flatnonzero(ids == model.piece_to_id("<0x0A>")), len(ids))
        if len(feeds) != len(some) + 1:
            raise ValueError("this model does not keep units apart")
        counts += (np.diff(feeds) - 1).tolist()
    return counts


def whole_tokens(path: str) -> dict[str, int]:
    """Word keys proven to be one token, with their cost. Keys as in `key_of_unit`; a line feed adds one.

    Raises if the vocabulary breaks what the shortcut rests on.
    """
    model = load_model(path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    if any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces) or len(model.encode("\n")) != 2:
        raise ValueError("pieces of this model cross words or line feeds")
    units = [p for p in pieces if p.rfind(MARK) <= 0]
    alone = [u for u, n in zip(units, count_units(model, units), strict=True) if n == 1]
    return {u[1:]: 1 for u in alone if u[0] == MARK} | {"\n" + u: 2 for u in alone if u[0] != MARK}


class Counter:
    def __init__(self, path: str, shortcut: dict[str, int]):
        self.model, self.shortcut, self.cost = load_model(path), shortcut, dict(shortcut)

    def _learn(self, keys: set[str]) -> None:
        if len(self.cost) + len(keys) > CACHED_WORDS:
            self.cost = dict(self.shortcut)
        new = list(keys.difference(self.cost))
        units = [k[1:] if k[:1] == "\n" else MARK + k for k in new]
        extra = (k[:1] == "\n" for k in new)
        self.cost.update((k, n + x) for k, n, x in zip(new, count_units(self.model, units), extra, strict=True))

    def count(self, texts: list[str]) -> list[int]:
        keys = [self._keys(t) for t in texts]
        self._learn(set(chain.from_iterable(keys)))
        get = self.cost.__getitem__
        return [sum(map(get, k)) for k in keys]

    def _keys(self, text: str) -> list[str]:
        """A key stands for a word after a space or, with a line feed in front, for that line feed and what follows it."""
        if not text:
            return []
        keys = text.replace("\n", " \n").split(" ")
        if "" not in keys and MARK not in text:
            return keys
        out: list[str] = []
        for unit in UNITS.findall(MARK + text.replace(" ", MARK)):  # runs of spaces belong to the word behind them
            if unit[0] == MARK:
                out.append(unit[1:])
            elif unit == "\n":
                out.append(unit)
            else:
                out[-1] += unit
        return out


@lru_cache(maxsize=2)
def _counter(path: str, shortcut: tuple) -> Counter:
    return Counter(path, dict(shortcut))


def count_tokens(docs: DataFrame, path: str, limit: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every text.

    Null text counts as empty: 0 bytes, 0 tokens. Rows stay as they are, repeated and
    null ids too; an empty table gives no rows; other columns are ignored. Very long texts are counted whole. One pass, no shuffle. What a worker keeps is bounded by
    CACHED_WORDS; the model file and the proven list are bounded by the vocabulary.
    """
    shortcut = tuple(whole_tokens(path).items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, shortcut)
        for batch in slices(batches):
            texts = batch.column(1)
            n = counter.count(texts.to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, SCHEMA).withColumn("over_limit", F.col("n_tokens") > limit)
