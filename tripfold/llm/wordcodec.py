"""Exact tokenizer output, word by word, with the ids of known words in flat tables.

A tokenizer whose pre-tokens never span the places where this module cuts a text
encodes the parts alone as it encodes them together, so a word's ids need to be
computed once. Words are found by a 64-bit hash, for a whole batch of texts with
numpy, and their bytes are compared. Texts whose white space is not of the plain form "words between
single spaces or line feeds" go to the tokenizer whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np

from tripfold.llm.shingles import Chunks

KNOWN_WORDS = 800_000  # bounds a worker's memory (about 55 bytes a word, twice that while tables grow); speed only
RECENT_WORDS = 50_000  # words learned before they are merged into the large table
GROUP_BYTES = 1 << 20  # text looked up at a time
WORDS_A_CALL = 2_000  # words go to the tokenizer together, parted by a word whose id no other word can hold

#: A word of Latin letters, perhaps with a stop behind.
SIMPLE = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)").fullmatch
SPACE, FEED = 0x20, 0x0A
#: ASCII white space but the space and the line feed (fixed values).
_ODD = np.zeros(256, bool)
_ODD[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = True


def byte_letters() -> dict[int, str]:
    """The public byte alphabet of byte-level models: printable Latin-1 stands for itself, the rest for 256, 257, ..."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_LETTERS = byte_letters()


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def odd_places(codes: np.ndarray) -> np.ndarray:
    """Where bytes of UTF-8 text begin white space other than a space or a line feed, or a special token's `<|`.

    Finds all white space of Unicode; U+2000 to U+202F and U+3000 to U+303F as a whole, which costs speed only.
    """
    found = _ODD[codes]
    a, b = codes[:-1], codes[1:]
    found[:-1] |= (a == ord("<")) & (b == ord("|"))
    lead = np.flatnonzero((a == 0xC2) | ((a >= 0xE1) & (a <= 0xE3)))
    first, second = a[lead], b[lead]
    third = codes[np.minimum(lead + 2, len(codes) - 1)]
    blank = (first == 0xC2) & ((second == 0x85) | (second == 0xA0))
    blank |= (first == 0xE1) & (second == 0x9A) & (third == 0x80)
    blank |= (first == 0xE2) & (second == 0x80) & ((third <= 0x8A) | (third == 0xA8) | (third == 0xA9) | (third == 0xAF))
    blank |= (first == 0xE2) & (second == 0x81) & (third == 0x9F)
    blank |= (first == 0xE3) & (second == 0x80) & (third == 0x80)
    found[lead[blank]] = True
    return found


class Table:
    """Sorted word hashes, and the number of each word."""

    def __init__(self):
        self.hashes, self.words = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes, and which of them are there."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes

    def add(self, hashes: np.ndarray, words: np.ndarray) -> None:
        hashes, words = np.concatenate([self.hashes, hashes]), np.concatenate([self.words, words])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.words = hashes[order], words[order]


def with_room(array: np.ndarray, used: int, more: int) -> np.ndarray:
    """The array, or a longer copy, with places for `more` values behind the first `used` of its last axis."""
    if used + more <= array.shape[-1]:
        return array
    extra = np.zeros((*array.shape[:-1], max(array.shape[-1] // 2, more)), array.dtype)
    return np.concatenate([array, extra], axis=-1)


class WordCodec:
    """Ids of texts. `spaces_matter`: a word carries the white space before it."""

    def __init__(self, path: str, spaces_matter: bool):
        self.tokenizer = load_tokenizer(path)
        self.spaces_matter = spaces_matter
        self.forget()
        self.feed = self._raw(["\n"])[0]
        self.stops = {x: self._raw([x])[0] for x in ("", ".", ",")}
        (self.mark,) = self.tokenizer.encode("\n" if spaces_matter else "~", add_special_tokens=False).ids

    def forget(self) -> None:
        self.known, self.recent = Table(), Table()
        self.ids, self.n_ids = np.zeros(1 << 18, np.uint32), 0
        self.chunks, self.n_chunks = np.zeros(1 << 16, np.uint64), 0
        self.table, self.n_words = np.zeros((4, 1 << 14), np.int32), 0  # of a word: its ids' start and number, its chunks' start, its bytes

    def _raw(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    # --- words that are new ---------------------------------------------------

    def _letters(self, text: str) -> list[int]:
        """One pre-token, in the byte alphabet that the model is written in."""
        if not self.spaces_matter:
            text = text.lower()
        text = text.replace(" ", BYTE_LETTERS[SPACE]) if text.isascii() else text.encode().decode("latin-1").translate(BYTE_LETTERS)
        return [t.id for t in self.tokenizer.model.tokenize(text)]

    def _learn(self, words: list[str]) -> list[list[int]]:
        """Ids of each word. Where spaces matter, a word starts with the space or line feed before it."""
        found: list[list[int] | None] = []
        odd = []
        for word in words:
            bare = word[1:] if self.spaces_matter else word
            simple = SIMPLE(bare)
            if not simple:
                odd.append(word)
                found.append(None)
                continue
            letters, stop = simple.groups()  # each is a pre-token of its own, and so is a line feed
            if self.spaces_matter:
                ids = self.feed + self._letters(letters) if word[0] == "\n" else self._letters(" " + letters)
            else:
                ids = self._letters(letters)
            found.append(ids + self.stops[stop] if stop else ids)
        rest = iter(self._learn_odd(odd))
        return [next(rest) if ids is None else ids for ids in found]

    def _learn_odd(self, words: list[str]) -> list[list[int]]:
        if not self.spaces_matter:
            marked = [w for w in words if "~" in w]
            alone = dict(zip(marked, self._raw(marked), strict=True))
            rest = iter(self._together([w for w in words if w not in alone]))
            return [alone[w] if w in alone else next(rest) for w in words]
        return self._together(words)

    def _together(self, words: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        for i in range(0, len(words), WORDS_A_CALL):
            some = words[i : i + WORDS_A_CALL]
            if self.spaces_matter:  # each behind a line feed, which is always a token of its own
                text = "".join([w if w[0] == "\n" else "\n" + w for w in some])
            else:
                text = "~ " + " ~ ".join(some)
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            marks = [*np.flatnonzero(np.array(ids) == self.mark).tolist(), len(ids)]
            if len(marks) != len(some) + 1:
                raise ValueError("the tokenizer does not keep words apart")
            for word, a, b in zip(some, marks[:-1], marks[1:], strict=True):
                out.append(ids[a + (not self.spaces_matter or word[0] != "\n") : b])
        return out

    def _store(self, hashes: np.ndarray, words: Chunks, new: np.ndarray, learned: list[list[int]]) -> None:
        n = len(new)
        sizes, counts = np.array([len(x) for x in learned], np.int64), words.counts[new]
        flat = np.fromiter((i for x in learned for i in x), np.uint32, int(sizes.sum()))
        chunks = words.of(new)
        self.ids = with_room(self.ids, self.n_ids, len(flat))
        self.chunks = with_room(self.chunks, self.n_chunks, len(chunks))
        self.table = with_room(self.table, self.n_words, n)
        self.ids[self.n_ids : self.n_ids + len(flat)] = flat
        self.chunks[self.n_chunks : self.n_chunks + len(chunks)] = chunks
        self.table[:, self.n_words : self.n_words + n] = self.n_ids + np.cumsum(sizes) - sizes, sizes, self.n_chunks + np.cumsum(counts) - counts, words.sizes[new]
        self.recent.add(hashes, np.arange(self.n_words, self.n_words + n, dtype=np.int32))
        self.n_ids, self.n_chunks, self.n_words = self.n_ids + len(flat), self.n_chunks + len(chunks), self.n_words + n
        if len(self.recent.hashes) > RECENT_WORDS:
            self.known.add(self.recent.hashes, self.recent.words)
            self.recent = Table()

    # --- texts ----------------------------------------------------------------

    def _places(self, hashes: np.ndarray, words: Chunks, first: np.ndarray, texts: Callable[[np.ndarray], list[str]]) -> tuple[np.ndarray, np.ndarray] | None:
        """Start and number of the ids of distinct words, which are number `first` of the words; none if a known word differs."""
        if len(self.known.hashes) + len(self.recent.hashes) + len(hashes) > KNOWN_WORDS:
            self.forget()
        missing = ~(self.known.find(hashes)[1] | self.recent.find(hashes)[1])
        if missing.any():
            new = first[missing]
            self._store(hashes[missing], words, new, self._learn(texts(new)))
        at, there = self.known.find(hashes)
        word = np.zeros(len(hashes), np.int64)
        word[there] = self.known.words[at[there]]
        at, here = self.recent.find(hashes)
        here &= ~there
        word[here] = self.recent.words[at[here]]
        starts, sizes, at, lengths = self.table[:, word].astype(np.int64)
        if (lengths != words.sizes[first]).any():
            return None
        counts = words.counts[first]
        steps = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        if (words.of(first) != self.chunks[np.repeat(at, counts) + steps]).any():
            return None
        return starts, sizes

    def _group(self, texts: list[bytes]) -> list[np.ndarray | None]:
        """Ids of the plain texts."""
        data = b"\n" + b"\n".join(texts) + b"\n"
        codes = np.frombuffer(data, np.uint8)
        borders = np.cumsum([0, *(len(t) + 1 for t in texts)])  # of each text, the feed before it
        parts = (codes == SPACE) | (codes == FEED)
        bad = odd_places(codes)
        bad[1:] |= parts[1:] & parts[:-1]  # also blanks at the ends of a text, and empty texts
        inside = np.add.reduceat(bad, borders[:-1], dtype=np.int64)
        # a feed behind a blank belongs to the text before and counts for the next; so it counts for both
        inside += bad[borders[1:]]
        plain = inside == 0
        if not plain.all():
            keep = [t for t, p in zip(texts, plain, strict=True) if p]
            rest = iter(self._group(keep) if keep else [])
            return [next(rest) if p else None for p in plain]

        edges = np.flatnonzero(parts)
        begins, ends = edges[:-1] + 1, edges[1:]  # of every word, behind its blank
        lead = int(self.spaces_matter)  # the blank is part of the word
        words = Chunks(data, begins - lead, ends)
        hashes = words.hashes()
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        # every chunk of a word against that of the first word with its hash
        twin = np.repeat(words.starts[first][which] - words.starts, words.counts)
        clash = (words.sizes != words.sizes[first][which]).any() or (words.values != words.values[np.arange(len(twin)) + twin]).any()

        def texts_of(some: np.ndarray) -> list[str]:
            return [data[a:b].decode() for a, b in zip((begins[some] - lead).tolist(), ends[some].tolist(), strict=True)]

        found = None if clash else self._places(distinct, words, first, texts_of)
        if found is None:  # two words of one hash: the tokenizer decides
            return [None] * len(texts)
        starts, sizes = found
        starts, sizes = starts[which], sizes[which]
        heads = np.searchsorted(begins, borders[:-1] + 1)
        if self.spaces_matter:  # the feed put before a text
            starts[heads] += 1
            sizes[heads] -= 1
        stops = np.cumsum(sizes)
        ids = self.ids[np.repeat(starts - stops + sizes, sizes) + np.arange(stops[-1])]
        return np.split(ids, stops[heads[1:] - 1])

    def _long(self, text: bytes) -> np.ndarray | None:
        """A text in parts that end at line feeds; none if it is not plain. A longer line stays whole."""
        parts, at = [], 0
        while at <= len(text):
            end = text.find(b"\n", at + GROUP_BYTES)
            end = len(text) if end < 0 else end
            (ids,) = self._group([text[at:end]])
            if ids is None:
                return None
            parts += [np.array(self.feed, np.uint32), ids] if at and self.spaces_matter else [ids]
            at = end + 1
        return np.concatenate(parts)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = []
        group: list[bytes] = []
        size = 0
        for text in texts:
            data = text.encode()
            if size + len(data) > GROUP_BYTES and group:
                out += self._group(group)
                group, size = [], 0
            if len(data) > 2 * GROUP_BYTES:
                out.append(self._long(data))
                continue
            group.append(data)
            size += len(data)
        out += self._group(group) if group else []
        whole = iter(self._raw([t for t, ids in zip(texts, out, strict=True) if ids is None]))
        return [np.array(next(whole), np.uint32) if ids is None else ids for ids in out]


@lru_cache(maxsize=4)
def codec(path: str, spaces_matter: bool) -> WordCodec:
    """One per worker process, so that its tables serve all the tasks there."""
    return WordCodec(path, spaces_matter)
