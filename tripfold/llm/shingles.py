"""Hashed word shingles of texts, their MinHash samples and odd sketches, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

SHINGLE = 5  # words
BANDS, ROWS = 32, 4  # two sets of similarity 0.75 share no band with a chance of 5e-6
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
GROUP_BYTES = 1 << 20  # text hashed at a time; a longer text is read in parts
SLICE = 2048  # shingles sampled at a time

_rng = np.random.default_rng(5)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_PLACES = _rng.integers(1, 2**63, SHINGLE).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _rng.integers(1, 2**63, SAMPLES).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True  # fixed values: what parts words


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _SPREAD
    h = (h ^ (h >> np.uint64(32))) * _SPREAD
    return h ^ (h >> np.uint64(32))


class Chunks:
    """The words data[begins:ends], each in chunks of eight bytes, the last one filled with zeros."""

    def __init__(self, data: bytes, begins: np.ndarray, ends: np.ndarray):
        self.sizes = ends - begins
        self.counts = (self.sizes + 7) >> 3
        stops = np.cumsum(self.counts)
        self.starts = stops - self.counts
        self.place = np.arange(int(stops[-1]) if len(stops) else 0) - np.repeat(self.starts, self.counts)
        at = np.repeat(begins, self.counts) + 8 * self.place
        words = np.frombuffer(data + bytes(16 - len(data) % 8), "<u8")
        low, shift = words[at >> 3], ((at & 7) << 3).astype(np.uint64)
        high = words[(at >> 3) + 1] << np.uint64(1) << (np.uint64(63) - shift)
        last = stops - 1
        self.values = (low >> shift) | high
        over = (8 * self.counts - self.sizes).astype(np.uint64) << np.uint64(3)  # bits of the last chunk behind the word
        self.values[last] = self.values[last] << over >> over

    def hashes(self) -> np.ndarray:
        """Every chunk is mixed with its place before they are added up, so words agree only by chance."""
        if not len(self.sizes):
            return np.zeros(0, np.uint64)
        mixed = mix(self.values + self.place.astype(np.uint64) * _STEP)
        return mix(np.add.reduceat(mixed, self.starts) + self.sizes.astype(np.uint64) * _SPREAD)

    def of(self, words: np.ndarray) -> np.ndarray:
        """The chunks of some of the words, one word after the other."""
        counts = self.counts[words]
        steps = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        return self.values[np.repeat(self.starts[words], counts) + steps]


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word."""
    blank = _BLANK[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(blank, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    return Chunks(data, starts, ends).hashes(), starts


def word_hashes(texts: list[bytes]) -> Iterator[np.ndarray]:
    """For each text the hashes of its words, A-Z read as a-z."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= GROUP_BYTES):
            size += len(texts[end]) + 1
            end += 1
        if size > 2 * GROUP_BYTES:
            yield _long(texts[at].lower())
        else:
            group = [t.lower() for t in texts[at:end]]
            hashes, starts = _words(b"\n".join(group))
            ends = np.cumsum([len(t) + 1 for t in group])
            yield from np.split(hashes, np.searchsorted(starts, ends[:-1]))
        at = end


def _long(data: bytes) -> np.ndarray:
    """One text in parts that end at a blank; a word longer than a part stays whole."""
    out, at = [], 0
    while at < len(data):
        end = min(at + GROUP_BYTES, len(data))
        while end < len(data) and not _BLANK[data[end]]:
            end += 1
        out.append(_words(data[at:end])[0])
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted hashes of the distinct shingles; with fewer words, of the whole sequence."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    if n < SHINGLE:
        return mix((words * _PLACES[:n]).sum(keepdims=True) + np.uint64(n))
    total = words[: n - SHINGLE + 1] * _PLACES[0]
    for k in range(1, SHINGLE):
        total += words[k : n - SHINGLE + 1 + k] * _PLACES[k]
    return np.unique(mix(total))


def samples(shingles: np.ndarray) -> np.ndarray:
    """The least shingle under each of SAMPLES permutations."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), SLICE):
        np.minimum(least, (shingles[None, i : i + SLICE] * _FACTORS[:, None]).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """A key for each band, made of its samples and its number."""
    rows = least.reshape(BANDS, ROWS)
    h = np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP
    for k in range(ROWS):
        h = mix(h + rows[:, k] * _PLACES[k])
    return h.view(np.int64)


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """Parity bitmap: every sample, with its number, flips one of SKETCH_BITS bits."""
    places = mix(least + np.arange(1, SAMPLES + 1, dtype=np.uint64) * _STEP) % np.uint64(SKETCH_BITS)
    odd = (np.bincount(places.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def estimated_similarity(bits: float | np.ndarray) -> float | np.ndarray:
    """Similarity that a number of unlike bits of two sketches speaks for."""
    return 1 + SKETCH_BITS / (4 * SAMPLES) * np.log(np.maximum(1 - 2 * bits / SKETCH_BITS, 1e-9))


def unlike_bits(similarity: float) -> int:
    """Expected number of unlike bits of two sets of the similarity."""
    return round(SKETCH_BITS / 2 * (1 - np.exp(-4 * SAMPLES * (1 - similarity) / SKETCH_BITS)))


def digest(shingles: np.ndarray) -> bytes:
    """128 bits that stand for the set."""
    return xxhash.xxh3_128_digest(shingles.tobytes())


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on the full sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)
