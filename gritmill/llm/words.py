"""Words of whole texts as arrays: where each begins, how long it is, and a 64-bit hash, for a batch of texts at once.

Bytes of UTF-8 above 0x7F are never separators, so cutting by bytes equals cutting by code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21
_GOLDEN = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(20240).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x2545F4914F6CDD1D)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_KIND = np.arange(256, dtype=np.uint8)
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = 65, 97, 48, 97

#: Bytes of words that anything but white space makes up, and of words that letters, digits and all beyond ASCII make up.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 places where its texts begin; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def sliced(batches, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text (a longer text is a batch of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_string())), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(sizes) - sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


@dataclass
class Words:
    raw: np.ndarray  # bytes of all texts, one after the other
    data: np.ndarray  # the same with A-Z in lower case
    start: np.ndarray  # of each word
    length: np.ndarray
    first: np.ndarray  # n + 1 places: the words of text i are first[i]:first[i + 1]
    begin: np.ndarray  # n + 1 places: the bytes of text i are begin[i]:begin[i + 1]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        ends = np.append(self.start[1:], len(self.data))
        at = np.arange(self.start[0], len(self.data)) - np.repeat(self.start, ends - self.start)
        values = _BYTE[self.data[self.start[0] :]]
        values *= powers(_BASE, int(self.length.max()) + 1)[np.minimum(at, int(self.length.max()))]
        values[at >= np.repeat(self.length, ends - self.start)] = 0
        return mix(np.add.reduceat(values, self.start - self.start[0]) + self.length.astype(np.uint64) * np.uint64(_GOLDEN))

    def shapes(self) -> np.ndarray:
        """A hash of each word's run of kinds: capitals, other letters, digits, each sign by itself; repeats count once."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        kinds, first = _KIND[self.raw], np.zeros(len(self.raw), bool)
        first[self.start] = True
        turns = first.copy()
        turns[1:] |= kinds[1:] != kinds[:-1]
        inside = np.zeros(len(self.raw) + 1, np.int8)
        np.add.at(inside, self.start, 1)
        np.add.at(inside, self.start + self.length, -1)
        turns &= np.cumsum(inside[:-1]) > 0
        at = np.flatnonzero(turns)
        opens = np.flatnonzero(first[at])
        place = np.arange(len(at)) - np.repeat(opens, np.diff(np.append(opens, len(at))))
        return mix(np.add.reduceat(_BYTE[kinds[at]] * powers(_BASE, int(place.max()) + 1)[place], opens))

    def text(self, i: int, j: int) -> str:
        """Words i to j - 1, joined by a space."""
        return b" ".join(self.data[s : s + n].tobytes() for s, n in zip(self.start[i:j].tolist(), self.length[i:j].tolist())).decode("utf-8", "replace")


def words_of(column: pa.Array, word_bytes: np.ndarray = NOT_SPACE) -> Words:
    data, offsets = text_bytes(column)
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, data, none, none, np.zeros(len(offsets), np.int64), offsets)
    inside = word_bytes[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    cut = offsets[1:-1]
    cut = cut[cut < len(data)]
    opens[cut] = inside[cut]  # a text's end also ends a word
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | opens[1:]
    start = np.flatnonzero(opens)
    return Words(data, LOWER[data], start, np.flatnonzero(closes) + 1 - start, np.searchsorted(start, offsets), offsets)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, at the place of its first word; runs across texts are the caller's to leave out."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k, power in enumerate(powers(_BASE, size)[1:], 1):
        out += hashes[k : k + n] * power
    return mix(out + np.uint64(size * _GOLDEN % 2**64))
