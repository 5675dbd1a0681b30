"""Words of whole columns of texts, found and hashed by array operations instead of one by one.

A word's 64-bit hash is the sum of one random number per place and byte, so
two given words share it with probability 2**-64.  Words of more than PLACES
bytes are hashed singly.  A-Z count as a-z where asked.  Long columns are cut
into slices of about SLICE bytes, so the arrays of a task stay small; a longer
text is a slice of its own and is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PLACES = 48
SLICE = 4 << 20
_RANDOM = np.random.RandomState(1301).randint(0, 1 << 62, (PLACES, 256), dtype=np.int64).astype(np.uint64) * np.uint64(4) + np.random.RandomState(1302).randint(0, 4, (PLACES, 256)).astype(np.uint64)
_FOLDED = _RANDOM.copy()
_FOLDED[:, 65:91] = _RANDOM[:, 97:123]
MUL = np.uint64(0x9E3779B97F4A7C15)


def bytes_inside(apart: list[tuple[int, int]]) -> np.ndarray:
    """Whether each byte value belongs to words; ``apart`` has the ranges that do not, both ends included."""
    inside = np.ones(256, bool)
    for lo, hi in apart:
        inside[lo : hi + 1] = False
    return inside


#: Words ``[^\x20\x09-\x0D]+`` and ``[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+``.
SPACED = bytes_inside([(0x20, 0x20), (0x09, 0x0D)])
LETTERS = bytes_inside([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])


@dataclass
class Words:
    """The words of some rows; those of row i are bounds[i]..bounds[i + 1]."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    data: np.ndarray

    def row(self, i: int) -> np.ndarray:
        return self.hashes[self.bounds[i] : self.bounds[i + 1]]

    def texts(self, lo: int, hi: int) -> list[bytes]:
        """The bytes of the words lo..hi."""
        if lo == hi:
            return []
        base = int(self.starts[lo])
        whole = self.data[base : int(self.ends[hi - 1])].tobytes()
        return [whole[s:e] for s, e in zip((self.starts[lo:hi] - base).tolist(), (self.ends[lo:hi] - base).tolist())]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def words_of(column: pa.Array, inside: np.ndarray, folded: bool) -> Words:
    """Words of a column of texts; nulls have none."""
    filled = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    raw = filled.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.empty(0, np.uint8)
    edges = offsets - offsets[0]
    if not len(data):
        none = np.empty(0, np.int64)
        return Words(np.empty(0, np.uint64), none, none, np.zeros(len(filled) + 1, np.int64), data)
    word = inside[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[edges] = True
    before, after = np.concatenate([[False], word[:-1]]), np.concatenate([word[1:], [False]])
    starts = np.flatnonzero(word & (~before | cut[:-1]))
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    lengths = ends - starts
    table = _FOLDED if folded else _RANDOM
    hashes = table[0, data[starts]]
    left = np.arange(len(starts))
    for place in range(1, PLACES):
        left = left[lengths[left] > place]
        if not len(left):
            break
        hashes[left] += table[place, data[starts[left] + place]]
    for i in left[lengths[left] > PLACES].tolist():
        one = data[starts[i] : ends[i]].tobytes()
        hashes[i] = xxhash.xxh3_64_intdigest(one.lower() if folded else one)
    return Words(hashes, starts, ends, np.searchsorted(starts, edges), data)


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about ``limit`` bytes together, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // limit
    edges = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(sizes)]
    for lo, hi in zip(edges, edges[1:]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def run_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive words of the array, whichever rows they are in."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, np.uint64(width), np.uint64)
    for j in range(width):
        out = mixed(out * MUL + hashes[j : j + n])
    return out


def shingle_sets(words: Words, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each row; fewer words than ``width`` are one shingle, none are the empty set."""
    runs = run_hashes(words.hashes, width)
    for lo, hi in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if hi - lo >= width:
            own = np.sort(runs[lo : hi - width + 1])
            yield own[np.concatenate([[True], own[1:] != own[:-1]])]
        else:
            yield run_hashes(words.hashes[lo:hi], hi - lo) if hi > lo else np.empty(0, np.uint64)
