"""Words and word runs of whole columns of text as numpy arrays, without a Python loop over words.

Works on UTF-8 bytes: every separator here is an ASCII character, and bytes of other characters are all 128 or more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
_BASE_INV = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SLICE_BYTES = 1 << 21

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[:128] = True
for _c in b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
    NOT_ALNUM[_c] = False
LINE_END = np.zeros(256, bool)
LINE_END[0x0A] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = (np.ones(1, U), np.ones(1, U))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    global _powers
    if len(_powers[0]) < n:
        n = max(n, 2 * _SLICE_BYTES)
        grown = []
        for b in (_BASE, _BASE_INV):
            p = np.full(n, b, U)
            p[0] = 1
            grown.append(np.cumprod(p))
        _powers = (grown[0], grown[1])
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def slices(batch: pa.RecordBatch, column: str = "text", most: int = _SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of whole rows of about so many bytes of text; a longer text is a run of its own."""
    n = batch.num_rows
    if not n:
        return
    size = np.asarray(pc.binary_length(batch.column(column)).fill_null(0)).astype(np.int64)
    run = (np.cumsum(size) - size) // most
    cuts = np.flatnonzero(np.diff(run)) + 1
    for a, b in zip([0, *cuts], [*cuts, n], strict=True):
        yield batch.slice(a, b - a)


@dataclass
class Words:
    data: np.ndarray  # bytes, lower-cased if asked
    offsets: np.ndarray  # of each text in data
    start: np.ndarray  # of each word in data
    end: np.ndarray
    bounds: np.ndarray  # words of text i: bounds[i] to bounds[i + 1]
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def last(self) -> np.ndarray:
        """For each word, the number of the word after its text's last one."""
        return np.repeat(self.bounds[1:], self.counts)

    def text(self, a: int, b: int) -> list[str]:
        """Words a to b as strings."""
        raw = self.data
        return [raw[s:e].tobytes().decode() for s, e in zip(self.start[a:b], self.end[a:b], strict=True)]

    def runs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on, and whether the text has so many."""
        n = len(self.hash)
        out = np.zeros(n, U)
        if n >= k:
            acc = np.zeros(n - k + 1, U)
            for j in range(k):
                acc = acc * U(0xD6E8FEB86659FD93) + self.hash[j : n - k + 1 + j]
            out[: n - k + 1] = mix(acc)
        return out, np.arange(n) + k <= self.last()


def raw_text(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets; null counts as empty."""
    text = text.fill_null("")
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    wide = pa.types.is_large_string(text.type)
    _, offsets, data = text.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(text) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(text: pa.Array, separator: np.ndarray, lower: bool = False) -> Words:
    data, offsets = raw_text(text)
    if lower:
        data = LOWER[data]
    inside = ~separator[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after[edges - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    power, inverse = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * power[: len(data)], out=sums[1:])
    hashed = mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U))
    return Words(data, offsets, start, end, np.searchsorted(start, offsets), hashed)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))
