"""Whole texts to word hashes, many documents at a time, in numpy.

Words are runs of bytes other than the six ASCII separators; A-Z counts as a-z. A word's bytes are
read as blocks of eight; every block is mixed with a constant of its place, and the sum of the mixed
blocks is mixed with the length. Words of one length up to eight bytes never share a hash; others
share one with the chance of a random 64-bit function, whatever their structure. Hashes are the same
in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_SECOND = _U(0xC2B2AE3D27D4EB4F)
#: Bytes kept of a block that a word fills with so many.
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], _U)
CHUNK = 1 << 20


def _tables():
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    shape = np.arange(256, dtype=np.uint8)
    shape[48:58] = 48
    shape[65:91] = 65
    shape[97:123] = 97
    shape[128:] = 97
    sep = np.zeros(256, bool)
    sep[[9, 10, 11, 12, 13, 32]] = True
    return lower, shape, sep


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


LETTERS, SHAPES, SEPARATOR = _tables()


class Words:
    """Words of some texts: ``start``, ``end`` in the joined bytes, ``doc`` of each word."""

    def __init__(self, texts: list[bytes]):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.n = len(texts)
        self.bytes = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.doc_start = np.cumsum(sizes) - sizes
        sep = SEPARATOR[self.bytes]
        edge = np.flatnonzero(sep[1:] != sep[:-1]) + 1
        if len(sep) and not sep[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[0::2], edge[1::2]
        self.doc = np.searchsorted(self.doc_start, self.start, "right") - 1
        self.count = np.bincount(self.doc, minlength=self.n)
        self._blocks: dict[int, np.ndarray] = {}

    def hashes(self, start=None, end=None, values: np.ndarray = LETTERS) -> np.ndarray:
        """Hashes of the byte spans [start, end), none empty, by default the words."""
        start, end = (self.start, self.end) if start is None else (start, end)
        if not len(start):
            return np.empty(0, _U)
        if id(values) not in self._blocks:
            raw = np.concatenate([values[self.bytes], np.zeros(8, np.uint8)])
            self._blocks[id(values)] = np.lib.stride_tricks.as_strided(raw.view(), (len(self.bytes), 8), (1, 1))
        blocks = self._blocks[id(values)]
        size = end - start
        out = mix(self._block(blocks, start, np.minimum(size, 8)) ^ _SECOND)
        long = np.flatnonzero(size > 8)
        if len(long):
            n = (size[long] - 1) // 8  # blocks after the first
            first = np.cumsum(n) - n
            place = np.arange(n.sum()) - np.repeat(first, n) + 1
            at = np.repeat(start[long], n) + 8 * place
            rest = self._block(blocks, at, np.minimum(np.repeat(end[long], n) - at, 8))
            out[long] += np.add.reduceat(mix(rest ^ mix(place.astype(_U) * _STEP)), first)
        return mix(out + size.astype(_U) * _STEP)

    @staticmethod
    def _block(blocks: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        return blocks[at].view("<u8")[:, 0].astype(_U, copy=False) & _MASK[size]

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hashes of k words in a row, per document, sorted by document and hash: (doc,
        hash). A text of fewer words has its whole sequence as one; a text without words none."""
        h = self.hashes()
        first = np.cumsum(self.count) - self.count
        n = np.where(self.count >= k, self.count - k + 1, np.minimum(self.count, 1))
        doc = np.repeat(np.arange(self.n), n)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        size = np.minimum(self.count, k)[doc]
        out = np.zeros(len(doc), _U)
        for j in range(k):
            use = size > j
            take = at[use] + j
            out[use] = mix(out[use] * _STEP + h[take] + _U(j + 1))
        order = np.lexsort((out, doc))
        doc, out = doc[order], out[order]
        keep = np.ones(len(doc), bool)
        keep[1:] = (doc[1:] != doc[:-1]) | (out[1:] != out[:-1])
        return doc[keep], out[keep]


def as_bytes(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow column as bytes, nulls as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK bytes together; a longer text is alone."""
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield lo, i
            lo, size = i, 0
        size += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)


def sums(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Sum of values by document."""
    return np.bincount(doc, weights=values, minlength=n)
