"""Array kernels over the text buffer of an Arrow batch.

Words are runs of bytes outside ``{0x20, 0x09-0x0D}``, and lower-casing touches A-Z only, so everything works on
UTF-8 bytes. A batch is cut into slices of bounded size first; a slice is always made of whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
WINDOW_BYTES = 1 << 18

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
DIGIT = np.zeros(256, bool)
DIGIT[0x30:0x3A] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_rng = np.random.Generator(np.random.PCG64(20240601))
_BYTE = _rng.integers(1, 2**64 - 1, 256, dtype=U64)
_STEP = _rng.integers(1, 2**63 - 1, 64, dtype=U64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0..n modulo 2 ** 64; the longest table asked for is kept."""
    if base not in _powers or len(_powers[base]) < n + 1:
        row = np.full(max(n, WINDOW_BYTES) + 1, base, U64)
        row[0] = 1
        _powers[base] = np.multiply.accumulate(row)
    return _powers[base]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits."""
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of ``batch`` with at most ``limit`` bytes of ``column`` each (one row at least)."""
    if batch.num_rows == 0:
        return
    ends = np.cumsum(np.diff(_offsets(batch.column(column))))
    at = 0
    while at < batch.num_rows:
        floor = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, floor + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def _offsets(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    return np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and the position at which each begins (one more at the end). Null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = _offsets(texts)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def runs(inside: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of True that doesn't cross any position in ``edges`` (sorted, from 0 to the length)."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[edges] = True
    edge[0] = edge[n] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are sorted and don't overlap."""
    out = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + WINDOW_BYTES, "right")))
        low, high = int(starts[at]), int(ends[to - 1])
        sums = np.zeros(high - low + 1, U64)
        np.cumsum(_BYTE[data[low:high]] * _power(_BASE, high - low)[: high - low], out=sums[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        out[at:to] = (sums[e] - sums[s]) * _power(_INVERSE, high - low)[s]
        at = to
    return mix(out)


def combine(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each window of n consecutive values; windows over the ends of texts are the caller's to drop."""
    if len(h) < n:
        return np.zeros(0, U64)
    total = h[: len(h) - n + 1] * _STEP[0]
    for k in range(1, n):
        total = total + h[k : len(h) - n + 1 + k] * _STEP[k]
    return mix(total)


class Words:
    """The words of a column of texts: byte spans, hashes, and for each text the range of its words."""

    def __init__(self, texts: pa.Array, lower: bool = True):
        raw, self.offsets = text_bytes(texts)
        self.data = LOWER[raw] if lower else raw
        self.starts, self.ends = runs(~SPACE[self.data], self.offsets)
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self._hashes: np.ndarray | None = None

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = span_hash(self.data, self.starts, self.ends)
        return self._hashes

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each window of n words within one text."""
        own = self.owner
        if len(own) < n:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        first = np.flatnonzero(own[n - 1 :] == own[: len(own) - n + 1])
        return first, combine(self.hashes, n)[first]

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text of each line (cut at 0x0A) that has a word."""
        edges = np.union1d(self.offsets, np.flatnonzero(self.data == 0x0A))
        s, e = runs(self.data != 0x0A, edges)
        has = np.searchsorted(self.starts, e) > np.searchsorted(self.starts, s)
        s, e = s[has], e[has]
        return s, e, np.searchsorted(self.offsets, s, "right") - 1


def ordered_sums(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the values in each range, which depends on their order."""
    n = len(h)
    sums = np.zeros(n + 1, U64)
    np.cumsum(h * _power(_BASE, n)[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power(_INVERSE, n)[starts])


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from all values in a row and the length of each list."""
    ends = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))
