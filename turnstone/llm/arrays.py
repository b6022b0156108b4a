"""Vectorised text kernels over Arrow string buffers.

Every operator that runs Python works on bytes, not on Python strings: words
are found with a byte-class table, and hashes of all words, word runs and
character runs of a batch come out of prefix sums. One call handles a slice of
a few megabytes, so memory is bounded by the largest single document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U64 = np.uint64

#: byte classes
_b = np.arange(256)
NOT_SPACE = ~((_b == 0x20) | ((_b >= 0x09) & (_b <= 0x0D)))
ALNUM = ((_b >= 0x30) & (_b <= 0x39)) | ((_b >= 0x61) & (_b <= 0x7A)) | ((_b >= 0x41) & (_b <= 0x5A)) | (_b >= 0x80)
LOWER = np.where((_b >= 0x41) & (_b <= 0x5A), _b + 32, _b).astype(np.uint8)
SAME = _b.astype(np.uint8)

#: odd multipliers of the prefix sums, with their inverses modulo 2**64
P_BYTE = 0x9E3779B97F4A7C15
P_WORD = 0xD6E8FEB86659FD93
_INV = {p: pow(p, -1, 1 << 64) for p in (P_BYTE, P_WORD)}
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all bits depend on all bits."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def byte_values(seed: int) -> np.ndarray:
    """One random 64-bit value per byte."""
    return mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed * 0x51ED2701 + 7))


def powers(p: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``p**i`` and ``p**-i`` for i in [0, n), kept and grown on demand."""
    have = _powers.get(p)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        out = []
        for q in (p, _INV[p]):
            a = np.full(size, q, dtype=U64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        have = (out[0], out[1])
        if size <= 1 << 22:
            _powers[p] = have
    return have[0][:n], have[1][:n]


def prefix_sums(values: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of ``values[i] * p**i`` (length n + 1) and the inverse powers."""
    pw, inv = powers(p, len(values) + 1)
    s = np.empty(len(values) + 1, dtype=U64)
    s[0] = 0
    np.cumsum(values * pw[:-1], out=s[1:])
    return s, inv


def run_hash(sums: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each run [start, end): equal content and length give equal hashes wherever the run stands."""
    s, inv = sums
    return run_mix((s[end] - s[start]) * inv[start], end - start)


def run_mix(difference: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``run_hash`` from the differences of prefix sums, shifted to the runs' starts, and the runs' lengths."""
    return mix(difference + length.astype(U64) * U64(0xA24BAED4963EE407))


class Slice:
    """Some consecutive texts of a batch as one byte array."""

    __slots__ = ("first", "data", "offsets")

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def slices(column, most: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of an Arrow string column in slices of about ``most`` bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # older combine_chunks of no chunk
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if not n:
        return
    bufs = column.buffers()
    off = np.frombuffer(bufs[1], dtype=kind)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + most, side="right")) - 1
        j = min(n, max(j, i + 1), i + 20_000)
        yield Slice(i, raw[off[i]:off[j]], off[i:j + 1] - off[i])
        i = j


class Words:
    """Words of a slice: byte ranges, the text each lies in, and 64-bit hashes."""

    __slots__ = ("start", "end", "doc", "first", "hash", "sums")

    def __init__(self, s: Slice, classes: np.ndarray, fold: np.ndarray, seed: int = 1):
        m = classes[s.data]
        o = s.offsets
        filled = o[1:] > o[:-1]
        begin, last = o[:-1][filled], o[1:][filled] - 1
        a = m.copy()
        a[1:] &= ~m[:-1]
        a[begin] = m[begin]
        z = m.copy()
        z[:-1] &= ~m[1:]
        z[last] = m[last]
        self.start, self.end = np.flatnonzero(a), np.flatnonzero(z) + 1
        self.doc = np.searchsorted(o, self.start, side="right") - 1
        self.first = np.searchsorted(self.doc, np.arange(s.n + 1))  # words of text i: first[i] .. first[i + 1]
        self.sums = prefix_sums(byte_values(seed)[fold][s.data], P_BYTE)
        self.hash = run_hash(self.sums, self.start, self.end)

    @property
    def n(self) -> int:
        return len(self.start)


def grams(words: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words that lie in one text, and where they start."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, U64), np.empty(0, np.int64)
    at = np.flatnonzero(doc[:n] == doc[k - 1:])
    return run_hash(prefix_sums(words, P_WORD), at, at + k), at


def sliding_argmin(hashes: np.ndarray, w: int) -> np.ndarray:
    """For each i the place of the smallest of ``hashes[i:i+w]`` (by the high 40 bits, leftmost among equals)."""
    n = len(hashes)
    if n < w:
        return np.empty(0, np.int64)
    out = []
    block = 1 << 22  # places fit in the 24 low bits
    for b in range(0, n - w + 1, block):
        part = hashes[b:b + block + w - 1]
        key = (part & U64(0xFFFFFFFFFF000000)) | np.arange(len(part), dtype=U64)
        have = 1
        m = key
        while have * 2 <= w:
            m = np.minimum(m[:-have], m[have:])
            have *= 2
        if have < w:
            m = np.minimum(m[:len(m) - (w - have)], m[w - have:])
        out.append((m & U64(0xFFFFFF)).astype(np.int64) + b)
    return np.concatenate(out)


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def text_array(batch: pa.RecordBatch, name: str = "text"):
    return batch.column(batch.schema.get_field_index(name))
