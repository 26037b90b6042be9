"""Words of whole texts as numpy arrays, a bounded slice of an Arrow batch at a time.

64-bit hashes stand for words and word sequences. Two given ones collide with a
probability of about 2 to the -60.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer text is a slice of its own.
SLICE = 2 << 20

_RANDOM = np.random.Generator(np.random.PCG64(20_011))
_BYTE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15 | 3)
_BACK = np.uint64(pow(int(_STEP), -1, 2**64))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Fixed classes: bytes that belong to a word. Bytes of other than ASCII characters always do.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x80:] = True

#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        with np.errstate(over="ignore"):
            for i, base in enumerate((_STEP, _BACK)):
                _POWERS[i] = np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(n, SLICE + 1), base))])
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread 64-bit numbers evenly, another way for each salt."""
    with np.errstate(over="ignore"):
        x = x ^ np.uint64((salt * 0xD6E8FEB86659FD93) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a text column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    places = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return places - places[0], raw[places[0] : places[-1]]


def slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about ``SLICE`` bytes of text, whole rows."""
    for batch in batches:
        offsets, _ = buffers(batch.column(text))
        at = 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1)
            yield batch.slice(at, upto - at)
            at = upto


class Words:
    """Words of a slice's texts: bytes, where they start and end, their rows and hashes."""

    def __init__(self, column: pa.Array, inside: np.ndarray, lower: bool = False):
        offsets, raw = buffers(column)
        self.rows = len(column)
        self.offsets = offsets
        self.raw = LOWER[raw] if lower else raw
        n = len(self.raw)
        word = np.zeros(n + 2, bool)
        word[1:-1] = inside[self.raw]
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        self.starts = np.flatnonzero(word[1:-1] & (~word[:-2] | first[:-1]))
        self.ends = np.flatnonzero(word[1:-1] & (~word[2:] | first[1:])) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.counts)

    def hashes(self) -> np.ndarray:
        return spans(*byte_sums(self.raw), self.starts, self.ends)


def byte_sums(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums from which ``spans`` hashes any stretch of bytes."""
    forward, back = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE[raw] * forward[: len(raw)], out=sums[1:])
    return sums, back


def spans(sums: np.ndarray, back: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from each start to each end."""
    with np.errstate(over="ignore"):
        return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def sequences(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` consecutive words, over row limits too."""
    n = max(0, len(hashes) - length + 1)
    out = np.full(n, np.uint64(length), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(length):
            out = out * _STEP + hashes[i : i + n]
    return mix(out)


def pick(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """The given stretches of bytes as an Arrow text column."""
    sizes = ends - starts
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    data = raw[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])]
    made = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
    return made.view(pa.string()) if kind is None else made


def per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive bounds."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
