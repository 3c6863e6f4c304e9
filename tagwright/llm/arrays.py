"""Words and their hashes as numpy arrays over an Arrow text column.

No Python string is made for a word: starts, ends and hashes are computed over
the UTF-8 bytes of a slice of documents at a time, so memory follows the slice
(or the longest text), not the partition.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_ODD = 0x9E3779B97F4A7C15
_BACK = pow(_ODD, -1, 1 << 64)
BYTE_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)

_bytes = np.arange(256)
WHITE_SPACE = (_bytes == 0x20) | ((_bytes >= 0x09) & (_bytes <= 0x0D))
NOT_ALNUM = ~(((_bytes >= 48) & (_bytes <= 57)) | ((_bytes >= 97) & (_bytes <= 122)) | ((_bytes >= 65) & (_bytes <= 90)) | (_bytes >= 128))
NOT_LETTER = NOT_ALNUM | ((_bytes >= 48) & (_bytes <= 57))
LOWER = np.where((_bytes >= 65) & (_bytes <= 90), _bytes + 32, _bytes).astype(np.uint8)

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 12), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def range_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Karp-Rabin hashes of codes[start:end], from one prefix sum."""
    prefix = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * powers(_ODD, len(codes)), out=prefix[1:])
    return mixed((prefix[ends] - prefix[starts]) * powers(_BACK, len(codes) + 1)[starts])


class Words(NamedTuple):
    data: np.ndarray  # bytes
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # words of document i: bounds[i]:bounds[i + 1]

    def hashes(self) -> np.ndarray:
        return range_hashes(BYTE_CODES[self.data], self.starts, self.ends)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(column: pa.Array, gaps: np.ndarray = WHITE_SPACE, lower: bool = True) -> Words:
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    gap = gaps[data]
    filled = np.flatnonzero(np.diff(offsets))
    before, after = np.ones(len(gap), bool), np.ones(len(gap), bool)
    before[1:], after[:-1] = gap[:-1], gap[1:]
    before[offsets[filled]] = True
    after[offsets[filled + 1] - 1] = True
    starts, ends = np.flatnonzero(~gap & before), np.flatnonzero(~gap & after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def spaced(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """All words, each followed by one space, and where each begins (with the end)."""
    lengths = found.ends - found.starts
    at = np.concatenate(([0], np.cumsum(lengths + 1)))
    line = np.full(at[-1], 0x20, np.uint8)
    inside = np.ones(at[-1], bool)
    inside[at[1:] - 1] = False
    shift = found.starts - (at[:-1] - np.arange(len(lengths)))
    line[inside] = found.data[np.repeat(shift, lengths) + np.arange(lengths.sum())]
    return line, at


def windows(bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of each run of size words that lies in one document, and its document."""
    lengths = np.maximum(np.diff(bounds) - size + 1, 0)
    documents = np.repeat(np.arange(len(lengths)), lengths)
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + bounds[:-1][documents], documents


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about SLICE_BYTES of text, one row at least."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & np.uint32(1), (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


_CRC = _crc_table()
_CRC_STEPS = 32


def crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """CRC-32 of each data[start:end], each going on from the CRC-32 in before (of nothing, by default).

    Short runs take a step a byte all together, longest first; the rare long ones go one by one.
    """
    before = np.zeros(len(starts), np.uint32) if before is None else before
    lengths = ends - starts
    order = np.argsort(np.minimum(lengths, _CRC_STEPS + 1).astype(np.uint8), kind="stable")[::-1]
    sorted_lengths, first = lengths[order], starts[order]
    state = ~before[order]
    n_long = int(np.searchsorted(-sorted_lengths, -_CRC_STEPS, side="left")) if len(order) else 0
    reach = np.searchsorted(-np.minimum(sorted_lengths, _CRC_STEPS), -np.arange(_CRC_STEPS), side="left")
    for k in range(_CRC_STEPS):
        if reach[k] <= n_long:
            break
        now = state[n_long : reach[k]]
        now[:] = _CRC[(now ^ data[first[n_long : reach[k]] + k]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out = np.empty(len(starts), np.uint32)
    out[order] = ~state
    for i in order[:n_long].tolist():
        out[i] = zlib.crc32(memoryview(np.ascontiguousarray(data[starts[i] : ends[i]])), int(before[i]))
    return out
