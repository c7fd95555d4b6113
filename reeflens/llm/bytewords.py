"""Words and their hashes from the UTF-8 bytes of Arrow string columns, without Python strings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: 64-bit odd constants of the hashes.
BASE = 0x9E3779B97F4A7C15
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
SLICE_BYTES = 1 << 21

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX_1)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX_2)
    return h ^ (h >> np.uint64(31))


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of ``base`` and of its inverse modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, n.bit_length())
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size <= 1 << 23:
            _powers[base] = have
    return have


def text_slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, bounds) for runs of whole texts of about SLICE_BYTES; null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1)
        end = min(end, n)
        yield row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


_space = np.zeros(256, bool)
_space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_lower = np.arange(256, dtype=np.uint64) + np.uint64(1)
_lower[65:91] += np.uint64(32)


def word_spans(buf: np.ndarray, bounds: np.ndarray, between: np.ndarray = _space) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the index of each text's first word.

    ``bounds`` are the offsets of the texts; a word never crosses them.  Words
    are runs of bytes that ``between`` does not mark: [^\\x20\\x09-\\x0D]+ by default.
    """
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    solid = np.zeros(len(buf) + 2, bool)
    solid[1:-1] = ~between[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[bounds] = True
    starts = np.flatnonzero(solid[1:-1] & (~solid[:-2] | cut[:-1]))
    ends = np.flatnonzero(solid[1:-1] & (~solid[2:] | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word with A-Z in lower case, in blocks of about a megabyte."""
    out, first = np.empty(len(starts), np.uint64), 0
    while first < len(starts):
        at = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, at + (1 << 20), "right")))
        size = int(ends[last - 1] - at)
        up, down = powers(size)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(_lower[buf[at:at + size]] * up[:size], out=total[1:])
        s, e = starts[first:last] - at, ends[first:last] - at
        out[first:last] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        first = last
    return out
