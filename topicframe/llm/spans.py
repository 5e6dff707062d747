"""Words of a whole Arrow text column as numpy arrays: places, rows and 64-bit hashes.

Texts stay in Arrow's UTF-8 buffer. A word is a maximal run of bytes that
are not separators; all separators are ASCII, so a run never cuts a
character. Hashes are polynomial over per-byte random 64-bit values
(upper-case A-Z share the values of a-z when ``fold``), taken from one
running sum over the buffer and finished with a bit mixer, so the cost is
a few vector operations a byte whatever the words are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are turned into numpy arrays at once; one longer text is still taken whole.
CHUNK_BYTES = 1 << 20

#: ``[\x20\x09-\x0D]``
BLANKS = bytes([32, 9, 10, 11, 12, 13])

_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply rounds)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _table(fold: bool) -> np.ndarray:
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    if fold:
        table[65:91] = table[97:123]
    return table


_TABLES = {False: _table(False), True: _table(True)}
_powers: dict[str, np.ndarray] = {}


def _power(n: int, inverse: bool) -> np.ndarray:
    name = "inv" if inverse else "pow"
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        base = np.full(size, _BASE_INV if inverse else _BASE, np.uint64)
        base[0] = 1
        have = np.multiply.accumulate(base)
        if size > 8 * CHUNK_BYTES:  # of one very long text; not kept
            return have
        _powers[name] = have
    return have[:n]


class Words:
    """Words of some texts. ``row``: the text of each word, from 0."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: bytes = BLANKS):
        self.data, self.offsets, self.n_rows = data, offsets, len(offsets) - 1
        sep = np.zeros(256, bool)
        sep[list(separators)] = True
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = ~sep[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        here, before = inside[1:], inside[:-1]
        self.start = np.flatnonzero(here & (~before | cut))
        self.end = np.flatnonzero(before & (~here | cut))
        self.row = np.searchsorted(offsets, self.start, "right") - 1

    def __len__(self) -> int:
        return len(self.start)

    def per_row(self) -> np.ndarray:
        """Words of each text."""
        return np.bincount(self.row, minlength=self.n_rows)

    def hashes(self, fold: bool = True, longest: int | None = None) -> np.ndarray:
        """64-bit hash of each word, or of its first ``longest`` bytes."""
        if not hasattr(self, "_sum") or self._fold != fold:
            value = _TABLES[fold][self.data]
            value *= _power(len(self.data), False)
            self._sum = np.zeros(len(value) + 1, np.uint64)
            np.cumsum(value, out=self._sum[1:])
            self._fold = fold
        end = self.end if longest is None else np.minimum(self.end, self.start + longest)
        h = (self._sum[end] - self._sum[self.start]) * _power(len(self.data) + 1, True)[self.start]
        return mix(h ^ (end - self.start).astype(np.uint64))


def combine(hashes: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of ``n`` items inside one row, and the index of its first item."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    last = len(hashes) - n + 1
    out = np.zeros(last, np.uint64)
    for k in range(n):
        out = (out + hashes[k : k + last]) * np.uint64(_BASE)
    at = np.flatnonzero(row[:last] == row[n - 1 :])
    return mix(out[at]), at


def text_chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Pieces (first row, end row, bytes, offsets) of a string column; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    _, places, data = column.buffers()
    places = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(places, places[first] + size, "right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[places[first] : places[end]], places[first : end + 1] - places[first]
        first = end
