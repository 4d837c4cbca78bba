"""Vectorised words and hashes over Arrow string batches.

The helpers work on the UTF-8 bytes of many rows at once, so that no Python object is made for a
word. A *slice* is a run of whole rows of up to ``SLICE_BYTES`` bytes; a longer text is a slice of
its own. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15)
#: Inverse of _MULT modulo 2**64.
_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

#: The six ASCII characters that end a word: \x20 and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)

_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + 2), base, np.uint64)
        have[0] = 1
        _powers[name] = have = np.multiply.accumulate(have)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


@dataclass
class Slice:
    """Rows ``first`` to ``first + rows`` of a batch; ``offs`` bounds each row within ``data``."""

    first: int
    rows: int
    data: np.ndarray
    offs: np.ndarray

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a per-byte flag for every row."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return np.diff(total[self.offs])

    def text(self, row: int) -> bytes:
        return self.data[self.offs[row] : self.offs[row + 1]].tobytes()


@dataclass
class Spans:
    """Byte spans of a slice in order, with the row of each."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray

    def __len__(self) -> int:
        return len(self.start)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, buf = column.buffers()
    n = len(column)
    if n == 0:
        return
    offs = np.frombuffer(off, np.int64 if large else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offs, offs[at] + limit, "right")) - 1
        to = min(n, max(to, at + 1))
        yield Slice(at, to - at, data[offs[at] : offs[to]], offs[at : to + 1] - offs[at])
        at = to


def words(s: Slice, space: np.ndarray = SPACE) -> Spans:
    """Maximal runs of bytes outside ``space`` within each row."""
    if len(s.data) == 0:
        e = np.zeros(0, np.int64)
        return Spans(e, e, e)
    solid = ~space[s.data]
    edge = np.zeros(len(s.data) + 1, bool)
    edge[s.offs] = True
    begin = solid.copy()
    begin[1:] &= ~solid[:-1] | edge[1:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | edge[1:-1]
    start, end = np.flatnonzero(begin), np.flatnonzero(last) + 1
    return Spans(start, end, rows_of(s, start))


def lines(s: Slice) -> Spans:
    r"""The \n-split lines of each row, empty ones included."""
    cut = np.flatnonzero(s.data == 10)
    start = np.concatenate([s.offs[:-1], cut + 1])
    row = np.concatenate([np.arange(s.rows), rows_of(s, cut)])
    order = np.lexsort((start, row))
    start, row = start[order], row[order]
    last = np.ones(len(row), bool)
    last[:-1] = row[1:] != row[:-1]
    end = np.empty_like(start)
    end[:-1] = start[1:] - 1
    end[last] = s.offs[1:][row[last]]
    return Spans(start, end, row)


def rows_of(s: Slice, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(s.offs, at, "right") - 1


def hashes(data: np.ndarray, spans: Spans, block: int = SLICE_BYTES) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; the same in every process. Spans are in order."""
    out = np.empty(len(spans), np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(spans):
            base = int(spans.start[at])
            to = max(at + 1, int(np.searchsorted(spans.end, base + block, "right")))
            piece = data[base : int(spans.end[to - 1])]
            total = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(_BYTE[piece] * _power("up", _MULT, len(piece)), out=total[1:])
            lo, hi = spans.start[at:to] - base, spans.end[at:to] - base
            out[at:to] = (total[hi] - total[lo]) * _power("down", _INV, len(piece) + 1)[lo] + (hi - lo).astype(np.uint64)
            at = to
        return mix(out)


def windows(word: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words within a row, and the index of the first word of each."""
    if len(word) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        h = word[: len(word) - n + 1].copy()
        for k in range(1, n):
            h = h * _MULT + word[k : len(word) - n + 1 + k]
        at = np.flatnonzero(row[: len(row) - n + 1] == row[n - 1 :])
        return mix(h[at]), at


def row_keys(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hashes that differ between rows."""
    with np.errstate(over="ignore"):
        return mix(h + (row.astype(np.uint64) + _U(1)) * _MULT)


def text_hash(value: bytes) -> np.uint64:
    """The hash that ``hashes`` gives a span with these bytes."""
    data = np.frombuffer(value, np.uint8)
    return hashes(data, Spans(np.array([0]), np.array([len(data)]), np.array([0])))[0]
