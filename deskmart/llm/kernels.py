"""Word hashes of Arrow text columns in numpy, for operators that work inside Python tasks.

Texts are taken in pieces of bounded size, cut between words, so that temporary arrays stay small
however long a text is. Word hashes are Karp-Rabin polynomials over the UTF-8 bytes modulo 2**64,
finished by a mixing step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64

_bytes = np.arange(256)
SPACES = (_bytes == 32) | ((_bytes >= 9) & (_bytes <= 13))
# ASCII letters and digits and every byte beyond ASCII belong to words
NOT_WORD = ~(((_bytes >= 48) & (_bytes <= 57)) | ((_bytes >= 65) & (_bytes <= 90))
             | ((_bytes >= 97) & (_bytes <= 122)) | (_bytes >= 128))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finisher of 64-bit hashes."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Tables:
    """Powers of the base and of its inverse, made where they are used: functions that are sent to tasks
    take an empty one along."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def __reduce__(self):
        return _Tables, ()

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        return self.up, self.down


_TABLES = _Tables()


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the n + 1 offsets of its rows; null rows are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]] if len(offsets) else data, offsets - offsets[0]


def segments(hashes_of: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges of one piece."""
    up, down = _TABLES.of(len(hashes_of) + 1)
    sums = np.zeros(len(hashes_of) + 1, dtype=np.uint64)
    np.cumsum((hashes_of.astype(np.uint64) + _U(1)) * up[:len(hashes_of)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] ^ (ends - starts).astype(np.uint64))


def ranges(data: np.ndarray, cuts: np.ndarray, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are not ``outside``, broken at ``cuts`` too."""
    inside = ~outside[data]
    if not len(inside):
        none = np.zeros(0, dtype=np.int64)
        return none, none
    edge = np.zeros(len(inside) + 1, dtype=bool)
    edge[cuts[cuts <= len(inside)]] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about PIECE bytes (or one longer row): first row, rows, bytes, offsets."""
    data, offsets = raw(column)
    row, n = 0, len(column)
    while row < n:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PIECE, side="right")) - 1)
        to = min(to, n)
        yield row, to - row, data[offsets[row]:offsets[to]], offsets[row:to + 1] - offsets[row]
        row = to


def words(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray = SPACES,
          ) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a block and the n + 1 word offsets of its rows."""
    hashes, begun, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        if end < len(data):  # move the cut back to the gap before a word, if the piece has one
            gaps = np.flatnonzero(outside[data[at:end]])
            while not len(gaps) and end < len(data):
                end = min(len(data), end + PIECE)
                gaps = np.flatnonzero(outside[data[at:end]])
            if end < len(data):
                end = at + int(gaps[-1]) + 1
        piece = data[at:end]
        near = offsets[(offsets >= at) & (offsets <= end)] - at
        starts, ends = ranges(piece, near, outside)
        hashes.append(segments(piece, starts, ends))
        begun.append(starts + at)
        at = end
    hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    begun = np.concatenate(begun) if begun else np.zeros(0, np.int64)
    return hashes, np.searchsorted(begun, offsets, side="left")


def windows(tokens: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hashes of all runs of ``k`` tokens, by Horner's rule over the token hashes."""
    n = len(tokens) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = _U((0xD6E8FEB86659FD93 + 2 * salt) & (2**64 - 1))
    out = tokens[:n].copy()
    for j in range(1, k):
        out = out * base + tokens[j:j + n]
    return mixed(out)


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """The row of each item, from row offsets."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
