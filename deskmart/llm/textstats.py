"""Counts over whole texts, computed for Arrow batches in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from deskmart.llm.kernels import SPACES, blocks, mixed, ranges, rows_of, segments, windows, words

SYMBOLS = b"#*$%&|<>"


def _flags(members: bytes | range) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(members)] = True
    return out


_SYMBOL, _BANG = _flags(SYMBOLS), _flags(b"!?")
_DIGIT, _UPPER, _LOWER = _flags(b"0123456789"), _flags(range(65, 91)), _flags(range(97, 123))
_NOT_BREAK = np.arange(256) != 10


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def repeated(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key occurs twice or more in its row, and whether an equal one came before."""
    own = keys ^ mixed(rows.astype(np.uint64) + np.uint64(1))
    order = np.argsort(own, kind="stable")
    same = own[order][1:] == own[order][:-1]
    later = np.zeros(len(keys), dtype=bool)
    later[order[1:]] = same
    twice = later.copy()
    twice[order[:-1]] |= same
    return twice, later


def _block(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    points = (data & 0xC0) != 0x80
    inside = points & ~SPACES[data]
    tokens, at = words(data, offsets)
    rows = rows_of(at)
    covered = np.zeros(len(tokens), dtype=bool)
    triples = windows(tokens, 3)
    if len(triples):
        whole = rows[:-2] == rows[2:]
        starts = np.flatnonzero(whole)[repeated(triples[whole], rows[:-2][whole])[0]]
        for j in range(3):
            covered[starts + j] = True
    # lines: runs between line feeds; an edge at every row keeps rows apart
    starts, ends = ranges(data, offsets, ~_NOT_BREAK)
    has_word = np.cumsum(np.concatenate([[0], ~SPACES[data]]))
    with_word = has_word[ends] > has_word[starts]
    starts, ends = starts[with_word], ends[with_word]
    line_at = np.searchsorted(starts, offsets, side="left")
    lines = _long_segments(data, starts, ends)
    next_equal = np.zeros(len(tokens), dtype=bool)
    if len(tokens) > 1:
        next_equal[:-1] = (tokens[1:] == tokens[:-1]) & (rows[1:] == rows[:-1])
    # capital letters of the Latin-1 block: lead byte C3, then 80 to 9E
    upper = _UPPER[data]
    if len(data) > 1:
        upper[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    count = lambda flags: _per_row(flags, offsets)
    return {
        "n_words": np.diff(at), "word_chars": count(inside), "n_symbols": count(_SYMBOL[data]),
        "n_dup_lines": _per_row(repeated(lines, rows_of(line_at))[1], line_at),
        "n_repeat_words": _per_row(covered, at), "n_chars": count(points),
        "n_lines": np.diff(line_at), "n_upper": count(upper), "n_lower": count(_LOWER[data]),
        "n_digits": count(_DIGIT[data]), "n_bangs": count(_BANG[data]),
        "n_next_equal": _per_row(next_equal, at),
        "n_later_words": _per_row(repeated(tokens, rows)[1], at),
    }


def _long_segments(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges of any length. A range is hashed in pieces of fixed length, which are
    combined, so that equal ranges get equal hashes wherever they stand."""
    size = 1 << 16
    if not len(starts):
        return np.zeros(0, np.uint64)
    pieces = np.maximum(1, -(-(ends - starts) // size))
    owner = np.repeat(np.arange(len(starts)), pieces)
    part = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = starts[owner] + part * size
    end = np.minimum(begin + size, ends[owner])
    out = np.zeros(len(owner), np.uint64)
    at = 0
    while at < len(owner):  # runs of neighbouring pieces with bounded span
        to = max(at + 1, int(np.searchsorted(end, begin[at] + 16 * size, side="right")))
        out[at:to] = segments(data[begin[at]:end[to - 1]], begin[at:to] - begin[at], end[at:to] - begin[at])
        at = to
    first = np.cumsum(pieces) - pieces
    return mixed(np.add.reduceat(out * (2 * part.astype(np.uint64) + np.uint64(1)), first))


def text_stats(column: pa.Array) -> dict[str, np.ndarray]:
    """Counts of every row of a text column (null: empty): words, characters of words and in all,
    symbols, repeated lines, words in repeated triples, lines, capitals, small letters, digits,
    exclamation or question marks, words equal to the next, words that came before."""
    parts = [_block(data, offsets) for _, _, data, offsets in blocks(column)]
    return {name: np.concatenate([p[name] for p in parts]) if parts else np.zeros(0, np.int64)
            for name in (parts[0] if parts else _block(np.zeros(0, np.uint8), np.zeros(1, np.int64)))}
