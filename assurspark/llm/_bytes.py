"""Vectorised text helpers for tasks: whole texts as byte arrays, in pieces of bounded size.

Documents arrive as Arrow string columns; several are joined into one byte
buffer, each followed by 0xFF, a byte that UTF-8 never uses.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEP = 255
PIECE = 1 << 19  # bytes worked on at once (one longer text makes a longer piece)

_TAB = np.zeros(256, bool)
_TAB[[32, 9, 10, 11, 12, 13, SEP]] = True
SPACE = _TAB                                   # bytes between words, and the separator
_SYM = np.zeros(256, bool)
_SYM[list(b"#*$%&|<>")] = True
SYMBOL = _SYM
_MIX = np.random.default_rng(77).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_POW: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POW.get(base)
    if have is None or len(have) < n:
        size = max(n, PIECE + (1 << 16))
        with np.errstate(over="ignore"):
            have = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, base, np.uint64)]))
        if size <= 4 * PIECE:
            _POW[base] = have
    return have


def pieces(column: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, start of each row's text) of pieces of
    about ``limit`` bytes.  Row k's text is bytes[start[k]:start[k + 1] - 1];
    a null is an empty text."""
    n = len(column)
    if n == 0:
        return
    buffers = column.buffers()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = buffers[2] if buffers[2] is not None else b""
    view = memoryview(data)
    lengths = np.diff(offsets)
    if column.null_count:
        lengths = np.where(np.asarray(column.is_null()), 0, lengths)
    i = 0
    while i < n:
        total, j = 0, i
        while j < n and (j == i or total + lengths[j] < limit):
            total += int(lengths[j])
            j += 1
        joined = b"".join([x for k in range(i, j) for x in (view[offsets[k]:offsets[k] + lengths[k]], b"\xff")])
        starts = np.zeros(j - i + 1, np.int64)
        np.cumsum(lengths[i:j] + 1, out=starts[1:])
        yield i, j, np.frombuffer(joined, np.uint8), starts
        i = j


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a 64-bit value over all bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash modulo 2^64; H[i] covers the first i bytes."""
    out = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_MIX[data] * _powers(_P, len(data))[:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes [start, end) wherever they stand."""
    with np.errstate(over="ignore"):
        h = (prefix[end] - prefix[start]) * _powers(_PINV, len(prefix))[start]
        return mixed(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def rolling_hash(prefix: np.ndarray, width: int) -> np.ndarray:
    """span_hash of every ``width`` neighbouring bytes."""
    n = len(prefix) - width
    with np.errstate(over="ignore"):
        h = (prefix[width:] - prefix[:n]) * _powers(_PINV, len(prefix))[:n]
        return mixed(h + np.uint64(width * 0xD6E8FEB86659FD93 % (1 << 64)))


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def owner(position: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Row of each position."""
    return np.searchsorted(starts, position, "right") - 1


def word_windows(words: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word windows inside a row, and each window's first word."""
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(row[:len(words) - n + 1] == row[n - 1:])
    h = np.zeros(len(first), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = h * np.uint64(0x9FB21C651E98DF25) + words[first + k]
    return mixed(h), first
