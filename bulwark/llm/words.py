"""Words of whole Arrow batches as 64-bit hashes, cut with numpy on the UTF-8 bytes.

Both word classes here are decided by single bytes: every byte of a multi-byte character is a word byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes of text that are cut at once; a longer text is cut alone.
PIECE_BYTES = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D

_fold = np.arange(256, dtype=np.uint8)
_fold[0x41:0x5B] += 32
_codes = np.random.RandomState(7).randint(1, 2**63, 256).astype(np.uint64)[_fold]

_b = np.arange(256)
#: Letters, digits and everything outside ASCII, after A-Z has become a-z.
ALNUM = ((_b >= 0x30) & (_b <= 0x39)) | ((_b >= 0x41) & (_b <= 0x5A)) | ((_b >= 0x61) & (_b <= 0x7A)) | (_b >= 0x80)
#: Everything but space and the characters 9 to 13.
NONSPACE = ~((_b == 0x20) | ((_b >= 0x09) & (_b <= 0x0D)))

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        n = max(n, PIECE_BYTES)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


@dataclass
class Words:
    """Words of some neighbouring rows: hash, byte start and end within `data`, and for each row its first word."""

    first_row: int
    data: np.ndarray
    text_at: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    word_at: np.ndarray


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: none), and where each row's begin; one more entry for the end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def pieces(at: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most `limit` bytes, or of one row."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def cut(column: pa.Array, is_word: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[Words]:
    """Cut the texts of a column into words, some rows at a time."""
    data, at = utf8(column)
    for i, j in pieces(at, limit):
        d, a = data[at[i] : at[j]], at[i : j + 1] - at[i]
        n = len(d)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = is_word[d]
        edge = np.zeros(n + 1, bool)
        edge[a] = True
        starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
        ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
        up, down = _powers_to(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_codes[d] * up[:n], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * down[starts])
        yield Words(i, d, a, hashes, starts, ends, np.searchsorted(starts, a))
