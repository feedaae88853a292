"""Vectorised word and shingle hashing over blocks of UTF-8 texts (numpy).

A block is the concatenation of whole texts plus their offsets. Word hashes are
polynomial hashes modulo 2**64, taken as differences of prefix sums, so a block
costs a fixed number of array operations, whatever its number of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15 | 1)
BASE_INV = U64(pow(int(BASE), -1, 1 << 64))
BLOCK_BYTES = 1 << 20

SPACES = np.zeros(256, bool)
SPACES[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """BASE**i (or its inverse) modulo 2**64 for i < n."""
    key = "inv" if inverse else "pow"
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        base = BASE_INV if inverse else BASE
        out = np.empty(size, U64)
        out[0] = 1
        filled = 1
        while filled < size:  # doubling: out[k:2k] = out[:k] * base**k
            step = U64(int(out[filled - 1]) * int(base) & 0xFFFFFFFFFFFFFFFF)
            take = min(filled, size - filled)
            out[filled:filled + take] = out[:take] * step
            filled += take
        _powers[key] = have = out
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a binary column without nulls, uncopied."""
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    buffers = column.buffers()
    off = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    return data, off


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets from 0) of runs of whole rows of about ``limit`` bytes."""
    data, off = raw(column)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def words(data: np.ndarray, off: np.ndarray, separator: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the index of the first word of each
    text (one entry more than texts). Words are runs of non-separators and never
    cross texts."""
    n = len(data)
    if n == 0:
        empty = np.empty(0, np.int64)
        return empty, empty, np.zeros(len(off), np.int64)
    inside = np.zeros(n + 1, bool)
    np.logical_not(separator[data], out=inside[:n])
    first = np.zeros(n + 1, bool)
    first[off] = True
    before = np.empty(n + 1, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first))
    ends = np.flatnonzero(before & (~inside | first))
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    n = len(data)
    prefix = np.zeros(n + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * powers(n), out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * powers(n + 1, inverse=True)[starts])


def shingle_hashes(words_: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive entries."""
    n = len(words_) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    out = np.full(n, U64(k))
    for j in range(k):
        out = (out ^ words_[j:j + n]) * U64(0x9FB21C651E98DF25) + U64(j + 1)
        out ^= out >> U64(29)
    return mix(out)


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int = 5, fewest_words: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``k``-word shingle hashes of the texts of a block, sorted in each
    text, and the bounds of the texts in them. Texts are lower-cased (A-Z); one
    with fewer words has its whole sequence as the only shingle, one without
    words or with less than ``fewest_words`` has none."""
    data = LOWER[data]
    starts, ends, first = words(data, off)
    texts, size = len(off) - 1, np.diff(first)
    if not len(starts):
        return np.empty(0, U64), np.zeros(texts + 1, np.int64)
    hashed = word_hashes(data, starts, ends)
    text = np.repeat(np.arange(texts), size)
    inside = np.flatnonzero((text[:max(0, len(text) - k + 1)] == text[k - 1:]) & (size[text[k - 1:]] >= fewest_words))
    values, rows = [shingle_hashes(hashed, k)[inside]], [text[inside]]
    for m in range(max(1, fewest_words), k):
        short = np.flatnonzero(size == m)
        if len(short):
            values.append(shingle_hashes(hashed, m)[first[short]])
            rows.append(short)
    value, row = np.concatenate(values), np.concatenate(rows)
    order = np.argsort(value)
    if texts <= 1 << 16:  # a stable sort of 16-bit integers is a radix sort
        order = order[np.argsort(row[order].astype(np.uint16), kind="stable")]
    else:
        order = order[np.argsort(row[order], kind="stable")]
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[new], row[new]
    return value, np.searchsorted(row, np.arange(texts + 1))
