"""Whole-batch text work in numpy: words, 64-bit hashes and rolling windows without per-word Python.

A batch's UTF-8 bytes are one array. A hash of any span is a difference of two prefix
sums of ``byte_code[b] * P**i`` (mod 2**64) scaled back by ``P**-start``, then mixed, so
hashing all words of a batch costs a few array passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_P = U(0x9E3779B97F4A7C15 | 1)
_P_INV = U(pow(int(_P), -1, 1 << 64))
_MASK = (1 << 64) - 1

#: Bytes of text worked on at a time; a longer text is worked on alone.
SLICE_BYTES = 512 << 10


def _byte_codes() -> np.ndarray:
    x = np.arange(1, 257, dtype=U)
    return mix(x * U(0xD1342543DE82EF95))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective, well spread)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_CODES = _byte_codes()
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = int(_P)) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` for i < n, kept up to a bounded length."""
    have = _powers.get(base)
    if have is not None and len(have[0]) >= n:
        return have[0][:n], have[1][:n]
    size = max(n, SLICE_BYTES + 64)
    up, down = np.full(size, U(base)), np.full(size, U(pow(base, -1, 1 << 64)))
    up[0] = down[0] = U(1)
    made = np.cumprod(up, dtype=U), np.cumprod(down, dtype=U)
    if size <= SLICE_BYTES * 2:  # a few bases only are in use
        _powers[base] = made
    return made[0][:n], made[1][:n]


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = int(_P)) -> np.ndarray:
    """Mixed hash of ``codes[start:end]`` for each span; equal spans anywhere have equal hashes."""
    up, down = powers(len(codes) + 1, base)
    total = np.empty(len(codes) + 1, dtype=U)
    total[0] = 0
    np.cumsum(codes * up[: len(codes)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U) * U(0xA24BAED4963EE407))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    if offs is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets from 0) of runs of rows with at most ``limit`` bytes, or one longer row."""
    raw, offsets = text_buffers(column)
    n, at = len(offsets) - 1, 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        end = min(end, n)
        yield at, end, raw[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``[^\\x20\\x09-\\x0D]`` and, for each text, its first word (n + 1 values)."""
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before, after = np.zeros(len(data), dtype=bool), np.zeros(len(data), dtype=bool)
    before[1:] = word[:-1]
    after[:-1] = word[1:]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, its start and end in ``data``, and each text's first word."""
    starts, ends, first = find_words(data, offsets)
    if lower:
        data = _LOWER[data]
    if not len(starts):
        return np.zeros(0, U), starts, ends, first
    return span_hashes(_CODES[data], starts, ends), starts, ends, first


def sequence_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of word sequences ``words[start:end]``."""
    return span_hashes(words, starts, ends, 0xC2B2AE3D27D4EB4F)


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost minimum of every ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at, best, have = np.arange(len(values)), values, 1
    while have < width:
        step = min(have, width - have)
        a, b = best[:-step], best[step:]
        left = a <= b
        best, at = np.where(left, a, b), np.where(left, at[:-step], at[step:])
        have += step
    return at[:n]


def as_long(x: np.ndarray) -> np.ndarray:
    """uint64 as the signed long of the same bits, for Spark."""
    return x.view(np.int64)
