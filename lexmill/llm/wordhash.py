"""Vectorised word and n-gram hashing on Arrow string columns.

Everything works on the UTF-8 bytes of a column: a word is a maximal run of
bytes other than space and ``\\x09-\\x0D``, which for UTF-8 is the same as the
regular expression ``[^\\x20\\x09-\\x0D]+`` on code points.  A word goes through
an avalanche mix eight bytes at a time, one of more than ``LONG_WORD`` bytes
through BLAKE2; n-grams are trees of such mixes.  No step is linear in the
input, so no family of texts collides by its form, and all processes agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes of a word from which on BLAKE2 takes over.
LONG_WORD = 64
_LENGTH, _STEP = U64(0x9E3779B97F4A7C15), U64(0xD1342543DE82EF97)  # the second is 3 modulo 4, so swapped parts differ

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_LANE_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=U64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Avalanche finaliser (a bijection on 64-bit integers)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two hashed parts in this order."""
    return mix64(left * _STEP + right)


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (length rows + 1) of a string column, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32, count=column.offset + len(column) + 1)[column.offset :].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def row_chunks(offsets: np.ndarray, limit: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes stay under ``limit`` (one longer row stands alone)."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(rows, max(stop, start + 1))
        yield start, stop
        start = stop


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (bytes in ``data``) and row of every word of the given rows."""
    base = int(offsets[0])
    inside = ~IS_SPACE[data[base : int(offsets[-1])]]
    size = len(inside)
    if not size:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[1:-1] - base
    cuts = cuts[(cuts > 0) & (cuts < size)]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first) + base, np.flatnonzero(last) + base + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word; another seed gives an independent one."""
    if not len(starts):
        return np.zeros(0, dtype=U64)
    low, high = int(starts[0]), int(ends[-1])
    padded = np.concatenate([data[low:high], np.zeros(8, dtype=np.uint8)])
    lanes = np.ndarray((high - low + 1,), dtype="<u8", buffer=padded, strides=(1,))  # eight bytes from every place
    at, size = starts - low, ends - starts
    hashes = mix64((lanes[at] & _LANE_MASK[np.minimum(size, 8)]) ^ mix64(np.array([seed + 1], dtype=U64))) + size.astype(U64) * _LENGTH
    for step in range(8, LONG_WORD, 8):
        more = np.flatnonzero(size > step)
        if not len(more):
            break
        lane = lanes[at[more] + step] & _LANE_MASK[np.minimum(size[more] - step, 8)]
        hashes[more] = combine(hashes[more], lane)
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        digest = hashlib.blake2b(padded[at[i] : at[i] + size[i]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little")).digest()
        hashes[i] = int.from_bytes(digest, "little")
    return mix64(hashes)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words (len(hashes) - n + 1 values)."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=U64)
    result, done, block, width = None, 0, hashes, 1
    while True:
        if n & width:
            part = block[done : done + count]
            result = part if result is None else combine(result, part)
            done += width
        if 2 * width > n:
            return result
        block = combine(block[: len(block) - width], block[width:])
        width *= 2


def row_bounds(rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Offsets of each row's words in the word arrays (length n_rows + 1)."""
    return np.searchsorted(rows, np.arange(n_rows + 1))
