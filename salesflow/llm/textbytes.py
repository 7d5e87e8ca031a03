"""Words of whole Arrow batches as numpy arrays, straight from the UTF-8 bytes.

Separators are ASCII, so cutting bytes cuts the same words as cutting characters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

#: bytes of words between ASCII white space
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: ASCII letters and digits, and every byte of a non-ASCII character
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

# one random 64-bit number for each (place in the word mod 64, byte): a word's hash is their sum
_TABLE = np.random.default_rng(20_240_601).integers(0, 1 << 63, 64 * 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offset of each row's first byte (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    start: np.ndarray   # first byte of each word
    length: np.ndarray  # bytes
    doc: np.ndarray     # row of each word
    hash: np.ndarray    # 64-bit hash of the bytes
    count: np.ndarray   # words of each row


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, fold: bool = True) -> Words:
    """Maximal runs of ``inside`` bytes within each row; ``fold`` lower-cases A-Z first."""
    rows = len(offsets) - 1
    keep = inside[data]
    before, after = np.zeros(len(keep), bool), np.zeros(len(keep), bool)
    before[1:], after[:-1] = keep[:-1], keep[1:]
    edges = offsets[(offsets > 0) & (offsets < len(keep))]
    before[edges], after[edges - 1] = False, False
    start = np.flatnonzero(keep & ~before)
    length = np.flatnonzero(keep & ~after) + 1 - start
    doc = np.searchsorted(offsets, start, "right") - 1
    if not len(start):
        return Words(start, length, doc, np.zeros(0, np.uint64), np.zeros(rows, np.int64))
    at = np.flatnonzero(keep)
    first = np.cumsum(length) - length
    place = np.arange(len(at)) - np.repeat(first, length)
    byte = data[at]
    value = _TABLE[((place & 63) << 8) | (FOLD[byte] if fold else byte)]
    if length.max() > 64:
        far = place > 63
        value[far] *= ((place[far] >> 6).astype(np.uint64) << np.uint64(1)) + np.uint64(3)
    h = mix(np.add.reduceat(value, first) + length.astype(np.uint64))
    return Words(start, length, doc, h, np.bincount(doc, minlength=rows))
