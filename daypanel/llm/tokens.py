"""Words of many texts at once, as 64-bit hashes, with numpy over the bytes of an Arrow column.

A word's hash is a polynomial over its bytes modulo 2**64, taken from one running sum per chunk and then mixed.
Two different words share a hash with a chance of about 2**-58 a pair; operators that cannot live with that
compare the texts afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_VALUES = np.random.default_rng(20240611).integers(1, 2**63, 256, dtype=np.uint64)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Words between white space, as they are written.
BETWEEN_SPACES = ~_SPACE
#: Words of ASCII letters, digits and all bytes of non-ASCII characters.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (one to one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of consecutive texts: text ``i`` of the chunk has the words ``bounds[i]:bounds[i + 1]``."""

    first: int
    hashes: np.ndarray
    bounds: np.ndarray


class _Powers:
    """``base ** i`` and its inverse modulo 2**64, grown on demand, one table per worker."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            inverse = np.uint64(pow(_BASE, -1, 1 << 64))
            for name, factor in (("up", np.uint64(_BASE)), ("down", inverse)):
                table = np.full(n, factor, np.uint64)
                table[0] = 1
                setattr(cls, name, np.cumprod(table, dtype=np.uint64))
        return cls.up[:n], cls.down[:n]


def word_chunks(texts: pa.Array, is_word: np.ndarray, lower: bool = True) -> Iterator[Words]:
    """The words of a string column, chunk by chunk of about a megabyte; a null text has none.

    A text is never split over chunks, so memory is bounded by the longest text.
    """
    if pa.types.is_large_string(texts.type) or texts.null_count:
        texts = pc.fill_null(texts.cast(pa.string()), "")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CHUNK_BYTES, side="right")) - 1)
        part = data[offsets[lo]:offsets[hi]]
        yield Words(lo, *_words(part, offsets[lo:hi + 1] - offsets[lo], is_word, lower))
        lo = hi


def _words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    inside = is_word[data]
    if not inside.any():
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    start[begins] = inside[begins]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    end[begins[1:] - 1] = inside[begins[1:] - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    if lower:
        data = np.where((data >= 0x41) & (data <= 0x5A), data + 32, data).astype(np.uint8)
    up, down = _Powers.of(len(data))
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up, out=running[1:])
    hashes = mix((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def ngrams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words inside a text, with their bounds per text."""
    if n == 1:
        return words.hashes, words.bounds
    m = len(words.hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(len(words.bounds), np.int64)
    total = np.zeros(m, np.uint64)
    for k in range(n):
        total = total * np.uint64(_BASE) + words.hashes[k:k + m]
    keep = np.ones(m, bool)
    for back in range(1, n):
        cut = words.bounds[1:-1] - back
        keep[cut[(cut >= 0) & (cut < m)]] = False
    sizes = np.maximum(np.diff(words.bounds) - n + 1, 0)
    return mix(total[keep]), np.concatenate([[0], np.cumsum(sizes)])
