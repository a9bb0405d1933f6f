"""Vectorised text primitives over Arrow string buffers: words, hashes, n-grams.

A word is a maximal run of ASCII letters, ASCII digits and non-ASCII bytes of the lower-cased text.
All hashes are 64 bits and wrap; a byte polynomial gives every word's hash from one prefix sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes of text handled at once; bounds the memory of the arrays beside it.
CHUNK_BYTES = 2 << 20

_P, _Q = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_WORD = np.zeros(256, bool)
_WORD[128:] = True
_WORD[ord("0") : ord("9") + 1] = True
_WORD[ord("a") : ord("z") + 1] = True
_WORD[ord("A") : ord("Z") + 1] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser (splitmix64) that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class _Powers:
    """Powers of an odd base mod 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.empty(0, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            self.up, self.down = (np.multiply.accumulate(np.concatenate([[U64(1)], np.full(n - 1, b, U64)])) for b in (self.base, self.inverse))
        return self.up, self.down

    def forget(self) -> None:
        self.up = self.down = np.empty(0, U64)


_BYTES, _WORDS = _Powers(_P), _Powers(_Q)


def forget_powers() -> None:
    """Give back what the hashes keep between calls; it is made again on demand."""
    _BYTES.forget()
    _WORDS.forget()


def chunks(batch: pa.RecordBatch, column: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of batch holding about size bytes of column each, whole rows always."""
    n = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = 0
    total = np.cumsum(n)
    while at < len(n):
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + size, "right")))
        yield batch.slice(at, to - at)
        at = to


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and the n+1 offsets; nulls count as empty."""
    texts = pc.fill_null(texts, "")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each text the index of its first word (n+1 of them)."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    w = _WORD[buf]
    head = w.copy()
    head[1:] &= ~w[:-1]
    tail = w.copy()
    tail[:-1] &= ~w[1:]
    edge = offsets[offsets < len(buf)]
    head[edge] = w[edge]
    edge = edge[edge > 0] - 1
    tail[edge] = w[edge]
    start = np.flatnonzero(head)
    return start, np.flatnonzero(tail) + 1, np.searchsorted(start, offsets)


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = _BYTES.get(len(buf))
    c = np.empty(len(buf) + 1, U64)
    c[0] = 0
    v = buf.astype(U64)
    v += U64(1)
    v *= up[: len(buf)]
    np.cumsum(v, out=c[1:])
    return mix((c[end] - c[start]) * down[start])


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of h[i:i+n] for every i that has n words left in the array."""
    if len(h) < n:
        return np.empty(0, U64)
    up, down = _WORDS.get(len(h) + 1)
    c = np.empty(len(h) + 1, U64)
    c[0] = 0
    np.cumsum(h * up[: len(h)], out=c[1:])
    return mix((c[n:] - c[:-n]) * down[: len(h) - n + 1] + U64(n))


def gram_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Of each text, the sorted distinct 56-bit hashes of its word n-grams.

    A text of fewer than n words has one gram, all its words; a text without words has none.
    """
    buf, offsets = buffer(pc.utf8_lower(texts))
    start, end, first = words(buf, offsets)
    h = word_hashes(buf, start, end)
    g = window_hashes(h, n) >> U64(8)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(g[a : b - n + 1]))
        elif b > a:
            out.append(window_hashes(h[a:b], b - a) >> U64(8))
        else:
            out.append(np.empty(0, U64))
    return out
