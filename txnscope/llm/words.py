"""Vectorised words and rolling hashes over the UTF-8 buffers of an Arrow text column.

A word is a maximal run of bytes other than space and U+0009-U+000D, the same in
UTF-8 bytes as in code points.  Nothing here loops over words in Python.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# odd multiplier of the byte polynomial, and its inverse modulo 2**64
_MULT = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULT, -1, 1 << 64)
_BLOCK = 1 << 19
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def column_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], type=column.type)
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, raw_offsets, raw = column.buffers()
    offsets = np.frombuffer(raw_offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, dtype=np.int64)
    if raw is None or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), offsets - offsets[0]
    return np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def text_bytes(texts: list[str | bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The same of a list of texts."""
    raw = [t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(r) for r in raw], out=offsets[1:])
    return np.frombuffer(b"".join(raw), dtype=np.uint8), offsets


def word_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of all words, and the index of each text's first word."""
    if not len(buf):
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(len(offsets), dtype=np.int64)
    space = SPACE[buf]
    solid = ~space
    begins, closes = solid.copy(), solid.copy()
    begins[1:] &= space[:-1]
    closes[:-1] &= space[1:]
    filled = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    begins[heads] = solid[heads]
    closes[tails] = solid[tails]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def compact(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words written one after another with one space behind each; new spans."""
    lengths = ends - starts
    new_starts = np.zeros(len(starts), dtype=np.int64)
    if len(starts):
        np.cumsum(lengths[:-1] + 1, out=new_starts[1:])
    total = int(new_starts[-1] + lengths[-1] + 1) if len(starts) else 0
    out = np.full(total, 0x20, dtype=np.uint8)
    new_ends = new_starts + lengths
    inside = np.zeros(total + 1, dtype=np.int8)
    inside[new_starts] = 1
    inside[new_ends] = -1
    keep = np.zeros(len(buf) + 1, dtype=np.int8)
    keep[starts] += 1
    np.add.at(keep, ends, -1)
    out[np.cumsum(inside[:-1], dtype=np.int8).view(bool)] = buf[np.cumsum(keep[:-1], dtype=np.int8).view(bool)]
    return out, new_starts, new_ends


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = _BLOCK
    while size < n:
        size *= 2
    if size not in _powers:
        made = []
        for base in (_MULT, _INVERSE):
            p = np.full(size + 1, base, dtype=np.uint64)
            p[0] = 1
            made.append(np.cumprod(p))
        if size > _BLOCK:
            return made[0], made[1]
        _powers[size] = (made[0], made[1])
    return _powers[size]


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span, from prefix sums of a byte polynomial; blocks bound the memory."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        a = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, a + _BLOCK, side="right")))
        b = int(ends[j - 1])
        powers, inverse = _power_tables(b - a)
        sums = np.zeros(b - a + 1, dtype=np.uint64)
        np.cumsum((buf[a:b].astype(np.uint64) + np.uint64(1)) * powers[:b - a], out=sums[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (sums[e] - sums[s]) * inverse[s]
        i = j
    return mix(out)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive word hashes (texts are not kept apart)."""
    size = max(0, len(hashes) - n + 1)
    acc = hashes[:size].copy()
    for j in range(1, n):
        acc *= np.uint64(0xD6E8FEB86659FD93)
        acc += hashes[j:j + size]
    return mix(acc)


def gram_starts(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, word index) of every run of n words that lies within one text."""
    counts = np.maximum(0, np.diff(first) - n + 1)
    text = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return text, np.arange(int(counts.sum())) - before[text] + first[:-1][text]
