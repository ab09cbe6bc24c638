"""A compressed FM-index over words: bounded-context BWT in a wavelet matrix of bit-packed levels.

Rows are ordered by their first ``context`` words only (ties by place), which leaves backward
search exact for patterns of up to ``context`` words.  All queries are array operations over
many patterns at once.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector of packed 64-bit words with ranks at word borders."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        padded = np.zeros((self.n // 64 + 1) * 64, dtype=np.uint8)
        padded[:self.n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.uint32)
        self.before = np.zeros(len(counts), dtype=np.uint32)
        np.cumsum(counts[:-1], out=self.before[1:])
        self.ones = int(counts.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word].astype(np.int64) + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Ranks of symbols in a sequence over [0, size)."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.width = max(1, int(size - 1).bit_length())
        self.levels = []
        current = symbols
        for level in range(self.width - 1, -1, -1):
            bit = (current >> level) & 1
            self.levels.append(Bits(bit.astype(np.uint8)))
            current = np.concatenate([current[bit == 0], current[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place, less the start of its run on the last level."""
        for level, bits in enumerate(self.levels):
            one = bits.rank(at)
            set_bit = ((symbol >> (self.width - 1 - level)) & 1).astype(bool)
            at = np.where(set_bit, bits.n - bits.ones + one, at - one)
        return at


class FMIndex:
    """Index of ``symbols`` (1 or more; 0 parts segments and is in no pattern)."""

    def __init__(self, symbols: np.ndarray, size: int, context: int):
        n = len(symbols)
        order = _context_order(symbols, context)
        self.wavelet = WaveletMatrix(symbols[order - 1], size)  # the word before each row; place 0 wraps
        self.first = np.zeros(size + 1, dtype=np.int64)
        np.cumsum(np.bincount(symbols, minlength=size), out=self.first[1:])
        every = np.arange(size)
        self.origin = self.wavelet.rank(every, np.zeros(size, dtype=np.int64))  # where each symbol's run starts on the last level
        self.n = n

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One backward step: rows that begin with the symbol and then with what low..high begin with."""
        both = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        base = self.first[symbol] - self.origin[symbol]
        return base + both[:len(low)], base + both[len(low):]

    def matching(self, symbols: np.ndarray, last: np.ndarray, length: int, least: int = 2) -> tuple[np.ndarray, np.ndarray]:
        """Bounded matching statistics of the patterns that end at ``last`` in ``symbols``.

        For each, how many words (up to ``length``, from its end to the left) still occur at ``least`` or more
        places, and the first row of the interval if that is ``length``.
        """
        matched, row = np.zeros(len(last), dtype=np.int64), np.full(len(last), -1, dtype=np.int64)
        if not len(last):
            return matched, row
        live = np.arange(len(last))
        low, high = self.first[symbols[last]], self.first[symbols[last] + 1]
        for step in range(1, length + 1):
            keep = high - low >= least
            live, low, high = live[keep], low[keep], high[keep]
            matched[live] = step
            if step == length or not len(live):
                break
            low, high = self.extend(low, high, symbols[last[live] - step])
        if len(live):
            row[live] = low
        return matched, row


def _context_order(symbols: np.ndarray, context: int) -> np.ndarray:
    """Places in the order of their first ``context`` symbols (past the end: smaller than any), ties by place."""
    n = len(symbols)
    rank, span = symbols.astype(np.int64), 1
    at_end = np.zeros(n, dtype=np.int64)
    while span < context:
        step = min(span, context - span)  # overlapping halves make any context
        following = at_end.copy()
        following[:max(0, n - step)] = rank[step:] + 1
        key = rank * (int(rank.max(initial=0)) + 2) + following
        order = np.argsort(key, kind="stable")
        changed = np.concatenate([[0], (np.diff(key[order]) != 0).astype(np.int64)])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(changed)
        span += step
    return np.argsort(rank, kind="stable")
