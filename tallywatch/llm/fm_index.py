"""A compressed full-text index over sequences of numbers: BWT in a wavelet matrix, searched backwards for many patterns at once."""
from __future__ import annotations

import numpy as np


class Bits:
    """A packed bit vector with counts of ones before each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words)
        self.before = (np.cumsum(counts, dtype=np.int64) - counts).astype(np.uint32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word].astype(np.int64) + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """One bit vector per bit of the symbols, the highest first; each level puts the symbols with a 0 before those with a 1."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels: list[tuple[int, int, Bits]] = []
        for level in reversed(range(bits)):
            one = (symbols >> level) & 1 == 1
            zeros = symbols[~one]
            self.levels.append((level, len(zeros), Bits(one)))
            symbols = np.concatenate((zeros, symbols[one]))
        self.first = np.zeros(1 << bits, np.int64)
        begin = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1]))) if len(symbols) else np.zeros(0, np.int64)
        self.first[symbols[begin]] = begin

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its position."""
        for level, zeros, bits in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> level) & 1 == 1, zeros + ones, at - ones)
        return at - self.first[symbol]


class FMIndex:
    """`text` holds symbols from 1 on and 0 between sequences. Suffixes are sorted by their first 24 symbols, which is enough to
    search patterns of up to 24 backwards."""

    DEPTH = 24

    def __init__(self, text: np.ndarray):
        self.text = text
        n = len(text)
        bits = max(1, int(text.max(initial=0)).bit_length())
        rank = text.astype(np.int64)
        if bits <= 21:
            after = np.concatenate((rank, np.zeros(2, np.int64)))
            rank, done = np.unique((rank << 2 * bits) | (after[1:n + 1] << bits) | after[2:n + 2], return_inverse=True)[1], 3
        else:
            done = 1
        while done < self.DEPTH:
            after = np.zeros(n, np.int64)
            after[:max(0, n - done)] = rank[done:] + 1
            rank, done = np.unique((rank << 32) | after, return_inverse=True)[1], 2 * done
        self.array = np.argsort(rank, kind="stable")
        self.bwt = WaveletMatrix(text[self.array - 1], bits)
        self.below = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=1 << bits))))

    def search(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """For the pattern text[p:p + length] at each place p: the range of its occurrences in the suffix array. A pattern whose
        end already stands once only is not followed further: it stands once, too, and gets a range of one."""
        symbol = self.text[at + length - 1]
        low, high = self.below[symbol], self.below[symbol + 1]
        live = np.flatnonzero(high - low > 1)
        for j in range(length - 2, -1, -1):
            if not len(live):
                break
            symbol = self.text[at[live] + j]
            base = self.below[symbol]
            low[live], high[live] = base + self.bwt.rank(symbol, low[live]), base + self.bwt.rank(symbol, high[live])
            live = live[high[live] - low[live] > 1]
        return low, high
