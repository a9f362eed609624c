"""A compressed full-text index of word sequences, searched backwards, vectorised over many patterns.

The index is a compressed suffix array.  For every symbol it holds the places of that symbol in
the Burrows-Wheeler transform; read one symbol after the other this is one ascending sequence, kept
in Elias-Fano form: about log2(symbols) + 4 bits a word in place of several 64-bit arrays.  Neither the text nor
the suffix order is kept.  Counting in that sequence gives backward search; reading it gives
the suffix one word further on (psi).  Every stretch ends in a mark of its own whose suffix rank is
the number of the stretch, so following psi to a mark locates an occurrence without a sample of positions.
"""

from __future__ import annotations

import numpy as np

from .nearsame import suffix_array

_ONE, _63, _6 = np.uint64(1), np.uint64(63), np.uint64(6)


def _pack(x: np.ndarray, width: int) -> np.ndarray:
    """Numbers of ``width`` bits one after the other in 64-bit words."""
    out = np.zeros(len(x) * width // 64 + 2, np.uint64)
    bit = np.arange(len(x), dtype=np.uint64) * np.uint64(width)
    word, shift = (bit >> _6).astype(np.int64), bit & _63
    np.bitwise_or.at(out, word, x << shift)
    over = (shift + np.uint64(width)) > np.uint64(64)
    np.bitwise_or.at(out, word[over] + 1, x[over] >> (np.uint64(64) - shift[over]))
    return out


class EliasFano:
    """An ascending sequence of non-negative numbers, compressed, with reading and counting."""

    def __init__(self, x: np.ndarray, top: int):
        """``top``: a number above all of ``x``."""
        self.n = n = len(x)
        self.width = max(0, int(top // max(n, 1)).bit_length() - 1)
        u = x.astype(np.uint64)
        self.low = _pack(u & np.uint64((1 << self.width) - 1), self.width) if self.width else np.zeros(0, np.uint64)
        high = (u >> np.uint64(self.width)).astype(np.int64)
        self.buckets = int(top >> self.width) + 1
        ones = high + np.arange(n)
        self.bits = np.zeros((n + self.buckets) // 64 + 1, np.uint64)
        np.bitwise_or.at(self.bits, ones >> 6, _ONE << (ones & 63).astype(np.uint64))
        kind = np.uint32 if n + self.buckets < 1 << 32 else np.int64
        self.ones = np.r_[0, np.cumsum(np.bitwise_count(self.bits), dtype=np.int64)].astype(kind)  # before each word
        self.zeros = (np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones).astype(kind)

    @property
    def nbytes(self) -> int:
        return self.low.nbytes + self.bits.nbytes + self.ones.nbytes + self.zeros.nbytes

    @staticmethod
    def _in_word(word: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Place of the k-th (from 0) set bit of each word."""
        place = np.zeros(len(word), np.uint64)
        k = k.astype(np.uint64)
        for half in (32, 16, 8, 4, 2, 1):
            h = np.uint64(half)
            count = np.bitwise_count((word >> place) & ((_ONE << h) - _ONE)).astype(np.uint64)
            go = k >= count
            place = place + np.where(go, h, np.uint64(0))
            k = k - np.where(go, count, np.uint64(0))
        return place.astype(np.int64)

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.int64)
        bit = i * self.width
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        left = self.low[word] >> shift
        right = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & _63), np.uint64(0))
        return ((left | right) & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def read(self, i: np.ndarray) -> np.ndarray:
        """The i-th numbers."""
        word = np.searchsorted(self.ones, i, "right") - 1
        one = word * 64 + self._in_word(self.bits[word], i - self.ones[word].astype(np.int64))
        return ((one - i) << self.width) | self._lows(i)

    def _bucket_ends(self, h: np.ndarray) -> np.ndarray:
        """How many numbers lie in the buckets up to and with ``h`` (-1: none)."""
        z = np.maximum(h, 0)
        word = np.searchsorted(self.zeros, z, "right") - 1
        zero = word * 64 + self._in_word(~self.bits[word], z - self.zeros[word].astype(np.int64))
        return np.where(h < 0, 0, zero - z)

    def below(self, x: np.ndarray) -> np.ndarray:
        """How many numbers are smaller than each ``x`` (at most ``top``)."""
        h = x >> self.width
        lo, hi = self._bucket_ends(h - 1), self._bucket_ends(h)
        rest = x & ((1 << self.width) - 1)
        live = np.flatnonzero(lo < hi)
        while len(live):  # halving within the bucket, which holds one number or so
            mid = (lo[live] + hi[live]) >> 1
            less = self._lows(mid) < rest[live]
            lo[live[less]] = mid[less] + 1
            hi[live[~less]] = mid[~less]
            live = live[lo[live] < hi[live]]
        return lo


class FullTextIndex:
    """The index of stretches (``tokens`` cut at ``off``)."""

    def __init__(self, s):
        self.of = s
        self.words, symbol = np.unique(s.tokens, return_inverse=True)
        self.rows = rows = len(s.cls)
        # each stretch is followed by an end mark of its own, smaller than every word
        at = np.arange(len(s.tokens)) + s.row
        text = np.empty(len(s.tokens) + rows, np.int64)
        text[at] = symbol + rows
        text[s.off[1:] + np.arange(rows)] = np.arange(rows)
        self.size = len(text)
        order = suffix_array(text)
        self.before = np.r_[np.arange(rows), rows + np.r_[0, np.cumsum(np.bincount(symbol, minlength=len(self.words)))]].astype(np.int64)  # smaller symbols in the text
        last = text[order - 1]  # the transform
        by = np.argsort(last, kind="stable")
        self.psi = EliasFano(last[by] * np.int64(self.size + 1) + by, (rows + len(self.words)) * (self.size + 1))

    @property
    def nbytes(self) -> int:
        """What the index holds beside the table of its symbols."""
        return self.psi.nbytes

    def symbols(self, tokens: np.ndarray) -> np.ndarray:
        """Symbols of tokens, -1 for those not in the index."""
        if not len(self.words):
            return np.full(len(tokens), -1, np.int64)
        at = np.minimum(np.searchsorted(self.words, tokens), len(self.words) - 1)
        return np.where(self.words[at] == tokens, at + self.rows, -1)

    def whole(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that start with a symbol."""
        return self.before[symbol], self.before[symbol + 1]

    def back(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix ranges after putting a symbol in front."""
        key = symbol * np.int64(self.size + 1)
        both = self.psi.below(np.r_[key + lo, key + hi])
        return both[: len(symbol)], both[len(symbol) :]

    def stretch_of(self, suffix: np.ndarray) -> np.ndarray:
        """The stretch each suffix lies in: words are skipped until its end mark."""
        at = suffix.copy()
        live = np.flatnonzero(at >= self.rows)
        while len(live):
            at[live] = self.psi.read(at[live]) % (self.size + 1)
            live = live[at[live] >= self.rows]
        return at
