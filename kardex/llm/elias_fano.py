"""Elias-Fano sequences and a two-level n-gram trie over memory-mapped files.

All look-ups take arrays of queries.
"""

from __future__ import annotations

import io

import numpy as np

_SELECT = np.array([[next((p for p in range(8) if (b >> p & 1) and (b & ((1 << p) - 1)).bit_count() == k), 8)
                     for k in range(8)] for b in range(256)], np.uint8)


def _in_word(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th set bit (from 0) of each 64-bit word: byte-wise counts
    and their running sums in one register, then a table per byte."""
    u = np.uint64
    s = word - ((word >> u(1)) & u(0x5555555555555555))
    s = (s & u(0x3333333333333333)) + ((s >> u(2)) & u(0x3333333333333333))
    upto = ((s + (s >> u(4))) & u(0x0F0F0F0F0F0F0F0F)) * u(0x0101010101010101)
    top = u(0x8080808080808080)
    k = k.astype(np.uint64)
    octet = np.bitwise_count((((k * u(0x0101010101010101)) | top) - upto) & top).astype(np.uint64) << u(3)
    before = ((upto << u(8)) >> octet) & u(255)
    return octet.astype(np.int64) + _SELECT[((word >> octet) & u(255)).astype(np.int64), (k - before).astype(np.int64)]


class EliasFano:
    """A non-decreasing sequence of numbers below ``universe``: high parts as
    unary gaps with a directory of counts, low parts packed."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ones = n, low_bits, low, high, ones
        self.zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = values.astype(np.int64)
        n = len(values)
        low_bits = max(0, int(universe // max(1, n)).bit_length() - 1)
        high = values >> low_bits
        length = n + (universe >> low_bits) + 2
        words = -(-length // 64)
        bits = np.zeros(words * 64, np.uint8)
        bits[high + np.arange(n)] = 1
        packed = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
        low = np.zeros((n * low_bits + 63) // 64 + 2, np.uint64)
        if low_bits:
            rest = (values & ((1 << low_bits) - 1)).astype(np.uint64)
            at = np.arange(n, dtype=np.int64) * low_bits
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            np.bitwise_or.at(low, word, rest << shift)
            over = np.flatnonzero(shift.astype(np.int64) + low_bits > 64)
            np.bitwise_or.at(low, word[over] + 1, rest[over] >> (np.uint64(64) - shift[over]))
        return cls(n, low_bits, low, packed, ones)

    def _low(self, index: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(index), np.int64)
        at = index * self.low_bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        # Two shifts: one by 64 would be undefined.
        upper = (self.low[word + 1] << np.uint64(1)) << (np.uint64(63) - shift)
        return (((self.low[word] >> shift) | upper) & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def _select(self, k: np.ndarray, directory: np.ndarray, invert: bool) -> np.ndarray:
        word = np.searchsorted(directory, k, side="right") - 1
        bits = self.high[word]
        return word * 64 + _in_word(~bits if invert else bits, k - directory[word])

    def get(self, index: np.ndarray) -> np.ndarray:
        high = self._select(index, self.ones, False) - index
        return (high << self.low_bits) | self._low(index)

    def successor(self, start: np.ndarray, end: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First index in [start, end) whose number is at least ``value``
        (``end`` if none), and whether it equals it."""
        high, low = value >> self.low_bits, value & ((1 << self.low_bits) - 1)
        # The zero that closes a bucket tells how many numbers lie up to it.
        upto = self._select(high, self.zeros, True) - high
        below = np.zeros_like(upto)
        some = np.flatnonzero(high > 0)
        below[some] = self._select(high[some] - 1, self.zeros, True) - high[some] + 1
        left, right = np.clip(below, start, end), np.clip(upto, start, end)
        last = right.copy()
        open_ = np.flatnonzero(left < right)
        while len(open_):
            middle = (left[open_] + right[open_]) >> 1
            less = self._low(middle) < low[open_]
            left[open_] = np.where(less, middle + 1, left[open_])
            right[open_] = np.where(less, right[open_], middle)
            open_ = open_[left[open_] < right[open_]]
        equal = np.zeros(len(value), bool)
        inside = np.flatnonzero(left < last)
        equal[inside] = self._low(left[inside]) == low[inside]
        return left, equal

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], np.int64), self.low, self.high, self.ones]

    @classmethod
    def of(cls, parts: list[np.ndarray]) -> EliasFano:
        n, low_bits = parts[0].view(np.int64).tolist()
        return cls(n, low_bits, parts[1].view(np.uint64), parts[2].view(np.uint64), parts[3].view(np.int64))


def pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays in one buffer, each at a multiple of 8 bytes, after their sizes."""
    out = io.BytesIO()
    out.write(np.array([len(arrays), *[a.nbytes for a in arrays]], np.int64).tobytes())
    for a in arrays:
        out.write(a.tobytes())
        out.write(bytes(-a.nbytes % 8))
    return out.getvalue()


def unpack(buffer) -> list[np.ndarray]:
    raw = np.frombuffer(buffer, np.uint8)
    count = int(raw[:8].view(np.int64)[0])
    at, out = 8 + 8 * count, []
    for size in raw[8:at].view(np.int64).tolist():
        out.append(raw[at:at + size])
        at += size + -size % 8
    return out


def quantise(logs: np.ndarray, bits: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Codes 1.. and the bins (bin 0 unused): equally wide bins of the
    logarithms, each standing for its members' mean."""
    if not len(logs):
        return np.zeros(0, np.uint8), np.zeros(1)
    most, low, high = (1 << bits) - 1, logs.min(), logs.max()
    code = np.minimum(((logs - low) * (most / max(high - low, 1e-12))).astype(np.int64), most - 1)
    bins = np.bincount(code, weights=logs, minlength=most) / np.maximum(1, np.bincount(code, minlength=most))
    return (code + 1).astype(np.uint8), np.concatenate([[0.0], bins])


class Trie:
    """Contexts, and below each the words that follow it.

    Contexts are an Elias-Fano sequence of ids, the pointers to their followers
    another; the followers' ids are made monotone by adding, in each context,
    the last number before it, so that a look-up is a context-relative
    successor search.  Probabilities are 8-bit codes.
    """

    def __init__(self, contexts: EliasFano, pointers: EliasFano, words: EliasFano, codes: np.ndarray,
                 bins: np.ndarray, rest_codes: np.ndarray, rest_bins: np.ndarray):
        self.contexts, self.pointers, self.words = contexts, pointers, words
        self.codes, self.bins, self.rest_codes, self.rest_bins = codes, bins, rest_codes, rest_bins

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, log_p: np.ndarray, log_rest: np.ndarray, ids: int) -> Trie:
        """From pairs sorted by (context, word); ``log_rest`` has one number for
        each distinct context.  Ids are below ``ids``."""
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(context) else np.zeros(0, np.int64)
        ends = np.append(first[1:], len(context)) if len(context) else first
        base = np.concatenate([[0], np.cumsum(word[ends - 1])])[:-1] if len(first) else first
        monotone = word + np.repeat(base, ends - first)
        codes, bins = quantise(log_p)
        rest_codes, rest_bins = quantise(log_rest)
        return cls(EliasFano.build(context[first], ids + 1), EliasFano.build(np.append(first, len(context)), len(context) + 1),
                   EliasFano.build(monotone, int(monotone[-1]) + ids + 2 if len(monotone) else ids + 2),
                   codes, bins, rest_codes, rest_bins)

    def look_up(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the pair and of the context, 0 where not found."""
        pair = np.zeros(len(context), np.uint8)
        asked, of = np.unique(context, return_inverse=True)
        none = np.zeros(len(asked), np.int64)
        at, known = self.contexts.successor(none, none + self.contexts.n, asked)
        at = at[known]
        start, end, base = none.copy(), none.copy(), none.copy()
        start[known], end[known] = self.pointers.get(at), self.pointers.get(at + 1)
        some = np.flatnonzero(start > 0)
        base[some] = self.words.get(start[some] - 1)
        codes = np.zeros(len(asked), np.uint8)
        codes[known] = self.rest_codes[at]
        rest = codes[of]
        ask = np.flatnonzero(known[of])
        of = of[ask]
        place, found = self.words.successor(start[of], end[of], base[of] + word[ask])
        pair[ask[found]] = self.codes[place[found]]
        return pair, rest

    def dump(self) -> bytes:
        return pack([*self.contexts.parts(), *self.pointers.parts(), *self.words.parts(), self.codes, self.bins,
                     self.rest_codes, self.rest_bins])

    @classmethod
    def load(cls, buffer) -> Trie:
        p = unpack(buffer)
        return cls(EliasFano.of(p[:4]), EliasFano.of(p[4:8]), EliasFano.of(p[8:12]), p[12], p[13].view(np.float64),
                   p[14], p[15].view(np.float64))
