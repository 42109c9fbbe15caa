"""Succinct text index of one shard: suffix array, wavelet-tree ranks over the
Burrows-Wheeler transform, and sampled suffix positions.  All steps work on
arrays of queries at once."""

from __future__ import annotations

import numpy as np


class BitRank:
    """Bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) + 64) // 64 * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, upto: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        word, rest = upto >> 6, (upto & 63).astype(np.uint64)
        mask = (np.uint64(1) << rest) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def at(self, position: np.ndarray) -> np.ndarray:
        return (self.words[position >> 6] >> (position & 63).astype(np.uint64)) & np.uint64(1)


class WaveletTree:
    """Level-wise wavelet tree (matrix layout) of a symbol sequence."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = []
        for shift in range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1):
            bit = (symbols >> shift & 1).astype(bool)
            self.levels.append((shift, BitRank(bit), int(len(bit) - bit.sum())))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def descend(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Where ``position`` lands at the bottom along ``symbol``'s path."""
        for shift, bits, zeros in self.levels:
            ones = bits.ones(position)
            position = np.where(symbol >> shift & 1, zeros + ones, position - ones)
        return position

    def step(self, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol at each position and where the position lands at the bottom."""
        symbol = np.zeros(len(position), np.int64)
        for shift, bits, zeros in self.levels:
            bit, ones = bits.at(position).astype(np.int64), bits.ones(position)
            symbol |= bit << shift
            position = np.where(bit, zeros + ones, position - ones)
        return symbol, position


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling over the groups still tied.  Symbol 0
    separates texts: each occurrence counts as a symbol of its own, smaller
    than the words and ordered by place.  The last symbol must be 0."""
    n = len(symbols)
    first = np.where(symbols == 0, np.arange(n), symbols + n)
    order = np.argsort(first, kind="stable")
    sorted_first = first[order]
    starts = np.concatenate([[True], sorted_first[1:] != sorted_first[:-1]])
    head = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = head
    alone = starts & np.concatenate([starts[1:], [True]])
    tied = order[~alone]
    width = 1
    while len(tied):
        key = rank[tied] * n + rank[tied + width]
        by = np.argsort(key, kind="stable")
        tied, key = tied[by], key[by]
        group = key // n
        at = np.arange(len(tied))
        new_group = np.concatenate([[True], group[1:] != group[:-1]])
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        offset = np.maximum.accumulate(np.where(new_key, at, 0)) - np.maximum.accumulate(np.where(new_group, at, 0))
        rank[tied] = group + offset
        alone = new_key & np.concatenate([new_key[1:], [True]])
        tied = tied[~alone]
        width *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    return suffixes


class FMIndex:
    """Index of a sequence of texts over symbols 1..n_symbols-1, each text
    ended by a 0."""

    def __init__(self, symbols: np.ndarray, n_symbols: int, sample: int = 32):
        suffixes = suffix_order(symbols)
        before = symbols[suffixes - 1]  # the last 0 precedes the first symbol
        self.tree = WaveletTree(before, n_symbols)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=n_symbols))])
        # Sampled: regular places, and the starts of texts, where no walk goes on.
        kept = (suffixes % sample == 0) | (before == 0)
        self.sampled = BitRank(kept)
        self.places = suffixes[kept]
        self.length = len(symbols)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of equally long phrases (rows): index ranges."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.length, np.int64)
        alive = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, column]
            zero = self.tree.descend(symbol, np.zeros(len(alive), np.int64))
            low[alive] = self.less[symbol] + self.tree.descend(symbol, low[alive]) - zero
            high[alive] = self.less[symbol] + self.tree.descend(symbol, high[alive]) - zero
            empty = low[alive] >= high[alive]
            high[alive[empty]] = low[alive[empty]]
            alive = alive[~empty]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each index row, by walking to a sampled row."""
        place = np.empty(len(rows), np.int64)
        at, steps, todo = rows.copy(), 0, np.arange(len(rows))
        while len(todo):
            known = self.sampled.at(at).astype(bool)
            place[todo[known]] = self.places[self.sampled.ones(at[known])] + steps
            todo, at = todo[~known], at[~known]
            if len(todo):
                symbol, bottom = self.tree.step(at)
                at = self.less[symbol] + bottom - self.tree.descend(symbol, np.zeros(len(at), np.int64))
                steps += 1
        return place
