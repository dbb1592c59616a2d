"""Compressed FM-index of a shard of word sequences, queried for many windows at once."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with constant-time rank: packed words and a count for each of them."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros(len(bits) // 64 + 1, np.uint64)
        packed.view(np.uint8)[: (len(bits) + 7) // 8] = np.packbits(bits, bitorder="little")
        self.words = packed
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int32)[:-1])).astype(np.int32)
        self.zeros = int(len(bits) - bits.sum())

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        block = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)


class WaveletTree:
    """Rank of any symbol in a sequence, a level of bits for each bit of the symbols (levels as in a wavelet matrix)."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels: list[Bits] = []
        self.shifts = list(range(max(1, (symbols - 1).bit_length()) - 1, -1, -1))
        for shift in self.shifts:
            bit = (sequence >> shift & 1).astype(bool)
            self.levels.append(Bits(bit))
            sequence = np.concatenate((sequence[~bit], sequence[bit]))
        self.base = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, level in zip(self.shifts, self.levels, strict=True):
            one = level.ones(i)
            i = np.where(symbol >> shift & 1, level.zeros + one, i - one)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self._down(symbol, i) - self.base[symbol]


class FMIndex:
    """Backward search over concatenated rows of symbols.

    Suffixes are sorted by their first ``depth`` symbols, which is all that
    patterns of up to ``depth`` symbols need.
    """

    def __init__(self, values: np.ndarray, bounds: np.ndarray, labels: np.ndarray, depth: int):
        """``values``: the symbols of all rows; ``bounds``: where each row starts; ``labels``: a number for each row."""
        rows = len(bounds) - 1
        _, symbol = np.unique(values, return_inverse=True)
        place = np.arange(len(values)) + np.repeat(np.arange(rows), np.diff(bounds))
        text = np.ones(len(values) + rows + 1, np.int64)  # 1 ends a row, 0 the whole
        text[place] = symbol + 2
        text[-1] = 0
        self.symbols = int(text.max()) + 1
        self.text, self.place = text, place
        rank, have = text.copy(), 1
        while have < depth:
            follow = np.concatenate((rank[have:], np.zeros(min(have, len(rank)), np.int64)))[: len(rank)]
            _, rank = np.unique(rank * (int(rank.max()) + 1) + follow, return_inverse=True)
            have *= 2
        order = np.argsort(rank, kind="stable")
        owner = np.repeat(np.arange(rows), np.diff(bounds) + 1)
        label = np.concatenate((labels[owner], [np.iinfo(np.int64).max]))
        self.own = label
        self.label = np.concatenate((label[order], [np.iinfo(np.int64).max]))
        self.tree = WaveletTree(text[order - 1], self.symbols)
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=self.symbols))))

    def smallest_label(self, starts: np.ndarray, length: int) -> np.ndarray:
        """For each window of the indexed text, by its first unit: the least label of the rows that hold its ``length`` symbols.

        Windows are searched backwards together. One whose interval has shrunk to
        itself before the full length can't occur elsewhere and leaves the search.
        """
        at = self.place[starts]
        out = self.own[at]
        live = np.arange(len(at))
        symbol = self.text[at + length - 1]
        lo, hi = self.less[symbol], self.less[symbol + 1]
        for back in range(length - 2, -1, -1):
            more = hi - lo > 1
            live, lo, hi = live[more], lo[more], hi[more]
            if not len(live):
                return out
            symbol = self.text[at[live] + back]
            both = self.less[np.concatenate((symbol, symbol))] + self.tree.rank(np.concatenate((symbol, symbol)), np.concatenate((lo, hi)))
            lo, hi = both[: len(live)], both[len(live) :]
        first, which = np.unique(lo, return_inverse=True)
        last = np.zeros(len(first), np.int64)
        last[which] = hi
        out[live] = np.minimum.reduceat(self.label, np.stack((first, last), 1).ravel())[::2][which]
        return out
