"""Suffix order of string collections, and two compressed indexes over it: run-length and wavelet-tree.

Collections are integer symbols in which each string ends with 0; terminators count as different from each other, in
the order of the strings. A string may be given as occurring twice: its copy stands in the transform (next to it, in each
row), though it is sorted only once. Texts are streamed through an index in lockstep, so that one step of all of them is a
few operations on whole arrays.
"""

from __future__ import annotations

import numpy as np


class Suffixes:
    """Suffix array by prefix doubling, and longest common prefixes of chosen neighbours."""

    def __init__(self, symbols: np.ndarray):
        codes = np.bincount(symbols) > 0  # only symbols in use need bits
        codes[0] = True
        self.symbols = symbols = (np.cumsum(codes) - 1)[symbols]
        n, bits, per = len(symbols), max(1, (int(codes.sum()) - 1).bit_length()), 1
        key, ended = symbols.copy(), symbols == 0
        while 2 * per * bits <= 62:  # keys of 1, 2, 4, ... symbols; nothing counts behind a terminator
            ahead, after = np.zeros(n, np.int64), np.ones(n, bool)
            ahead[: max(0, n - per)], after[: max(0, n - per)] = key[per:], ended[per:]
            ahead[ended] = 0
            key, ended, per = key << per * bits | ahead, ended | after, 2 * per
        self.key, self.ended, self.per = key, ended, per
        order = np.argsort(key).astype(np.int32)
        slots = np.flatnonzero(self.ended[order])
        held = order[slots]
        order[slots] = held[np.lexsort((held, key[held]))]
        sorted_key = key[order]
        new = np.ones(n, bool)
        new[1:] = (sorted_key[1:] != sorted_key[:-1]) | self.ended[order[1:]]
        rank = np.empty(n, np.int32)
        head = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), np.int32(0)))
        rank[order] = head
        slots, width = np.arange(n, dtype=np.int32), per
        while True:
            last = np.ones(len(slots), bool)
            last[:-1] = new[1:]
            tied = ~(new & last)
            slots = slots[tied]
            if not len(slots):
                break
            held = order[slots]
            pair = rank[held].astype(np.int64) << 32 | rank[held + width]
            turn = np.argsort(pair)
            pair, held = pair[turn], held[turn]
            order[slots] = held
            new = np.ones(len(slots), bool)
            new[1:] = pair[1:] != pair[:-1]
            rank[held] = np.maximum.accumulate(np.where(new, slots, np.int32(0)))
            width *= 2
        self.order = order

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of suffixes at a and b (different places)."""
        length = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live] + length[live], b[live] + length[live]
            live = live[(self.key[x] == self.key[y]) & ~self.ended[x]]
            length[live] += self.per
        live = np.arange(len(a))
        for _ in range(self.per):
            x = self.symbols[a[live] + length[live]]
            live = live[(x == self.symbols[b[live] + length[live]]) & (x != 0)]
            length[live] += 1
        return length

    def rows(self, twice: np.ndarray | None) -> np.ndarray:
        """The position at which each row's suffix starts; rows of strings that occur twice stand there twice."""
        if twice is None or not twice.any():
            return self.order
        ends = self.symbols == 0
        text = np.cumsum(ends) - ends
        return np.repeat(self.order, 1 + twice[text[self.order]])


def string_ends(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first position, position of the terminator) of each string."""
    end = np.flatnonzero(np.asarray(symbols) == 0)
    return np.r_[0, end[:-1] + 1].astype(np.int64), end


ALL_BITS = np.uint64(0xFFFFFFFFFFFFFFFF)


def counted_bits(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of 64 bits, the first the lowest, and how many are set before each word."""
    packed = np.zeros(((len(bits) >> 6) + 1) * 64, np.uint8)
    packed[: len(bits)] = bits
    words = np.packbits(packed, bitorder="little").view(np.uint64)
    return words, (np.cumsum(np.bitwise_count(words), dtype=np.int64) - np.bitwise_count(words)).astype(np.int32)


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform with match lengths sampled at run ends; the suffix array is not kept.

    Of each run there are its first row (in a bit vector with counts, which tells the run of a row), the row to which the
    last-to-first mapping takes that row, and the common prefixes of its first row with the row above and of its last row
    with the row below.
    """

    def __init__(self, symbols: np.ndarray, twice: np.ndarray | None = None):
        s = Suffixes(symbols)
        symbols, rows = s.symbols, s.rows(twice)
        start, end = string_ends(symbols)
        n, bwt = len(rows), symbols[rows - 1]
        first = np.ones(n, bool)
        first[1:] = (bwt[1:] != bwt[:-1]) | (bwt[1:] == 0)
        heads = np.flatnonzero(first)
        self.marks, self.before = counted_bits(first)
        length, symbol = np.diff(np.r_[heads, n]), bwt[heads]
        # Runs by symbol and then by place: what stands before a run in this order is where its first row is mapped to.
        order = np.argsort(symbol, kind="stable")
        mapped = np.empty(len(heads), np.int64)
        mapped[order] = np.cumsum(length[order]) - length[order]
        self.shift = (mapped - heads).astype(np.int32)
        self.first_row = np.r_[heads, n].astype(np.int32)
        above, below = rows[heads[1:] - 1], rows[heads[1:]]
        match = np.zeros(len(heads) + 1, np.int32)
        other = np.flatnonzero(above != below)
        match[1 + other] = s.common(above[other], below[other])
        copy = np.flatnonzero(above == below)  # the copy of a string: it matches to the end
        match[1 + copy] = end[np.searchsorted(end, below[copy])] - below[copy]
        self.match = match  # of each run's first row with the row above; one place on, of its last row with the row below
        weight = np.ones(len(end), np.int64) if twice is None else 1 + twice
        self.start, self.end, self.end_row = start, end, (np.cumsum(weight) - weight).astype(np.int32)

    def run_of(self, row: np.ndarray) -> np.ndarray:
        block = row >> 6
        return self.before[block] + np.bitwise_count(self.marks[block] & (ALL_BITS >> (63 - (row & 63)).astype(np.uint64))) - 1

    def statistics(self) -> np.ndarray:
        """For each position of each string the length of the longest match that starts there and at another place too.

        All strings are streamed from their ends to their starts by last-to-first steps over the runs. A suffix whose row is
        the first (last) of its run has its match with the row above (below) among the samples; any other row has the same
        symbol before it as its neighbour, so that its match is one shorter than the match one position earlier.
        """
        n = int(self.end[-1]) + 1 if len(self.end) else 0
        above, below = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
        lanes = np.argsort(self.start - self.end, kind="stable")  # longest first: those still under way are a prefix
        row, place, length = self.end_row[lanes], self.end[lanes], (self.end - self.start)[lanes]
        under_way = np.searchsorted(-length, -np.arange(int(length[0]) + 1), "right").tolist() if len(lanes) else []
        for live in under_way:
            row, place = row[:live], place[:live]
            run = self.run_of(row)
            above[place] = np.where(row == self.first_row[run], self.match[run], -1)
            run += 1
            below[place] = np.where(row + 1 == self.first_row[run], self.match[run], -1)
            run -= 1
            row = row + self.shift[run]
            place = place - 1
        at = np.arange(n)
        # The end of the match that the last sample before each position began.
        best = np.zeros(n, np.int64)
        for known in (above, below):
            last = np.maximum.accumulate(np.where(known >= 0, at, 0))
            np.maximum(best, last + known[last] - at, out=best)
        return best


class WaveletIndex:
    """FM-index: the transform in a wavelet tree (levels as one bit vector each, with block counts), searched backward."""

    def __init__(self, symbols: np.ndarray, twice: np.ndarray | None = None):
        row = np.asarray(symbols)[Suffixes(symbols).rows(twice) - 1]
        self.n, self.levels = len(row), max(1, int(row.max(initial=1)).bit_length())
        counts = np.bincount(row)
        self.before = np.r_[0, np.cumsum(counts)]
        self.words, self.blocks, self.zeros = [], [], []
        origin = np.zeros(len(counts), np.int64)
        for level in range(self.levels - 1, -1, -1):
            bit = row >> level & 1
            words, blocks = counted_bits(bit)
            self.words.append(words)
            self.blocks.append(blocks)
            self.zeros.append(int(self.n - bit.sum()))
            row = np.concatenate([row[bit == 0], row[bit == 1]])
        self.origin = self._down(np.arange(len(counts)), origin)

    def _down(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            block = place >> 6
            ones = self.blocks[i][block] + np.bitwise_count(self.words[i][block] & ((np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)))
            place = np.where(symbol >> level & 1 == 1, self.zeros[i] + ones, place - ones)
        return place

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that start with the symbol and then with what rows low..high-1 start with."""
        base = self.before[symbol] - self.origin[symbol]
        both = self._down(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return base + both[: len(symbol)], base + both[len(symbol) :]

    def matches(self, symbols: np.ndarray, start: np.ndarray, end: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
        """(first, after, rows) of the matches of at least ``width`` symbols that have two rows or more.

        Documents start..end-1 are streamed backward. Of each end that is looked at the longest match is found (its
        matching statistic): the interval of rows is narrowed symbol by symbol as long as it has two. Ends within a reported
        match that leave no window beyond it are passed over.
        """
        found: list[tuple[np.ndarray, ...]] = []
        right = end - 1
        lane = np.flatnonzero(right - width + 1 >= start)
        at, low, high = right.copy(), np.zeros(len(start), np.int64), np.full(len(start), self.n, np.int64)
        while len(lane):
            a, b = self.extend(symbols[at[lane]], low[lane], high[lane])
            on = b - a >= 2
            longer = lane[on]
            low[longer], high[longer] = a[on], b[on]
            at[longer] -= 1
            # A match ends where one more symbol is met once only, or at the document's start.
            over = lane[~on | (at[lane] < start[lane])]
            if len(over):
                enough = over[right[over] - at[over] >= width]
                found.append((at[enough] + 1, right[enough] + 1, (high - low)[enough]))
                right[over] = np.minimum(right[over] - 1, at[over] + width - 1)
                at[over], low[over], high[over] = right[over], 0, self.n
                lane = lane[right[lane] - width + 1 >= start[lane]]
        if not found:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))
