"""A compressed FM-index in numpy: suffix order, wavelet matrix, matching statistics by backward search."""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    n, size = len(rank), 1
    while True:
        after = np.zeros(n, np.int64)
        after[:max(n - size, 0)] = rank[size:] + 1
        pair = rank * (n + 1) + after
        order = np.argsort(pair, kind="stable")
        step = np.concatenate(([0], np.cumsum(pair[order][1:] != pair[order][:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = step
        if n == 0 or step[-1] == n - 1:
            return order
        size *= 2


def common_prefixes(text: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """LCP of each suffix with the one before it in order; -1 at both ends (n + 1 values)."""
    n = len(sa)
    lcp = np.zeros(n + 1, np.int64)
    lcp[0] = lcp[n] = -1
    at = np.arange(1, n)
    a, b = sa[1:], sa[:-1]
    depth = 0
    while len(at):
        ok = (a + depth < n) & (b + depth < n)
        at, a, b = at[ok], a[ok], b[ok]
        same = text[a + depth] == text[b + depth]
        at, a, b = at[same], a[same], b[same]
        depth += 1
        lcp[at] = depth
    return lcp


class WaveletMatrix:
    """Counts of a symbol before a place, over packed bits."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.n = len(symbols)
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits, self.before, self.zeros = [], [], []
        s = symbols.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            bit = (s >> level & 1).astype(bool)
            padded = np.zeros((self.n // 64 + 1) * 64, bool)
            padded[:self.n] = bit
            word = np.packbits(padded, bitorder="little").view(np.uint64)
            count = np.bitwise_count(word).astype(np.int64)
            self.bits.append(word)
            self.before.append(np.concatenate(([0], np.cumsum(count)[:-1])))
            self.zeros.append(int(self.n - bit.sum()))
            s = np.concatenate((s[~bit], s[bit]))
        self.first = self._trace(np.arange(sigma), np.zeros(sigma, np.int64))

    def _trace(self, c: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k in range(self.levels):
            block = at >> 6
            rest = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.before[k][block] + np.bitwise_count(self.bits[k][block] & rest)
            one = (c >> (self.levels - 1 - k) & 1).astype(bool)
            at = np.where(one, self.zeros[k] + ones, at - ones)
        return at

    def count_before(self, c: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._trace(c, at) - self.first[c]


class FmIndex:
    """Index of several texts (symbols 1..sigma-1, concatenated with a 0 after each) with a value per text.

    Interval queries also tell the least value among the occurrences.
    """

    def __init__(self, symbols: np.ndarray, sigma: int, values: np.ndarray):
        n = self.n = len(symbols)
        ends = np.flatnonzero(symbols == 0)
        # each end sorts on its own, so that no common prefix crosses an end
        apart = symbols + len(ends)
        apart[ends] = np.arange(len(ends))
        sa = suffix_order(apart)
        lcp = self.lcp = common_prefixes(apart, sa)
        bwt = symbols[sa - 1]  # before the first place stands the last end
        self.wavelet = WaveletMatrix(bwt, sigma)
        self.smaller = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=sigma))))
        text = np.searchsorted(ends, sa)
        self.least = [values[text].astype(np.int32)]
        while 2 << (len(self.least) - 1) <= n:
            k = 1 << (len(self.least) - 1)
            self.least.append(np.minimum(self.least[-1][:-k], self.least[-1][k:]))
        self.left, self.right = self._parents(lcp, n)

    @staticmethod
    def _parents(lcp: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest places before and after with a smaller LCP."""
        left, right = np.zeros(n + 1, np.int64), np.full(n + 1, n, np.int64)
        order = np.argsort(lcp, kind="stable")
        values, cuts = np.unique(lcp[order], return_index=True)
        for v, lo, hi in zip(values[1:], cuts[1:], [*cuts[2:], n + 1]):
            at = order[lo:hi]
            small = np.flatnonzero(lcp < v)
            k = np.searchsorted(small, at)
            left[at], right[at] = small[k - 1], small[k]
        return left, right

    def least_value(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Least value in each nonempty interval."""
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), np.int32)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.least[k][lo[at]], self.least[k][hi[at] - (1 << k)])
        return out

    def extend(self, lo: np.ndarray, hi: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of c followed by what the intervals stand for."""
        both = self.wavelet.count_before(np.concatenate((c, c)), np.concatenate((lo, hi)))
        return self.smaller[c] + both[:len(c)], self.smaller[c] + both[len(c):]

    def matching_statistics(self, queries: np.ndarray, ends: np.ndarray, below: np.ndarray) -> np.ndarray:
        """For each place of the queries (concatenated; ``ends`` exclusive) the longest match from there
        that occurs in a text whose value is less than the query's ``below``.

        All queries go from right to left together: a step extends the match by one symbol
        backward or, if that occurs nowhere, shortens it to the parent interval.
        """
        out = np.zeros(len(queries), np.int64)
        firsts = np.concatenate(([0], ends[:-1]))
        at, stop = ends - 1, firsts
        lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), self.n, np.int64)
        depth = np.zeros(len(ends), np.int64)
        go = at >= stop
        at, stop, lo, hi, depth, below = (x[go] for x in (at, stop, lo, hi, depth, below))
        while len(at):
            new_lo, new_hi = self.extend(lo, hi, queries[at])
            ok = new_lo < new_hi
            ok[ok] = self.least_value(new_lo[ok], new_hi[ok]) < below[ok]
            lo, hi, depth = np.where(ok, new_lo, lo), np.where(ok, new_hi, hi), depth + ok
            out[at[ok]] = depth[ok]
            shrink = np.flatnonzero(~ok & (depth > 0))
            k = np.where(self.lcp[lo[shrink]] >= self.lcp[hi[shrink]], lo[shrink], hi[shrink])
            depth[shrink] = np.maximum(self.lcp[k], 0)
            lo[shrink], hi[shrink] = self.left[k], self.right[k]
            moved = np.ones(len(at), bool)
            moved[shrink] = False
            at = at - moved
            go = at >= stop
            if not go.all():
                at, stop, lo, hi, depth, below = (x[go] for x in (at, stop, lo, hi, depth, below))
        return out
