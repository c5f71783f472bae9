"""External induced sorting of suffixes with common prefixes, in numpy.

The text is an array of symbols in which 0 ends a segment; ends differ from each other, so
no common prefix crosses one.  As in induced sorting with recursion: the suffixes at local
minima (LMS) are sorted through their substrings' names, recursively; the others follow
from them in two passes.  A pass takes suffix tuples (place, common prefix with the one
before) from a priority queue by symbol, in order of arrival, and pushes the tuples of the
places before them; a pushed tuple's common prefix is one more than the least since the
last push to that symbol.  The queue keeps a bounded number of tuples in memory and the
rest in a private spill file that ends with the task.  Tuples are handled in arrays: all
that a symbol holds at a time is one round.
"""

from __future__ import annotations

import heapq
import tempfile
from bisect import bisect_right
from collections.abc import Callable

import numpy as np

from martlet.llm.fm_index import common_prefixes, suffix_order

IN_MEMORY = 1 << 22  # tuples a queue keeps
BASE = 1 << 21  # reduced texts up to this long are sorted directly
ROUND = 1 << 17
FAR = np.int32(np.iinfo(np.int32).max)

Emit = Callable[[np.ndarray, np.ndarray], None]


class DiskQueue:
    """Tuples by symbol, first in first out; the least (or greatest) symbol comes first."""

    def __init__(self, down: bool, in_memory: int):
        self.sign, self.most, self.held = (-1 if down else 1), in_memory, 0
        self.memory: dict[int, list[np.ndarray]] = {}
        self.disk: dict[int, list[tuple[int, int]]] = {}
        self.heap: list[int] = []
        self.spill = None

    def push(self, symbols: np.ndarray, tuples: np.ndarray) -> None:
        """``symbols`` ascending, a row of ``tuples`` (place, common prefix) for each."""
        cuts = np.flatnonzero(np.diff(symbols)) + 1
        for c, rows in zip(symbols[np.concatenate(([0], cuts))].tolist(), np.split(tuples, cuts)):
            if c not in self.memory and c not in self.disk:
                heapq.heappush(self.heap, self.sign * c)
            self.memory.setdefault(c, []).append(rows)
        self.held += len(tuples)
        if self.held > self.most:
            self._spill()

    def _spill(self) -> None:
        if self.spill is None:
            self.spill = tempfile.TemporaryFile()
        self.spill.seek(0, 2)
        for c, parts in self.memory.items():
            rows = np.concatenate(parts)
            self.disk.setdefault(c, []).append((self.spill.tell(), len(rows)))
            self.spill.write(rows.tobytes())
        self.memory, self.held = {}, 0

    def first(self) -> int | None:
        return self.sign * self.heap[0] if self.heap else None

    def take(self, c: int):
        """Arrays of the tuples that symbol ``c`` holds now, in order."""
        if self.heap and self.heap[0] == self.sign * c:
            heapq.heappop(self.heap)
        stored, parts = self.disk.pop(c, []), self.memory.pop(c, [])
        self.held -= sum(map(len, parts))
        for at, n in stored:
            for k in range(0, n, ROUND):
                self.spill.seek(at + 8 * k)
                m = min(ROUND, n - k)
                yield np.frombuffer(self.spill.read(8 * m), np.int32).reshape(-1, 2)
        if parts:
            rows = np.concatenate(parts)
            for k in range(0, len(rows), ROUND):
                yield rows[k:k + ROUND]

    def close(self) -> None:
        if self.spill is not None:
            self.spill.close()


class _Prefixes:
    """Common prefixes of pushed tuples from those of the tuples that pushed them."""

    def __init__(self, sigma: int):
        self.round = np.full(sigma, -1, np.int64)  # of the last push to a symbol
        self.rest = np.full(sigma, FAR, np.int32)  # least in that round after the push
        self.now = 0
        self.rounds: list[int] = []  # rounds whose least is below all later ones, and these leasts
        self.leasts: list[int] = []

    def of(self, lcp: np.ndarray, at: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """For items ``at`` of a round, ordered by (symbol, place in the round)."""
        out = np.empty(len(at), np.int32)
        if len(at):
            table = [lcp]
            while 2 << (len(table) - 1) <= len(lcp):
                k = 1 << (len(table) - 1)
                table.append(np.minimum(table[-1][:-k], table[-1][k:]))
            new = np.ones(len(at), bool)
            new[1:] = symbols[1:] != symbols[:-1]
            lo = np.zeros(len(at), np.int64)
            lo[1:] = np.where(new[1:], 0, at[:-1] + 1)
            level = np.frexp((at + 1 - lo).astype(np.float64))[1] - 1
            for k in np.unique(level):
                i = np.flatnonzero(level == k)
                out[i] = np.minimum(table[k][lo[i]], table[k][at[i] + 1 - (1 << int(k))])
            out += 1
            firsts = np.flatnonzero(new)
            for i, c in zip(firsts.tolist(), symbols[firsts].tolist()):
                if self.round[c] < 0:
                    out[i] = 0
                else:
                    k = bisect_right(self.rounds, self.round[c])
                    since = min(int(self.rest[c]), self.leasts[k] if k < len(self.leasts) else int(FAR))
                    out[i] = min(int(out[i]), since + 1) if since < FAR else out[i]
            lasts = np.append(firsts[1:], len(at)) - 1
            tail = np.append(np.minimum.accumulate(lcp[::-1])[::-1], FAR)
            self.round[symbols[lasts]] = self.now
            self.rest[symbols[lasts]] = tail[at[lasts] + 1]
        least = int(lcp.min())
        while self.leasts and self.leasts[-1] >= least:
            self.leasts.pop()
            self.rounds.pop()
        self.leasts.append(least)
        self.rounds.append(self.now)
        self.now += 1
        return out


def _direct(text: np.ndarray, a: int, b: int) -> int:
    """Common prefix of two suffixes, by comparing."""
    n, step = 0, 64
    while True:
        x, y = text[a + n:a + n + step], text[b + n:b + n + step]
        m = min(len(x), len(y))
        stop = np.flatnonzero((x[:m] != y[:m]) | (x[:m] == 0))
        if len(stop):
            return n + int(stop[0])
        if m < step:
            return n + m
        n += m


def _induce(text: np.ndarray, sigma: int, seeds: np.ndarray, lcps: np.ndarray, emit: Emit, in_memory: int) -> None:
    """Emit all suffixes but the ends, from the greatest down, with the common prefix with the next greater.

    ``seeds``: the ends, then the LMS suffixes in order with common prefixes ``lcps``.
    """
    falling = DiskQueue(False, in_memory)  # L suffixes to come
    fallen = DiskQueue(True, in_memory)  # L suffixes in order, for the second pass
    rising = DiskQueue(True, in_memory)  # S suffixes to come
    try:
        prefixes = _Prefixes(sigma)

        def scan(queue: DiskQueue, places: np.ndarray, lcp: np.ndarray, keep: np.ndarray, before: np.ndarray) -> None:
            at = np.flatnonzero(keep)
            s = before[at]
            order = np.argsort(s, kind="stable")
            at, s = at[order], s[order]
            found = prefixes.of(lcp, at, s)
            if len(at):
                queue.push(s, np.column_stack((places[at] - 1, found)).astype(np.int32))

        heads = text[seeds]
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(heads)) + 1, [len(seeds)]))
        groups = {int(heads[a]): (a, b) for a, b in zip(cuts[:-1], cuts[1:])}
        waiting = sorted(groups, reverse=True)
        while waiting or falling.heap:
            c = min([x for x in (waiting[-1] if waiting else None, falling.first()) if x is not None])
            last = None
            while falling.first() == c:
                for rows in falling.take(c):
                    places, lcp = rows[:, 0].astype(np.int64), rows[:, 1]
                    fallen.push(np.full(len(rows), c), rows)
                    before = text[places - 1]
                    scan(falling, places, lcp, before >= c, before)
                    last = int(places[-1])
            if waiting and waiting[-1] == c:
                waiting.pop()
                lo, hi = groups[c]
                for k in range(lo, hi, ROUND):
                    places = seeds[k:min(k + ROUND, hi)]
                    lcp = lcps[k:min(k + ROUND, hi)].astype(np.int32)
                    if k == lo:
                        lcp[0] = 0 if last is None else _direct(text, last, int(places[0]))
                    before = text[places - 1]
                    scan(falling, places, lcp, before > c, before)

        prefixes = _Prefixes(sigma)
        while fallen.heap or rising.heap:
            c = max([x for x in (fallen.first(), rising.first()) if x is not None])
            last = None
            while rising.first() == c:
                for rows in rising.take(c):
                    places, lcp = rows[:, 0].astype(np.int64), rows[:, 1]
                    emit(places, lcp)
                    before = text[places - 1]
                    scan(rising, places, lcp, (before <= c) & (before > 0), before)
                    last = int(places[-1])
            if fallen.first() == c:
                parts = list(fallen.take(c))
                nxt = 0 if last is None else _direct(text, last, int(parts[-1][-1, 0]))
                for rows in reversed(parts):
                    places = rows[::-1, 0].astype(np.int64)
                    lcp = np.concatenate(([nxt], rows[:0:-1, 1])).astype(np.int32)
                    nxt = int(rows[0, 1])
                    emit(places, lcp)
                    before = text[places - 1]
                    scan(rising, places, lcp, (before < c) & (before > 0), before)
    finally:
        for q in (falling, fallen, rising):
            q.close()


class _Kept:
    """Collects emitted suffixes of a kind and the common prefixes between them."""

    def __init__(self, wanted: np.ndarray | None):
        self.wanted, self.places, self.lcps, self.carry = wanted, [], [], int(FAR)

    def __call__(self, places: np.ndarray, lcp: np.ndarray) -> None:
        if self.wanted is not None:
            at = np.flatnonzero(self.wanted[places])
            if not len(at):
                self.carry = min(self.carry, int(lcp.min()))
                return
            starts = np.concatenate(([0], at[:-1] + 1))
            low = np.minimum.reduceat(lcp[:at[-1] + 1], starts)
            low[0] = min(int(low[0]), self.carry)
            rest = lcp[at[-1] + 1:]
            self.carry = int(rest.min()) if len(rest) else int(FAR)
            places, lcp = places[at], low
        self.places.append(places)
        self.lcps.append(lcp)

    def ascending(self) -> tuple[np.ndarray, np.ndarray]:
        """Places in ascending order and the common prefix of each with the one before."""
        if not self.places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        places, down = np.concatenate(self.places)[::-1], np.concatenate(self.lcps)[::-1]
        return places, np.concatenate(([0], down[:-1])).astype(np.int64)


def _order_reduced(names: np.ndarray, base: int, in_memory: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes of the reduced text but its ends, and their common prefixes in names."""
    if len(names) > base:
        kept = _Kept(None)
        sort_suffixes(names, int(names.max()) + 1, kept, base, in_memory)
        return kept.ascending()
    ends = np.flatnonzero(names == 0)
    apart = names + len(ends)
    apart[ends] = np.arange(len(ends))
    sa = suffix_order(apart)
    lcp = common_prefixes(apart, sa)[:-1]
    lcp[:1] = 0
    return sa[len(ends):], lcp[len(ends):]


def sort_suffixes(text: np.ndarray, sigma: int, emit: Emit, base: int = BASE, in_memory: int = IN_MEMORY) -> None:
    """Emit (places, common prefixes with the next greater) of the suffixes of ``text``, greatest first.

    ``text`` starts and ends with 0; suffixes that start with 0 are not emitted.
    """
    n = len(text)
    text = text.astype(np.int64)
    change = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)  # last place of each run
    run_end = np.repeat(change, np.diff(np.concatenate(([-1], change))))
    after = np.append(text, 0)[run_end + 1]
    rises = (after > text) | (text == 0)  # S; of a run, as its end
    lms = np.zeros(n, bool)
    lms[1:] = rises[1:] & ~rises[:-1]
    ends = np.flatnonzero(text == 0)
    lms[ends] = False
    low = np.flatnonzero(lms)

    # name the substrings from a minimum to the next
    length_of_run = run_end[low] - low + 1
    order = np.lexsort((-length_of_run, text[low]))
    seeds, runs = low[order], length_of_run[order]
    lcp = np.zeros(len(seeds), np.int64)
    same = text[seeds[1:]] == text[seeds[:-1]]
    lcp[1:] = np.where(same, np.minimum(runs[1:], runs[:-1]), 0)
    named = _Kept(lms)
    none = np.zeros(len(ends), np.int64)
    _induce(text, sigma, np.concatenate((ends, seeds)), np.concatenate((none, lcp)), named, in_memory)
    places, between = named.ascending()

    stops = np.flatnonzero(lms | (text == 0))  # minima and ends in order of place
    number = np.full(n, -1, np.int64)
    number[stops] = np.arange(len(stops))
    length = np.zeros(n, np.int64)
    length[stops[:-1]] = np.diff(stops) + 1
    new = np.ones(len(places), bool)
    if len(places) > 1:
        size = length[places]
        new[1:] = (size[1:] != size[:-1]) | (between[1:] < size[1:])
    name = np.cumsum(new)
    size = length[places]
    # common prefix of neighbouring names up to where a type differs, which the last symbol of the shorter may
    typed = between.copy()
    typed[1:] = np.minimum(between[1:], np.minimum(size[1:], size[:-1]) - 1)

    def to_symbols(x: np.ndarray, y: np.ndarray, same: np.ndarray) -> np.ndarray:
        """Common prefix of suffixes x and y from that of their types: equal symbols of different types end runs."""
        p, q = x + same, y + same
        alike = (text[p] == text[q]) & (text[p] > 0)
        return same + np.where(alike, np.minimum(run_end[p] - p, run_end[q] - q) + 1, 0)

    if len(places) and name[-1] < len(places):
        names = np.zeros(len(stops), np.int64)
        names[number[places]] = name
        reduced, equal = _order_reduced(names, base, in_memory)
        # the equal names, then the first two different ones
        table = [typed[new]]  # of name k + 1 with name k
        while 2 << (len(table) - 1) <= len(table[0]):
            k = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-k], table[-1][k:]))
        a, b = reduced[:-1] + equal[1:], reduced[1:] + equal[1:]
        x, y = np.minimum(names[a], names[b]), np.maximum(names[a], names[b])
        more = np.zeros(len(a), np.int64)
        ok = np.flatnonzero(x > 0)
        level = np.frexp((y[ok] - x[ok]).astype(np.float64))[1] - 1
        for k in np.unique(level):
            i = ok[level == k]
            more[i] = np.minimum(table[k][x[i]], table[k][y[i] - (1 << int(k))])
        places = stops[reduced]
        between = np.concatenate(([0], stops[b] - places[1:] + to_symbols(stops[a], stops[b], more)))
    elif len(places):
        between = np.concatenate(([0], to_symbols(places[:-1], places[1:], typed[1:])))
    _induce(text, sigma, np.concatenate((ends, places)), np.concatenate((none, between)), emit, in_memory)
