"""Operator 11: periodic runs of words, by a suffix automaton with link-cut access.

A run is a stretch of consecutive words whose smallest period is q (words q apart are the
same), at least ``max(6, 4 * q)`` words long, that no neighbouring word extends with period q.

The words of a stretch are put into a suffix automaton.  Then they are appended once more,
one at a time: the automaton's states on the path from the new prefix to the root are the
prefix's suffixes, and the access recolours that path with the new end.  A path segment
with one old colour holds the suffixes last seen to end there.  If the distance of the two
ends is no more than the segment's greatest length, the words of that distance stand twice
in a row: a square, whose root is primitive because the colour is the last occurrence.
The segment's length also tells how far the period goes back, so squares of one period at
consecutive ends make one run.  The link tree does not change any more, so its preferred
paths are kept on heavy paths, as stacks of (colour, greatest length): an access touches
few paths, and every segment it takes off was put on once.

Before that an exact sieve leaves out what cannot be in a run: in a run any four words in a
row stand there again, so stretches in which each four words in a row occur twice, inside
the same stretch, hold all runs whole.

Null and empty texts have no words and no runs.  Repeated rows are answered alike.  Texts of
any length are taken whole; memory follows the longest text of a task.  A null doc_id is
answered like any other; the test rewriting of the query leaves its text as it is.  Other
columns are not read.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm.common import read_table, text_or_empty
from martlet.llm.texts import chunks, mix, word_hashes, words

LEAST_WORDS, LEAST_TIMES = 6, 4
GRAM = 4  # every four words in a row of a run stand in it twice
HASHED_WORDS = 1 << 17  # words hashed together

#: doc_id and number of words -> which original word stands at each place (None: as they are)
Rewrite = Callable[[int | None, int], np.ndarray | None]


class Automaton:
    """Suffix automaton of a sequence of small numbers; a state's first transition is kept in arrays."""

    def __init__(self, seq: Sequence[int]):
        room = 2 * len(seq) + 1
        self.length = length = array("i", bytes(4 * room))
        self.link = link = array("i", [-1]) * room
        symbol, target = array("i", [-1]) * room, array("i", bytes(4 * room))
        others: dict[int, dict[int, int]] = {}
        self.prefix = prefix = array("i", bytes(4 * len(seq)))
        size, last = 1, 0
        for i, c in enumerate(seq):
            new, size = size, size + 1
            length[new] = i + 1
            p, q = last, -1
            while p != -1:
                if symbol[p] == c:
                    q = target[p]
                    break
                if symbol[p] == -1:
                    symbol[p], target[p] = c, new
                else:
                    more = others.get(p)
                    if more is None:
                        others[p] = {c: new}
                    elif c in more:
                        q = more[c]
                        break
                    else:
                        more[c] = new
                p = link[p]
            if p == -1:
                link[new] = 0
            elif length[q] == length[p] + 1:
                link[new] = q
            else:
                copy, size = size, size + 1
                length[copy], link[copy] = length[p] + 1, link[q]
                symbol[copy], target[copy] = symbol[q], target[q]
                if q in others:
                    others[copy] = dict(others[q])
                while p != -1:
                    if symbol[p] == c:
                        if target[p] != q:
                            break
                        target[p] = copy
                    else:
                        more = others.get(p)
                        if more is None or more.get(c) != q:
                            break
                        more[c] = copy
                    p = link[p]
                link[q] = link[new] = copy
            prefix[i] = last = new
        self.size = size

    def heads(self) -> array:
        """The shortest state of each state's heavy path in the link tree."""
        link = self.link
        order = np.argsort(np.frombuffer(self.length, np.int32)[:self.size], kind="stable")[1:].tolist()
        weight, heavy = array("i", [1]) * self.size, array("i", [-1]) * self.size
        for v in reversed(order):
            p = link[v]
            weight[p] += weight[v]
            if heavy[p] == -1 or weight[heavy[p]] < weight[v]:
                heavy[p] = v
        head = array("i", range(self.size))
        for v in order:
            if heavy[link[v]] == v:
                head[v] = head[link[v]]
        return head


def runs_of_sequence(seq: Sequence[int], least_words: int = LEAST_WORDS,
                     least_times: int = LEAST_TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs, sorted."""
    tree = Automaton(seq)
    head, length, link, prefix = tree.heads(), tree.length, tree.link, tree.prefix
    # on each heavy path: (end, greatest length), the shortest suffixes last
    stacks: dict[int, list[tuple[int, int]]] = {}
    open_runs: dict[int, list[int]] = {}  # period -> start, last end
    found: list[tuple[int, int, int]] = []

    def close(period: int, start: int, end: int) -> None:
        if end - start + 1 >= max(least_words, least_times * period):
            found.append((start, end - start + 1, period))

    for i in range(len(seq)):
        v = prefix[i]
        while v > 0:
            top, reach = head[v], length[v]
            stack = stacks.get(top)
            if stack is None:
                stacks[top] = [(i, reach)]
            else:
                covered = 0
                while covered < reach and stack:
                    end, longest = stack[-1]
                    if longest <= reach:
                        stack.pop()
                    covered = min(longest, reach)
                    period = i - end
                    if period <= covered:
                        run = open_runs.get(period)
                        if run is None:
                            open_runs[period] = [i - period - covered + 1, i]
                        elif run[1] == i - 1:
                            run[1] = i
                        elif run[1] < i:  # not seen on a deeper path of this access
                            close(period, *run)
                            run[:] = i - period - covered + 1, i
                stack.append((i, reach))
            v = link[top]
    for period, run in open_runs.items():
        close(period, *run)
    return sorted(found)


def stretches(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(from, to) of the stretches of words that can hold runs; ``first`` cuts the documents apart."""
    lo, hi = first[:-1].astype(np.int64), first[1:].astype(np.int64)
    if len(h) < LEAST_WORDS:
        return lo[:0], hi[:0]
    pair = mix(h[:-1] * np.uint64(3) + h[1:])
    gram = mix(pair[:-2] * np.uint64(5) + pair[2:])
    before = -1
    while True:
        keep = hi - lo >= LEAST_WORDS
        lo, hi = lo[keep], hi[keep]
        grams = hi - lo - GRAM + 1
        total = int(grams.sum())
        if total == before or not total:
            return lo, hi
        before = total
        ahead = np.cumsum(grams) - grams
        of = np.repeat(np.arange(len(lo)), grams)
        at = np.arange(total) - ahead[of] + lo[of]
        name = gram[at] ^ mix(of.astype(np.uint64) + np.uint64(1))
        order = np.argsort(name)
        same = name[order[1:]] == name[order[:-1]]
        twice = np.zeros(total, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        # consecutive places of such grams make the next stretches
        kept = np.flatnonzero(twice)
        if not len(kept):
            return lo[:0], hi[:0]
        at, of = at[kept], of[kept]
        new = np.ones(len(kept), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (of[1:] != of[:-1])
        begin = np.flatnonzero(new)
        stop = np.append(begin[1:], len(kept)) - 1
        lo, hi = at[begin], at[stop] + GRAM


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    parts = [word_hashes(data, starts[k:k + HASHED_WORDS], ends[k:k + HASHED_WORDS])
             for k in range(0, len(starts), HASHED_WORDS)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _scan(rewrite: Rewrite | None):
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, data, offsets in chunks(b.column(1)):
                starts, ends, first = words(data, offsets)
                ids = b.column(0).slice(rows.start, len(offsets) - 1)
                source = np.arange(len(starts))
                if rewrite is not None:
                    for d, doc in enumerate(ids.to_pylist()):
                        moved = rewrite(doc, int(first[d + 1] - first[d]))
                        if moved is not None:
                            source[first[d]:first[d + 1]] = first[d] + moved
                body = data.tobytes()
                found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(ids))]
                for lo, hi in zip(*(x.tolist() for x in stretches(_hashes(data, starts, ends)[source], first))):
                    at = source[lo:hi]
                    numbers: dict[bytes, int] = {}
                    seq = [numbers.setdefault(body[x:y], len(numbers))
                           for x, y in zip(starts[at].tolist(), ends[at].tolist())]
                    d = int(np.searchsorted(first, lo, "right")) - 1
                    shift = lo - int(first[d])
                    found[d] += [(s + shift, n, q) for s, n, q in runs_of_sequence(seq)]
                left = np.ones(len(source), bool)
                for d, runs in enumerate(found):
                    runs.sort(key=lambda r: (r[0], r[2]))
                    for s, n, q in runs:
                        left[first[d] + s + q:first[d] + s + n] = False
                texts = []
                for d in range(len(ids)):
                    at = source[first[d]:first[d + 1]][left[first[d]:first[d + 1]]]
                    texts.append(b" ".join([body[x:y] for x, y in zip(starts[at].tolist(), ends[at].tolist())]))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.diff(first).astype(np.int64)),
                     pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in found], pa.list_(run)),
                     pa.array([t.decode() for t in texts], pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])
    return task


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", rewrite: Rewrite | None = None) -> DataFrame:
    """A row per document: doc_id, n_words, runs (array of start, length, period; by start, then period), collapsed.

    ``collapsed`` is the text without the words that a run repeats after its first period, words
    joined by one space.  No shuffle: each task works on the rows it reads.
    """
    rows = docs.select(F.col(key).alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(_scan(rewrite), (
        f"doc_id {dict(rows.dtypes)['doc_id']}, n_words long, "
        "runs array<struct<start:long,length:long,period:long>>, collapsed string"))


def planted_period(doc: int | None, n: int) -> np.ndarray | None:
    """The test rewriting that the query applies: a tenth of the documents become periodic from a place on."""
    h = None if doc is None else zlib.crc32(str(doc).encode())
    if h is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(read_table(spark, sf_dir, "documents"), rewrite=planted_period)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("short"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("top", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.before")).alias("start"), F.col("top.length").alias("length"), (-F.col("top.short")).alias("period"),
        F.expr("1000 * top.length div -top.short").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
