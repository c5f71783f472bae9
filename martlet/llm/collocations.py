"""Operator 13: phrase collocations from weighted acyclic automata of n-gram counts.

A count transducer is an acyclic automaton over words whose paths are n-grams; the weight of
a path's last state is how often the n-gram stands in the corpus.

1. *Shards.*  A task gives each run of texts of one language a transducer of the paths of two words
   and more.  Only paths that go no further carry their count; a state's weight is the sum of
   the weights behind it.
2. *Union.*  The shards' paths are dealt to blocks by their first two words, sorted and packed
   there, one row per shard and block.  In a block the paths of all shards meet; they are cut where they can
   not reach ``least`` and added in sorted order, which keeps only the path that was added
   last: a state that is left will never change, so its weight is final and goes up to the state before it.
   The paths of very common pairs are dealt by the third word too; the counts of such a pair are
   summed after.
3. *Part lookups.*  The counted phrases are composed with the transducer itself.  In sorted
   order, a phrase's left parts are the states on the path to it; in the order of the reversed
   phrases, its right parts are.  The same walk tells whether a phrase one word longer has
   the same count.

A phrase can only reach ``least`` if its words do.  Words are counted first, exactly; the hashes of those that
reach ``least`` make a bitmap of ``2 ** filter_bits`` bits, of that size whatever the input.  Equal words
have equal hashes and chance matches only let more through, so no phrase is lost.  Word pairs are not
filtered before: how much such a filter leaves depends on the size of the corpus, and what it leaves grows faster than that.
Every occurrence of a word is the start of one path at most.

Null languages count as ``und``, null and empty texts have no words.  Repeated rows count again.
Texts of any length are taken whole.  An empty table has no phrases.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlet.llm.common import partitions, read_table, stored, text_or_empty
from martlet.llm.texts import buffers, chunks, mix, word_hashes

LEAST = 100          # fixed value of the contract: occurrences of a candidate
MOST_WORDS = 5
TOP = 2000
SHARD_BYTES = 1 << 23
HELD_BYTES = 1 << 25  # texts of all languages that wait for more
FILTER_BITS = 24
OUT_ROWS = 20_000
OUT_BYTES = 1 << 22
BLOCK_WORDS = 4_000_000  # words of the corpus per block of paths
# Common pairs are looked for among one pair of so many, to deal their paths evenly.  No count is made of it.
ONE_OF = 16
LEAST_SEEN, COMMON = 16, 1024

_KIND = np.zeros(256, np.uint8)      # 0 word, 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


class Filter:
    """Bitmap over hashes of phrases."""

    def __init__(self, bits: int, body: np.ndarray):
        self.mask, self.body = np.uint64((1 << bits) - 1), body

    def __call__(self, h: np.ndarray) -> np.ndarray:
        at = (h & self.mask).astype(np.int64)
        return (self.body[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _lang_number(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))


def _pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(3) + right)


class Shard:
    """Words of a run of texts: their numbers, pieces and dictionary."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lang: str):
        data = _LOWER[data]
        kind = _KIND[data]
        word = kind == 0
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1] | cut[1:-1]
        last[:-1] &= ~word[1:] | cut[1:-1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        # breaks and documents before a word: equal only inside one piece
        breaks = np.cumsum(kind == 2, dtype=np.int32)
        self.piece = breaks[starts] + np.searchsorted(offsets, starts, "right") if len(starts) else starts
        places = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
        column = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data[word].tobytes())])
        coded = column.dictionary_encode()
        self.ids = coded.indices.to_numpy().astype(np.int64)
        self.words = coded.dictionary
        body, off = buffers(self.words)
        self.hashes = word_hashes(body, off[:-1], off[1:]) ^ _lang_number(lang)

    def word_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """(hash, count) of the words."""
        return self.hashes, np.bincount(self.ids, minlength=len(self.words))

    def common_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(hash, estimated count) of the pairs that are a noticeable share of the shard."""
        at = np.flatnonzero(self.piece[1:] == self.piece[:-1])[::ONE_OF]
        pairs, counts = np.unique(self.ids[at] * len(self.words) + self.ids[at + 1], return_counts=True)
        common = counts >= max(LEAST_SEEN, len(at) // COMMON)
        left, right = np.divmod(pairs[common], max(len(self.words), 1))
        return _pair_hash(self.hashes[left], self.hashes[right]), counts[common] * ONE_OF

    def paths(self, depth: int, words: Filter) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known words, distinct paths, counts): sorted paths of two words and more that go no further.

        A path is a column of ``depth`` places in the known words, from 1; 0 is after its end.
        The most frequent words come first, as small numbers pack better.
        """
        known = np.flatnonzero(words(self.hashes))
        names = known[np.argsort(-np.bincount(self.ids, minlength=len(self.words))[known], kind="stable")]
        place = np.zeros(len(self.words), np.int64)
        place[names] = np.arange(1, len(names) + 1)
        end = np.zeros(depth, np.int64)
        code = np.concatenate((place[self.ids], end))
        on = np.concatenate(((self.piece[1:] == self.piece[:-1]) & (code[:-depth - 1] > 0) & (code[1:-depth] > 0), end > 0, [False]))
        at = np.flatnonzero(on)
        columns, more = [code[at]], np.ones(len(at), bool)
        for n in range(1, depth):
            more = more & on[at + n - 1]
            columns.append(np.where(more, code[at + n], 0))
        state, states, base = np.zeros(len(at), np.int64), 1, len(names) + 1
        for c in columns:
            if states * base >= 1 << 62:
                ranks, state = np.unique(state, return_inverse=True)
                states = len(ranks)
            state = state * base + c
            states *= base
        _, first, counts = np.unique(state, return_index=True, return_counts=True)
        return names, np.stack(columns)[:, first], counts

    def rows(self, lang: str, depth: int, words: Filter, deal: Deal) -> Iterator[pa.RecordBatch]:
        """One row per block with paths: the block's words, its paths as places in them, their counts."""
        names, paths, counts = self.paths(depth, words)
        if not len(counts):
            return
        texts = self.words.cast(pa.string()).take(pa.array(names))
        block = deal(np.concatenate((np.zeros(1, np.uint64), self.hashes[names])), paths)
        order = np.argsort(block, kind="stable")
        cuts = np.flatnonzero(np.diff(block[order], prepend=-1, append=-1))
        out, size = [], 0
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            part = paths[:, order[lo:hi]]
            used = np.zeros(len(names) + 1, bool)
            used[part] = True
            used[0] = False
            here = texts.take(pa.array(np.flatnonzero(used) - 1))
            here = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(here)], pa.int32()), here), "\t")[0].as_buffer()
            row = (int(block[order[lo]]), lang, hi - lo, here.size, pa.compress(here, "zstd", asbytes=True),
                   packed(np.cumsum(used)[part] * (part > 0)), packed(counts[order[lo:hi]]))
            out.append(row)
            size += sum(map(len, row[4:]))
            if size > OUT_BYTES or hi == len(order):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), BLOCK_TYPES.values())], list(BLOCK_TYPES))
                out, size = [], 0


class Deal:
    """Blocks of paths: by the hash of the first two words, and by the third word where that pair is common."""

    def __init__(self, blocks: int, pairs: np.ndarray, spread: np.ndarray):
        order = np.argsort(pairs)
        self.blocks, self.pairs, self.spread = blocks, pairs[order], spread[order]

    def common(self, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pair is common, over how many blocks its paths are dealt)."""
        if not len(self.pairs):
            return np.zeros(len(pair), bool), np.ones(len(pair), np.int64)
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        found = self.pairs[at] == pair
        return found, np.where(found, self.spread[at], 1)

    def __call__(self, hashes: np.ndarray, paths: np.ndarray) -> np.ndarray:
        """Blocks of the paths; ``hashes`` are those of the places in ``paths``."""
        pair = _pair_hash(hashes[paths[0]], hashes[paths[1]])
        block = (pair >> np.uint64(32)).astype(np.int64)
        if len(paths) > 2:
            found, spread = self.common(pair)
            third = (mix(hashes[paths[2][found]]) >> np.uint64(32)).astype(np.int64)
            block[found] += third % spread[found]
        return block % self.blocks


#: A row of packed paths: ``n`` paths of equal depth and their words, ``length`` bytes joined by tabs, which no word holds.
BLOCK_TYPES = {"block": pa.int32(), "lang": pa.string(), "n": pa.int32(), "length": pa.int64(),
               "words": pa.binary(), "paths": pa.binary(), "counts": pa.binary()}
BLOCK_DDL = "block int, lang string, n int, length long, words binary, paths binary, counts binary"


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 in the least width that holds them all: the width, then their first bytes, second bytes and so on."""
    width = next(k for k in (1, 2, 4, 8) if int(numbers.max()) < 1 << 8 * k)
    planes = np.ascontiguousarray(numbers.astype(f"<u{width}").reshape(-1, 1).view(np.uint8).T)
    return bytes([width]) + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpacked(body: bytes, n: int) -> np.ndarray:
    planes = pa.decompress(body[1:], n * body[0], "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(body[0], n).T).view(f"<u{body[0]}").ravel()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Shard]]:
    """Shards of about ``SHARD_BYTES`` of one language, over the bounds of batches."""
    held: dict[str, list] = {}

    def shards(lang: str, all_of_it: bool) -> Iterator[tuple[str, Shard]]:
        texts = pa.concat_arrays(held.pop(lang))
        for part, data, offsets in chunks(texts, SHARD_BYTES):
            if part.stop == len(texts) and not all_of_it and len(data) < SHARD_BYTES // 2:
                held[lang] = [texts[part]]
            elif len(data):
                yield lang, Shard(data, offsets, lang)

    for b in batches:
        langs = np.array(b.column(0).to_pylist(), object)
        for lang in sorted(set(langs.tolist())):
            held.setdefault(lang, []).append(b.column(1).take(pa.array(np.flatnonzero(langs == lang))))
            if sum(x.nbytes for x in held[lang]) >= SHARD_BYTES:
                yield from shards(lang, False)
        if sum(x.nbytes for parts in held.values() for x in parts) >= HELD_BYTES:
            for lang in sorted(held):
                yield from shards(lang, True)
    for lang in sorted(held):
        yield from shards(lang, True)


def _rows(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), text_or_empty(text).alias("text"))


def word_counts(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, word, h, w: the shards' counts of words; without a word, the estimated counts of their common pairs."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, shard in _runs(batches):
            pairs = shard.common_pairs()
            for texts, (h, counts) in ((shard.words.cast(pa.string()), shard.word_counts()), (pa.nulls(len(pairs[0]), pa.string()), pairs)):
                for k in range(0, len(h), OUT_ROWS):
                    part = h[k:k + OUT_ROWS]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(part)), texts[k:k + OUT_ROWS], pa.array(part.view(np.int64)),
                                                      pa.array(counts[k:k + OUT_ROWS].astype(np.int64))], ["lang", "word", "h", "w"])

    rows = _rows(docs, lang, text).mapInArrow(task, "lang string, word string, h long, w long")
    return rows.groupBy("lang", "word", "h").agg(F.sum("w").alias("w"))


def filter_of(counts: DataFrame, least: int, bits: int = FILTER_BITS) -> Filter:
    """The filter of the hashes that reach ``least``; what reaches the driver has ``2 ** bits`` bits."""
    block = 1 << 15  # bits of one Spark bitmap
    bit = F.col("h").bitwiseAND((1 << bits) - 1)
    found = (counts.groupBy("h").agg(F.sum("w").alias("w")).filter(F.col("w") >= least)
             .groupBy((bit / block).cast("long").alias("block")).agg(F.bitmap_construct_agg(bit % block).alias("body")))
    body = np.zeros(max((1 << bits) // 8, block // 8), np.uint8)
    for r in found.collect():
        body[r.block * block // 8:(r.block + 1) * block // 8] = np.frombuffer(r.body, np.uint8)
    return Filter(bits, body)


def deal_of(counts: DataFrame, total: int, block_words: int = BLOCK_WORDS) -> Deal:
    """As many blocks as the words ask for; a pair that would take an eighth of a block or more is dealt on.

    Such pairs are at most a few for each block, and so is what reaches the driver.
    """
    blocks = max(partitions(counts.sparkSession), -(-total // block_words))
    share = max(total // blocks // 8, 1)
    found = counts.filter(F.col("word").isNull() & (F.col("w") > share)).select("h", "w").collect()
    return Deal(blocks, np.array([r.h for r in found], np.int64).view(np.uint64),
                np.array([min(blocks, -(-r.w // share)) for r in found], np.int64))


def shard_transducers(docs: DataFrame, depth: int, words: Filter, deal: Deal, lang: str = "lang", text: str = "text") -> DataFrame:
    """The shards' paths of two to ``depth`` words, packed by block."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, shard in _runs(batches):
            yield from shard.rows(name, depth, words, deal)

    return _rows(docs, lang, text).mapInArrow(task, BLOCK_DDL)


class SortedUnion:
    """Sum of transducers whose paths are added in sorted order; only the last path is kept."""

    def __init__(self, least: int):
        self.least = least
        self.path: list[str] = []        # the language, then words
        self.weights: list[int] = []
        self.shared: int | None = None   # states of the path that are on the range's first path
        self.out: list[tuple[list[str], int]] = []

    def _leave(self, depth: int, edge: bool = False) -> None:
        """Leave the states below ``depth``."""
        while len(self.path) > depth:
            w = self.weights.pop()
            k = len(self.path)
            if k > 1 and (w >= self.least or edge or k <= self.shared):
                self.out.append((self.path[:], w))
            self.shared = min(self.shared, k - 1)
            self.path.pop()
            if self.weights:
                self.weights[-1] += w

    def add(self, path: list[str], weight: int) -> None:
        if self.shared is None:
            self.shared = len(path)
        common = 0
        for a, b in zip(self.path, path):
            if a != b:
                break
            common += 1
        self._leave(common)
        self.path += path[common:]
        self.weights += [0] * (len(path) - common)
        self.weights[-1] += weight

    def end(self) -> None:
        self._leave(0, edge=True)

    def take(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        return pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p, _ in rows], pa.string()),
             pa.array([p[1:] for p, _ in rows], pa.list_(pa.string())),
             pa.array([w for _, w in rows], pa.int64())], ["lang", "phrase", "w"])


def frequent_paths(paths: np.ndarray, counts: np.ndarray, base: int, least: int, common: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Sorted paths cut after the last state that reaches ``least``, and their counts; pairs that do not are left out.

    ``common``: paths of pairs whose other paths may be in other blocks.  Each such pair stays.
    """
    out = []
    _, first, state = np.unique(paths[0].astype(np.int64) * base + paths[1], return_index=True, return_inverse=True)
    goes = (np.bincount(state, counts)[state] >= least) | common
    paths, counts, example, state = paths[:, goes], counts[goes], paths[:, first], state[goes]
    for n in range(2, len(paths) + 1):
        goes = np.zeros(len(counts), bool)
        if n < len(paths):
            goes = paths[n] > 0
            _, first, after = np.unique(state[goes] * base + paths[n][goes], return_index=True, return_inverse=True)
            longer = paths[:, goes][:, first]
            enough = np.bincount(after, counts[goes])[after] >= least
            goes[goes] = enough
            after = after[enough]
        own = np.bincount(state[~goes], counts[~goes]).astype(np.int64)
        for k in np.flatnonzero(own).tolist():
            out.append((tuple(example[:n, k].tolist()), int(own[k])))
        if not goes.any():
            break
        paths, counts, example, state = paths[:, goes], counts[goes], longer, after
    return sorted(out)


def union_by_prefix(packs: DataFrame, depth: int, deal: Deal, least: int) -> DataFrame:
    """lang, phrase (array of words), f of the phrases of two words and more that stand ``least`` times or more."""
    def united(lang: str, rows: list[tuple[int, int, bytes, bytes, bytes]]) -> pa.RecordBatch:
        parts = [pa.decompress(words, length, "zstd", asbytes=True).decode().split("\t") for _, length, words, _, _ in rows]
        coded = pa.array([w for p in parts for w in p], pa.string()).dictionary_encode()
        number = coded.indices.to_numpy() + np.int32(1)
        paths, at = [], 0
        for (n, _, _, body, _), p in zip(rows, parts):
            table = np.concatenate((np.zeros(1, np.int32), number[at:at + len(p)]))
            at += len(p)
            paths.append(table[unpacked(body, n * depth).reshape(depth, n)])
        paths = np.concatenate(paths, axis=1)
        counts = np.concatenate([unpacked(c, n).astype(np.float64) for n, _, _, _, c in rows])  # sums under 2 ** 53 are exact
        body, off = buffers(coded.dictionary)
        hashes = np.concatenate((np.zeros(1, np.uint64), word_hashes(body, off[:-1], off[1:]) ^ _lang_number(lang)))
        common, _ = deal.common(_pair_hash(hashes[paths[0]], hashes[paths[1]]))
        names = coded.dictionary.to_pylist()
        union = SortedUnion(1)  # what is too rare is cut off already
        for path, w in frequent_paths(paths, counts, len(hashes), least, common):
            union.add([lang, *(names[k - 1] for k in path)], w)
        if union.path:
            union.end()
        union.out = [x for x in union.out if len(x[0]) > 2]  # first words are counted elsewhere
        return union.take()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for b in batches:
            for block, lang, *row in zip(*(c.to_pylist() for c in b.columns)):
                if (block, lang) != key:
                    if held:
                        yield united(key[1], held)
                    key, held = (block, lang), []
                held.append(row)
        if held:
            yield united(key[1], held)

    dealt = packs.repartitionById(deal.blocks, F.col("block")).sortWithinPartitions("block", "lang")
    parts = dealt.mapInArrow(task, "lang string, phrase array<string>, w long")
    return parts.groupBy("lang", "phrase").agg(F.sum("w").alias("f")).filter(F.col("f") >= least)


def counted_phrases(docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS, filter_bits: int = FILTER_BITS,
                    lang: str = "lang", text: str = "text", block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f of all phrases of 1 to ``most_words`` words that stand ``least`` times; lang, n: all words)."""
    counts = stored(word_counts(docs, lang, text), "word-counts")
    words = counts.filter(F.col("word").isNotNull())
    total = words.groupBy("lang").agg(F.sum("w").alias("n"))
    known = filter_of(words, least, filter_bits)
    deal = deal_of(counts, words.agg(F.sum("w")).first()[0] or 0, block_words)
    packs = shard_transducers(docs, most_words, known, deal, lang, text)
    single = words.filter(F.col("w") >= least).select("lang", F.array("word").alias("phrase"), F.col("w").alias("f"))
    return stored(single.union(union_by_prefix(packs, most_words, deal, least)), "phrases"), total


class PartWalk:
    """Composition of sorted phrases with their own transducer: parts' counts are those of the states passed."""

    def __init__(self):
        self.lang: str | None = None
        self.path: list[str] = []
        self.open: list[tuple] = []      # row, count, [has an equally frequent extension]
        self.done: list[tuple] = []

    def _leave(self, depth: int) -> None:
        while len(self.open) > depth:
            row, f, same = self.open.pop()
            self.path.pop()
            self.done.append((row, [x[1] for x in self.open], same[0]))

    def add(self, lang: str, path: list[str], f: int, row) -> None:
        if lang != self.lang:
            self._leave(0)
            self.lang = lang
        common = 0
        for a, b in zip(self.path, path):
            if a != b:
                break
            common += 1
        self._leave(common)
        # every beginning of a counted phrase is counted, so the path grows by one word
        if len(self.path) != len(path) - 1:
            raise ValueError(f"no count of the parts of {path}")
        if self.open and self.open[-1][1] == f and len(path) > 2:
            self.open[-1][2][0] = True
        self.path.append(path[-1])
        self.open.append((row, f, [False]))

    def end(self) -> None:
        self._leave(0)


def _walk(backwards: bool, columns: Sequence[str], types: dict[str, pa.DataType]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = PartWalk()

        def take() -> pa.RecordBatch:
            done, walk.done = walk.done, []
            cols = [pa.array([r[0][k] for r in done], types[c]) for k, c in enumerate(columns)]
            cols += [pa.array([r[1] for r in done], pa.list_(pa.int64())), pa.array([r[2] for r in done], pa.bool_())]
            return pa.RecordBatch.from_arrays(cols, [*columns, "parts", "inside"])

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in columns)):
                phrase = row[1][::-1] if backwards else row[1]
                walk.add(row[0], phrase, row[2], row)
                if len(walk.done) >= OUT_ROWS:
                    yield take()
        walk.end()
        yield take()
    return task


def with_parts(counted: DataFrame) -> DataFrame:
    """lang, phrase, f, lefts, rights (counts of the parts of 1, 2, ... words), inside (a longer phrase is as frequent)."""
    types = {"lang": pa.string(), "phrase": pa.list_(pa.string()), "f": pa.int64(), "lefts": pa.list_(pa.int64()), "inside_left": pa.bool_()}
    ddl = "lang string, phrase array<string>, f long"
    ahead = ["lang", "phrase", "f"]
    left = (counted.select(*ahead).repartition("lang", F.col("phrase")[0]).sortWithinPartitions("lang", "phrase")
            .mapInArrow(_walk(False, ahead, types), f"{ddl}, parts array<long>, inside boolean")
            .withColumnsRenamed({"parts": "lefts", "inside": "inside_left"}))
    both = [*ahead, "lefts", "inside_left"]
    right = (left.repartition("lang", F.element_at("phrase", -1)).sortWithinPartitions("lang", F.reverse("phrase"))
             .mapInArrow(_walk(True, both, types), f"{ddl}, lefts array<long>, inside_left boolean, parts array<long>, inside boolean"))
    return right.select(*ahead, "lefts", F.col("parts").alias("rights"), (F.col("inside") | F.col("inside_left")).alias("inside"))


def collocations(docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS, top: int = TOP,
                 filter_bits: int = FILTER_BITS, lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases.

    The score is that of the lowest-scoring cut, ``floor(1000 * a * n / (l * r))`` in whole
    numbers of up to 38 digits.  Phrases inside an equally frequent longer one are left out.
    """
    counted, total = counted_phrases(docs, least, most_words, filter_bits, lang, text)
    parts = with_parts(counted).filter((F.size("phrase") > 1) & ~F.col("inside")).join(total, "lang")
    score = "(1000BD * cast(f as decimal(19,0)) * cast(n as decimal(15,0))) div (cast(lefts[k - 1] as decimal(19,0)) * cast(rights[size(phrase) - k - 1] as decimal(19,0)))"
    cuts = F.expr("array_min(transform(sequence(1, size(phrase) - 1), k -> struct("
                  f"{score} as score, k as k, lefts[k - 1] as l, rights[size(phrase) - k - 1] as r)))")
    scored = parts.withColumn("cut", cuts).select(
        "lang", F.array_join("phrase", " ").alias("phrase"), F.col("f").alias("a"), "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


#: DuckDB SQL for the whole query: phrases by position joins inside pieces, exact HUGEINT arithmetic.
ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(range(1, len(parts) + 1)) AS p, unnest(parts) AS piece
  FROM (SELECT lang, doc_id, regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]') AS parts FROM documents)
), lists AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), grams AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM lists), range(1, 6) t(k)
  WHERE i + k - 1 <= len(ws)
), total AS (
  SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100
), cuts AS (
  SELECT c.lang, c.phrase, c.k, c.f AS a, cut,
         array_to_string(string_split(c.phrase, ' ')[1:cut], ' ') AS lp,
         array_to_string(string_split(c.phrase, ' ')[cut + 1:], ' ') AS rp
  FROM f c, range(1, 5) t(cut) WHERE cut < c.k
), scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, l.f AS l, r.f AS r, total.n AS n, cut,
         (1000::HUGEINT * cuts.a * total.n) // (l.f::HUGEINT * r.f) AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = lp
            JOIN f r ON r.lang = cuts.lang AND r.phrase = rp JOIN total ON total.lang = cuts.lang
), least AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT DISTINCT lang, array_to_string(string_split(phrase, ' ')[i:i + len - 1], ' ') AS phrase, f
  FROM f, range(1, 6) t(i), range(2, 5) u(len) WHERE len < k AND i + len - 1 <= k
), ranked AS (
  SELECT m.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM least m WHERE NOT EXISTS (
    SELECT 1 FROM inside x WHERE x.lang = m.lang AND x.phrase = m.phrase AND 100 * x.f >= 100 * m.a)
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
       score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""
