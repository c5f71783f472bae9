"""Repeated windows of a corpus, dealt to shards by content; shared by operators 3 and 5.

A unit is a byte or a word and a window is ``width`` consecutive units of one text.  Each
window has an anchor: the leftmost of its ``gram``-unit grams with the least hash.  Equal
windows have equal anchors at the same place in the window, so all the copies of a window
can be brought together by the hash of the anchor's gram, and a window whose anchor's gram
stands nowhere else needs no work.  Consecutive windows with the same anchor make one
segment.  The steps, all Spark jobs:

1. every text gives its anchors (a row of arrays per document); equal texts become one,
   named by its least id and the hash ``h1`` of its text, as a doc_id may stand with several texts;
2. grams that stand more than once are joined back, and their segments cut from the texts;
3. equal segments become one with a count and a least document; the distinct segments go
   to shards by key, where the operator's index finds the repeated windows;
4. the answers are joined to the segments' places and become spans per document.

A gram whose segments have more than ``HOT`` distinct contents would bring them all together
(the edge of a common passage in ever new surroundings).  Its segments are cut into shorter
runs of windows, keyed by the content that all windows of the run share, which spreads
them; the more contents, the shorter the runs.  Segments inside the passage are one content
with a count, however often it stands, and stay whole.

A periodic stretch (padding, one repeated word) has the same short segment again and again.
Such segments in a row are one place with a number of times, so places follow the distinct
windows of a text and not its length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import TEXT_ROWS, stored, text_or_empty
from martlet.llm.near_documents import row_id, text_hash
from martlet.llm.texts import buffers, chunks, mix, word_hashes, words

HOT = 2000      # distinct contents of a gram's segments from which they are cut into runs
HOTTER = 50_000  # ... and into the shortest runs
STEP = 1 << 19  # windows looked at together
SHARD_BYTES = 1 << 21
SEEN = 200_000  # segments a task remembers in order not to repeat their bytes


@dataclass(frozen=True)
class Windows:
    by_words: bool
    width: int
    gram: int
    runs: tuple[int, int]  # windows of a run from HOT and from HOTTER contents

    def units(self, data: np.ndarray, offsets: np.ndarray):
        """Starts and ends of the units (None for bytes), first unit of each document, hash of the gram at each unit."""
        if self.by_words:
            starts, ends, first = words(data, offsets)
            h = word_hashes(data, starts, ends)
            size = 1
            while size < self.gram:  # the gram is a power of two
                h = mix(h[:-size] * np.uint64(3) + h[size:]) if len(h) > size else h[:0]
                size *= 2
            return starts, ends, first, h
        n = len(data) - self.gram + 1
        if n <= 0:
            return None, None, offsets, np.zeros(0, np.uint64)
        body = np.ascontiguousarray(data)
        h = np.zeros(n, np.uint64)
        for k in range(0, self.gram, 8):
            part = np.ndarray((n,), np.uint64, body, k, (1,))
            h ^= part
            h *= np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        return None, None, offsets, h


BYTES_200 = Windows(False, 200, 48, (32, 4))
WORDS_50 = Windows(True, 50, 8, (8, 1))


def _sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each w consecutive values."""
    n = len(x) - w + 1
    pad = -len(x) % w
    full = np.concatenate((x, np.full(pad, np.iinfo(x.dtype).max, x.dtype))).reshape(-1, w)
    head = np.minimum.accumulate(full, 1).ravel()
    tail = np.minimum.accumulate(full[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(tail[:n], head[w - 1:w - 1 + n])


def anchors(h: np.ndarray, first: np.ndarray, spec: Windows) -> tuple[np.ndarray, ...]:
    """(document, first window, windows, offset of the anchor in the first window, gram hash, content, times) of segments.

    Places are units from the document's start; ``content`` is a 32-bit hash of all units of the
    segment, and ``times`` tells how often the segment follows itself, each starting where the
    windows of the one before end.
    """
    w = spec.width - spec.gram + 1
    bits = np.uint64(22)
    low = (np.uint64(1) << bits) - np.uint64(1)
    out = []
    total = len(h) - w + 1  # window starts with all their grams
    for s in range(0, max(total, 0), STEP):
        m = min(STEP, total - s)
        x = (h[s:s + m + w - 1] & ~low) | np.arange(m + w - 1, dtype=np.uint64)
        at = (_sliding_least(x, w) & low).astype(np.int64) + s
        p = np.arange(s, s + m)
        doc = np.searchsorted(first, p, "right") - 1
        ok = p + spec.width <= first[doc + 1]
        p, at, doc = p[ok], at[ok], doc[ok]
        if not len(p):
            continue
        new = np.ones(len(p), bool)
        new[1:] = (at[1:] != at[:-1]) | (p[1:] != p[:-1] + 1)
        i = np.flatnonzero(new)
        start, nw = p[i], np.diff(np.append(i, len(p)))
        # grams side by side and the last one hold every unit of the segment
        last, content = start + nw + spec.width - 1 - spec.gram, nw.astype(np.uint64)
        for k in range(0, int(nw.max()) + spec.width - 1, spec.gram):
            content = mix(content * np.uint64(3) + h[np.minimum(start + k, last)])
        row = (doc[i], start - first[doc[i]], nw, at[i] - start, h[at[i]], content.astype(np.uint32).view(np.int32))
        again = np.zeros(len(i), bool)
        again[1:] = start[1:] == start[:-1] + nw[:-1]
        for k in (0, 2, 3, 4, 5):
            again[1:] &= row[k][1:] == row[k][:-1]
        one = np.flatnonzero(~again)
        out.append((*(x[one] for x in row), np.diff(np.append(one, len(i)))))
    if not out:
        return tuple(np.zeros(0, kind) for kind in (*[np.int64] * 4, np.uint64, np.int32, np.int64))
    return tuple(np.concatenate([o[k] for o in out]) for k in range(7))


def kept_words(data: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    return b" ".join([data[a:b] for a, b in zip(starts.tolist(), ends.tolist())])


def _scan(spec: Windows):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, data, offsets in chunks(b.column(1)):
                docs = len(offsets) - 1
                starts, ends, first, h = spec.units(data, offsets)
                doc, lo, nw, ao, gram, content, times = anchors(h, first, spec)
                bounds = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=docs)))).astype(np.int32)
                raw = data.tobytes()
                texts = [raw[x:y] for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                h2 = np.frombuffer(b"".join(xxhash.xxh3_64_digest(t) for t in texts), np.int64)
                if spec.by_words:
                    whole = [hashlib.sha256(kept_words(raw, starts[i:j], ends[i:j])).hexdigest()
                             for i, j in zip(first[:-1], first[1:])]
                else:
                    whole = [hashlib.sha256(t).hexdigest() for t in texts]
                lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x))
                         for x in (gram.view(np.int64), *(x.astype(np.int32) for x in (lo, nw, ao, content, times)))]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(rows.start, docs), b.column(2).slice(rows.start, docs),
                     b.column(3).slice(rows.start, docs), pa.array(h2), pa.array(np.diff(first).astype(np.int64)),
                     pa.array(whole), *lists],
                    ["id", "doc_id", "h1", "h2", "n_units", "whole", "g", "lo", "nw", "ao", "c", "t"])
    return task


def _digest(*parts: bytes) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(b"".join(parts)), "little", signed=True)


def _cut(spec: Windows):
    """id, h1, text and its repeated anchors in; a row per segment out, with its bytes once per task."""
    w = spec.width

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for b in batches:
            out: list[tuple] = []
            for i in range(b.num_rows):
                raw = (b.column(2)[i].as_py() or "").encode()
                data, offsets = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
                if spec.by_words:
                    # words alone name a segment, whatever white space stands between them
                    starts, ends, _ = words(data, offsets)
                    joined = kept_words(raw, starts, ends)
                    stops = np.cumsum(ends - starts + 1) - 1
                    begins = stops - (ends - starts)
                    piece = lambda x, y: joined[begins[x]:stops[y - 1]]
                else:
                    piece = lambda x, y: raw[x:y]
                doc = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                for a in b.column(3)[i].as_py():
                    g = a["g"].to_bytes(8, "little", signed=True)
                    r = a["r"]
                    if not r:
                        runs = [(a["lo"], a["nw"], g)]
                    else:
                        at, runs = a["lo"] + a["ao"], []
                        p, stop = a["lo"], a["lo"] + a["nw"]
                        while p < stop:
                            k = (at - p) // r  # windows whose anchor lies r*k .. r*k + r - 1 units in
                            end = min(stop, at - r * k + 1)
                            core = piece(at - r * k, at - r * k - r + 1 + w)
                            runs.append((p, end - p, g + k.to_bytes(4, "little") + core))
                            p = end
                    for lo, nw, key in runs:
                        seg = piece(lo, lo + nw + w - 1)
                        # key and sid together name a segment
                        name = _digest(key), _digest(b"|", nw.to_bytes(4, "little"), seg)
                        fresh = name not in seen
                        if fresh:
                            if len(seen) >= SEEN:
                                seen.clear()
                            seen.add(name)
                        out.append((*name, *doc, lo, nw, a["t"], (a["t"] - 1) * a["nw"], seg if fresh else None))
                    if len(out) >= 5000:
                        yield _segment_batch(out)
                        out = []
            if out:
                yield _segment_batch(out)
    return task


# far: how far the last of the times starts after the first
_SEGMENT = "key long, sid long, id long, h1 long, lo int, nw int, t int, far int, seg binary"


def _segment_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.int32()] * 4 + [pa.binary()]
    cols = [pa.array([x[k] for x in rows], kinds[k]) for k in range(9)]
    return pa.RecordBatch.from_arrays(cols, ["key", "sid", "id", "h1", "lo", "nw", "t", "far", "seg"])


#: What a shard's index gets: the segments' bytes, windows, least documents; it returns for
#: each segment the runs (first window, windows) of those that also stand elsewhere.
Index = Callable[[list[bytes], np.ndarray, np.ndarray], list[list[tuple[int, int]]]]


def _index_shards(index: Index):
    """Distinct segments sorted by key in; key, sid, least, n and the runs of repeated windows out."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(t: pa.Table) -> pa.RecordBatch:
            # the windows of one segment differ from each other (their anchor lies at other places in
            # them), so a key with one kind of segment needs no search: its count tells
            _, kind_of, kinds = np.unique(t.column("key").to_numpy(), return_inverse=True, return_counts=True)
            several = np.flatnonzero(kinds[kind_of] > 1)
            runs: list = [[] for _ in range(t.num_rows)]
            if len(several):
                found = t.take(pa.array(several))
                for i, r in zip(several.tolist(), index(found.column("seg").to_pylist(), found.column("nw").to_numpy(),
                                                        found.column("least").to_numpy())):
                    runs[i] = r
            kind = pa.list_(pa.struct([("a", pa.int32()), ("n", pa.int32())]))
            found = pa.array([[{"a": a, "n": n} for a, n in r] for r in runs], kind)
            cols = [t.column(c).combine_chunks() for c in ("key", "sid", "least", "n")]
            return pa.RecordBatch.from_arrays([*cols, found], ["key", "sid", "least", "n", "runs"])

        kept: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            keys = b.column(0).to_numpy()
            _, off = buffers(b.column(b.schema.get_field_index("seg")))
            edges = np.append(np.flatnonzero(np.diff(keys)) + 1, b.num_rows)
            at = 0
            if kept and b.num_rows and kept[-1].column(0)[-1].as_py() != keys[0] and size >= SHARD_BYTES:
                yield answer(pa.Table.from_batches(kept))
                kept, size = [], 0
            for e in edges[:-1].tolist():  # the last key may go on in the next batch
                if size + off[e] - off[at] >= SHARD_BYTES:
                    yield answer(pa.Table.from_batches([*kept, b.slice(at, e - at)]))
                    kept, size, at = [], 0, e
            if at < b.num_rows:
                kept.append(b.slice(at))
                size += int(off[-1] - off[at])
        if kept:
            yield answer(pa.Table.from_batches(kept))
    return task


def union_of_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs (from, to) covered by the spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def repeated_spans(docs: DataFrame, spec: Windows, index: Index, earlier: bool,
                   key: str = "doc_id", text: str = "text", hot: int = HOT, hotter: int = HOTTER) -> tuple[DataFrame, DataFrame]:
    """Two tables: the scanned rows, and the texts that hold repeated windows with their spans.

    Scanned: id, h1, doc_id, n_units, whole (digest of all that is kept if nothing goes) and
    ``full`` where the whole text is repeated as an equal text.  Texts: id, h1, text, spans
    (array of from, to in units); id and h1 together name a text.  ``earlier``: only windows that also stand in a
    document with a smaller id count; else any other place does.
    """
    rows = docs.select(row_id(key, text).alias("id"), text_or_empty(text).alias("text"), F.col(key).cast("long").alias("doc_id"),
                       text_hash(text).alias("h1"))
    scanned = stored(rows.mapInArrow(_scan(spec), (
        "id long, doc_id long, h1 long, h2 long, n_units long, whole string, "
        "g array<long>, lo array<int>, nw array<int>, ao array<int>, c array<int>, t array<int>")), "scanned", TEXT_ROWS)
    same = scanned.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    reps = same.select(F.col("rep").alias("id"), "h1", "h2")
    places = (scanned.join(reps, ["id", "h1", "h2"], "left_semi").dropDuplicates(["id", "h1"])
              .select("id", "h1", F.explode(F.arrays_zip("g", "lo", "nw", "ao", "c", "t")).alias("a")).select("id", "h1", "a.*"))
    more = F.min("id") != F.max("id") if earlier else F.sum("t") > 1
    # a table of its own, so that a hot gram can be split where places meet it
    grams = stored(places.groupBy("g").agg(F.sum("t").alias("n"), more.alias("more")).filter("more")
                   .select("g", (F.col("n") > hot).alias("often")), "grams")
    # of the grams that stand often, those whose segments differ; equal ones meet in the first step
    often = stored(grams.filter("often").select("g"), "frequent-grams")
    varied = stored(places.select("g", "c").join(often, "g").groupBy("g", "c").agg(F.count(F.lit(1)).alias("n"))
                    .groupBy("g").agg(F.count(F.lit(1)).alias("contents")).filter(F.col("contents") > hot)
                    .select("g", F.when(F.col("contents") > hotter, spec.runs[1]).otherwise(spec.runs[0]).alias("r")), "varied-grams")
    cut = grams.select("g").join(varied, "g", "left").select("g", F.coalesce("r", F.lit(0)).alias("r"))
    flagged = (places.drop("c").join(cut, "g")
               .groupBy("id", "h1").agg(F.collect_list(F.struct("g", "lo", "nw", "ao", "t", "r")).alias("at")))
    held = stored(rows.select("id", "h1", "text").join(flagged, ["id", "h1"]).dropDuplicates(["id", "h1"]), "held-texts")

    segs = stored(held.select("id", "h1", "text", "at").mapInArrow(_cut(spec), _SEGMENT), "segments", TEXT_ROWS)
    # counts meet before the shuffle; bytes, once per task and segment, go to their key's place once
    counts = segs.groupBy("key", "sid").agg(F.min("id").alias("least"), F.sum("t").alias("n"), F.first("nw").alias("nw"))
    both = counts.withColumn("seg", F.lit(None).cast("binary")).unionByName(
        segs.filter("seg is not null").select("key", "sid", "seg"), allowMissingColumns=True)
    distinct = both.repartition("key").groupBy("key", "sid").agg(
        *[F.max(c).alias(c) for c in ("least", "n", "seg", "nw")])
    answers = stored(distinct.sortWithinPartitions("key", "sid")
                     .mapInArrow(_index_shards(index), "key long, sid long, least long, n long, runs array<struct<a:int,n:int>>")
                     .filter((F.col("n") > 1) | (F.size("runs") > 0)), "answers")
    whole = F.col("id") > F.col("least") if earlier else F.col("n") > 1
    runs = F.when(whole, F.array(F.struct(F.lit(0).alias("a"), F.col("nw").alias("n")))).otherwise(F.col("runs"))
    # the windows of all times reach over each other's starts, so each run is one span
    spans = (segs.select("key", "sid", "id", "h1", "lo", "nw", "far").join(answers, ["key", "sid"])
             .select("id", "h1", "lo", "far", F.explode(runs).alias("r"))
             .select("id", "h1", F.struct((F.col("lo") + F.col("r.a")).alias("a"),
                                    (F.col("lo") + F.col("far") + F.col("r.a") + F.col("r.n") + spec.width - 1).alias("b")).alias("s"))
             .groupBy("id", "h1").agg(F.collect_list("s").alias("spans")))
    texts = held.select("id", "h1", "text").join(spans, ["id", "h1"])

    marked = scanned.select("id", "doc_id", "h1", "h2", "n_units", "whole").join(same, ["h1", "h2"])
    again = F.col("id") > F.col("rep") if earlier else F.col("copies") > 1
    full = again & (F.col("n_units") >= spec.width)
    return marked.select("id", "h1", "doc_id", "n_units", "whole", full.alias("full")), texts
