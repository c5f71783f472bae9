"""Operator 4: near-duplicate documents by ProbMinHash, bands and exact verification.

A document's elements are its distinct five-word shingles (the whole text if it has fewer
words), weighted by ``1 + ln(times)`` in the document.  Every element is a Poisson process of
that rate whose arrivals fall on random registers; a register keeps the element that arrives
first, and a document's arrivals stop once none can be first any more.  Two documents agree in
a register with the probability Jaccard similarity of their weights, and the same similarity,
computed exactly from the whole texts, decides a link, so no pair is near by one rule and
far by the other.  Where no shingle repeats it is the Jaccard similarity of the sets; it does not
change if all of a document's weights grow alike.  Bands of registers deal documents into buckets.
Inside a bucket the registers are compared as arrays.  First each member
of a few bands' buckets proposes its closest partner, and the pairs are verified from their
texts; that connects most of what belongs together.  Then the buckets that still hold
unconnected members with enough common registers get the weighted shingles of just these, and
all such pairs are verified inside the bucket, each pair in the first band that it shares.
Only a spanning forest of the links found leaves the bucket.  A link is a similarity of 0.8 or
more; classes are the connected components.
A bucket of more than ``BLOCK`` members is compared block by block, each pair of blocks a
unit of work.

Equal texts are one class from the start, and only one of them goes further.  Null and
empty texts, and texts of white space alone, have no shingle: they link only with equal
texts.  A row without doc_id gets an id from its text's hash, larger than 2**62, so that it
is kept only where no row with a doc_id is in its class.  Repeated rows share a class.  Rows
that repeat a doc_id with other texts (a page fetched again) are judged by their own text:
only text_id and class_id are ids, so texts of one doc_id that are not alike show the same
class_id in different classes, and each of these classes keeps its row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlet.llm.common import TEXT_ROWS, read_table, stored, text_or_empty
from martlet.llm.components import components
from martlet.llm.texts import chunks, mix, word_hashes, words

SHINGLE = 5
SIMILARITY = 0.8
REGISTERS, BAND = 125, 5  # a pair at 0.8 shares one of the 25 bands with probability 0.99995
FIRST_BANDS = 5  # the first round looks into these only: they connect most of what belongs together
LEAST_AGREEING = 0.62  # of registers, five standard deviations below 0.8: spares verifying other pairs
BLOCK = 2000


def row_id(key: str = "doc_id", text: str = "text") -> Column:
    """The doc_id, or an id beyond 2**62 from the text's hash."""
    spare = F.xxhash64(text_or_empty(text)).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    return F.coalesce(F.col(key).cast("long"), spare)


def text_hash(text: str = "text") -> Column:
    """A 64-bit hash that, with the id, names a text."""
    return F.xxhash64(F.lit(1), text_or_empty(text))


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash, count) of the distinct shingles, in order of document."""
    starts, ends, first = words(data, offsets)
    h = word_hashes(data, starts, ends)
    n = np.diff(first)
    docs = len(n)
    runs = np.where(n >= SHINGLE, n - SHINGLE + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(docs), runs)
    before = np.concatenate(([0], np.cumsum(runs)[:-1])) if docs else np.zeros(0, np.int64)
    at = first[:-1][doc] + np.arange(len(doc)) - before[doc]
    size = np.minimum(n, SHINGLE)[doc]
    value = np.zeros(len(doc), np.uint64)
    for k in range(SHINGLE):
        more = size > k
        value[more] = mix(value[more] ^ h[at[more] + k]) + np.uint64(k + 1)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    places = np.flatnonzero(new)
    return doc[places], value[places], np.diff(np.append(places, len(doc)))


def weights(times: np.ndarray) -> np.ndarray:
    return 1 + np.log(times)


def probability_jaccard(va: np.ndarray, wa: np.ndarray, vb: np.ndarray, wb: np.ndarray) -> float:
    """Exact similarity of two weighted sets (values sorted, each once): sum over the common elements i of
    1 / sum over all j of max(a_j / a_i, b_j / b_i).

    With the elements in order of a_j / b_j, the first term is the greater one from i on and the
    second before i, so running sums give every inner sum.
    """
    value = np.concatenate((va, vb))
    if not len(va) or not len(vb):
        return 0.0
    union, at = np.unique(value, return_inverse=True)
    a, b = np.zeros(len(union)), np.zeros(len(union))
    a[at[:len(va)]], b[at[len(va):]] = wa, wb
    with np.errstate(divide="ignore"):
        order = np.argsort(a / b, kind="stable")
    a, b = a[order], b[order]
    behind, before = np.cumsum(a[::-1])[::-1], np.cumsum(b) - b
    both = (a > 0) & (b > 0)
    return float((1 / (behind[both] / a[both] + before[both] / b[both])).sum())


def prob_minhash(doc: np.ndarray, value: np.ndarray, weight: np.ndarray, docs: int) -> np.ndarray:
    """(docs, REGISTERS) first elements; rows of documents without elements are 0."""
    times = np.full(docs * REGISTERS, np.inf)
    elements = np.zeros(docs * REGISTERS, np.uint64)
    last = np.full(docs, np.inf)  # the latest of a document's first arrivals
    now = np.zeros(len(value))
    state = value.copy()
    while len(state):
        state = mix(state + np.uint64(0x9E3779B97F4A7C15))
        now = now - np.log1p(-((state >> np.uint64(11)).astype(np.float64) / (1 << 53))) / weight
        go = now < last[doc]
        doc, state, now, weight, value = doc[go], state[go], now[go], weight[go], value[go]
        place = doc * REGISTERS + (mix(state ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(REGISTERS)).astype(np.int64)
        np.minimum.at(times, place, now)
        won = times[place] == now
        elements[place[won]] = value[won]
        touched = np.unique(doc)
        last[touched] = times.reshape(docs, -1)[touched].max(1)
    return elements.reshape(docs, REGISTERS)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, text in; id, number of shingles, one byte per register, band keys out."""
    for b in batches:
        for rows, data, offsets in chunks(b.column(1)):
            docs = len(offsets) - 1
            doc, value, times = shingles(data, offsets)
            n = np.bincount(doc, minlength=docs)
            first = prob_minhash(doc, value, weights(times), docs)
            marks = (mix(first) & np.uint64(255)).astype(np.uint8)
            bands = np.empty((docs, REGISTERS // BAND), np.uint64)
            for k in range(bands.shape[1]):
                key = np.full(docs, np.uint64(k + 1))
                for r in range(BAND):
                    key = mix(key ^ first[:, k * BAND + r])
                bands[:, k] = key
            keys = [x if n[i] else [] for i, x in enumerate(bands.view(np.int64).tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(rows.start, docs), pa.array(n, pa.int64()),
                 pa.array([m.tobytes() for m in marks], pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["id", "n", "marks", "bands"])


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by their first ``keys`` columns."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.column_stack([batch.column(c).to_numpy() for c in range(keys)])
        if kept and tuple(kept[-1].column(c)[-1].as_py() for c in range(keys)) != tuple(key[0].tolist()):
            yield pa.Table.from_batches(kept).combine_chunks()
            kept = []
        other = np.flatnonzero((key != key[-1]).any(1))
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield pa.Table.from_batches([*kept, batch.slice(0, cut)]).combine_chunks()
            kept = []
        kept.append(batch.slice(cut))
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks()


class _Buckets:
    """The columns (band, a, b, sub, id, part, n, marks) of a table of whole units of work."""

    def __init__(self, t: pa.Table):
        self.table = t
        self.band, self.a, self.b, self.sub, self.ids, self.part, self.n = (t.column(c).to_numpy() for c in range(7))
        self.marks = np.frombuffer(b"".join(t.column(7).to_pylist()), np.uint8).reshape(-1, REGISTERS)

    def units(self) -> Iterator[tuple[int, int]]:
        change = (np.diff(self.band) != 0) | (np.diff(self.a) != 0) | (np.diff(self.b) != 0)
        cuts = np.flatnonzero(change) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(self.ids)]):
            if hi - lo > 1:
                yield lo, hi

    def agreeing(self, lo: int, hi: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of rows of a unit: (rows, common registers with each row; -1 where no likely partner)."""
        part, marks, sub = self.part[lo:hi], self.marks[lo:hi], self.sub[lo:hi] == self.a[lo]
        for k in range(0, hi - lo, 64):
            r = np.arange(k, min(k + 64, hi - lo))
            agree = (marks[r, None, :] == marks[None, :, :]).sum(2, dtype=np.int32)
            ok = (part[r, None] != part[None, :]) & (agree >= LEAST_AGREEING * REGISTERS)
            if self.a[lo] != self.b[lo]:
                ok &= sub[r, None] != sub[None, :]
            agree[~ok] = -1
            yield r, agree


def _closest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pair u > v of each member and its closest likely partner."""
    for t in whole_groups(batches, 3):
        x, pairs = _Buckets(t), [np.zeros((0, 2), np.int64)]
        for lo, hi in x.units():
            for r, agree in x.agreeing(lo, hi):
                best = agree.argmax(1)
                hit = agree[np.arange(len(r)), best] >= 0
                u, v = x.ids[lo:hi][r[hit]], x.ids[lo:hi][best[hit]]
                pairs.append(np.column_stack((np.maximum(u, v), np.minimum(u, v))))
        out = np.unique(np.concatenate(pairs), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["u", "v"])


def _open_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (band, a, b, sub, id, part, n, marks) that have a likely partner in another part."""
    for t in whole_groups(batches, 3):
        x = _Buckets(t)
        keep = np.zeros(len(x.ids), bool)
        for lo, hi in x.units():
            for r, agree in x.agreeing(lo, hi):
                keep[lo + r] |= (agree >= 0).any(1)
        yield from t.filter(pa.array(keep)).to_batches()


def _links_inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (band .. marks, bands, values, times) in; a spanning forest of the verified links of each unit out."""
    for t in whole_groups(batches, 3):
        x, out = _Buckets(t), []
        bands = np.array(t.column(8).to_pylist(), np.int64)
        values, times = t.column(9), t.column(10)

        def element(p: int) -> tuple[np.ndarray, np.ndarray]:  # views of the table's own memory, two texts at a time
            return (np.frombuffer(values[p].as_buffer(), np.uint64), weights(np.frombuffer(times[p].as_buffer(), np.int32)))

        for lo, hi in x.units():
            root = {p: p for p in set(x.part[lo:hi].tolist())}

            def find(p: int) -> int:
                while root[p] != p:
                    root[p] = root[root[p]]
                    p = root[p]
                return p

            for r, agree in x.agreeing(lo, hi):
                i, j = np.nonzero(agree >= 0)
                i = r[i]
                i, j = i[i < j], j[i < j]
                # a pair counts in the first band that it shares
                i, j = i + lo, j + lo
                place = (bands[i] == bands[j]).argmax(1)
                here = bands[i, place] == x.band[lo]
                for p, q in zip(i[here].tolist(), j[here].tolist()):
                    a, b = find(x.part[p]), find(x.part[q])
                    if a == b:
                        continue
                    if probability_jaccard(*element(p), *element(q)) >= SIMILARITY - 1e-9:
                        root[a] = b
                        out.append((int(x.ids[p]), int(x.ids[q])))
        cols = [pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays(cols, ["u", "v"])


def _shingle_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, text in; id, the text's distinct shingle hashes and their times out."""
    for b in batches:
        for rows, data, offsets in chunks(b.column(1)):
            doc, value, times = shingles(data, offsets)
            cuts = np.searchsorted(doc, np.arange(len(offsets)))
            values = [value[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:])]
            counts = [times[x:y].astype(np.int32).tobytes() for x, y in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(rows.start, len(values)), pa.array(values, pa.binary()), pa.array(counts, pa.binary())],
                ["id", "values", "times"])


def similarity(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Probability Jaccard similarity of two text columns, row by row (0 if one has no shingle)."""
    out = np.zeros(len(left))
    step = 200
    for k in range(0, len(left), step):
        found = []
        for col in (left.slice(k, step), right.slice(k, step)):
            parts: list[tuple[np.ndarray, np.ndarray]] = []
            for _, data, offsets in chunks(col):
                doc, value, times = shingles(data, offsets)
                cuts = np.searchsorted(doc, np.arange(len(offsets)))
                parts += [(value[x:y], weights(times[x:y])) for x, y in zip(cuts[:-1], cuts[1:])]
            found.append(parts)
        out[k:k + step] = [probability_jaccard(*a, *b) for a, b in zip(*found)]
    return out


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep = pa.array(similarity(b.column(2), b.column(3)) >= SIMILARITY - 1e-9)
        yield pa.RecordBatch.from_arrays([b.column(c).filter(keep) for c in (0, 1)], ["u", "v"])


_UNIT = "band long, a int, b int, sub int, id long, part long, n long, marks binary"


def _units(stands: DataFrame) -> DataFrame:
    """Rows of the units of work, together and sorted; ``stands`` has band, k, id, part, n, marks."""
    blocks = stands.withColumn("nb", F.ceil(F.col("k") / BLOCK).cast("int"))
    blocks = blocks.withColumn("sub", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int"))
    rows = blocks.select("*", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("o"))
    return (rows.select("band", F.least("sub", "o").alias("a"), F.greatest("sub", "o").alias("b"), "sub", "id", "part",
                        "n", "marks").repartition("band", "a", "b").sortWithinPartitions("band", "a", "b", "id"))


def _with_parts(stands: DataFrame, component: DataFrame) -> DataFrame:
    """The buckets that still hold several parts."""
    parts = (stands.join(component.withColumnRenamed("node", "id"), "id", "left")
             .withColumn("part", F.coalesce("component", "id")).drop("component"))
    several = (parts.groupBy("band").agg(F.min("part").alias("lo"), F.max("part").alias("hi"))
               .filter("lo < hi").select("band"))
    return parts.join(several, "band")


def classify(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id (see :func:`row_id`), h1 (hash of the text), text_id (least id with the same text), class_id and kept of each row.

    Kept is the text of a class with the least id, where it stands with that id.
    """
    rows = docs.select(row_id(key, text).alias("id"), text_or_empty(text).alias("text"), text_hash(text).alias("h1"))
    signed = stored(
        rows.mapInArrow(_with_hashes, "id long, n long, marks binary, bands array<long>, h1 long, h2 long"), "signatures", TEXT_ROWS)
    texts = signed.groupBy("h1", "h2").agg(F.min("id").alias("text_id"))
    # a text is a node by its least id; further texts with that least id are nodes below -2**62
    spare = -F.xxhash64("text_id", "h1", "h2").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    place = F.row_number().over(Window.partitionBy("text_id").orderBy("h1", "h2"))
    texts = stored(texts.select("*", F.when(place == 1, F.col("text_id")).otherwise(spare).alias("node")), "text-nodes")
    names = texts.select(F.col("text_id").alias("id"), "h1", "h2", "node")
    reps = stored(signed.join(names, ["id", "h1", "h2"]).dropDuplicates(["node"])
                  .select(F.col("node").alias("id"), "n", "marks", "bands"), "signature-classes")
    spread = reps.select("id", F.posexplode("bands").alias("place", "band"))
    shared = spread.groupBy("band").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    stands = stored(spread.join(shared, "band"), "buckets")
    marks = reps.select("id", "n", "marks")

    # texts of the documents in buckets, read once
    wanted = names.join(stands.select(F.col("id").alias("node")).distinct(), "node").select("id", "h1", "node")
    near = stored(rows.join(wanted, ["id", "h1"]).select(F.col("node").alias("id"), "text").dropDuplicates(["id"]), "bucket-texts")
    first = _units(stands.filter(F.col("place") < FIRST_BANDS).withColumn("part", F.col("id")).join(marks, "id"))
    pairs = first.mapInArrow(_closest, "u long, v long").distinct()
    joined = pairs.join(near.toDF("u", "tu"), "u").join(near.toDF("v", "tv"), "v").select("u", "v", "tu", "tv")
    links = stored(joined.mapInArrow(_verified, "u long, v long"), "near-links", TEXT_ROWS)
    likely = stored(_units(_with_parts(stands, components(links)).join(marks, "id")).mapInArrow(_open_members, _UNIT), "open-members")
    sets = (near.join(likely.select("id").distinct(), "id").select("id", "text")
            .mapInArrow(_shingle_values, "id long, values binary, times binary"))
    unit = likely.join(reps.select("id", "bands"), "id").join(sets, "id")
    unit = (unit.select("band", "a", "b", "sub", "id", "part", "n", "marks", "bands", "values", "times")
            .repartition("band", "a", "b").sortWithinPartitions("band", "a", "b", "id"))
    comp = components(links.unionByName(unit.mapInArrow(_links_inside, "u long, v long")))
    classes = texts.join(comp, "node", "left").withColumn("c", F.coalesce("component", "node"))
    best = classes.groupBy("c").agg(F.min(F.struct("text_id", "h1", "h2")).alias("best"))
    by_text = classes.join(best, "c").select(
        "h1", "h2", "text_id", F.col("best.text_id").alias("class_id"),
        (F.struct("text_id", "h1", "h2") == F.col("best")).alias("first"))
    return signed.select("id", "h1", "h2").join(by_text, ["h1", "h2"]).select(
        "id", "h1", "text_id", "class_id", (F.col("first") & (F.col("id") == F.col("class_id"))).alias("kept"))


def _with_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures of id, text, h1 and a second hash of each text."""
    import xxhash

    for b in batches:
        at = 0
        for s in _signatures(iter([b])):
            digests = [xxhash.xxh3_64_digest(t.as_py().encode()) for t in b.column(1).slice(at, s.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [*s.columns, b.column(2).slice(at, s.num_rows), pa.array(np.frombuffer(b"".join(digests), np.int64))],
                [*s.schema.names, "h1", "h2"])
            at += s.num_rows


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class, with the least id; all columns stay.

    Of rows with the same id and text the one whose other columns come first (as JSON text) stays.
    """
    kept = classify(docs).filter("kept").select(F.col("id").alias("_id"), F.col("h1").alias("_h")).distinct()
    others = F.to_json(F.struct(F.lit(0).alias("_"), *[F.col(c) for c in docs.columns if c != "text"]))
    return (docs.withColumn("_key", row_id()).withColumn("_text", text_hash())
            .join(kept, (F.col("_key") == F.col("_id")) & (F.col("_text") == F.col("_h")))
            .withColumn("_n", F.row_number().over(Window.partitionBy("_key", "_text").orderBy(others)))
            .filter("_n = 1").select(*docs.columns))


def op4_near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return classify(docs).select(F.col("id").alias("doc_id"), "text_id", "class_id", "kept")
