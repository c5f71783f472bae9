"""Operator 2: near-duplicate embeddings by E8 lattice hashing.

Unit vectors are projected at random to 8 dimensions (per block), scaled, shifted and
decoded to the nearest E8 lattice point, in several tables.  A vector stands in its own
cell and in the nearest neighbouring cells of each table; two vectors meet if they share a
cell.  Vectors that meet are compared by their cosine in double precision, as matrix
products inside a cell.  Links are counted, not written out: a linked pair counts in the
first cell the two share and nowhere else, and each cell passes on only a spanning star of
its links, from which the components follow.

Equal vectors are one class with a count.  A cell with more than ``BLOCK`` classes is cut
into blocks and every pair of blocks is a unit of work, so that no task holds a whole hot
cell.  Vectors of different lengths share no cell and never link.  A vector that is null, zero or holds a
null or non-finite component links with nothing, and neither does a row without vec_id.
The number of lattice blocks in a key follows the number of classes, so that cells stay
small; with more blocks there are more tables and probes (see :func:`hashing`).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm.common import read_table, stored
from martlet.llm.components import components
from martlet.llm.lattice import Tables

COSINE = 0.95
BLOCK = 2000
SCALE = 5.0


def hashing(classes: int) -> dict[str, int]:
    """Blocks, tables and probes for a number of vectors.

    One block has about a thousand well-filled cells; another is added per factor of a thousand
    beyond a million vectors.  At cosine 0.95 a pair shares a cell with probability 0.86 a
    table with one block (0.9996 over four), more for closer pairs.
    """
    blocks = 1 + max(0, math.ceil(math.log(max(classes, 1) / 1e6, 1e3)))
    return {"blocks": blocks, "tables": 4 * 3 ** (blocks - 1), "probes": 2 * blocks}


@lru_cache(maxsize=8)
def _tables(dims: int, blocks: int, tables: int, probes: int) -> Tables:
    return Tables(dims, tables, blocks, SCALE, probes, seed=7 + dims)


def _matrix(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat float64 values and offsets of a list column."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    off = np.asarray(col.offsets)
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64), off - off[0]


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # keeps squares of very large or small values finite
    return x / np.sqrt(np.square(x).sum(1, keepdims=True))


def _with_keys(shape: dict[str, int]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, off = _matrix(b.column(1))
            dims = np.diff(off)
            for d in np.unique(dims):
                rows = np.flatnonzero(dims == d)
                units = _units(flat[off[rows][:, None] + np.arange(d)])
                keys = _tables(int(d), **shape).keys(units).reshape(len(rows), -1)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), keys.shape[1]).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), lists], ["id", "keys"])
    return task


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest member reachable from each of n members over links (i, j)."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _first_meeting(keys_i: np.ndarray, keys_j: np.ndarray, cell: int, tables: int) -> np.ndarray:
    """Whether ``cell`` is the least key that both rows of each pair have."""
    a = keys_i.reshape(len(keys_i), tables, -1)
    b = keys_j.reshape(len(keys_j), tables, -1)
    both = (a[:, :, :, None] == b[:, :, None, :]).any(3)
    return np.where(both, a, np.iinfo(np.int64).max).reshape(len(a), -1).min(1) == cell


def _compare(cell: int, same: bool, sub: np.ndarray, first: int, ids, copies, keys, units, tables: int):
    """Links of one unit of work: (id, weighted links, root id) of each member that has a link here."""
    if same:
        left = right = np.arange(len(ids))
    else:
        left, right = np.flatnonzero(sub == first), np.flatnonzero(sub != first)
    found_i, found_j = [], []
    for k in range(0, len(left), 512):
        hit = units[left[k:k + 512]] @ units[right].T >= COSINE
        if same:
            hit &= right[None, :] > left[k:k + 512, None]
        i, j = np.nonzero(hit)
        found_i.append(left[k:k + 512][i])
        found_j.append(right[j])
    if not found_i:
        return None
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    if not len(i):
        return None
    links = np.zeros(len(ids), np.int64)
    for k in range(0, len(i), 20_000):
        p, q = i[k:k + 20_000], j[k:k + 20_000]
        counts = _first_meeting(keys[p], keys[q], cell, tables)
        np.add.at(links, p[counts], copies[q[counts]])
        np.add.at(links, q[counts], copies[p[counts]])
    root = _roots(len(ids), i, j)
    member = np.unique(np.concatenate((i, j)))
    return ids[member], links[member], ids[root[member]]


def _links_in_cells(tables: int):
    """Sorted rows (cell, a, b, sub, id, copies, keys, v) in; (id, links, root) out."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def work(t: pa.Table) -> Iterator[pa.RecordBatch]:
            t = t.combine_chunks()
            cell, a, b, sub, ids, copies = (t.column(c).to_numpy() for c in range(6))
            n = len(ids)
            if n < 2:
                return
            keys = np.asarray(t.column(6).combine_chunks().flatten()).reshape(n, -1)
            flat, off = _matrix(t.column(7))
            dims = np.diff(off)
            cuts = np.flatnonzero((np.diff(cell) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0)) + 1
            out: list[tuple] = []
            for lo, hi in zip([0, *cuts], [*cuts, n]):
                for d in np.unique(dims[lo:hi]):  # one, as keys hold the length, but for a chance equality
                    r = lo + np.flatnonzero(dims[lo:hi] == d)
                    if len(r) < 2:
                        continue
                    units = _units(flat[off[r][:, None] + np.arange(d)])
                    got = _compare(int(cell[lo]), a[lo] == b[lo], sub[r], int(a[lo]), ids[r], copies[r], keys[r],
                                   units, tables)
                    if got is not None:
                        out.append(got)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([x[k] for x in out])) for k in range(3)], ["id", "links", "root"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = [batch.column(c).to_numpy() for c in range(3)]
            last = np.flatnonzero((key[0] != key[0][-1]) | (key[1] != key[1][-1]) | (key[2] != key[2][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if kept and any(kept[-1].column(c)[-1].as_py() != key[c][0] for c in range(3)):
                yield from work(pa.Table.from_batches(kept))
                kept = []
            if cut:
                yield from work(pa.Table.from_batches([*kept, batch.slice(0, cut)]))
                kept = []
            kept.append(batch.slice(cut))
        if kept:
            yield from work(pa.Table.from_batches(kept))
    return task


def link_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
                 shape: dict[str, int] | None = None, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = (F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True))
              & F.exists("v", lambda x: x != 0))
    rows = rows.withColumn("ok", F.coalesce(usable, F.lit(False)))
    # adding 0 makes -0 and 0 one value
    marked = rows.select("vec_id", "ok", F.when(F.col("ok"), F.transform("v", lambda x: x + F.lit(0).cast("float"))).alias("v"))
    marked = marked.withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(1), F.col("v")))
    classes = stored(marked.filter("ok").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v")), "vector-classes")
    shape = shape or hashing(classes.count())

    keyed = stored(classes.select("id", "v").mapInArrow(_with_keys(shape), "id long, keys array<long>"), "cells")
    stands = keyed.select("id", F.explode("keys").alias("cell")).distinct()
    sizes = stands.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    units = (stands.join(sizes, "cell").withColumn("nb", blocks)
             .withColumn("sub", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int"))
             .select("id", "cell", "sub", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("o")))
    work = (units.select("id", "cell", F.least("sub", "o").alias("a"), F.greatest("sub", "o").alias("b"), "sub")
            .join(classes.select("id", "copies", "v"), "id").join(keyed, "id")
            .select("cell", "a", "b", "sub", "id", "copies", "keys", "v")
            .repartition("cell", "a", "b").sortWithinPartitions("cell", "a", "b", "id"))
    linked = stored(work.mapInArrow(_links_in_cells(shape["tables"]), "id long, links long, root long"), "vector-links")

    links = linked.groupBy("id").agg(F.sum("links").alias("links"))
    comp = components(linked.select(F.col("id").alias("u"), F.col("root").alias("v")))
    by_class = (classes.select("h1", "h2", "id", "copies").join(links, "id", "left")
                .join(comp.withColumnRenamed("node", "id"), "id", "left")
                .select("h1", "h2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"),
                        F.coalesce("component", "id").alias("c")))
    out = marked.select("vec_id", "ok", F.when(F.col("ok"), F.col("h1")).alias("h1"),
                        F.when(F.col("ok"), F.col("h2")).alias("h2")).join(by_class, ["h1", "h2"], "left")
    component = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(read_table(spark, sf_dir, "embeddings"))
