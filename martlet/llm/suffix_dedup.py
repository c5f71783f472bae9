"""Operator 3: removal of byte strings that occur more than once, by external induced suffix sorting.

A byte goes if a 200-byte string that covers it also starts anywhere else, in the same or
another text.  ``llm.repeats`` brings the copies of each such string to one shard.  There
the segments' suffixes are sorted by induction with disk-backed queues, which carry the
common prefixes along; neighbours in the order with a common prefix of 200 bytes or more
mark both their places.  Strings are judged on the input, not on what is left.

Null and empty texts have no bytes.  A text that occurs twice as a whole (repeated rows
included) goes whole if it has 200 bytes.  Rows that repeat a doc_id with other texts are
texts of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm.common import read_table
from martlet.llm.repeats import BYTES_200, Windows, repeated_spans, row_id, text_hash, union_of_spans
from martlet.llm.substring_dedup import runs_of
from martlet.llm.suffix_sort import sort_suffixes
from martlet.llm.texts import CHUNK


def repeated_windows(segments: list[bytes], windows: np.ndarray, least: np.ndarray,
                     spec: Windows = BYTES_200) -> list[list[tuple[int, int]]]:
    """Runs of windows of each segment that also start at another place of the shard."""
    sizes = np.array([len(s) for s in segments])
    starts = np.concatenate(([1], 1 + np.cumsum(sizes + 1)))
    text = np.zeros(int(starts[-1]), np.int32)
    inside = np.ones(len(text), bool)
    inside[0] = False
    inside[starts[1:] - 1] = False
    text[inside] = np.frombuffer(b"".join(segments), np.uint8)
    text[inside] += 1
    marked = np.zeros(len(text), bool)
    greater = [0]  # the place emitted last

    def mark(places: np.ndarray, lcp: np.ndarray) -> None:
        equal = lcp >= spec.width
        marked[places[equal]] = True
        marked[np.concatenate((greater, places[:-1]))[equal]] = True
        greater[0] = int(places[-1])

    sort_suffixes(text, 257, mark)
    return [runs_of(marked[a:a + n]) for a, n in zip(starts[:-1].tolist(), windows.tolist())]


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, h1, text, spans of bytes in; id, h1, bytes and runs removed, the bytes that stay out."""
    def batch(rows: list[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                          ["id", "h1", "n_removed", "n_spans", "kept"])

    for b in batches:
        out, size = [], 0
        for i in range(b.num_rows):
            raw = (b.column(2)[i].as_py() or "").encode()
            spans = union_of_spans([(x["a"], x["b"]) for x in b.column(3)[i].as_py()])
            edges = [0, *[e for s in spans for e in s], len(raw)]
            kept = b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2]))
            out.append((b.column(0)[i].as_py(), b.column(1)[i].as_py(), len(raw) - len(kept), len(spans), kept))
            size += len(raw)
            if size >= CHUNK:
                yield batch(out)
                out, size = [], 0
        if out:
            yield batch(out)


def remove_repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(scanned rows of ``llm.repeats``; id, h1, n_removed, n_spans and kept bytes of the searched texts that lose bytes)."""
    scanned, texts = repeated_spans(docs, BYTES_200, repeated_windows, earlier=False)
    return scanned, texts.select("id", "h1", "text", "spans").mapInArrow(
        _without, "id long, h1 long, n_removed long, n_spans long, kept binary")


def _as_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, h1 and kept bytes in; id, h1 and text out, without the bytes of characters cut in part."""
    for b in batches:
        kept = [x.as_py().decode("utf-8", "ignore") for x in b.column(2)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(kept, pa.string())], ["_id", "_h", "_kept"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with their repeated bytes removed, all columns; n_chars follows.

    What is left of a character cut in part goes too.  A text that occurs twice as a whole
    becomes empty if it has 200 bytes.
    """
    scanned, cut = remove_repeats(docs)
    changed = (cut.select("id", "h1", "kept").mapInArrow(_as_text, "_id long, _h long, _kept string")
               .unionByName(scanned.filter("full").select(F.col("id").alias("_id"), F.col("h1").alias("_h"), F.lit("").alias("_kept")))
               .groupBy("_id", "_h").agg(F.min("_kept").alias("_kept")))
    out = docs.withColumn("_key", row_id()).withColumn("_text", text_hash()).join(
        changed, (F.col("_key") == F.col("_id")) & (F.col("_text") == F.col("_h")), "left")
    out = out.withColumn("text", F.coalesce("_kept", "text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_kept").isNotNull(), F.length("text").cast("long"))
                             .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


NOTHING = hashlib.sha256(b"").hexdigest()


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned, cut = remove_repeats(read_table(spark, sf_dir, "documents"))
    cut = cut.select("id", "h1", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha"))
    full = F.col("full")
    return scanned.join(cut, ["id", "h1"], "left").select(
        "doc_id", F.col("n_units").alias("n_bytes"),
        F.when(full, F.col("n_units")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(full, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(full, F.lit(NOTHING)).otherwise(F.coalesce("sha", "whole")).alias("kept_sha256"))
