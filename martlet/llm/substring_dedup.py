"""Operator 5: substring dedup with a compressed FM-index per shard.

A word goes if a window of 50 consecutive words that covers it also starts in a document
with a smaller doc_id.  ``llm.repeats`` brings the copies of each window to one shard.
There the segments are indexed (wavelet matrix over the words, in the order of the
suffixes) and streamed through backward search, all at a time, for their matching
statistics against documents with smaller ids; windows that start where the match is 50
words or longer are reported.

Null and empty texts have no words.  Of equal texts the one with the least doc_id is
searched, and the others go whole if they have a window.  Rows that repeat a doc_id do not
count against each other, but each is answered by its own text.  Rows without doc_id come after all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm.common import read_table
from martlet.llm.fm_index import FmIndex
from martlet.llm.repeats import WORDS_50, Windows, kept_words, repeated_spans, union_of_spans
from martlet.llm.texts import CHUNK, word_hashes, words


def runs_of(marked: np.ndarray) -> list[tuple[int, int]]:
    """(first, length) of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], marked.astype(np.int8), [0]))))
    return [(int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2])]


def earlier_windows(segments: list[bytes], windows: np.ndarray, least: np.ndarray,
                    spec: Windows = WORDS_50) -> list[list[tuple[int, int]]]:
    """Runs of windows of each segment that occur in a segment with a smaller least document."""
    data = np.frombuffer(b"".join(segments), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(s) for s in segments])))
    starts, ends, first = words(data, offsets)
    names, ids = np.unique(word_hashes(data, starts, ends), return_inverse=True)
    symbols = np.insert(ids + 1, first[1:], 0)
    order = np.unique(least, return_inverse=True)[1]
    index = FmIndex(symbols, len(names) + 1, order)
    found = index.matching_statistics(ids + 1, first[1:], order)
    return [runs_of(found[first[k]:first[k] + windows[k]] >= spec.width) for k in range(len(segments))]


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, h1, text, spans of words in; id, h1, words removed, the words that stay joined by one space out."""
    def batch(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
        return pa.RecordBatch.from_arrays(cols, ["id", "h1", "n_removed", "kept"])

    for b in batches:
        out, size = [], 0
        for i in range(b.num_rows):
            raw = (b.column(2)[i].as_py() or "").encode()
            starts, ends, _ = words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
            stay = np.ones(len(starts), bool)
            for s, e in union_of_spans([(x["a"], x["b"]) for x in b.column(3)[i].as_py()]):
                stay[s:e] = False
            out.append((b.column(0)[i].as_py(), b.column(1)[i].as_py(), int((~stay).sum()), kept_words(raw, starts[stay], ends[stay])))
            size += len(raw)
            if size >= CHUNK:
                yield batch(out)
                out, size = [], 0
        if out:
            yield batch(out)


def remove_earlier_windows(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(scanned rows of ``llm.repeats``, id, h1, n_removed and kept bytes of the searched texts that lose words)."""
    scanned, texts = repeated_spans(docs, WORDS_50, earlier_windows, earlier=True)
    return scanned, texts.select("id", "h1", "text", "spans").mapInArrow(_without, "id long, h1 long, n_removed long, kept binary")


NOTHING = hashlib.sha256(b"").hexdigest()


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned, cut = remove_earlier_windows(read_table(spark, sf_dir, "documents"))
    cut = cut.select("id", "h1", "n_removed", F.sha2("kept", 256).alias("sha"))
    return scanned.join(cut, ["id", "h1"], "left").select(
        "doc_id", F.col("n_units").alias("n_words"),
        F.when(F.col("full"), F.col("n_units")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("full"), F.lit(NOTHING)).otherwise(F.coalesce("sha", "whole")).alias("kept_sha256"))
