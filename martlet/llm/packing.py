"""Operator 7: packing token sequences by minimum bin slack.

A document's ids end with an end mark.  Whole windows of ``capacity`` ids are cut off its
front and are sequences of their own; the rest, shorter than a window, is an item.  Items
are dealt at random into groups of bounded size.  In a group, each window starts with the
longest item left; a subset-sum over the counted lengths, kept as the bits of an integer
and stopped once the window can be filled, tells the multiset that comes closest to its
end; going back through the kept steps gives how many items of each length to take, and
the same multiset is used again while the counts allow.  Only the last windows of a group
can have slack.  Ids never leave the task that made them: items carry length and checksum.

The ids are those of the ``tokenizers`` library for the vocabulary's JSON file, its special
tokens included.  ``tiktoken`` gives the same ids from the same vocabulary in a quarter of the
time, but its pattern matcher gives up on very long runs of white space; such a text is
encoded by ``tokenizers`` itself.

Null and empty texts are a single end mark.  Repeated rows and null doc_ids are items like
any other; they are dealt to groups by their place in the table as well, so copies of a row
do not meet in one group.  Texts of any length are encoded whole.  An empty table has no
pieces.  Other columns are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm.common import read_table, stored, text_or_empty

CAPACITY = 2048
END_ID = 1
GROUP_ITEMS = 40_000


def closest_multiset(counts: dict[int, int], order: list[int], capacity: int) -> dict[int, int]:
    """Counts of lengths that hold the first of ``order`` and whose sum comes closest to ``capacity``.

    ``order`` lists the lengths that are left, longest first.
    """
    taken = {order[0]: 1}
    want = capacity - order[0]
    if want <= 0:
        return taken
    reach, mask, goal = 1, (1 << (want + 1)) - 1, 1 << want
    steps: list[tuple[int, int, int]] = []  # length, copies, sums reached before
    for length in order:
        if length > want:
            continue
        left = min(counts[length] - taken.get(length, 0), want // length)
        copies = 1
        while left > 0 and not reach & goal:
            k = min(copies, left)
            grown = (reach | (reach << (k * length))) & mask
            if grown != reach:
                steps.append((length, k, reach))
                reach = grown
            left -= k
            copies *= 2
        if reach & goal:
            break
    at = reach.bit_length() - 1
    for length, k, before in reversed(steps):
        if not before >> at & 1:
            taken[length] = taken.get(length, 0) + k
            at -= k * length
    return taken


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Window number and place in it of each item (lengths 1..capacity)."""
    by_length: dict[int, list[int]] = {}
    for i in np.lexsort((np.arange(len(lengths)), -lengths)).tolist():
        by_length.setdefault(int(lengths[i]), []).append(i)
    counts = {k: len(v) for k, v in by_length.items()}
    order = sorted(counts, reverse=True)
    window, place, n = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    while order:
        taken = closest_multiset(counts, order, capacity)
        for _ in range(min(counts[k] // c for k, c in taken.items())):
            at = 0
            for k, c in taken.items():
                for _ in range(c):
                    i = by_length[k].pop()
                    window[i], place[i] = n, at
                    at += k
                counts[k] -= c
            n += 1
        if any(not counts[k] for k in taken):
            order = [k for k in order if counts[k]]
    return window, place


@lru_cache(maxsize=2)
def encoder(json_path: str, rank_path: str, pattern: str) -> Callable[[str], np.ndarray]:
    """A function from a text to its ids."""
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(json_path)
    special = {t.content: i for i, t in whole.get_added_tokens_decoder().items()}
    with open(rank_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
    fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # its matcher ran out of stack
            return np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


def cut_documents(docs: DataFrame, json_path: str, rank_path: str, pattern: str, capacity: int = CAPACITY) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(json_path, rank_path, pattern)
        for b in batches:
            doc, start, length, crc, total = [], [], [], [], []
            for i, text in enumerate(b.column(1)):
                ids = np.append(encode(text.as_py() or ""), END_ID).astype("<u4")
                for at in range(0, len(ids), capacity):
                    piece = ids[at:at + capacity]
                    doc.append(i)
                    start.append(at)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(doc, pa.int32())), *[pa.array(x, pa.int64()) for x in (start, length, crc, total)]],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    rows = docs.select(F.col("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(
        task, f"doc_id {dict(rows.dtypes)['doc_id']}, start long, length long, ids_crc32 long, doc_tokens long")


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Add sequence_id and offset.  ``pieces`` is a stored table of :func:`cut_documents`."""
    groups = pieces.count() // group_items + 1
    # the place in the stored table tells copies of a row apart
    dealt = pieces.withColumn("g", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id()),
                                          F.lit(groups)))

    def pack(items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["length", "doc_id", "start", "ids_crc32"], ignore_index=True)
        window, place = pack_lengths(items["length"].to_numpy(), capacity)
        return items.assign(sequence_id=items["g"] * (1 << 32) + window, offset=place).drop(columns="g")

    fields = ", ".join(f"{c} {t}" for c, t in pieces.dtypes)
    return dealt.groupBy("g").applyInPandas(pack, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, json_path: str, rank_path: str, pattern: str) -> DataFrame:
    return pack_pieces(stored(cut_documents(docs, json_path, rank_path, pattern), "pieces"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                          public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
