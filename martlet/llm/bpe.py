"""Operator 6: byte-level BPE encoding and decoding in length-bucketed numpy matrices.

The vocabulary's merge table is an open-addressed hash table in numpy: (left id, right id)
-> id of the joined token, which is also its rank.  Distinct unknown pieces of a run of
documents are put in matrices by length (2, 4, 8, ... ids wide, padded).  Each round finds
every row's leftmost pair of least rank, merges it, and drops finished rows; ranks are
kept beside the ids, so a round looks up only the two pairs next to a merge.  A piece that
is a token as a whole is that token, as in the usual library.  Pieces over ``WIDEST``
bytes are merged one by one with a heap over a linked list, which gives the same ids.

Null and empty texts have no ids.  Piece results are remembered up to a fixed number,
then forgotten; this changes no result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm.common import read_table, text_or_empty

NONE = np.int64(1 << 40)  # no merge
WIDEST = 1024
CELLS = 1 << 20  # ids in one matrix
REMEMBERED = 250_000
RUN_BYTES = 1 << 20


class PairTable:
    """(left, right) -> joined id by open addressing with linear steps."""

    def __init__(self, left: np.ndarray, right: np.ndarray, joined: np.ndarray):
        size = 16
        while size < 3 * len(left):
            size *= 2
        self.mask = np.uint64(size - 1)
        self.keys = np.full(size, -1, np.int64)
        self.joined = np.full(size, NONE, np.int64)
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        at, todo = self._home(key), np.arange(len(key))
        while len(todo):
            free = self.keys[at[todo]] < 0
            self.keys[at[todo[free]]] = key[todo[free]]  # of several at one place the last stays
            placed = self.keys[at[todo]] == key[todo]
            self.joined[at[todo[placed]]] = joined[todo[placed]]
            todo = todo[~placed]
            at[todo] = (at[todo] + 1) & int(self.mask)

    def _home(self, key: np.ndarray) -> np.ndarray:
        h = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((h >> np.uint64(29)) & self.mask).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Joined id of each pair, NONE where there is none (a negative id never joins)."""
        key = (left << 32) | right
        out = np.full(len(key), NONE, np.int64)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        at = self._home(key[todo])
        while len(todo):
            there = self.keys[at]
            hit = there == key[todo]
            out[todo[hit]] = self.joined[at[hit]]
            on = ~hit & (there >= 0)
            todo, at = todo[on], (at[on] + 1) & int(self.mask)
        return out


class ByteBpe:
    """Encoder and decoder for a rank file; made once per process by :func:`vocabulary`."""

    def __init__(self, rank_path: str, pattern: str):
        with open(rank_path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.split = regex.compile(pattern).findall
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items()
                 for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        self.pairs = PairTable(*np.array(pairs, np.int64).reshape(-1, 3).T)
        # the same pairs one by one, for long pieces
        self.joined = {(left << 32) | right: r for left, right, r in pairs}
        self.bytes_of = {str(r): t for t, r in self.ranks.items()}
        self.known: dict[str, str] = {}

    # pieces -> ids

    def merge_pieces(self, pieces: Sequence[bytes]) -> list[list[int]]:
        """Ids of each piece."""
        out: list[list[int]] = [[] for _ in pieces]
        by_width: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[i] = [whole]
            elif len(p) > WIDEST:
                out[i] = self._merge_long(p)
            elif p:
                by_width.setdefault(1 << (len(p) - 1).bit_length(), []).append(i)
        for width, members in by_width.items():
            step = max(1, CELLS // width)
            for k in range(0, len(members), step):
                self._merge_matrix([pieces[i] for i in members[k:k + step]], width, members[k:k + step], out)
        return out

    def _merge_matrix(self, pieces: list[bytes], width: int, where: list[int], out: list[list[int]]) -> None:
        body = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        n = np.array([len(p) for p in pieces])
        ids = np.where(np.arange(width) < n[:, None], self.byte_ids[body], -1)
        row = np.array(where)
        ranks = np.full(ids.shape, NONE, np.int64)  # of the pair that starts at each place
        ranks[:, :-1] = self.pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
        places = np.arange(width)
        while len(ids):
            at = ranks.argmin(1)  # the leftmost of the least
            all_rows = np.arange(len(ids))
            joined = ranks[all_rows, at]
            done = joined == NONE
            if done.any():
                for r, line, k in zip(row[done], ids[done].tolist(), (ids[done] >= 0).sum(1)):
                    out[r] = line[:k]
                go = ~done
                ids, ranks, row, at, joined = ids[go], ranks[go], row[go], at[go], joined[go]
                all_rows = all_rows[:len(ids)]
                if not len(ids):
                    return
                used = int((ids >= 0).sum(1).max())
                ids, ranks, places = ids[:, :used], ranks[:, :used], places[:used]
            # close the gap: what follows the merged pair moves one place left
            after = places > at[:, None]
            left_ids = np.concatenate((ids[:, 1:], np.full((len(ids), 1), -1)), 1)
            left_ranks = np.concatenate((ranks[:, 1:], np.full((len(ids), 1), NONE)), 1)
            ids = np.where(after, left_ids, ids)
            ranks = np.where(after, left_ranks, ranks)
            ids[all_rows, at] = joined
            follows = np.where(at + 1 < ids.shape[1], ids[all_rows, np.minimum(at + 1, ids.shape[1] - 1)], -1)
            before = np.where(at > 0, ids[all_rows, np.maximum(at - 1, 0)], -1)
            ranks[all_rows, at] = self.pairs.find(joined, follows)
            inner = at > 0
            ranks[all_rows[inner], at[inner] - 1] = self.pairs.find(before[inner], joined[inner])

    def _merge_long(self, piece: bytes) -> list[int]:
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        prev, nxt = list(range(-1, n - 1)), [*range(1, n), -1]
        first = self.pairs.find(np.array(ids[:-1], np.int64), np.array(ids[1:], np.int64))
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)

        def push(i: int, j: int) -> None:
            r = self.joined.get((ids[i] << 32) | ids[j])
            if r is not None:
                heapq.heappush(heap, (r, i, ids[i], ids[j]))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue  # merged away meanwhile
            ids[i], ids[j] = r, -1
            nxt[i] = nxt[j]
            if nxt[i] >= 0:
                prev[nxt[i]] = i
                push(i, nxt[i])
            if prev[i] >= 0:
                push(prev[i], i)
        return [x for x in ids if x >= 0]

    # texts -> ids as decimal text

    def encode_texts(self, texts: Sequence[str]) -> list[str]:
        """The ids of each text in decimal, joined by one space."""
        split = [self.split(t) for t in texts]
        unknown = list({p for pieces in split for p in pieces if p not in self.known})
        if len(self.known) + len(unknown) > REMEMBERED:
            self.known.clear()
            unknown = list({p for pieces in split for p in pieces})
        for p, ids in zip(unknown, self.merge_pieces([p.encode() for p in unknown])):
            self.known[p] = " ".join(map(str, ids))
        return [" ".join(map(self.known.__getitem__, pieces)) for pieces in split]

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.split(" "))) if ids else b""


@lru_cache(maxsize=2)
def vocabulary(rank_path: str, pattern: str) -> ByteBpe:
    return ByteBpe(rank_path, pattern)


def _runs(col: pa.Array) -> Iterator[list[str]]:
    """Texts of a column in runs of about RUN_BYTES."""
    run, size = [], 0
    for x in col:
        t = x.as_py() or ""
        run.append(t)
        size += len(t)
        if size >= RUN_BYTES:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array of int) of each text."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(rank_path, pattern)
        for b in batches:
            at = 0
            for run in _runs(b.column(1)):
                ids = [[int(x) for x in line.split(" ")] if line else [] for line in bpe.encode_texts(run)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(run)), pa.array(ids, pa.list_(pa.int32()))],
                                                 ["doc_id", "ids"])
                at += len(run)

    rows = docs.select(F.col(key).alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(task, f"doc_id {dict(rows.dtypes)['doc_id']}, ids array<int>")


def decode_documents(encoded: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id, bytes (binary) of rows with doc_id and ids."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(rank_path, pattern)
        for b in batches:
            body = [bpe.decode(" ".join(map(str, x.as_py() or ()))) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(body, pa.binary())], ["doc_id", "bytes"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(task, f"doc_id {dict(rows.dtypes)['doc_id']}, bytes binary")


def token_digests(docs: DataFrame, rank_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the bytes decoded from them.

    The ids are encoded and decoded in the task that has the text, so they are never moved.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(rank_path, pattern)
        for b in batches:
            at = 0
            for run in _runs(b.column(1)):
                lines = bpe.encode_texts(run)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(at, len(run)),
                    pa.array([x.count(" ") + 1 if x else 0 for x in lines], pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in lines]),
                    pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in lines]),
                ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                at += len(run)

    rows = docs.select(F.col(key).alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(
        task, f"doc_id {dict(rows.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_digests(read_table(spark, sf_dir, "documents"),
                         public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
