"""Operator 12: language identification with hyperdimensional profiles.

Every letter has a random vector of ``DIMENSIONS`` signs, made by a rule from its code point.
An n-gram of letters is bound into one vector: the letters' vectors, each rotated by its place
from the end, are multiplied.  A text's vector is the bundle (sum) of its n-grams' vectors, and
a language's prototype is the bundle of its learned texts.  A text gets the language
whose prototype has the greatest cosine with the text's vector; the mean of the prototypes'
directions, which all languages share, is taken off both sides first.

Letters are Unicode letters in lower case; every run of other characters is one space, also
before and after the text.  A null text, or one without a letter, is ``und`` with score 0;
equal cosines go to the first language in alphabetical order.  Texts of any length are taken
whole; n-grams are bundled in blocks of bounded size.  Sums are of whole numbers, so neither
the order of the rows nor their partitions change a result.  Repeated rows count again in
learning and are answered alike.  Without learned rows every text is ``und``.  Other columns are
not read.

Learning sums vectors per task and then per language in Spark; the driver gets one vector of
``DIMENSIONS`` numbers per language, whatever the number of documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm.common import read_table
from martlet.llm.texts import mix

DIMENSIONS = 1024
NGRAM = 3
BLOCK = 16384          # n-gram vectors made together
SMALL_SPACE = 1 << 22  # n-gram names that are counted in a table
RUN_LETTERS = 1 << 19  # letters of texts bundled together
UNDETERMINED = "und"
HELD_OUT = 2
EXACT_IN_SINGLE = 1 << 24


class _Letters:
    """Code point -> code point of the letter in lower case, 32 for what is no letter; filled as points appear."""

    def __init__(self):
        self.table = np.zeros(0x110000, np.uint32)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        out = self.table[points]
        if not out.all():
            for k in np.unique(points[out == 0]).tolist():
                self.table[k] = ord(chr(k).lower()[0]) if chr(k).isalpha() else 32
            out = self.table[points]
        return out


@lru_cache(maxsize=1)
def _letters() -> _Letters:
    return _Letters()


def letter_numbers(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts' letters, one 32 between and around words, and each one's text."""
    points = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts])
    x = _letters()(points)
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != 32) | (x[:-1] != 32) | (row[1:] != row[:-1])
    return x[keep], row[keep]


def letter_signs(points: np.ndarray, dims: int = DIMENSIONS) -> np.ndarray:
    """A row of ``dims`` bits (0: plus, 1: minus) per code point."""
    words = np.arange(dims // 64, dtype=np.uint64)
    seed = mix(mix(points.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))[:, None] + words[None, :] * np.uint64(0x9E3779B97F4A7C15))
    return np.unpackbits(seed.astype("<u8").view(np.uint8), axis=1)


def bind(grams: np.ndarray, dims: int = DIMENSIONS) -> np.ndarray:
    """A row of signs (+1, -1) per n-gram; ``grams`` has a row of code points each."""
    letters, at = np.unique(grams, return_inverse=True)
    bits = letter_signs(letters, dims)
    at = at.reshape(grams.shape)
    out = np.zeros((len(grams), dims), np.uint8)
    for k in range(grams.shape[1]):
        # signs multiply as bits add; the rotation keeps the order of the letters
        out ^= np.roll(bits, grams.shape[1] - 1 - k, axis=1)[at[:, k]]
    return 1 - 2 * out.astype(np.int8)


class Bundler:
    def __init__(self, dims: int = DIMENSIONS, ngram: int = NGRAM):
        self.dims, self.ngram = dims, ngram

    def bundle(self, texts: list[str]) -> np.ndarray:
        """A row of whole numbers (as doubles) per text; zero where there is no letter."""
        n, out = self.ngram, np.zeros((len(texts), self.dims))
        x, row = letter_numbers(texts)
        if len(x) < n:
            return out
        number_of = np.zeros(int(x.max()) + 1, np.int64)
        number_of[x] = 1
        letters = np.flatnonzero(number_of).astype(np.uint32)
        number_of[letters] = np.arange(len(letters))
        at = number_of[x]
        name = at[:len(x) - n + 1]
        for k in range(1, n):
            name = name * len(letters) + at[k:len(x) - n + 1 + k]
        inside = row[n - 1:] == row[:len(name)]  # an n-gram does not reach over a text's end
        name, row = name[inside], row[:len(inside)][inside]
        space = len(letters) ** n
        if space <= SMALL_SPACE:
            seen = np.zeros(space, bool)
            seen[name] = True
            kinds = np.flatnonzero(seen)
            number_of = np.zeros(space, np.int32)
            number_of[kinds] = np.arange(len(kinds), dtype=np.int32)
            kind = number_of[name].astype(np.int64)
        else:
            kinds, kind = np.unique(name, return_inverse=True)
        exact = np.float32 if len(name) < EXACT_IN_SINGLE else np.float64
        blocks = [slice(None)]
        if len(kinds) > BLOCK:
            order = np.argsort(kind, kind="stable")
            kind, row = kind[order], row[order]
            edges = np.searchsorted(kind, np.arange(0, len(kinds) + BLOCK, BLOCK))
            blocks = [slice(a, b) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
        for k, part in enumerate(blocks):
            block = kinds[k * BLOCK:(k + 1) * BLOCK]
            grams = np.stack([letters[block // len(letters) ** (n - 1 - j) % len(letters)] for j in range(n)], axis=1)
            counts = np.bincount(row[part] * len(block) + kind[part] - k * BLOCK, minlength=len(texts) * len(block))
            out += counts.reshape(len(texts), len(block)).astype(exact) @ bind(grams, self.dims).astype(exact)
        return out


def _runs(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of about RUN_LETTERS characters."""
    run, size, first = [], 0, 0
    for i, t in enumerate(texts):
        run.append(t or "")
        size += len(t or "")
        if size >= RUN_LETTERS:
            yield first, run
            run, size, first = [], 0, i + 1
    if run:
        yield first, run


def _learn(dims: int, ngram: int):
    """lang, text in; lang and the task's bundle per language out (whole numbers)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundler, sums = Bundler(dims, ngram), {}
        for b in batches:
            langs = b.column(0).to_pylist()
            for first, run in _runs(b.column(1).to_pylist()):
                vectors = bundler.bundle(run)
                here = np.array(langs[first:first + len(run)], object)
                for lang in set(here.tolist()):
                    part = np.rint(vectors[here == lang].sum(axis=0)).astype(np.int64)
                    sums[lang] = sums.get(lang, 0) + part
        for lang, v in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dims), pa.array(np.arange(dims, dtype=np.int32)), pa.array(v)], ["lang", "i", "v"])
    return task


class Profiles:
    """Centred unit prototypes, languages in alphabetical order."""

    def __init__(self, sums: dict[str, np.ndarray]):
        self.langs = sorted(sums)
        unit = np.array([_unit(sums[k].astype(float)) for k in self.langs]) if sums else np.zeros((0, 0))
        # with one language there is nothing shared to take off
        self.shared = unit.mean(axis=0) if len(self.langs) > 1 else np.zeros(unit.shape[1:])
        self.prototypes = np.array([_unit(u - self.shared) for u in unit])

    def compare(self, vectors: np.ndarray) -> np.ndarray:
        """Cosine of each vector with each prototype."""
        length = np.linalg.norm(vectors, axis=1, keepdims=True)
        centred = vectors / np.where(length == 0, 1, length) - self.shared
        length = np.linalg.norm(centred, axis=1, keepdims=True)
        return (centred / np.where(length == 0, 1, length)) @ self.prototypes.T


def _unit(v: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(v)
    return v / length if length else v


def learn(labelled: DataFrame, lang: str = "lang", text: str = "text", dims: int = DIMENSIONS, ngram: int = NGRAM) -> Profiles:
    """Prototypes of the languages of ``labelled``; rows without a language or without a letter teach nothing."""
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang is not null and text is not null")
    parts = rows.mapInArrow(_learn(dims, ngram), "lang string, i int, v long")
    sums: dict[str, np.ndarray] = {}
    for r in parts.groupBy("lang", "i").agg(F.sum("v").alias("v")).collect():  # dims rows per language
        sums.setdefault(r.lang, np.zeros(dims, np.int64))[r.i] = r.v
    return Profiles({k: v for k, v in sums.items() if v.any()})


def identify(docs: DataFrame, profiles: Profiles, key: str = "doc_id", text: str = "text",
             dims: int = DIMENSIONS, ngram: int = NGRAM) -> DataFrame:
    """doc_id, lang_pred, score (the cosine, 0 at least) and margin over the next language."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundler = Bundler(dims, ngram)
        for b in batches:
            for first, run in _runs(b.column(1).to_pylist()):
                vectors = bundler.bundle(run)
                known = vectors.any(axis=1) & bool(profiles.langs)
                pred, score, margin = [UNDETERMINED] * len(run), np.zeros(len(run)), np.zeros(len(run))
                if profiles.langs:
                    cosines = np.clip(profiles.compare(vectors), -1.0, 1.0)
                    best = cosines.argmax(axis=1)
                    ranked = np.sort(cosines, axis=1)
                    for i in np.flatnonzero(known).tolist():
                        pred[i] = profiles.langs[best[i]]
                    score = np.where(known, np.maximum(ranked[:, -1], 0.0), 0.0)
                    if len(profiles.langs) > 1:
                        margin = np.where(known, ranked[:, -1] - ranked[:, -2], 0.0)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(run)), pa.array(pred), pa.array(score), pa.array(margin)],
                    ["doc_id", "lang_pred", "score", "margin"])

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(task, f"doc_id {dict(rows.dtypes)['doc_id']}, lang_pred string, score double, margin double")


def held_out(key: str = "doc_id") -> Column:
    """Documents that are never learned from; a null id is none of them."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    profiles = learn(docs.filter(~held_out()))
    return identify(docs, profiles).withColumn("held_out", held_out()).select(
        "doc_id", "held_out", "lang_pred", "score", "margin")
