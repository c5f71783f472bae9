"""Operator 1: quality classifier by regularised quadratic discriminant analysis.

Each whole text gives a short vector of transformed statistics (shares of symbols,
capitals, repeated words and so on).  The sums of the vectors and of their products over
the labelled training rows, added up by Spark, give each class its mean and a covariance
shrunk towards the pooled covariance and its diagonal.  The Cholesky factors are computed
once on the driver and cached in the model; a score is the logistic of the difference of
the two Gaussian log densities plus the log odds of the classes.  Labels, language, source and ids never enter a score.

Null and empty texts have the vector of a text without letters.  Training uses labels
0 and 1 with a doc_id; a document labelled more than once takes the larger label, and
repeated rows of a document count once each.  If a class has no training row, every score
is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm.common import read_table, stored, text_or_empty
from martlet.llm.texts import chunks, word_hashes, words

THRESHOLD = 0.3
SHRINK_POOLED, SHRINK_DIAGONAL = 0.1, 0.05
FEATURES = ("symbols", "bangs", "bars", "capitals", "digits", "stops", "other", "repeated", "distinct", "word_length",
            "line_length", "word_spread")

LEAN_CHARS, LEAN_WORDS = 150.0, 25.0

# Byte classes, a fixed value each: 1 symbol, 2 '!', 3 '|', 4 capital, 5 digit, 6 stop, 7 other mark, 8 letter
_CLASS = np.zeros(256, np.uint8)
for _codes, _k in ((b"#*$%&<>@^~=+\\{}[]_", 1), (b"!", 2), (b"|", 3), (bytes(range(65, 91)), 4),
                   (b"0123456789", 5), (b".,;:?", 6), (b"\"'()/-`", 7), (bytes(range(97, 123)), 8),
                   (bytes(range(0xC3, 0xF5)), 8)):
    _CLASS[list(_codes)] = _k


def _per_doc(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.float64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def vectors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The transformed statistics of each document, a row each."""
    kind = _CLASS[data]
    # capitals of the two-byte range: C3 followed by 80..9E
    if len(data) > 1:
        accented = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
        kind[:-1][accented] = 4
    n = {k: _per_doc(kind == k, offsets) for k in range(1, 9)}
    lines = _per_doc(data == 10, offsets) + 1
    starts, ends, first = words(data, offsets)
    h = word_hashes(data, starts, ends)
    lens = (ends - starts).astype(np.float64)
    n_words = np.diff(first).astype(np.float64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    order = np.lexsort((h, doc))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (doc[1:] != doc[:-1])
    distinct = np.bincount(doc, weights=new, minlength=len(n_words)) if len(h) else np.zeros(len(n_words))
    chars = _per_doc(lens, first)
    w = np.maximum(n_words, 1.0)
    mean_len = _per_doc(lens, first) / w
    spread = np.sqrt(np.maximum(_per_doc(lens * lens, first) / w - mean_len ** 2, 0))
    # shares lean on a usual value, so that a short text is not judged by a few characters
    share = lambda x, of, usual, lean: np.sqrt((x + usual * lean) / (of + lean))
    part = lambda k, usual: share(n[k], chars, usual, LEAN_CHARS)
    weight = n_words / (n_words + LEAN_WORDS)
    return np.column_stack([
        part(1, 0.001), part(2, 0.001), part(3, 0.001), share(n[4], n[4] + n[8], 0.03, LEAN_CHARS), part(5, 0.001),
        part(6, 0.02), part(7, 0.001), share(_per_doc(again, first), w, 0.01, LEAN_WORDS),
        np.log((distinct + 1) / (n_words + 1)) / np.log(n_words + 3), weight * (np.log1p(mean_len) - 1.85),
        weight * np.log1p(n_words / lines) / 4, weight * (np.log1p(spread) - 1.3)])


def _vectors_in_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id and text in; doc_id and vector out."""
    for b in batches:
        for rows, data, offsets in chunks(b.column(1)):
            x = vectors(data, offsets)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(rows.start, rows.stop - rows.start), flat], ["doc_id", "x"])


@dataclass(frozen=True)
class Model:
    """Per class: mean, inverse of the Cholesky factor and half its log determinant; log odds."""

    means: np.ndarray | None
    roots: np.ndarray | None
    half_logdet: np.ndarray | None
    log_odds: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), 1 / (1 + np.exp(-self.log_odds)))
        density = [-0.5 * np.square((x - self.means[k]) @ self.roots[k].T).sum(1) - self.half_logdet[k]
                   for k in (0, 1)]
        z = density[1] - density[0] + self.log_odds
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_moments(n: np.ndarray, sums: np.ndarray, products: np.ndarray) -> Model:
    """Model from the counts (2), sums (2, d) and sums of products (2, d, d) of the classes."""
    log_odds = float(np.log((n[1] + 0.5) / (n[0] + 0.5))) if n.sum() else 0.0
    if n.min() < 1:
        return Model(None, None, None, log_odds)
    means = sums / n[:, None]
    cov = products / n[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = (cov * n[:, None, None]).sum(0) / n.sum()
    floor = 1e-6 + 1e-3 * np.diag(np.diag(pooled))
    roots, half = [], []
    for k in (0, 1):
        own = 1 - SHRINK_POOLED - SHRINK_DIAGONAL
        s = own * cov[k] + SHRINK_POOLED * pooled + SHRINK_DIAGONAL * np.diag(np.diag(pooled)) + np.diag(np.diag(floor))
        low = np.linalg.cholesky(s)
        roots.append(np.linalg.inv(low))
        half.append(float(np.log(np.diag(low)).sum()))
    return Model(means, np.array(roots), np.array(half), log_odds)


def _moments_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """label and vector in; one row (label, n, sums, products) per class of the task out."""
    d = len(FEATURES)
    n, s, p = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for b in batches:
        y = b.column(0).to_numpy(zero_copy_only=False)
        x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        for k in (0, 1):
            own = x[y == k]
            n[k] += len(own)
            s[k] += own.sum(0)
            p[k] += own.T @ own
    flat = [np.concatenate(([n[k]], s[k], p[k].ravel())).tolist() for k in (0, 1)]
    yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array(flat, pa.list_(pa.float64()))],
                                     ["label", "m"])


def document_vectors(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the vector of each row, kept once in the shared folder."""
    rows = docs.select(F.col(key).alias("doc_id"), text_or_empty(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return stored(rows.mapInArrow(_vectors_in_batches, f"doc_id {kind}, x array<double>"), "text-vectors")


def fit(known: DataFrame, labels: DataFrame) -> Model:
    """Fit on the vectors that have a label; ``labels`` has doc_id and quality."""
    y = (labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
         .groupBy("doc_id").agg(F.max("quality").cast("int").alias("label")))
    train = known.join(y, "doc_id").select("label", "x")
    # a row per number of the model reaches the driver, whatever the rows
    summed = (train.mapInArrow(_moments_of, "label int, m array<double>")
              .select("label", F.posexplode("m").alias("i", "v")).groupBy("label", "i").agg(F.sum("v").alias("v")).collect())
    d = len(FEATURES)
    m = np.zeros((2, 1 + d + d * d))
    for r in summed:
        m[r["label"], r["i"]] = r["v"]
    return fit_moments(m[:, 0], m[:, 1:1 + d], m[:, 1 + d:].reshape(2, d, d))


def score(known: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of each vector."""
    d = len(FEATURES)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.scores(x))], ["doc_id", "score"])

    kind = dict(known.dtypes)["doc_id"]
    return known.mapInArrow(scored, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, all columns, fitted on the labels given.

    Every row is judged by its own text in the task that reads it.
    """
    model = fit(document_vectors(docs), labels)
    at = docs.columns.index("text")

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [model.scores(vectors(data, offsets)) for _, data, offsets in chunks(b.column(at))]
            yield b.filter(pa.array(np.concatenate(scores) >= threshold) if scores else pa.array([], pa.bool_()))

    return docs.mapInArrow(good, docs.schema)


def held_out(key: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = document_vectors(read_table(spark, sf_dir, "documents"))
    labels = read_table(spark, sf_dir, "labels").filter(~held_out())
    out = score(known, fit(known, labels))
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
