"""A quality score by regularised quadratic discriminant analysis of document statistics.

Each document becomes a short vector of statistics of its whole text.  Per class, mean and covariance come
from sums over all labelled training rows; covariances are shrunk towards the pooled one and towards its
diagonal.  The score is the posterior of class 1 from the two Gaussian log densities, whose Mahalanobis terms
use Cholesky factors computed once on the driver from k x k matrices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescout.llm.common import SPACES, flat_bytes, fold, lowered, pieces, separators, staged, text_bytes, word_hashes

NAMES = (
    "length", "word_length", "distinct_words", "top_word", "repeated_pairs", "upper", "digits", "symbols", "stops",
    "marks_in_words", "bars", "lines", "repeated_lines", "high_bytes",
)
THRESHOLD = 0.7
TO_POOLED, TO_DIAGONAL = 0.5, 0.1


def _mask(bytes_: bytes) -> np.ndarray:
    return separators(bytes_)


_SPACE = _mask(SPACES)
_NEWLINE = _mask(b"\n")
_UPPER = _mask(bytes(range(65, 91)))
_LETTER = _mask(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
_DIGIT = _mask(b"0123456789")
_STOP = _mask(b".!?")
_BAR = _mask(b"|<>{}[]\\/_=")
_SYMBOL = _mask(bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"!?()-|<>{}[]\\/_="))
_HIGH = _mask(bytes(range(128, 192)))


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def _ratio(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _repeats(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row: how many distinct values, and the count of the commonest."""
    distinct, top = np.zeros(len(bounds) - 1), np.zeros(len(bounds) - 1)
    for row in np.flatnonzero(np.diff(bounds)):
        some = np.sort(hashes[bounds[row] : bounds[row + 1]])
        edges = np.flatnonzero(some[1:] != some[:-1]) + 1
        runs = np.diff(np.concatenate([[0], edges, [len(some)]]))
        distinct[row], top[row] = len(runs), runs.max()
    return distinct, top


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of NAMES for each text, of the UTF-8 bytes of all.  Ratios have a constant added below, so short
    texts do not jump; an empty text has zeros, and 1 for its distinct words."""
    size = np.diff(offsets).astype(float)
    low = lowered(data)
    words, word_bounds = word_hashes(low, offsets, _SPACE)
    n_words = np.diff(word_bounds).astype(float)
    distinct, top = _repeats(words, word_bounds)
    pairs = words.copy()
    pairs[:-1] = words[:-1] * np.uint64(3) + words[1:]
    distinct_pairs, _ = _repeats(pairs, word_bounds)
    lines, line_bounds = word_hashes(low, offsets, _NEWLINE)
    n_lines = np.diff(line_bounds).astype(float)
    distinct_lines, _ = _repeats(lines, line_bounds)
    letters = _sums(_LETTER[data], offsets)
    ends = np.zeros(len(data), bool)
    ends[:-1] = _SYMBOL[data[:-1]] & _SPACE[data[1:]]
    logged = np.log1p(n_words)
    return np.column_stack([
        np.log1p(size),
        np.log1p(_ratio(size, n_words)),
        np.where(n_words > 1, np.log1p(distinct) / np.maximum(logged, 1e-9), 1.0),
        np.sqrt(top / (n_words + 10)),
        np.sqrt((n_words - distinct_pairs) / (n_words + 50)),
        np.sqrt(_ratio(_sums(_UPPER[data], offsets), letters)),
        np.sqrt(_ratio(_sums(_DIGIT[data], offsets), size)),
        np.sqrt(_ratio(_sums(_SYMBOL[data], offsets), n_words)),
        np.sqrt(_ratio(_sums(_STOP[data], offsets), n_words)),
        np.sqrt(_ratio(_sums(ends, offsets), n_words)),
        np.sqrt(_ratio(_sums(_BAR[data], offsets), n_words)),
        np.log1p(_ratio(n_words, n_lines)),
        np.sqrt((n_lines - distinct_lines) / (n_lines + 20)),
        np.sqrt(_ratio(_sums(_HIGH[data], offsets), size)),
    ])


def _mapped(documents: DataFrame, keep: Sequence[str], out: Callable, names: list[str], kinds: str) -> DataFrame:
    """(doc_id, *keep) of each row and the columns that `out` makes of a matrix of statistics, in one pass."""

    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat_bytes(batch.column(batch.num_columns - 1))
            for a, b in pieces(np.diff(offsets), 1 << 20):
                rows = statistics(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                columns = [batch.column(k)[a:b] for k in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*columns, *out(rows)], names=["doc_id", *keep, *names])

    kept = documents.select(F.col("doc_id").cast("long").alias("doc_id"), *keep)
    schema = ", ".join(f"`{name}` {kind}" for name, kind in kept.dtypes)
    wanted = documents.select(F.col("doc_id").cast("long").alias("doc_id"), *keep, text_bytes(F.col("text")).alias("statistics of"))
    return wanted.mapInArrow(computed, f"{schema}, {kinds}")


def document_statistics(documents: DataFrame) -> DataFrame:
    """(doc_id, features) for each row; null texts count as empty."""

    def listed(rows: np.ndarray) -> list[pa.Array]:
        ends = pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32())
        return [pa.ListArray.from_arrays(ends, pa.array(rows.ravel()))]

    return _mapped(documents, (), listed, ["features"], "features array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Log priors, means, inverse Cholesky factors and log determinants of both classes; or a fixed score."""

    fixed: float | None
    prior: np.ndarray | None = None
    mean: np.ndarray | None = None
    whitener: np.ndarray | None = None
    log_det: np.ndarray | None = None

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if self.fixed is not None:
            return np.full(len(rows), self.fixed)
        density = [
            self.prior[c] - 0.5 * (self.log_det[c] + (((rows - self.mean[c]) @ self.whitener[c].T) ** 2).sum(axis=1))
            for c in (0, 1)
        ]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def fit(training: DataFrame, to_pooled: float = TO_POOLED, to_diagonal: float = TO_DIAGONAL) -> Discriminant:
    """From rows (features, label).  Class sums are added up in tasks and by Spark; only k x k sums come back.

    Without rows of both classes the score is (n1 + 1) / (n + 2) for every text.
    """
    k = len(NAMES)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, k + 1, k + 1))
        for batch in batches:
            rows = np.array(batch.column("features").to_pylist(), float).reshape(-1, k)
            rows = np.column_stack([np.ones(len(rows)), rows])
            label = np.array(batch.column("label").to_pylist(), int)
            for c in (0, 1):
                sums[c] += rows[label == c].T @ rows[label == c]
        at = np.indices(sums.shape).reshape(3, -1)
        yield pa.RecordBatch.from_arrays([pa.array(at[i], pa.int32()) for i in range(3)] + [pa.array(sums.ravel())], names=["c", "i", "j", "v"])

    added = training.mapInArrow(partial, "c int, i int, j int, v double").groupBy("c", "i", "j").agg(F.sum("v").alias("v"))
    sums = np.zeros((2, k + 1, k + 1))
    for c, i, j, v in added.collect():  # 2 (k + 1)^2 numbers
        sums[c, i, j] = v
    count = sums[:, 0, 0]
    if count.min() < 2:
        return Discriminant(float((count[1] + 1) / (count.sum() + 2)))
    mean = sums[:, 0, 1:] / count[:, None]
    scatter = [sums[c, 1:, 1:] - count[c] * np.outer(mean[c], mean[c]) for c in (0, 1)]
    pooled = (scatter[0] + scatter[1]) / count.sum()
    floor = 1e-6 + 1e-3 * np.diag(pooled)
    factors = []
    for c in (0, 1):
        own = (1 - to_pooled) * scatter[c] / count[c] + to_pooled * pooled
        own = (1 - to_diagonal) * own + to_diagonal * np.diag(np.diag(own)) + np.diag(floor)
        factors.append(np.linalg.cholesky(own))
    return Discriminant(
        None, np.log(count / count.sum()), mean, np.array([np.linalg.inv(f) for f in factors]),
        np.array([2 * np.log(np.diag(f)).sum() for f in factors]),
    )


def single_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, label): ids with one label, 0 or 1; null and contradicting ones teach nothing."""
    quality = F.col("quality").cast("int")
    return (
        labels.where(quality.isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(quality).alias("label"), F.max(quality).alias("high"))
        .where("label = high")
        .drop("high")
    )


def _scored(model: Discriminant, threshold: float) -> Callable:
    def scored(rows: np.ndarray) -> list[pa.Array]:
        found = model.scores(rows)
        return [pa.array(found), pa.array((found >= threshold).astype(np.int32))]

    return scored


def score(features: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) of rows (doc_id, features)."""
    out = _scored(model, threshold)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column("features").to_pylist(), float).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *out(rows)], names=["doc_id", "score", "predicted"])

    return features.select("doc_id", "features").mapInArrow(scored, "doc_id long, score double, predicted int")


def classify(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, keep: Sequence[str] = ()) -> DataFrame:
    """Per row of documents: doc_id, columns to keep, score (the posterior of quality 1), predicted (score >=
    threshold).

    Learns from all documents with one label whose crc32(doc_id as text) mod 4 is not 2.  Null texts count as
    empty and get a score like others.  Null and repeated doc_ids stay, a row for a row, and a null one has no
    label; empty tables give no rows, or scores without features (see `fit`).  Other columns are ignored.
    Columns to keep are passed by while the statistics are computed anew, so that they need not be shuffled.
    """
    features = staged(document_statistics(documents), "statistics")
    training = features.where(fold(F.col("doc_id"), 4) != 2).join(single_labels(labels), "doc_id")
    model = fit(training)
    if not keep:
        return score(features, model, threshold)
    return _mapped(documents, keep, _scored(model, threshold), ["score", "predicted"], "score double, predicted int")
