"""Document quality by a Gaussian kernel over text statistics, approximated with random Fourier features."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpline.llm.bytetools import buffers, slices, words
from kelpline.llm.storage import materialise

#: Random Fourier features, width of the Gaussian kernel over standardised statistics, ridge penalty a row.
FEATURES, WIDTH, RIDGE = 256, 5.0, 1e-3
#: Raw scores are put in so many bins for the isotonic fit.
BINS = 2000

#: Byte classes: space, line end, lower, upper, digit, sentence marks, other ASCII signs, other bytes, controls.
_CLASS = np.full(256, 8, np.int64)
_CLASS[32], _CLASS[10] = 0, 1
_CLASS[33:127] = 6
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 2, 3, 4, 7
_CLASS[[ord(c) for c in ".,;:?'\"-()"]] = 5
_N_CLASSES = 9
STATISTICS = (
    "log_bytes", "log_words", "spaces", "line_ends", "lower", "upper", "digits", "marks", "signs", "beyond_ascii", "controls",
    "word_length", "word_length_spread", "long_words", "distinct_words", "most_frequent_word", "same_as_last_word", "bytes_a_line", "repeated_bigrams", "distinct_pairs",
)


def statistics(column: pa.Array) -> np.ndarray:
    """STATISTICS of each text of a slice; an empty text has zeros."""
    data, offsets = buffers(column)
    n = len(offsets) - 1
    size = np.diff(offsets)
    owner = np.repeat(np.arange(n), size)
    classes = np.bincount(owner * _N_CLASSES + _CLASS[data], minlength=n * _N_CLASSES).reshape(n, _N_CLASSES).astype(np.float64)
    per_byte = classes / np.maximum(size, 1)[:, None]
    hashes, of, first, past = words(data, offsets)
    n_words = np.bincount(of, minlength=n).astype(np.float64)
    per = np.maximum(n_words, 1)
    length = (past - first).astype(np.float64)
    mean = np.bincount(of, length, n) / per
    spread = np.sqrt(np.maximum(np.bincount(of, length**2, n) / per - mean**2, 0))
    long = np.bincount(of, length > 12, n) / per
    distinct, most = _distinct(hashes, of, n)
    next_too = of[:-1] == of[1:]
    same = np.bincount(of[1:][next_too & (hashes[:-1] == hashes[1:])], minlength=n) / per
    pair = (hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])[next_too]
    pairs, most_pair = _distinct(pair, of[:-1][next_too], n)
    table = np.column_stack([
        np.log1p(size), np.log1p(n_words), per_byte, mean, spread, long, distinct / per, most / per, same,
        np.log1p(size / (classes[:, 1] + 1)), most_pair / per, pairs / per,
    ])
    table[size == 0] = 0
    return table


def _distinct(values: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct values and count of the most frequent one, by text."""
    if not len(values):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((values, of))
    v, o = values[order], of[order]
    starts = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (o[1:] != o[:-1])]))
    runs = np.diff(np.append(starts, len(v)))
    most = np.zeros(n)
    np.maximum.at(most, o[starts], runs)
    return np.bincount(o[starts], minlength=n).astype(np.float64), most


def document_statistics(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``stats`` (array<double>, see STATISTICS) of every row's whole text; null counts as empty."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            table = statistics(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(list(table), pa.list_(pa.float64()))], names=["doc_id", "stats"])

    return rows.mapInArrow(run, T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("stats", T.ArrayType(T.DoubleType()))]))


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray | None = None
    levels: np.ndarray | None = None

    def lift(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.spread, -8, 8)
        return np.hstack([np.sqrt(2 / len(self.phases)) * np.cos(x @ self.directions + self.phases), np.ones((len(x), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.lift(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.levels), 0, 1)


def _table(part: pa.RecordBatch) -> np.ndarray:
    column = part.column("stats")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def isotonic(x: np.ndarray, total: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in order of x: (mean x, level) of each pool."""
    pools: list[list[float]] = []
    for a, t, c in zip(x, total, count, strict=True):
        pools.append([a * c, t, c])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last, strict=True)]
    sums = np.array(pools)
    return sums[:, 0] / sums[:, 2], sums[:, 1] / sums[:, 2]


def _reduced(rows: DataFrame, per_part) -> np.ndarray | None:
    """Sum of the arrays that ``per_part`` makes of each partition, added up in a tree on the executors."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for part in batches:
            if part.num_rows:
                own = per_part(part)
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    add = lambda a, b: b if a is None else a if b is None else a + b
    return rows.mapInArrow(run, "sums binary").rdd.map(lambda r: np.frombuffer(bytes(r.sums))).treeAggregate(None, add, add, 3)


def train(stats: DataFrame, labels: DataFrame, *, seed: int = 5, label_col: str = "quality", id_col: str = "doc_id") -> Model | None:
    """Model of the labels of all rows that are not held out (crc32(id as text) mod 5 is 0 is held out). None without labels.

    Means and spreads, then the normal equations of a ridge regression on the lifted statistics, are
    summed within partitions and added up in a tree; only sums, of fixed size, reach the driver. The raw
    scores of all training rows are counted in ``BINS`` bins for the isotonic fit.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("y"))
    known = known.where(F.col("y").isin(0.0, 1.0) & (F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    rows = materialise(stats.join(known, "doc_id").select("stats", "y"), "quality-train")
    width = len(STATISTICS)

    def moments(part: pa.RecordBatch) -> np.ndarray:
        t = _table(part)
        return np.concatenate([t.sum(0), (t**2).sum(0), [len(t)]])

    sums = _reduced(rows, moments)
    if sums is None:
        return None
    mean = sums[:width] / sums[-1]
    spread = np.sqrt(np.maximum(sums[width:-1] / sums[-1] - mean**2, 1e-12)) + 1e-6
    rng = np.random.default_rng(seed)
    model = Model(mean, spread, rng.standard_normal((width, FEATURES)) / WIDTH, rng.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1))

    def equations(part: pa.RecordBatch) -> np.ndarray:
        z, y = model.lift(_table(part)), part.column("y").to_numpy()
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    sums = _reduced(rows, equations)
    n = FEATURES + 1
    gram, right = sums[: n * n].reshape(n, n), sums[n * n :]
    model.weights = np.linalg.solve(gram + RIDGE * gram[-1, -1] * np.eye(n), right)

    def binned(part: pa.RecordBatch) -> np.ndarray:
        at = np.clip((model.raw(_table(part)) + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int64)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, part.column("y").to_numpy(), BINS)]).astype(np.float64)

    sums = _reduced(rows, binned)
    full = np.flatnonzero(sums[:BINS])
    model.knots, model.levels = isotonic((full + 0.5) / BINS * 2 - 0.5, sums[BINS:][full], sums[:BINS][full])
    return model


def score_quality(stats: DataFrame, model: Model | None, *, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= threshold) of each row of ``document_statistics``.

    Without a model every score is 0.5. A null id is not held out; equal rows are separate rows.
    """
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if part.num_rows:
                score = shared.value.score(_table(part)) if shared.value is not None else np.full(part.num_rows, 0.5)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    kind = stats.schema["doc_id"].dataType
    out = stats.mapInArrow(run, T.StructType([T.StructField("doc_id", kind), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))
    return out.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def predict_quality(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3) -> DataFrame:
    """Scores of all documents by a model trained on the labels of those that are not held out."""
    stats = materialise(document_statistics(docs), "quality-stats")
    return score_quality(stats, train(stats, labels), threshold=threshold)
