"""Language identification by string kernels."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpline.llm.bytetools import buffers, slices

#: Labelled documents that the classifier is fitted on, per language: the documented bound of the training sample.
PER_LANGUAGE = 500
#: Landmarks are sampled documents of at most so many distinct n-grams, where a language has enough of them.
LANDMARKS, LANDMARK_GRAMS = 256, 20_000
ORDERS = (1, 2, 3)
#: Texts whose n-grams are spread out as rows of one matrix.
ROWS = 256
#: A text is strange if the share of its n-grams that landmarks have is below so much of what nearly all sampled texts of some
#: length reach that are no landmarks themselves; of fewer than a hundred such texts nothing is concluded.
STRANGE, TELLING_GRAMS = 0.8, 100

#: Symbols: 0 all that is no letter, 1-26 letters, 27-154 bytes of characters from U+0080 on.
_SYMBOL = np.zeros(256, np.int32)
_SYMBOL[97:123] = _SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[128:] = np.arange(27, 155)
_N_SYMBOLS = 155
_STARTS = (0, _N_SYMBOLS, _N_SYMBOLS + _N_SYMBOLS**2)
N_CODES = _STARTS[2] + _N_SYMBOLS**3


def codes(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the n-gram codes in the texts of a slice and the texts they are in; none spans two texts."""
    if not len(data):
        return
    symbols = _SYMBOL[data]
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    joined = symbols
    for n, start in zip(ORDERS, _STARTS, strict=True):
        if n > 1:
            if len(symbols) < n:
                return
            joined = joined[:-1] * _N_SYMBOLS + symbols[n - 1 :]
            whole = owner[: 1 - n] == owner[n - 1 :]
            yield joined[whole] + start, owner[: 1 - n][whole]
        else:
            yield joined + start, owner


@dataclass
class Model:
    """Presence kernel k(x, y) = |X & Y| / sqrt(|X| |Y|) over all n-grams, Nystrom landmarks, ridge weights.

    Only n-grams of some landmark can be in an intersection, so the matrix has these; a text's size counts all of its own.
    A text of which a share below ``least_known`` is known to the landmarks is in no learned language.
    """

    column: np.ndarray  # of each n-gram code, or the number of columns if no landmark has it
    landmarks: np.ndarray  # n-grams x landmarks, each column over the root of its size
    weights: np.ndarray  # landmarks x languages
    prior: np.ndarray
    languages: list[str]
    scale: float = 3.0
    least_known: float = 0.0

    def kernel(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each text of a slice: kernel values with all landmarks, and the share of its n-grams that some landmark has."""
        cuts = [(lo, min(len(offsets) - 1, lo + ROWS)) for lo in range(0, len(offsets) - 1, ROWS)]
        return self._joined([self._batch(codes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]), hi - lo) for lo, hi in cuts])

    def kernel_of_sets(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The same of lists of distinct n-gram codes."""
        parts = [sets[lo : lo + ROWS] for lo in range(0, len(sets), ROWS)]
        return self._joined([self._batch([(np.concatenate(p), np.repeat(np.arange(len(p)), [len(x) for x in p]))], len(p)) for p in parts])

    def _joined(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([k for k, _ in parts]), np.concatenate([known for _, known in parts])

    def _batch(self, found: Iterable[tuple[np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
        width = len(self.landmarks) + 1
        flags, others = np.zeros(n * width, np.float32), [np.zeros(0, np.int64)]
        for code, owner in found:
            column = self.column[code]
            flags[owner * width + column] = 1
            rest = column == width - 1
            others.append(np.unique(owner[rest] * N_CODES + code[rest]))
        present = flags.reshape(n, width)[:, :-1]
        own = present.sum(1)
        sizes = np.maximum(own + np.bincount(np.concatenate(others) // N_CODES, minlength=n), 1)
        return present @ self.landmarks / np.sqrt(sizes)[:, None], own / sizes

    def margins(self, kernel: np.ndarray) -> np.ndarray:
        """What each language's classifier says: about 1 if the text is its own, -1 if not."""
        return kernel @ self.weights + self.prior

    def probabilities(self, margins: np.ndarray) -> np.ndarray:
        raw = np.exp(self.scale * (margins - margins.max(1, keepdims=True)))
        return raw / raw.sum(1, keepdims=True)


def fit(samples: list[tuple[str, np.ndarray]], ridge: float = 1e-4) -> Model:
    """Model from (language, distinct n-gram codes) of the sampled documents, by one-versus-rest kernel ridge regression."""
    languages = sorted({k for k, _ in samples})
    y = np.array([languages.index(k) for k, _ in samples])
    large = np.array([len(c) > LANDMARK_GRAMS for _, c in samples])
    per = -(-LANDMARKS // len(languages))
    order = np.argsort(large, kind="stable")
    marks = np.concatenate([order[y[order] == k][:per] for k in range(len(languages))])
    known = np.unique(np.concatenate([samples[m][1] for m in marks]))
    column = np.full(N_CODES, len(known), np.int32)
    column[known] = np.arange(len(known))
    landmarks = np.zeros((len(known), len(marks)), np.float32)
    for k, m in enumerate(marks):
        landmarks[column[samples[m][1]], k] = 1 / np.sqrt(max(1, len(samples[m][1])))
    model = Model(column, landmarks, np.zeros((len(marks), len(languages))), np.zeros(len(languages)), languages)
    values, vectors = np.linalg.eigh((landmarks.T @ landmarks).astype(np.float64))
    keep = values > values.max() * 1e-6
    root = vectors[:, keep] / np.sqrt(values[keep])
    kernel, share_known = model.kernel_of_sets([c for _, c in samples])
    others = np.setdiff1d([k for k, (_, c) in enumerate(samples) if len(c) >= TELLING_GRAMS], marks)
    if len(others) >= 100:
        model.least_known = float(STRANGE * np.quantile(share_known[others], 0.01))
    phi = kernel.astype(np.float64) @ root
    phi = np.hstack([phi, np.ones((len(phi), 1))])
    targets = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)
    share = np.bincount(y, minlength=len(languages)) / len(y)
    balance = (1 / (len(languages) * share))[y][:, None]
    beta = np.linalg.solve(phi.T @ (balance * phi) + ridge * len(phi) * np.eye(phi.shape[1]), phi.T @ (balance * targets))
    model.weights, model.prior = (root @ beta[:-1]).astype(np.float32), beta[-1].astype(np.float32)
    return model


def _sample(labelled: DataFrame, per_language: int) -> DataFrame:
    """About ``per_language`` labelled rows of each language, picked by a hash of the row (bounded, the same in each run)."""
    counts = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return labelled.limit(0)
    share = F.element_at(F.create_map(*[x for k, n in sorted(counts.items()) for x in (F.lit(k), F.lit(min(1.0, per_language / n)))]), F.col("lang"))
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return labelled.where(draw < share)


def train(df: DataFrame, *, per_language: int = PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Model fitted on a sample of the rows with id, text and language; the driver gets their distinct n-grams only. None without such rows.

    Rows whose crc32(id as text) mod 4 is 2 are held out and never learned from.
    """
    key = F.col(id_col).cast("string")
    rows = df.select(key.alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.crc32("doc_id") % 4 != 2))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 18):
            found = list(codes(*buffers(part.column("text"))))
            cuts = [np.searchsorted(owner, np.arange(part.num_rows + 1)) for _, owner in found]
            sets = [np.unique(np.concatenate([np.zeros(0, np.int64), *[code[at[k] : at[k + 1]] for (code, _), at in zip(found, cuts, strict=True)]])).astype(np.int32) for k in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), pa.array(sets, pa.list_(pa.int32()))], names=["doc_id", "lang", "codes"])

    sets = _sample(rows, per_language).mapInArrow(run, "doc_id string, lang string, codes array<int>").toArrow().sort_by("doc_id")
    if not sets.num_rows:
        return None
    flat = sets.column("codes").combine_chunks()
    at, values = flat.offsets.to_numpy(), flat.values.to_numpy()
    return fit([(k, values[at[i] : at[i + 1]]) for i, k in enumerate(sets.column("lang").to_pylist())])


def identify(df: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, lang_pred, score and margin of every row's whole text, and the columns ``keep``.

    ``score`` is the probability of the predicted language among those learned; ``known`` is the share of the
    text's n-grams that some landmark has, which for a text in none of them is below the model's ``least_known``.

    A null text and one without a letter is ``und`` with score 0, as is every text if ``model`` is None.
    A text with letters but no known n-gram gets the likeliest language a priori. A null id is not held
    out; equal rows are separate rows; columns that are not named are ignored.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded: n-grams of 256 landmarks (one a language, if there are more) x landmarks
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
    rows = df.select(F.col(id_col).alias("_id"), held.alias("_held"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("_letters"), F.col(text_col).alias("_text"), *keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for part in slices(batches, "_text"):
            letters = np.asarray(part.column("_letters").to_numpy(zero_copy_only=False), bool)
            names, best = np.full(part.num_rows, "und", object), np.zeros(part.num_rows)
            share = np.zeros(part.num_rows)
            if known is not None:
                kernel, share = known.kernel(*buffers(part.column("_text")))
                scores = known.probabilities(known.margins(kernel))
                names = np.where(letters, np.array(known.languages, object)[scores.argmax(1)], "und")
                best = np.where(letters, scores.max(1).astype(np.float64), 0.0)
            yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_held"), pa.array(names.tolist(), pa.string()), pa.array(np.clip(best, 0, 1)), pa.array(share.astype(np.float64)), *[part.column(k) for k in keep]], names=["doc_id", "held_out", "lang_pred", "score", "known", *[f"_kept_{k}" for k in keep]])

    schema = T.StructType([T.StructField("doc_id", rows.schema["_id"].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("known", T.DoubleType()), *[T.StructField(f"_kept_{k}", rows.schema[k].dataType) for k in keep]])
    return rows.mapInArrow(run, schema)


def predict_languages(df: DataFrame, *, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``identify`` by a model trained on the table itself."""
    return identify(df, train(df, per_language=per_language))
