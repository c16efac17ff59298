"""Quality classifier: naive Bayes support vectors.

Every text becomes the set of its n-grams, hashed into a fixed number of features. A feature is not used as 0 or 1
but scaled by its log-count ratio between the two classes (the naive Bayes part), and a linear hinge-loss model is then
fitted on the scaled features by dual coordinate descent (the support vector part). Margins become probabilities by a
logistic curve fitted on the same rows with equal class weights.

Fitting takes at most ``sample_rows`` labelled rows, the ones with the smallest hash of their id, and of each of them
the whole text. Scoring is one pass over the documents, without a shuffle, of whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.token_files import release_memory

# Rows the model is fitted on; their feature sets are all that the driver holds (about 4 kB a row).
SAMPLE_ROWS = 8_000
FEATURE_BITS = 16
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_KINDS = np.array(
    [ord("a") if 97 <= c <= 122 or c >= 128 else ord("A") if 65 <= c <= 90 else ord("0") if 48 <= c <= 57 else c for c in range(256)],
    dtype=np.uint8,
)


@dataclass(frozen=True)
class QualityModel:
    """Weights by feature (log-count ratio times hinge weight), bias, and the logistic curve over margins."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, texts: list[bytes]) -> np.ndarray:
        return np.array([_margin(self.weights, features(t)) for t in texts], dtype=float) + self.bias

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.offset, -500, 500)))


def _margin(weights: np.ndarray, found: np.ndarray) -> float:
    """Sum scaled by the number of features, so that long and short texts have margins of one size."""
    return float(weights[found].sum()) / np.sqrt(max(1, len(found)))


def features(text: bytes) -> np.ndarray:
    """Sorted ids of the n-grams of a text; an empty text has none.

    Three alphabets: bytes (n up to 2), kinds of bytes (letters by case, digits, all else as it is; n from 3 to 5), and
    whether a word equals the one before it (n up to 4).
    """
    seen = np.zeros(1 << FEATURE_BITS, dtype=bool)
    data = np.frombuffer(text, dtype=np.uint8)
    words = text.split()
    repeats = np.fromiter(map(eq, words, words[1:]), dtype=np.uint8, count=max(0, len(words) - 1))
    for alphabet, (letters, sizes) in enumerate(((data, (1, 2)), (_KINDS[data], (3, 4, 5)), (repeats, (1, 2, 3, 4)))):
        letters = letters.astype(np.uint64)
        for n in sizes:
            if len(letters) < n:
                break
            gram = np.full(len(letters) - n + 1, alphabet * 8 + n, dtype=np.uint64)
            for k in range(n):
                gram = (gram << np.uint64(8)) | letters[k : k + len(gram)]
            seen[((gram * _SPREAD) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)] = True
    return np.flatnonzero(seen)


def fit(texts: list[bytes], labels: np.ndarray, cost: float = 1.0, epochs: int = 12) -> QualityModel:
    """Fit on texts with 0/1 labels."""
    return fit_features([features(t) for t in texts], labels, cost, epochs)


def fit_features(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, epochs: int = 12) -> QualityModel:
    """Fit on feature sets with 0/1 labels. With rows of one class only, every score is near that class; without rows, 0.5."""
    width = 1 << FEATURE_BITS
    y = np.where(np.asarray(labels) == 1, 1.0, -1.0)
    if len(y) == 0 or (y > 0).all() or (y < 0).all():
        return QualityModel(np.zeros(width), 0.0, 1.0, 0.0 if len(y) == 0 else 4.0 * float(y[0]))
    counts = {side: np.ones(width) for side in (1.0, -1.0)}
    for found, side in zip(rows, y, strict=True):
        counts[side][found] += 1
    ratio = np.log(counts[1.0] / counts[1.0].sum()) - np.log(counts[-1.0] / counts[-1.0].sum())
    scale = np.array([1 / np.sqrt(max(1, len(found))) for found in rows])
    # Classes weigh the same, whatever their sizes.
    bound = {1.0: cost * len(y) / (2 * (y > 0).sum()), -1.0: cost * len(y) / (2 * (y < 0).sum())}
    w, bias, alpha = np.zeros(width), 0.0, np.zeros(len(y))
    square = np.array([(ratio[found] ** 2).sum() * s * s + 1.0 for found, s in zip(rows, scale, strict=True)])
    shuffle = np.random.default_rng(0)
    for _ in range(epochs):
        moved = 0.0
        for i in shuffle.permutation(len(y)):
            found = rows[i]
            x = ratio[found] * scale[i]
            slack = y[i] * (w[found] @ x + bias) - 1
            new = min(max(alpha[i] - slack / square[i], 0.0), bound[y[i]])
            step = (new - alpha[i]) * y[i]
            if step:
                w[found] += step * x
                bias += step
                moved = max(moved, abs(step))
            alpha[i] = new
        if moved < 1e-4:
            break
    weights = w * ratio
    margin = np.array([_margin(weights, found) for found in rows]) + bias
    return QualityModel(weights, bias, *_logistic(margin, y))


def _logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(label 1 | margin), both classes weighing the same, by Newton's method."""
    weight = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum())
    n_pos, n_neg = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (n_pos + 1) / (n_pos + 2), 1 / (n_neg + 2))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -500, 500)))
        gradient = np.array([(weight * (p - target) * margin).sum() + 1e-6 * slope, (weight * (p - target)).sum()])
        bend = weight * p * (1 - p)
        hessian = np.array([[(bend * margin**2).sum(), (bend * margin).sum()], [(bend * margin).sum(), bend.sum()]])
        step = np.linalg.solve(hessian + 1e-9 * np.eye(2), gradient)
        size = np.abs(step).max()
        slope, offset = slope - step[0] * min(1, 5 / size), offset - step[1] * min(1, 5 / size)
        if size < 1e-8:
            break
    return max(float(slope), 1e-3), float(offset)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fifth of the ids whose crc32 divides by 5; labels of these rows are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Fit on the labelled rows that are not held out.

    If there are more than ``sample_rows`` labelled rows, each class gives those of its rows with the smallest hash of
    their id, half of the sample at most unless the other class is smaller. Only these rows' texts reach the driver.
    Rows without a label, id or text are not used; a doc_id labelled several times counts once, with its smallest label.
    """
    known = (
        labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_label"))
        .filter(F.col("_label").isin(0, 1) & F.col("_id").isNotNull() & ~held_out("_id"))
        .groupBy("_id")
        .agg(F.min("_label").alias("_label"))
    )
    rank = F.xxhash64(F.col("_id"))
    per_class = []
    for label in (0, 1):
        # limit() after orderBy keeps the smallest rows of each task before they meet: never more than sample_rows.
        per_class.append(known.filter(F.col("_label") == label).orderBy(rank, "_id").limit(sample_rows))
    small = per_class[0].unionByName(per_class[1]).collect()
    zeros, ones = ([r for r in small if r["_label"] == label] for label in (0, 1))
    half = sample_rows // 2
    n_zeros = min(len(zeros), max(half, sample_rows - len(ones)))
    chosen = zeros[:n_zeros] + ones[: sample_rows - n_zeros]
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(int(r["_id"]), int(r["_label"])) for r in chosen], "_id long, _label int")
    texts = (
        docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
        .join(F.broadcast(wanted), "_id")
        .filter(F.col("_text").isNotNull())
        .mapInArrow(_feature_rows, "id long, label int, found binary")
    )
    rows = sorted(texts.collect())
    return fit_features([np.frombuffer(r["found"], dtype=np.uint16) for r in rows], np.array([r["label"] for r in rows]))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(t).astype(np.uint16).tobytes() for t in binary(batch.column("_text"))]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_label"), pa.array(found, pa.binary())], ["id", "label", "found"])


def binary(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def with_scores(docs: DataFrame, model: QualityModel, score: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 as column ``score`` (a column of that name is replaced).

    A null text counts as empty; every row is scored by its whole text, and nothing but its text.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.slope, model.offset))
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != score.lower()]

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release_memory()
        model = QualityModel(*shared.value)
        for texts in batches:
            yield pa.array(model.scores(binary(texts)), pa.float64())
        del model
        release_memory()

    return docs.select(*kept, scored(F.coalesce("text", F.lit(""))).alias(score))
