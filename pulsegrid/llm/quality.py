"""Quality classifier: naive Bayes log-count ratios inside a linear support vector machine.

Features are indicators of the token n-grams of a text (words and runs of
punctuation, one and two at a time, hashed), and of how much of it repeats the
token one to four places before. Each indicator is scaled by its
log-count ratio between the classes; a hinge-loss linear model is fitted to the
scaled, length-normalised rows by dual coordinate descent, and its weights are
drawn towards their mean magnitude. A logistic curve maps margins to 0..1.

The model is fitted in numpy on the driver from a sample of at most
``TRAINING_ROWS`` labelled rows; all texts are scored whole in Spark tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.common import Tokens, as_binary, mix64, read_table, segment_ids, text_blocks, text_column
from pulsegrid.llm.labelled import fold, training_rows

TRAINING_ROWS = 6000
BITS = 18
LAGS = (1, 2, 3, 4)
FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.5


def indicators(texts: pa.Array, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Per block of texts: (distinct feature numbers, row of each, rows in the block), rows ascending."""
    data, offsets = as_binary(texts)
    for a, b in text_blocks(offsets):
        tokens = Tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], punctuation=True)
        row = segment_ids(tokens.count)
        pair = mix64(tokens.hash[:-1] * np.uint64(3) + tokens.hash[1:])[row[:-1] == row[1:]]
        shift = np.uint64(64 - bits)
        keys = np.concatenate(
            [(row << bits) | (tokens.hash >> shift).astype(np.int64), (row[1:][row[:-1] == row[1:]] << bits) | (pair >> shift).astype(np.int64)]
        )
        keys = np.unique(np.concatenate([keys, _repeats(tokens, row, b - a, bits)]))
        yield keys & ((1 << bits) - 1), keys >> bits, b - a


def _repeats(tokens: Tokens, row: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Back-off features "token again k tokens later": one for each tenth of a text's tokens that are so."""
    out = []
    for lag in LAGS:
        again = (row[:-lag] == row[lag:]) & (tokens.hash[:-lag] == tokens.hash[lag:])
        tenths = 10 * np.bincount(row[lag:][again], minlength=n) // np.maximum(tokens.count, 1)
        at = np.repeat(np.arange(n), tenths)
        step = np.arange(len(at)) - np.repeat(np.cumsum(tenths) - tenths, tenths)
        out.append((at << bits) | (mix64(np.uint64(lag) * np.uint64(16) + step.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(out)


@dataclass
class QualityModel:
    """``weight`` of each feature on rows of unit length, and the curve 1 / (1 + exp(-(slope m + shift)))."""

    weight: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, texts: pa.Array) -> np.ndarray:
        out = []
        for feature, row, n in indicators(texts):
            size = np.maximum(np.bincount(row, minlength=n), 1)
            out.append(np.bincount(row, self.weight[feature], n) / np.sqrt(size) + self.bias)
        margin = np.concatenate(out) if out else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


def dual_coordinate_descent(
    rows: list[tuple[np.ndarray, np.ndarray]], sign: np.ndarray, width: int, cost: np.ndarray, passes: int = 20, seed: int = 5
) -> tuple[np.ndarray, float]:
    """Weights and bias of the L1 hinge loss: each step solves one dual variable exactly within [0, cost]."""
    weight, bias, alpha = np.zeros(width), 0.0, np.zeros(len(rows))
    square = np.array([float(v @ v) + 1.0 for _, v in rows])
    rng = np.random.default_rng(seed)
    for _ in range(passes):
        largest = 0.0
        for i in rng.permutation(len(rows)):
            at, value = rows[i]
            gradient = sign[i] * (weight[at] @ value + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            if (step := new - alpha[i]) != 0:
                alpha[i] = new
                weight[at] += step * sign[i] * value
                bias += step * sign[i]
                largest = max(largest, abs(step))
        if largest < 1e-4:
            break
    return weight, bias


def logistic_curve(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift that fit labels by Newton steps, with smoothed targets."""
    ones = int(label.sum())
    target = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (len(label) - ones + 2))
    x, theta = np.stack([margin, np.ones_like(margin)], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p))
        theta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def fit(rows: pa.Table, bits: int = BITS, strength: float = 1.0, blend: float = 0.25) -> QualityModel:
    """Fit to a table (label, text). With one class only, every text scores near that class."""
    label = rows["label"].to_numpy()
    width = 1 << bits
    if len(label) == 0 or label.min() == label.max():
        share = (float(label.sum()) + 1) / (len(label) + 2)
        return QualityModel(np.zeros(width), 0.0, 1.0, float(np.log(share / (1 - share))))
    features = []
    for found, row, n in indicators(rows["text"].combine_chunks()):
        cuts = np.searchsorted(row, np.arange(n + 1))
        features += [found[cuts[i] : cuts[i + 1]] for i in range(n)]
    counts = [np.ones(width), np.ones(width)]
    for f, y in zip(features, label, strict=True):
        counts[int(y == 1)][f] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    scaled = [(f, ratio[f] / np.sqrt(max(len(f), 1))) for f in features]
    sign = np.where(label == 1, 1.0, -1.0)
    share = label.mean()
    cost = strength * np.where(label == 1, 0.5 / share, 0.5 / (1 - share))
    weight, bias = dual_coordinate_descent(scaled, sign, width, cost)
    weight = (1 - blend) * np.abs(weight).mean() + blend * weight
    weight = weight * ratio
    model = QualityModel(weight, bias * blend, 1.0, 0.0)
    margin = np.array([weight[f].sum() / np.sqrt(max(len(f), 1)) + model.bias for f in features])
    model.slope, model.shift = logistic_curve(margin, label)
    return model


def quality_score(text: Column, model: QualityModel) -> Column:
    """Score of each whole text; an empty or NULL text scores by the bias alone."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(model.score(texts), pa.float64())

    return score(F.coalesce(text.cast("string"), F.lit("")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit(training_rows(docs, read_table(spark, sf_dir, "labels"), "quality", FOLDS, HELD_OUT, TRAINING_ROWS))
    scored = docs.select("doc_id", quality_score(text_column(), model).alias("score"))
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
