"""Quality classifier: a support vector machine on Naive Bayes features.

Features are indicators of byte n-grams (1 to 4), hashed. Each is scaled by the log of
the ratio of its smoothed counts in the two classes, a text's vector is brought to
length one, and a linear model with hinge loss is fitted by dual coordinate descent.
A sigmoid fitted on margins of two-fold cross-validation turns a margin into a score.

The model is fitted on at most ``max_train`` labelled documents, those with the
smallest hashes of their doc_id; every document is scored whole.

Edge cases: null text is empty, and an empty text gets the score of the bias alone;
null labels are not learned from; several labels of a document count by the smallest;
of several texts with one doc_id that with the smallest features is learned from;
without labels of both classes every score is the smoothed share of label 1; repeated
rows get equal scores; other columns are never inputs.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BATCH_ROWS, text_or_empty, text_pieces, whole_texts

BITS = 18
ORDERS = (1, 2, 3, 4)
MAX_TRAIN = 8000
HELD_OUT_OF = 5
KEEP_FROM = 0.3
CHUNK = 1 << 20


def ngrams(text: str) -> np.ndarray:
    """The sorted feature numbers that occur in a text."""
    seen = np.zeros(1 << BITS, bool)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    for at in range(0, len(data), CHUNK):
        part = data[at : at + CHUNK + max(ORDERS) - 1].astype(np.uint32)
        for n in ORDERS:
            m = len(part) - n + 1
            if m <= 0:
                break
            code = np.full(m, n, np.uint32)
            for k in range(n):
                code = code * np.uint32(0x01000193) ^ part[k : k + m] * np.uint32(0x9E3779B1)
            code ^= code >> np.uint32(15)
            seen[(code * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)] = True
    return np.flatnonzero(seen).astype(np.int32)


def packed(features: np.ndarray) -> bytes:
    """Steps between sorted numbers, deflated: half of what the numbers take, on their way to the driver."""
    return zlib.compress(np.diff(features, prepend=0).astype("<u4").tobytes(), 1)


def unpacked(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(blob), "<u4")).astype(np.int32)


@dataclass
class Model:
    """margin = gain[features].sum() / sqrt(square[features].sum()) + bias."""

    gain: np.ndarray
    square: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None

    def score(self, text: str) -> float:
        if self.constant is not None:
            return self.constant
        return float(sigmoid(self.slope * self.margin(ngrams(text)) + self.shift))

    def margin(self, features: np.ndarray) -> float:
        norm = float(np.sqrt(self.square[features].sum(dtype=np.float64)))
        return float(self.gain[features].sum(dtype=np.float64)) / norm + self.bias if norm else self.bias


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_margin(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, rounds: int = 12) -> Model:
    """Log-count ratios, then dual coordinate descent on the hinge loss."""
    size, y = 1 << BITS, np.where(labels == 1, 1.0, -1.0)
    counts = [np.ones(size), np.ones(size)]
    for features, label in zip(rows, labels):
        counts[int(label)][features] += 1
    ratio = np.log((counts[1] / counts[1].sum()) / (counts[0] / counts[0].sum()))
    norms = [float(np.sqrt((ratio[f] ** 2).sum())) or 1.0 for f in rows]
    most = {1.0: cost * len(y) / (2 * max(1, (y > 0).sum())), -1.0: cost * len(y) / (2 * max(1, (y < 0).sum()))}
    weight, bias, alpha = np.zeros(size), 0.0, np.zeros(len(rows))
    scaled, rng = np.zeros(size), np.random.default_rng(7)  # scaled: ratio * weight
    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            f = rows[i]
            gradient = y[i] * (scaled[f].sum() / norms[i] + bias) - 1.0
            new = min(max(alpha[i] - gradient / 2.0, 0.0), most[y[i]])  # a vector and its bias have squared length 2
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                weight[f] += step * ratio[f] / norms[i]
                scaled[f] = ratio[f] * weight[f]
                bias += step
                alpha[i] = new
    return Model(scaled.astype(np.float32), (ratio**2).astype(np.float32), bias)


def fit_sigmoid(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Newton steps on the log loss with smoothed targets."""
    up, down = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (up + 1) / (up + 2), 1 / (down + 2))
    x, theta = np.column_stack([margins, np.ones_like(margins)]), np.array([1.0, 0.0])
    for _ in range(60):
        p = sigmoid(x @ theta)
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * theta)
        theta = theta - np.clip(step, -2, 2)
    return float(theta[0]), float(theta[1])


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    size = 1 << BITS
    if min((labels == 1).sum(), (labels == 0).sum()) < 2:
        share = ((labels == 1).sum() + 1) / (len(labels) + 2)
        return Model(np.zeros(size, np.float32), np.zeros(size, np.float32), 0.0, constant=float(share))
    fold, margins = np.zeros(len(rows), int), np.zeros(len(rows))
    for label in (0, 1):
        fold[labels == label] = np.arange((labels == label).sum()) % 2
    for k in (0, 1):
        inside = np.flatnonzero(fold != k)
        part = fit_margin([rows[i] for i in inside], labels[inside])
        for i in np.flatnonzero(fold == k):
            margins[i] = part.margin(rows[i])
    model = fit_margin(rows, labels)
    model.slope, model.shift = fit_sigmoid(margins, labels)
    return model


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % HELD_OUT_OF == 0


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Fit on the bounded sample. The driver gets feature numbers, no texts."""
    known = labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("label"))
    learn = known.where(~F.coalesce(held_out(), F.lit(True))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    texts = docs.select("doc_id", text_or_empty().alias("body")).join(F.broadcast(learn), "doc_id")

    def features(batches):
        for batch in whole_texts(batches):
            found = [packed(ngrams(t)) for t in batch["_qm_text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"].astype("int32"), "features": found})

    sample = text_pieces(texts, "body").mapInPandas(features, "doc_id bigint, label int, features binary").toPandas()
    sample = sample.sort_values(["doc_id", "features"]).drop_duplicates("doc_id")
    return fit([unpacked(b) for b in sample["features"]], sample["label"].to_numpy(int))


def score_column(spark, model: Model) -> Column:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    shared = spark.sparkContext.broadcast(model)  # two arrays of 2**BITS floats, whatever the input

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        own = shared.value
        return pd.Series([own.score(t) for t in texts], dtype="float64")

    return score(text_or_empty())


def classify(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    model = train(docs, labels, max_train)
    scored = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), score_column(docs.sparkSession, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= KEEP_FROM).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """The rows of ``docs``, all columns, that are predicted to be good."""
    scored = docs.withColumn("_qm_score", score_column(docs.sparkSession, train(docs, labels, max_train)))
    return scored.where(F.col("_qm_score") >= KEEP_FROM).select(*docs.columns)
