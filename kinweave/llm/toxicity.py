"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

The classifier is fitted on a bounded sample of the labelled training documents, so the sample's ids can be broadcast
and no text is shuffled. One pass counts in how many toxic and other documents each hashed n-gram occurs; the
ratio of the smoothed shares is the scale of its feature. A second pass takes the features of fewer documents to the
driver for the logistic regression. A third scores all documents. What reaches the driver is bounded by the number of
features and of sampled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kinweave.llm.common import by_batch, returning_memory
from kinweave.session import ship_package

SIZES = (4, 5, 6)
BITS = 18
#: Features in fewer training documents, or with a ratio within so many standard errors of 0, are left out; of more
#: than so many, those with the most standard errors stay.
MIN_DOCS, MIN_ERRORS, MAX_FEATURES = 3, 4.0, 8_192
#: About so many labelled documents, drawn by a hash of their id, give the ratios; about so many of them the weights.
RATIO_ROWS, FIT_ROWS = 20_000, 6_000
#: A toxic document counts as so many others in the fit.
TOXIC_WEIGHT = 3.0
ROUNDS, STEP, RIDGE = 120, 0.1, 1e-3


def ngrams(text: str) -> np.ndarray:
    """Hashes of the text's character n-grams, with repeats. Case does not matter; white space is one space."""
    padded = " " + " ".join(text.lower().split()) + " "
    points = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out, h = [], points
    with np.errstate(over="ignore"):
        for n in range(2, max(SIZES) + 1):
            if len(points) < n:
                break
            h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1 :]
            if n in SIZES:
                mixed = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
                out.append((mixed >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(out) if out else np.empty(0, np.int64)


@dataclass
class Model:
    """Weight of each feature, its ratio included, and the intercept."""

    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        """Probability of label 1. A null text counts as empty."""
        found = ngrams(text or "")
        found = np.unique(found[self.weights[found] != 0])
        return float(1 / (1 + np.exp(-np.clip(self.weights[found].sum() + self.bias, -500, 500))))


def log_ratios(toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int) -> np.ndarray:
    """Log of the ratio of the smoothed shares of documents with a feature; 0 for features left out."""
    ratio = np.log((toxic + 1) / (n_toxic + 2)) - np.log((other + 1) / (n_other + 2))
    error = np.sqrt(1 / (toxic + 1) + 1 / (other + 1))
    errors = np.where(toxic + other >= MIN_DOCS, np.abs(ratio) / error, 0.0)
    least = max(MIN_ERRORS, np.sort(errors)[-MAX_FEATURES - 1] if len(errors) > MAX_FEATURES else 0.0)
    return np.where(errors >= least, ratio, 0.0)


def fit(features: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, prior: float) -> Model:
    """Logistic regression with a ridge on binary features times their ratios, by adaptive gradient steps."""
    weights, bias = np.zeros(len(ratios)), prior
    if len(labels) and 0 < labels.sum() < len(labels):
        flat = np.concatenate(features)
        row = np.repeat(np.arange(len(features), dtype=np.int32), [len(f) for f in features])
        value = ratios[flat].astype(np.float32)
        squares, bias_square = np.full(len(ratios), 1e-8), 1e-8
        counts = np.where(labels == 1, TOXIC_WEIGHT, 1.0)
        counts /= counts.sum()
        for _ in range(ROUNDS):
            z = np.bincount(row, weights=value * weights[flat], minlength=len(features)) + bias
            error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels) * counts
            slope = np.bincount(flat, weights=value * error[row], minlength=len(ratios)) + RIDGE * weights
            squares += slope * slope
            weights -= STEP * slope / np.sqrt(squares)
            bias_square += error.sum() ** 2
            bias -= STEP * error.sum() / np.sqrt(bias_square)
    return Model((weights * ratios).astype(np.float32), float(bias))


def fold(id_col: str = "doc_id"):
    """Remainder by 5 of the crc32 of the id as text; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5, F.lit(0))


def train(docs: DataFrame, labels: DataFrame, ratio_rows: int = RATIO_ROWS, fit_rows: int = FIT_ROWS) -> Model:
    """A model from the labelled documents outside fold 0. Documents without a label take no part.

    Of several labels of one id the larger counts, so the sample holds an id once.
    """
    ship_package(docs.sparkSession)
    known = labels.where(F.col("toxic").isNotNull() & (fold() != 0)).groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")
    )
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    below = lambda rows, of: draw < F.lit(min(1.0, rows / max(1.0, of)) * 1_000_000)
    # The sample's size is a parameter, so its ids may be broadcast.
    n_known = known.count()
    ratio_rows = min(ratio_rows, n_known)
    drawn = known.where(below(ratio_rows, n_known))
    rows = docs.select("doc_id", F.col("text").cast("string")).join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "toxic")
    width = 1 << BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, seen = np.zeros((2, width + 1), np.int64), np.zeros(width, bool)
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                found = ngrams(text.as_py() or "")
                seen[found] = True
                totals[int(toxic == 1), :width] += seen
                seen[found] = False
                totals[int(toxic == 1), width] += 1
        used = np.flatnonzero(totals.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(totals[1, used]), pa.array(totals[0, used])], names=["feature", "toxic", "other"]
        )

    counts = rows.select("text", "toxic").mapInArrow(returning_memory(count), "feature long, toxic long, other long")
    counts = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).toArrow()
    totals = np.zeros((2, width + 1))
    at = counts.column("feature").to_numpy()
    totals[0, at], totals[1, at] = counts.column("other").to_numpy(), counts.column("toxic").to_numpy()
    n_other, n_toxic = totals[:, width]
    ratios = log_ratios(totals[1, :width], totals[0, :width], n_toxic, n_other)

    # Of the documents drawn those with the smallest hashes.
    fewer = min(1.0, fit_rows / max(1.0, float(n_other + n_toxic)))
    sample = rows.where(below(ratio_rows * fewer, n_known))
    used = ratios != 0

    def features():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = []
            for text in batch.column(1):
                grams = ngrams(text.as_py() or "")
                found.append(np.unique(grams[used[grams]]).astype("<i4").tobytes())
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.binary())], names=["doc_id", "toxic", "found"])

        return run

    kind = docs.schema["doc_id"].dataType.simpleString()
    sampled = by_batch(sample, features, f"doc_id {kind}, toxic int, found binary").toArrow().sort_by("doc_id")
    return fit(
        [np.frombuffer(f, "<i4") for f in sampled.column("found").to_pylist()], (sampled.column("toxic").to_numpy() == 1).astype(float),
        ratios, float(np.log((n_toxic + 1) / (n_other + 2))),
    )


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row; repeated rows get equal scores."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            score = [model.score(t.as_py()) for t in batch.column(2)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array([int(s >= 0.5) for s in score], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"],
            )

        return run

    narrow = docs.select("doc_id", (fold() == 0).alias("held_out"), F.col("text").cast("string"))
    return by_batch(narrow, make, f"doc_id {kind}, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows, all columns, whose text scores below one half."""
    at = docs.columns.index("text")

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array([model.score(t.as_py()) < 0.5 for t in batch.column(at)], pa.bool_()))

        return run

    return by_batch(docs, make, docs.schema)


def train_and_score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scores(docs, train(docs, labels))
