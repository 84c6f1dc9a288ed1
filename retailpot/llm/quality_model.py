"""Document quality from supervised subword embeddings.

Every hashed word and character n-gram has a learned vector; a document is the mean of its vectors, a softmax over two classes reads it.
Vectors and output are trained by numpy stochastic gradient descent with a falling rate on a bounded sample of labelled rows. With two
classes the score depends on one number per feature (vector times the difference of the class weights), so scoring looks up scalars.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailpot.llm.features import BUCKET_BITS, document_features, worker_scorer

SAMPLE = 2_000      # labelled rows that a fit reads at most
DIMENSIONS, STEPS, BATCH, RATE = 8, 600, 16, 4.0
FOLDS = 5


def held_out(doc_id) -> object:
    """True where the row is never learned from: crc32 of the id as text is a multiple of five."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE, label: str = "quality") -> tuple[list, np.ndarray]:
    """Texts and labels of at most ``limit`` rows outside the held-out fold, chosen by a hash of their id; a doubly labelled id counts as its worse label."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min(label).alias("_label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most ``limit`` rows
    rows = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("_label").alias("_label")).orderBy("doc_id").collect()
    return [r.text for r in rows], np.array([r["_label"] for r in rows], float)


class Model:
    """Feature weights and bias of the log odds of label 1."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), float(bias)


def fit(texts: list, y: np.ndarray, bits: int = BUCKET_BITS, seed: int = 7) -> Model:
    """Trained model; without both labels, a constant one at the share of label 1 (one half without any row)."""
    n = len(texts)
    if not n or y.min() == y.max():
        share = (y.sum() + 1) / (n + 2)
        return Model(np.zeros(1 << bits), np.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    docs = [(b, c / max(c.sum(), 1)) for b, c in document_features(texts, bits)]
    vectors = (rng.random((1 << bits, DIMENSIONS)) - 0.5) / DIMENSIONS
    output, bias = np.zeros((DIMENSIONS, 2)), np.zeros(2)
    target = np.stack([1 - y, y], 1)
    epochs = -(-STEPS // -(-n // BATCH))  # as many steps for a small sample as for a large one
    steps, step = epochs * -(-n // BATCH), 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for k in range(0, n, BATCH):
            batch = [i for i in order[k : k + BATCH] if len(docs[i][0])]
            rate, step = RATE * (1 - step / steps), step + 1
            if not batch:
                continue
            ids, share = np.concatenate([docs[i][0] for i in batch]), np.concatenate([docs[i][1] for i in batch])
            size = np.array([len(docs[i][0]) for i in batch])
            mean = np.add.reduceat(vectors[ids] * share[:, None], np.concatenate(([0], np.cumsum(size)[:-1])))
            z = mean @ output + bias
            z = np.exp(z - z.max(1, keepdims=True))
            error = (z / z.sum(1, keepdims=True) - target[batch]) / len(batch)
            pull = np.repeat(error @ output.T, size, axis=0) * share[:, None]
            output -= rate * (mean.T @ error)
            bias -= rate * 0.1 * error.sum(0)
            rows, where = np.unique(ids, return_inverse=True)
            # a document's mean spreads its gradient thinly over many vectors: their rate is raised in turn
            vectors[rows] -= rate * 20 * np.stack([np.bincount(where, pull[:, d], len(rows)) for d in range(DIMENSIONS)], 1)
    return Model(vectors @ (output[:, 1] - output[:, 0]), bias[1] - bias[0])


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 as ``out``; a null or empty text scores by the bias alone."""
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)
    bias = model.bias

    @F.pandas_udf("double")
    def probability(text: pd.Series) -> pd.Series:
        return pd.Series(1 / (1 + np.exp(-(worker_scorer(weights.value)(text.tolist()) + bias))))

    return docs.withColumn(out, probability(F.col("text")))
