"""Quality rules: plain text statistics and a calibrated logistic regression over hashed n-grams, against fixed thresholds.

The regression (``features``: words, character n-grams, repeats; averaged per text) is trained by numpy gradient steps with per-feature
rates on a bounded labelled sample; one row in five of it is set aside to fit the calibration (a logistic curve over the raw score).
Statistics and score are computed together in Arrow batches, each text whole, a bounded chunk at a time.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailpot.llm.features import BUCKET_BITS, document_features, worker_scorer
from retailpot.llm.words import Words, chunks, mix, shingle_hashes

MIN_WORDS = 50             # base rule: fewer words fail
MAX_REPEAT_PERCENT = 50    # base rule: a larger share of words in repeated windows fails
WINDOW = 3
KEEP_PROBABILITY = 0.5     # calibrated probability of label 1 from which a text is kept
STEPS, BATCH, RATE = 500, 16, 1.0
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_U = np.uint64


class Rules(NamedTuple):
    weights: np.ndarray
    bias: float
    slope: float      # calibration of the raw log odds
    shift: float


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _calibrate(raw: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of a logistic curve over ``raw``, by Newton steps on smoothed targets and a slight pull to slope one."""
    high, low = ((y == 1).sum() + 1) / ((y == 1).sum() + 2), 1 / ((y == 0).sum() + 2)
    target, x, w = np.where(y == 1, high, low), np.stack([raw, np.ones_like(raw)], 1), np.array([1.0, 0.0])
    for _ in range(steps):
        p = _sigmoid(x @ w)
        pull = x.T @ (p - target) + 1e-2 * (w - (1.0, 0.0))
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2), pull)
        w = w - np.clip(move, -1, 1)
        if abs(move).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit(texts: list, y: np.ndarray, bits: int = BUCKET_BITS, seed: int = 11) -> Rules:
    """Trained and calibrated rules; without both labels, a constant verdict at the share of label 1 (one half without any row)."""
    n = len(texts)
    if not n or y.min() == y.max():
        share = (y.sum() + 1) / (n + 2)
        return Rules(np.zeros(1 << bits, np.float32), float(np.log(share / (1 - share))), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    docs = [(b, c / max(c.sum(), 1)) for b, c in document_features(texts, bits)]
    aside = np.arange(n) % 5 == 4
    if len(set(y[aside])) < 2 or len(set(y[~aside])) < 2:
        aside[:] = False
    learn = np.flatnonzero(~aside)
    w, seen, bias = np.zeros(1 << bits), np.full(1 << bits, 1e-8), 0.0
    for _ in range(-(-STEPS // -(-len(learn) // BATCH))):
        order = rng.permutation(learn)
        for k in range(0, len(order), BATCH):
            batch = [i for i in order[k : k + BATCH] if len(docs[i][0])]
            if not batch:
                continue
            ids, share = np.concatenate([docs[i][0] for i in batch]), np.concatenate([docs[i][1] for i in batch])
            size = np.array([len(docs[i][0]) for i in batch])
            error = _sigmoid(np.add.reduceat(w[ids] * share, np.concatenate(([0], np.cumsum(size)[:-1]))) + bias) - y[batch]
            rows, where = np.unique(ids, return_inverse=True)
            pull = np.bincount(where, np.repeat(error, size) * share, len(rows))
            seen[rows] += pull * pull
            w[rows] -= RATE * pull / np.sqrt(seen[rows])
            bias -= 0.05 * error.mean()
    raw = np.array([w[b] @ c if len(b) else 0.0 for b, c in docs]) + bias
    test = np.flatnonzero(aside) if aside.any() else learn
    return Rules(w.astype(np.float32), bias, *_calibrate(raw[test], y[test]))


def text_stats(w: Words) -> dict[str, np.ndarray]:
    """``STATS`` of each text of the chunk."""
    n, data = w.n_docs, w.data
    before = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    marks = np.concatenate(([0], np.cumsum(SYMBOL[data])))
    out = {"n_words": w.per_doc, "word_chars": np.bincount(w.doc, before[w.end] - before[w.start], n).astype(np.int64),
           "n_symbols": marks[w.doc_end] - marks[w.doc_start]}
    # lines with a word: equal lines share the hash of their bytes
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    filled = np.searchsorted(w.start, ends) > np.searchsorted(w.start, starts)
    starts, ends = starts[filled], ends[filled]
    line_doc = np.searchsorted(w.doc_end, starts, side="right")
    key = mix(w.span_hash(starts, ends) + line_doc.astype(np.uint64))
    out["n_dup_lines"] = np.bincount(line_doc, minlength=n) - np.bincount(line_doc[np.unique(key, return_index=True)[1]], minlength=n)
    # words in windows that occur twice or more
    doc, h = shingle_hashes(w, WINDOW)
    long = w.per_doc[doc] >= WINDOW
    doc, h = doc[long], h[long]
    _, inverse, times = np.unique(mix(h + doc.astype(np.uint64)), return_inverse=True, return_counts=True)
    first = w.first[doc] + (np.arange(len(doc)) - np.searchsorted(doc, doc))
    hit = np.zeros(len(w.start) + 1, np.int64)
    twice = first[times[inverse] >= 2]
    hit[: len(w.start)] = np.bincount(twice, minlength=len(w.start))[: len(w.start)] if len(twice) else 0
    covered = np.zeros(len(w.start), bool)
    for k in range(WINDOW):
        covered[k:] |= hit[: len(w.start) - k][: max(len(w.start) - k, 0)] > 0
    out["n_repeat_words"] = np.bincount(w.doc, covered, n).astype(np.int64)
    return out


def judge(docs: DataFrame, rules: Rules, keep: float = KEEP_PROBABILITY) -> DataFrame:
    """``docs`` with ``STATS`` (long), ``base_failed``, ``quality`` (calibrated probability) and ``kept``; existing columns of these names give way.

    A null or empty text has no words, so it fails the base rule. Repeated rows get equal results; an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(rules)

    @F.pandas_udf(", ".join(f"{c} long" for c in STATS) + ", quality double")
    def measure(text: pd.Series) -> pd.DataFrame:
        r = shared.value
        scorer = worker_scorer(r.weights)
        texts, parts = text.tolist(), []
        for _, part in chunks(texts):
            w = Words(part)
            stats = text_stats(w)
            stats["quality"] = _sigmoid((scorer.score(w) + r.bias) * r.slope + r.shift)
            parts.append(pd.DataFrame(stats))
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({c: [] for c in (*STATS, "quality")})

    out = docs.drop(*STATS, "base_failed", "quality", "kept").withColumn("_m", measure(F.col("text"))).select("*", "_m.*").drop("_m")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("quality") >= keep))
