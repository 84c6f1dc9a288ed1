"""Embedding whitening by a weighted multiplicity covariance.

Vectors become integers, equal ones meet once with their count (the fit list), and count or one is a vector's weight. Sums of the fit list
are exact integers; ``n * x - S`` is centred exactly before the division, so an offset of any size costs no digits. Every task multiplies
its centred vectors into one matrix (GEMM), the matrices are added in Spark in blocks, and the driver holds dimensions squared numbers for
the eigenvectors. Each distinct vector is projected once and joined back to its rows.

Copies: counting is combined on the map side, so a vector that a third of all rows hold moves once a task. In the join back, vectors with
more than a ``HOT``-th of all rows (``HOT`` at most, by their counts) are broadcast, so every key of the shuffled join is small.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailpot.llm.common import stored
from retailpot.llm.vectors import Shape, floored, lists, matrix, whole

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
HOT = 1000
BLOCK = 64   # matrix columns that are summed as one row


def sums(df: DataFrame, column: str, length: int, weight: str = "w") -> tuple[int, list]:
    """Weights' sum and the weighted sums of each position; longs stay exact."""
    real = dict(df.dtypes)[column] == "array<double>"
    kind = np.float64 if real else np.int64

    def run(batches):
        total, n = np.zeros(length, kind), 0
        for b in batches:
            w = b.column("w").to_numpy().astype(np.int64)
            total += w.astype(kind) @ matrix(b.column("x"), length).astype(kind)
            n += int(w.sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, length), pa.int32()), pa.array(np.concatenate(([n], np.zeros(length, np.int64) if real else total)), pa.int64()),
                                          pa.array(np.concatenate(([0.0], total.astype(float))), pa.float64())], names=["i", "whole", "part"])

    got = df.select(F.col(weight).alias("w"), F.col(column).alias("x")).mapInArrow(run, "i int, whole long, part double").groupBy("i").agg(F.sum("whole").alias("whole"), F.sum("part").alias("part"))
    by = {r.i: r for r in got.collect()}
    return (by[-1].whole if by else 0), [by[i].part if real else by[i].whole for i in range(length)] if by else []


def covariance(df: DataFrame, column: str, length: int, n: int, centred: Callable[[np.ndarray], np.ndarray], weight: str = "w") -> np.ndarray:
    """Weighted sum of products of ``centred`` vectors over ``n``; block rows are added in Spark."""
    n_blocks = -(-length // BLOCK)

    def run(batches):
        total = np.zeros((length, length))
        for b in batches:
            z = centred(matrix(b.column("x"), length))
            total += z.T @ (z * b.column("w").to_numpy().astype(float)[:, None])
        padded = np.zeros((length, n_blocks * BLOCK))
        padded[:, :length] = total
        for block in range(n_blocks):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(length), pa.int32()), pa.array(np.full(length, block), pa.int32()), lists(padded[:, block * BLOCK : (block + 1) * BLOCK], pa.float64())], names=["i", "block", "v"])

    parts = df.select(F.col(weight).alias("w"), F.col(column).alias("x")).mapInArrow(run, "i int, block int, v array<double>")
    added = parts.groupBy("i", "block").agg(F.array(*[F.sum(F.col("v")[k]) for k in range(BLOCK)]).alias("v"))
    out = np.zeros((length, n_blocks * BLOCK))
    for r in added.collect():
        out[r.i, r.block * BLOCK : (r.block + 1) * BLOCK] = r.v
    return out[:, :length] / n


def components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns; one without variance is 0."""
    value, vector = np.linalg.eigh((v + v.T) / 2)
    value, vector = value[::-1][:k], vector[:, ::-1][:, :k]
    least = max(float(np.abs(value).max(initial=0.0)) * len(v) * np.finfo(float).eps, 0.0)
    return np.where(value > least, value, 0.0), vector


def _deviation(moved: np.ndarray) -> np.ndarray:
    """Exact sums of squares of integer rows."""
    top = int(np.abs(moved).max(initial=0))
    if top * top * max(1, moved.shape[1]) < 1 << 63:
        return (moved * moved).sum(1)
    exact = [sum(int(v) ** 2 for v in row) for row in moved]
    if max(exact) >= 1 << 63:
        raise OverflowError("a squared deviation does not fit a long")
    return np.array(exact, np.int64)


def whiten(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", k: int = COMPONENTS, weights: str = "one",
           scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per kept row and component: ``id_column``, component, n, deviation, whitened, explained, identity_error.

    ``weights``: ``one`` counts each distinct vector once, ``count`` as often as it occurs. Rows whose vector is null or holds null or
    non-finite entries are left out. Null ids are ids, repeated rows are answered each, other columns are ignored, an empty table gives no
    rows. Fewer dimensions than ``k`` give as many components. A component without variance (fewer distinct vectors than dimensions, or
    equal entries) has ``whitened`` null and does not count for ``identity_error``; ``explained`` is null where nothing varies at all.
    Vectors of several lengths raise ValueError, a deviation beyond a long OverflowError.
    """
    if weights not in ("one", "count"):
        raise ValueError("weights: one or count")
    picked = rows.where(whole(F.col(vector))).select(F.col(id_column).alias("id"), floored(F.col(vector), scale, shift).alias("x"))
    key = F.unhex(F.sha2(F.array_join("x", ","), 256))
    fit = stored(picked.select(key.alias("key"), "x").groupBy("key", "x").agg(F.count("*").alias("rows")).withColumn("w", F.lit(1).cast("long") if weights == "one" else F.col("rows")), "fit_list")
    shape = Shape(fit, "x")
    length, k = shape.length, min(k, shape.length)
    schema = {"component": "int", "n": "long", "deviation": "long", "whitened": "double", "explained": "double", "identity_error": "double"}
    if not shape.n or not k:
        return picked.limit(0).select(F.col("id").alias(id_column), *[F.lit(None).cast(t).alias(c) for c, t in schema.items()])
    n, total = sums(fit, "x", length)
    s = np.array(total, np.int64)
    if n * (shape.top + abs(shift)) >= 1 << 62:
        raise OverflowError("sums of the fit list do not fit a long")
    v = covariance(fit, "x", length, n, lambda x: (n * x - s) / n)
    value, axes = components(v, k)
    trace, live = float(np.trace(v)), np.flatnonzero(value > 0)
    scaled = axes[:, live] / np.sqrt(value[live])

    def project(batches):
        for b in batches:
            moved = n * matrix(b.column("x"), length) - s
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("rows"), b.column("w"), pa.array(_deviation(moved), pa.int64()), lists((moved / n) @ scaled, pa.float64())],
                                             names=["key", "rows", "w", "deviation", "white"])

    white = stored(fit.mapInArrow(project, "key binary, rows long, w long, deviation long, white array<double>"), "whitened")
    error = 0.0
    if len(live):
        mean = np.array(sums(white, "white", len(live))[1]) / n
        error = float(np.abs(covariance(white, "white", len(live), n, lambda x: x - mean) - np.eye(len(live))).max())
    at = {c: j for j, c in enumerate(live.tolist())}
    one = F.array(*[F.struct(F.lit(c + 1).alias("component"), (F.col("white")[at[c]] if c in at else F.lit(None).cast("double")).alias("whitened"),
                             F.lit(float(value[c]) / trace if trace > 0 else None).cast("double").alias("explained")) for c in range(k)])
    joined = _back(picked.select("id", key.alias("key")), white, white.agg(F.sum("rows")).first()[0])
    return joined.select("id", "deviation", F.explode(one).alias("c")).select(
        F.col("id").alias(id_column), "c.component", F.lit(n).cast("long").alias("n"), "deviation", "c.whitened", "c.explained", F.lit(error).alias("identity_error"))


def _back(rows: DataFrame, white: DataFrame, n_rows: int) -> DataFrame:
    """``rows`` with what was computed for their vectors."""
    hot = white.where(F.col("rows") * HOT > F.lit(n_rows)).select("key", "deviation", "white")  # fewer than HOT rows
    rest = white.select("key", "deviation", "white")
    if not hot.limit(1).count():
        return rows.join(rest, "key")
    few = rows.join(F.broadcast(hot.select("key")), "key", "left_anti").join(rest, "key")
    return few.unionByName(rows.join(F.broadcast(hot), "key"))
