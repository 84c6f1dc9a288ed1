"""Boosted regression trees for any twice differentiable loss, by Newton steps over Spark ML trees.

A round takes the loss's slope g and curvature h of every training row at its present margin and fits one Spark ML regression tree to -g / h
with weight h. The mean of such a leaf is -sum(g) / sum(h): the Newton step of the leaf, so the tree needs no second pass for its values.
The fitted trees become one ``GBTRegressionModel``: it scores in the JVM, is saved and loaded like any other model, and has trees for the
feature contributions.

With held-out rows the loss on them is followed round by round; when it has not fallen for ``patience`` rounds, boosting stops and the trees
behind the best round are dropped. Margins are kept as a column and updated by the newest tree only; lineage is cut by a reliable
checkpoint every ``CUT_EVERY`` rounds and the rounds between are persisted.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailpot.session import cut

CUT_EVERY = 10
LEAST_CURVATURE = 1e-6
# fixed values: erfc(x) = t exp(-x^2 + sum of ERFC[k] t^k), t = 1 / (1 + x / 2), a published Chebyshev fit for x >= 0
ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


class Loss(NamedTuple):
    """``start``: label whose weighted mean is the first margin; ``terms``: (slope, curvature, loss) of a row at a margin; ``link``: margin to prediction."""

    start: Callable[[], Column]
    terms: Callable[[Column], tuple[Column, Column, Column]]
    link: Callable[[Column], Column]


def squared(label: str = "target") -> Loss:
    """Half the squared error."""
    y = F.col(label)
    return Loss(lambda: y, lambda m: (m - y, F.lit(1.0), (m - y) * (m - y) / 2), lambda m: m)


def log_upper_tail(z: Column) -> Column:
    """log P(Z > z) for a standard normal Z; Spark has no error function. Relative error of the tail below 2e-7 on the whole line."""
    x = F.abs(z) / math.sqrt(2.0)
    t = 1.0 / (1.0 + 0.5 * x)
    poly = F.lit(ERFC[-1])
    for c in reversed(ERFC[:-1]):
        poly = poly * t + F.lit(c)
    outer = math.log(0.5) + F.log(t) - x * x + poly   # beyond |z|
    return F.when(z >= 0, outer).otherwise(F.log1p(-F.exp(outer)))


def censored_normal(lower: str = "lower_bound", censor: str = "censor", sigma: float = 1.0) -> Loss:
    """Negative log likelihood of log demand ~ N(margin, sigma), observed where ``censor`` is 1, else known to be at least ``lower``.

    With z = (log(lower) - margin) / sigma: an observed row costs z^2 / 2 + log(sigma * lower * sqrt(2 pi)), a censored one -log P(Z > z); its
    slope is the hazard r = density / tail over sigma, its curvature r (r - z) over sigma squared.
    """
    y = F.log(F.col(lower))
    exact = F.col(censor) == 1.0
    half_log = 0.5 * math.log(2 * math.pi)

    def terms(m: Column) -> tuple[Column, Column, Column]:
        z = (y - m) / sigma
        log_tail = log_upper_tail(z)
        hazard = F.exp(-z * z / 2 - half_log - log_tail)
        slope = F.when(exact, -z).otherwise(-hazard) / sigma
        curve = F.when(exact, F.lit(1.0)).otherwise(F.greatest(hazard * (hazard - z), F.lit(LEAST_CURVATURE))) / (sigma * sigma)
        cost = F.when(exact, z * z / 2 + half_log + math.log(sigma) + y).otherwise(-log_tail)
        return slope, curve, cost

    return Loss(lambda: y, terms, F.exp)


class Fit(NamedTuple):
    """A fitted booster; ``transform`` adds ``prediction``."""

    model: GBTRegressionModel
    train_loss: list[float]      # mean loss before the first round and after each
    held_out_loss: list[float]   # the same on the held-out rows, empty without any
    kept: int                    # rounds that the model holds
    link: Callable[[Column], Column]

    def transform(self, rows: DataFrame) -> DataFrame:
        return self.model.setPredictionCol("_margin").transform(rows).withColumn("prediction", self.link(F.col("_margin"))).drop("_margin")


class Booster(NamedTuple):
    """Settings of a fit. ``subsample`` draws rows anew each round by a hash of ``key``."""

    loss: Loss
    rounds: int = 100
    depth: int = 6
    rate: float = 0.05
    patience: int = 50
    subsample: float = 1.0
    min_rows: int = 1
    seed: int = 42
    key: str = "Outlet_ID"
    features: str = "features"

    def fit(self, train: DataFrame, held_out: Column | None = None) -> Fit:
        """``held_out``: true for rows that only judge the rounds (null counts as false)."""
        aside = F.coalesce(held_out, F.lit(False)) if held_out is not None else F.lit(False)
        data = cut(train.withColumn("_aside", aside))  # a tree reads its rows several times
        learn = ~F.col("_aside")
        first = self._tree(data.where(learn).select(self.features, self.loss.start().alias("_step"), F.lit(1.0).alias("_weight")), 0)
        trees, weights = [first], [1.0]
        state, before = self._terms(data.withColumn("_margin", F.lit(_root(first)))), None
        losses, judged, kept = [], [], 0
        for k in range(self.rounds + 1):
            r = state.agg(F.avg(F.when(learn, F.col("_loss"))).alias("seen"), F.avg(F.when(~learn, F.col("_loss"))).alias("unseen")).first()
            if before is not None:
                before.unpersist()   # the new state has just been computed from it
            losses.append(r.seen)
            if r.unseen is not None:
                judged.append(r.unseen)
            kept = int(np.argmin(judged)) if judged else k
            if k == self.rounds or k - kept >= self.patience:
                break
            drawn = learn if self.subsample >= 1 else learn & (F.pmod(F.xxhash64(self.key, F.lit(self.seed), F.lit(k)), F.lit(1 << 20)) < int(self.subsample * (1 << 20)))
            tree = self._tree(state.where(drawn).select(self.features, (-F.col("_slope") / F.col("_curve")).alias("_step"), F.col("_curve").alias("_weight")), self.depth)
            trees.append(tree)
            weights.append(self.rate)
            moved = tree.setPredictionCol("_newest").transform(state.drop("_slope", "_curve", "_loss"))
            moved = self._terms(moved.withColumn("_margin", F.col("_margin") + self.rate * F.col("_newest")).drop("_newest"))
            before, state = state, (cut(moved) if (k + 1) % CUT_EVERY == 0 else moved.persist())
        state.unpersist()
        return Fit(_ensemble(train.sparkSession, trees[: kept + 1], weights[: kept + 1]), losses, judged, kept, self.loss.link)

    def _tree(self, rows: DataFrame, depth: int):
        return DecisionTreeRegressor(labelCol="_step", weightCol="_weight", featuresCol=self.features, maxDepth=depth, minInstancesPerNode=self.min_rows,
                                     maxBins=64, seed=self.seed).fit(rows)

    def _terms(self, df: DataFrame) -> DataFrame:
        slope, curve, cost = self.loss.terms(F.col("_margin"))
        return df.withColumns({"_slope": slope, "_curve": curve, "_loss": cost})


def _root(tree) -> float:
    return float(tree._java_obj.rootNode().prediction())


def _ensemble(spark, trees: list, weights: list[float]) -> GBTRegressionModel:
    """Trees as one model of Spark's."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    kinds = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    numbers = gateway.new_array(jvm.double, len(trees))
    for i, (t, w) in enumerate(zip(trees, weights, strict=True)):
        kinds[i], numbers[i] = t._java_obj, float(w)
    return GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(f"boosted_{uuid.uuid4().hex[:12]}", kinds, numbers, trees[0].numFeatures))
