"""Shapley values of a tree ensemble, one row per outlet.

The game of a row is the tree's expected value when only some features are known: at a split on a known feature the row's side is taken,
at any other both sides, weighted by the training weight (cover) that went there. A leaf of value v, whose path splits on features D,
gives feature i the share

    v (o_i - z_i) * sum over subsets S of D without i of |S|! (|D|-|S|-1)! / |D|! * prod_{S} o_j * prod_{rest} z_j

where o_j says whether the row takes every split of the path on j, and z_j is the product of the cover shares of those splits. The sum over
subsets is the integral over t in [0, 1] of prod_{j != i} (z_j (1 - t) + o_j t), a polynomial of degree below |D|, which Gauss-Legendre
points integrate exactly: work per leaf grows with |D| squared, not with 2^|D|. Rows with the same o share it.

Contributions and ``base_value`` (the trees' expectation) add up to the prediction. The node table (trees x 2^depth rows at most) travels
with the function.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def node_table(model: Model) -> list[dict]:
    """Per tree: arrays of feature, threshold, children and value, read from the fitted model."""
    weights = list(model.treeWeights)
    total = sum(weights) if type(model).__name__.startswith("RandomForest") else 1.0
    trees = []
    for tree, weight in zip(model.trees, weights):
        flat: dict[str, list] = {"feature": [], "threshold": [], "left": [], "right": [], "value": [], "cats": [], "cover": []}

        def walk(node) -> int:
            i = len(flat["value"])
            flat["value"].append(node.prediction())
            flat["cover"].append(node.impurityStats().count())
            leaf = node.subtreeDepth() == 0
            flat["feature"].append(-1 if leaf else node.split().featureIndex())
            split = None if leaf else node.split()
            by_value = leaf or split.getClass().getSimpleName() == "ContinuousSplit"
            flat["threshold"].append(0.0 if leaf or not by_value else split.threshold())
            flat["cats"].append(None if by_value else frozenset(split.leftCategories()))
            flat["left"].append(-1)
            flat["right"].append(-1)
            if not leaf:
                flat["left"][i] = walk(node.leftChild())
                flat["right"][i] = walk(node.rightChild())
            return i

        walk(tree._java_obj.rootNode())
        trees.append({**{k: np.asarray(flat[k]) for k in ("feature", "threshold", "left", "right", "value", "cover")},
                      "cats": flat["cats"], "weight": weight / total})
    return trees


class Leaf(NamedTuple):
    """A leaf by the distinct features of its path; ``value`` holds the tree's weight already."""

    value: float
    features: np.ndarray             # distinct features of the path
    share: np.ndarray                # product of cover shares per feature
    steps: list[list[tuple[int, bool]]]   # per feature the splits on it: node and whether the path goes left


def leaves(tree: dict) -> list[Leaf]:
    out: list[Leaf] = []

    def walk(node: int, path: dict[int, tuple[float, list]]) -> None:
        f = int(tree["feature"][node])
        if f < 0:
            names = list(path)
            out.append(Leaf(tree["weight"] * float(tree["value"][node]), np.array(names, int), np.array([path[n][0] for n in names]), [path[n][1] for n in names]))
            return
        share, steps = path.get(f, (1.0, []))
        for side, child in ((True, int(tree["left"][node])), (False, int(tree["right"][node]))):
            part = float(tree["cover"][child] / tree["cover"][node])
            walk(child, {**path, f: (share * part, [*steps, (node, side)])})

    walk(0, {})
    return out


def expectation(tree: dict) -> float:
    """Mean leaf value by cover."""
    return sum(leaf.value * float(np.prod(leaf.share)) for leaf in leaves(tree))


def _shares(one: np.ndarray, share: np.ndarray) -> np.ndarray:
    """(o_i - z_i) times the weighted subset sum for each pattern row of ``one`` and feature."""
    m = len(share)
    points, weights = np.polynomial.legendre.leggauss(m // 2 + 1)
    total = np.zeros(one.shape)
    for t, w in zip((points + 1) / 2, weights / 2, strict=True):
        factor = share * (1 - t) + one * t
        before, after = np.ones(one.shape), np.ones(one.shape)
        before[:, 1:] = np.cumprod(factor[:, :-1], axis=1)
        after[:, :-1] = np.cumprod(factor[:, :0:-1], axis=1)[:, ::-1]
        total += w * before * after
    return (one - share) * total


def shapley(x: np.ndarray, trees: list[dict], n_features: int) -> tuple[np.ndarray, float]:
    """Contributions of the rows ``x`` and the value that they start from."""
    out, base = np.zeros((len(x), n_features)), 0.0
    for tree in trees:
        goes_left = {}
        for node in np.flatnonzero(tree["feature"] >= 0).tolist():
            v, cats = x[:, tree["feature"][node]], tree["cats"][node]
            goes_left[node] = v <= tree["threshold"][node] if cats is None else np.isin(v, list(cats))
        for leaf in leaves(tree):
            base += leaf.value * float(np.prod(leaf.share))
            if not len(leaf.features) or not len(x):
                continue
            one = np.stack([np.logical_and.reduce([goes_left[node] == side for node, side in steps]) for steps in leaf.steps], axis=1)
            pattern, inverse = np.unique(np.packbits(one, axis=1), axis=0, return_inverse=True)
            kinds = np.unpackbits(pattern, axis=1, count=one.shape[1]).astype(float)
            out[:, leaf.features] += leaf.value * _shares(kinds, leaf.share)[inverse.ravel()]
    return out, base


def feature_contributions(assembled: DataFrame, model: Model, features: Sequence[str]) -> DataFrame:
    """Outlet_ID, one Shapley value per feature and ``base_value``: their sum is the prediction. Row order and batches do not matter."""
    trees, names = node_table(model), list(features)
    schema = "Outlet_ID string, " + ", ".join(f"`{n}` double" for n in names) + ", base_value double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = np.vstack(pdf["x"].to_numpy()) if len(pdf) else np.zeros((0, len(names)))
            contrib, base = shapley(x, trees, len(names))
            frame = pd.DataFrame(contrib, columns=names)
            frame.insert(0, "Outlet_ID", pdf["Outlet_ID"].to_numpy())
            frame["base_value"] = base
            yield frame

    return assembled.select("Outlet_ID", vector_to_array("features").alias("x")).mapInPandas(run, schema)


def long_contributions(wide: DataFrame, features: Sequence[str], key: str = "Outlet_ID") -> DataFrame:
    """(key, feature, contribution) rows."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"`{f}`").cast("double").alias("contribution")) for f in features]))
    return wide.select(key, pairs.alias("x")).select(key, "x.*")
