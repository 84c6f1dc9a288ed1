"""Shapley values, boosting, ordered category codes, the parameter sampler and the run store."""

import math
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from retailpot.operators import attribution, boosting, models, ranking, search
from retailpot.operators.target_codes import TargetCodes
from retailpot.sources.run_store import RunStore


# --- Shapley values --------------------------------------------------------------------------

def known_value(tree, x, known, node=0):
    """Expected value of a tree when only the features in ``known`` are known."""
    f = tree["feature"][node]
    if f < 0:
        return tree["value"][node]
    left, right = tree["left"][node], tree["right"][node]
    if f in known:
        goes = x[f] <= tree["threshold"][node] if tree["cats"][node] is None else x[f] in tree["cats"][node]
        return known_value(tree, x, known, left if goes else right)
    share = tree["cover"][left] / tree["cover"][node]
    return share * known_value(tree, x, known, left) + (1 - share) * known_value(tree, x, known, right)


def brute_shapley(trees, x, n):
    out = np.zeros(n)
    value = lambda known: sum(t["weight"] * known_value(t, x, known) for t in trees)
    for i in range(n):
        rest = [j for j in range(n) if j != i]
        for size in range(n):
            for s in combinations(rest, size):
                out[i] += factorial(size) * factorial(n - size - 1) / factorial(n) * (value({*s, i}) - value(set(s)))
    return out, value(set())


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(2)
    rows = [(f"o{i:03d}", ["a", "b", "c", "d"][i % 4], *map(float, rng.normal(size=4))) for i in range(240)]
    rows = [(*r, float(3 * r[2] + (r[3] > 0) * r[4] * 4 + "abcd".index(r[1]) % 3 + abs(r[5]))) for r in rows]
    df = spark.createDataFrame(rows, "Outlet_ID string, kind string, x double, y double, z double, w double, target double")
    steps = [StringIndexer(inputCol="kind", outputCol="kind_code", stringOrderType="alphabetAsc"), VectorAssembler(inputCols=["kind_code", "x", "y", "z", "w"], outputCol="features")]
    return Pipeline(stages=steps).fit(df).transform(df).withColumn("fold", (F.substring("Outlet_ID", 2, 3).cast("int") % 5)).cache()


NAMES = ["kind_code", "x", "y", "z", "w"]


@pytest.mark.parametrize("kind,params", [(DecisionTreeRegressor, {"maxDepth": 7}), (RandomForestRegressor, {"numTrees": 4, "maxDepth": 5, "seed": 1}), (GBTRegressor, {"maxIter": 3, "maxDepth": 4, "seed": 1})])
def test_shapley_values_equal_the_sum_over_subsets(points, kind, params):
    estimator = kind(labelCol="target", **params)
    model = estimator.fit(points)
    if isinstance(estimator, DecisionTreeRegressor):
        model = boosting._ensemble(points.sparkSession, [model], [1.0])
    trees = attribution.node_table(model)
    assert any(c is not None for t in trees for c in t["cats"])   # a split by category is met
    wide = {r.Outlet_ID: r for r in attribution.feature_contributions(points, model, NAMES).collect()}
    scored = {r.Outlet_ID: r for r in model.transform(points).collect()}
    for oid in list(scored)[:12]:
        x = scored[oid].features.toArray()
        want, base = brute_shapley(trees, x, 5)
        assert np.allclose([wide[oid][n] for n in NAMES], want, atol=1e-9) and wide[oid].base_value == pytest.approx(base)
    for oid, r in scored.items():
        assert sum(wide[oid][n] for n in NAMES) + wide[oid].base_value == pytest.approx(r.prediction, abs=1e-8)


def test_shapley_values_of_hand_made_trees():
    """A feature twice on a path; a feature that changes nothing; symmetric features share alike."""
    tree = {"feature": np.array([0, 0, 1, -1, -1, -1, -1]), "threshold": np.array([2.0, 1.0, 0.0, 0, 0, 0, 0]), "left": np.array([1, 3, 5, -1, -1, -1, -1]),
            "right": np.array([2, 4, 6, -1, -1, -1, -1]), "value": np.array([0, 0, 0, 1.0, 5.0, 5.0, 9.0]), "cover": np.array([10.0, 6, 4, 2, 4, 1, 3]), "cats": [None] * 7, "weight": 0.5}
    x = np.array([[0.5, -1.0, 7.0], [1.5, 3.0, 0.0], [5.0, 1.0, 0.0]])
    got, base = attribution.shapley(x, [tree], 3)
    for row, g in zip(x, got, strict=True):
        want, b = brute_shapley([tree], row, 3)
        assert np.allclose(g, want) and b == pytest.approx(base) and g[2] == 0
    assert attribution.expectation(tree) == pytest.approx(base)
    assert attribution.shapley(np.zeros((0, 3)), [tree], 3)[0].shape == (0, 3)


def test_contributions_of_an_empty_table_and_a_stump(points):
    stump = boosting._ensemble(points.sparkSession, [DecisionTreeRegressor(labelCol="target", maxDepth=0).fit(points)], [1.0])
    assert attribution.feature_contributions(points.limit(0), stump, NAMES).count() == 0
    assert {tuple(r)[1:6] for r in attribution.feature_contributions(points, stump, NAMES).collect()} == {(0.0,) * 5}


# --- boosting --------------------------------------------------------------------------------

def test_upper_tail(spark):
    z = [-9.0, -3.0, -0.5, 0.0, 0.2, 1.7, 5.0, 12.0]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in z], "z double").select(boosting.log_upper_tail(F.col("z"))).collect()]
    assert got == pytest.approx([math.log(0.5 * math.erfc(v / math.sqrt(2))) for v in z], rel=1e-6, abs=1e-7)


@pytest.fixture(scope="module")
def censored(spark):
    rng = np.random.default_rng(0)
    n = 500
    a, b = rng.random(n), rng.random(n)
    f = 1 + 2 * np.sin(3 * a) + 1.5 * (b > 0.5)
    y = np.exp(f + 0.4 * rng.standard_normal(n))
    limit = np.quantile(y, 0.7) * np.exp(0.3 * rng.standard_normal(n))
    rows = [(f"o{i}", float(a[i]), float(b[i]), float(min(y[i], limit[i])), float(y[i] <= limit[i]), float(f[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "Outlet_ID string, a double, b double, lower_bound double, censor double, f double").coalesce(2)
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).cache()


def test_censored_boosting_recovers_planted_demand(censored):
    share = censored.agg(F.avg(1 - F.col("censor"))).first()[0]
    assert 0.2 < share < 0.4
    fit = boosting.Booster(boosting.censored_normal(sigma=0.4), rounds=14, depth=3, rate=0.3).fit(censored)
    assert all(b < a for a, b in zip(fit.train_loss, fit.train_loss[1:])) and fit.kept == 14 and fit.held_out_loss == []
    error = lambda m, c: m.transform(censored).agg(F.sqrt(F.avg((F.log(c) - F.col("f")) ** 2))).first()[0]
    linear = models.linear_latent().fit(censored.withColumn("label", F.col("lower_bound")))
    blind = boosting.Booster(boosting.censored_normal(sigma=0.4), rounds=14, depth=3, rate=0.3).fit(censored.withColumn("censor", F.lit(1.0)))
    boosted = error(fit, "prediction")
    assert boosted < 0.6 * error(linear, "prediction") and boosted < error(blind, "prediction")


def test_loss_slopes_are_the_derivatives(censored):
    loss, h = boosting.censored_normal(sigma=0.7), 1e-3
    rows = censored.limit(60).withColumn("m", F.lit(1.5))
    at = lambda d: loss.terms(F.col("m") + d)
    got = rows.select(at(0)[0].alias("g"), at(0)[1].alias("h"), at(0)[2].alias("l"), at(h)[2].alias("up"), at(-h)[2].alias("down"), "censor").collect()
    assert {r.censor for r in got} == {0.0, 1.0}
    for r in got:
        assert r.g == pytest.approx((r.up - r.down) / (2 * h), abs=1e-3)
        assert r.h == pytest.approx((r.up - 2 * r.l + r.down) / h**2, abs=0.3)


def test_rounds_follow_the_held_out_rows(points):
    noisy = points.withColumn("target", F.col("target") + 6 * F.randn(3)).cache()
    booster = boosting.Booster(boosting.squared(), rounds=14, depth=5, rate=0.6, patience=3)
    kept = []
    for k in (0, 3):
        fit = booster.fit(noisy, F.col("fold") == k)
        assert fit.kept == int(np.argmin(fit.held_out_loss)) and len(fit.held_out_loss) in (15, fit.kept + 4)
        assert isinstance(fit.model, GBTRegressionModel) and len(fit.model.trees) == fit.kept + 1
        loss = fit.transform(noisy.where(F.col("fold") == k)).agg(F.avg((F.col("prediction") - F.col("target")) ** 2) / 2).first()[0]
        assert loss == pytest.approx(fit.held_out_loss[fit.kept])
        kept.append((fit.kept, round(loss, 6)))
    assert max(k for k, _ in kept) < 14 and len(set(kept)) == 2


# --- ordered category codes ------------------------------------------------------------------

@pytest.mark.parametrize("block", [1 << 16, 16])
def test_ordered_codes_equal_a_walk_and_hide_the_own_target(spark, monkeypatch, block):
    monkeypatch.setattr(ranking, "BLOCK", block)
    monkeypatch.setattr(ranking.running_sum, "__defaults__", ((), block, None))
    rng = np.random.default_rng(4)
    rows = [(f"o{i:03d}", None if i % 13 == 0 else "hot" if i % 3 else f"k{i % 5}", float(rng.integers(0, 50))) for i in range(120)]
    df = spark.createDataFrame(rows, "Outlet_ID string, kind string, target double")
    codes = TargetCodes(["kind"], weight=2.0)
    model = codes.fit(df)
    got = {r.Outlet_ID: r.kind_code for r in model.ordered(df).collect()}
    order = [r.Outlet_ID for r in df.orderBy(F.xxhash64("Outlet_ID", F.lit(42)), "Outlet_ID").collect()]
    prior, seen, by = np.mean([r[2] for r in rows]), {}, {r[0]: r for r in rows}
    for oid in order:
        s, n = seen.get(by[oid][1], (0.0, 0))
        assert got[oid] == pytest.approx((s + 2 * prior) / (n + 2))
        seen[by[oid][1]] = (s + by[oid][2], n + 1)
    full = {r.kind: r.kind_code for r in model.transform(spark.createDataFrame([("hot",), (None,), ("new",)], "kind string")).collect()}
    assert full["new"] == pytest.approx(prior) and full["hot"] == pytest.approx((seen["hot"][0] + 2 * prior) / (seen["hot"][1] + 2)) and full[None] != full["new"]
    # the code of a row is the same whatever its own target is, but for the mean that all share
    target, n = "o050", len(rows)
    other = df.withColumn("target", F.when(F.col("Outlet_ID") == target, F.col("target") + 1000).otherwise(F.col("target")))
    again = {r.Outlet_ID: r.kind_code for r in codes.fit(other)._replace(prior=float(prior)).ordered(other).collect()}
    assert again[target] == pytest.approx(got[target])


def test_ordered_codes_read_their_rows_a_few_times(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BLOCK", 5)
    monkeypatch.setattr(ranking.running_sum, "__defaults__", ((), 5, None))
    names = ["a", "b", "c", "d"]
    df = spark.range(40).selectExpr("concat('OUT_', id) AS Outlet_ID", "id * 1.0D AS target", *[f"id % {k + 2} AS {n}" for k, n in enumerate(names)])
    coded = TargetCodes(names).fit(df).ordered(df)
    leaves = coded._jdf.queryExecution().optimizedPlan().collectLeaves().size()
    assert leaves <= 3 * len(names) and coded.count() == 40


def test_ordered_codes_leak_nothing_where_every_category_is_single(spark):
    rng = np.random.default_rng(5)
    rows = [(f"o{i}", f"c{i}", float(rng.normal()), float(rng.normal())) for i in range(300)]
    df = VectorAssembler(inputCols=["x"], outputCol="numbers").transform(spark.createDataFrame(rows, "Outlet_ID string, kind string, x double, target double"))
    model = models.OrderedBoosting(TargetCodes(["kind"]), boosting.Booster(boosting.squared(), rounds=5, depth=4, rate=0.5, patience=2), refit=False).fit(df)
    coded = TargetCodes(["kind"]).fit(df).ordered(df)
    assert coded.select("kind_code").distinct().count() == 1                 # nothing to read off
    assert model.fitted.model.featureImportances.toArray()[1:].sum() == 0.0 and model.fitted.model.numFeatures == 2


def test_ordered_boosting_scores_everyone(points):
    data = VectorAssembler(inputCols=["x", "y", "z", "w"], outputCol="numbers").transform(points.drop("features"))
    model = models.OrderedBoosting(TargetCodes(["kind"]), boosting.Booster(boosting.squared(), rounds=8, depth=3, rate=0.4, patience=3)).fit(data)
    assert model.fitted.kept == len(model.fitted.model.trees) - 1
    out = model.transform(data.withColumn("kind", F.lit("unseen")))
    assert out.count() == data.count() and out.where("prediction is null").count() == 0
    rmse = model.transform(data).agg(F.sqrt(F.avg((F.col("prediction") - F.col("target")) ** 2)), F.stddev("target")).first()
    assert rmse[0] < 0.6 * rmse[1]
    wide = attribution.feature_contributions(model.assembled(data), model.fitted.model, ["x", "y", "z", "w", "kind"])
    total = wide.join(model.transform(data).select("Outlet_ID", "prediction"), "Outlet_ID").select((F.col("x") + F.col("y") + F.col("z") + F.col("w") + F.col("kind") + F.col("base_value") - F.col("prediction")).alias("d"))
    assert total.agg(F.max(F.abs("d"))).first()[0] < 1e-8


# --- sampler ---------------------------------------------------------------------------------

SPACE = {"x": search.Float(-5.0, 5.0), "rate": search.Float(1e-4, 1.0, log=True), "depth": search.Integer(2, 20, 2), "kind": search.Choice(("a", "b", "c"))}


def bowl(p):
    return (p["x"] - 1.5) ** 2 + (math.log10(p["rate"]) + 2) ** 2 + abs(p["depth"] - 8) / 4 + (p["kind"] != "b")


def proposals(seed, n, startup):
    trials = []
    for _ in range(n):
        p = search.suggest(SPACE, trials, seed, startup)
        trials.append((p, bowl(p)))
    return trials


def test_sampler_repeats_and_stays_in_its_ranges():
    a = proposals(3, 30, 10)
    assert a == proposals(3, 30, 10) and a != proposals(4, 30, 10)
    for p, _ in a:
        assert -5 <= p["x"] <= 5 and 1e-4 <= p["rate"] <= 1 and p["depth"] in range(2, 21, 2) and p["kind"] in "abc"
    assert search.suggest(SPACE, [({"x": 0.0, "rate": 0.1, "depth": 4, "kind": "a"}, math.nan)] * 12, 1)


def test_sampler_beats_random_search():
    ours = [min(v for _, v in proposals(seed, 40, 10)) for seed in range(30)]
    drawn = [min(v for _, v in proposals(seed, 40, 10**6)) for seed in range(30)]
    assert np.mean(ours) < 0.7 * np.mean(drawn) and sum(a <= b for a, b in zip(ours, drawn)) >= 20


def test_a_broken_search_goes_on_from_its_table(spark, tmp_path):
    seen = []
    def objective(p):
        seen.append(p)
        return bowl(p)
    whole = search.Study(spark, str(tmp_path / "whole"), SPACE, 7, startup=3)
    assert whole.table().count() == 0
    whole.run(objective, 6)
    part = search.Study(spark, str(tmp_path / "part"), SPACE, 7, startup=3)
    part.run(objective, 4)
    best = search.Study(spark, str(tmp_path / "part"), SPACE, 7, startup=3).run(objective, 6)
    assert len(seen) == 12 and seen[:6] == seen[6:]
    assert [tuple(r) for r in best.collect()] == [tuple(r) for r in whole.table().collect()]
    assert best.first().value == min(r.value for r in best.collect())


def test_cross_validated_objective(points):
    make = lambda p: RandomForestRegressor(labelCol="target", numTrees=2, maxDepth=p["depth"], seed=1)
    score = search.cross_validated_rmse(points, 5, make)
    assert score({"depth": 5}) < score({"depth": 1})
    fold = points.where("fold <> 0")
    own = np.mean([make({"depth": 3}).fit(points.where(f"fold <> {k}")).transform(points.where(f"fold = {k}")).agg(F.sqrt(F.avg((F.col("prediction") - F.col("target")) ** 2))).first()[0] for k in range(5)])
    assert score({"depth": 3}) == pytest.approx(own) and search.cross_validated_rmse(fold, 5, make)({"depth": 1}) > 0


# --- run store -------------------------------------------------------------------------------

def test_runs_are_stored_found_and_blended(spark, points, tmp_path):
    store = RunStore(spark, str(tmp_path / "store"))
    with pytest.raises(FileNotFoundError):
        store.model("any")
    settings = lambda i, n: spark.createDataFrame([(i, "forest", n)], "run_id string, algorithm string, n_features int")
    kept = {}
    for run_id, depth in (("0012", 2), ("2026_forest_a", 3), ("2026_forest_b", 4)):
        model = RandomForestRegressor(labelCol="target", numTrees=2, maxDepth=depth, seed=1).fit(points)
        kept[run_id] = model.transform(points).select("Outlet_ID", F.col("prediction").alias("model_prediction"))
        store.save(settings(run_id, depth), model, kept[run_id], models.feature_importance(spark, model, NAMES))
    assert {r.run_id for r in store.runs().collect()} == set(kept)
    assert store.resolve("0012") == store.resolve("001") == "0012" and store.resolve("_b") == "2026_forest_b"
    with pytest.raises(ValueError):
        store.resolve("2026")
    with pytest.raises(FileNotFoundError):
        store.predictions("missing")
    again = store.model("forest_a").transform(points).select("Outlet_ID", F.col("prediction").alias("model_prediction"))
    assert again.exceptAll(kept["2026_forest_a"]).count() == 0 and store.importance("_a").count() == 5
    got = {r.Outlet_ID: r.model_prediction for r in store.blend(["_a", "_b"], [0.25, 0.75]).collect()}
    a, b = ({r.Outlet_ID: r.model_prediction for r in kept[f"2026_forest_{x}"].collect()} for x in "ab")
    assert got == {o: pytest.approx(max(0.0, a[o] * 0.25 + b[o] * 0.75), abs=0.006) for o in a}
    store.save(settings("0012", 99), model, kept["0012"])
    assert store.runs().count() == 3 and store.runs().where("run_id = '0012'").first().n_features == 99
    with pytest.raises(ValueError):
        store.save(settings("a/b", 1), model, kept["0012"])
