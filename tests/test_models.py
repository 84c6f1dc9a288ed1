from dataclasses import replace

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from retailpot.config import Config
from retailpot.operators import attribution, baseline, features, models, profiling

CFG = Config()


@pytest.fixture(scope="module")
def master(spark):
    rng = np.random.default_rng(7)
    n, out = 160, []
    for i in range(n):
        p90 = float(rng.integers(0, 90)) if i % 9 else 0.0
        out.append((f"o{i:03d}", ["Grocery", "Kiosk", "Hotel"][i % 3], ["Small", "Large"][i % 2], "Western", "moderate", i % 6, p90, p90 * 1.2, float(rng.random() * 2),
                    float(rng.random() * 100), float(rng.random()), i % 10 != 0, i % 16 == 5, 1.2, 20))
    return spark.createDataFrame(out, "Outlet_ID string, Outlet_Type string, Outlet_Size string, province string, market_saturation_class string, Cooler_Count int, hist_p90_monthly double, "
                                      "hist_max_monthly double, capacity_utilization_ratio double, composite_gravity_score double, active_months_pct double, has_transaction_history boolean, "
                                      "exclude_from_training boolean, seasonality_multiplier_jan_2026 double, jan_2026_trading_days int")


@pytest.fixture(scope="module")
def prep(master):
    return models.Prepared(master, CFG)


def test_strategies_and_interactions(master):
    df, cols = models.apply_strategy(master, "strategyC", CFG)
    assert {"gravity_x_cooler", "gravity_x_active_months"} <= set(cols) and "catchment_x_cooler" not in df.columns
    assert not {"hist_p90_monthly", "Outlet_ID", "jan_2026_trading_days"} & set(cols)
    assert "hist_p90_monthly" in models.feature_columns(master, "round1_baseline", CFG)
    assert models.strategy_table(master, CFG).select("strategy").distinct().count() == 8


def test_target_codes_and_folds(master):
    t = models.training_target(master, CFG)
    assert t.where("not has_transaction_history or exclude_from_training").count() == 0
    r = t.first()
    assert r.target == pytest.approx(r.hist_p90_monthly * 1.2 * 20 / 22)
    coded, names = models.encode_categoricals(master)
    assert dict(rows(coded.select("Outlet_Type", "Outlet_Type_code").distinct())) == {"Grocery": 0.0, "Hotel": 1.0, "Kiosk": 2.0} and len(names) == 4
    a = rows(models.with_fold(master, CFG), "Outlet_ID", "fold")
    assert a == rows(models.with_fold(master.repartition(13), CFG), "Outlet_ID", "fold") and {f for _, f in a} == set(range(5))


def test_out_of_fold_never_sees_its_own_fold(spark, prep):
    # the label tells the fold: a model that had seen the row's fold could return it
    leak = prep.train.withColumn("target", F.col("fold") * 1000.0)
    got = models.oof_predict(leak, prep.all, models.regressor("randomforest", CFG, numTrees=3, maxDepth=2), CFG, "p")
    assert got.count() == prep.all.count()
    for k in range(5):
        others = [f * 1000.0 for f in range(5) if f != k]
        p = [r.p for r in got.where(F.col("held_out_fold") == k).collect()]
        assert p and all(min(others) <= x <= max(others) for x in p)
    assert got.where("held_out_fold is null").count() == prep.all.count() - prep.train.count()


@pytest.mark.parametrize("algorithm,params", [("randomforest", {"numTrees": 6, "maxDepth": 4}), ("gbt", {"maxIter": 4, "maxDepth": 3})])
def test_contributions_add_up_to_the_prediction(prep, algorithm, params):
    model, preds = models.train_regressor(prep, models.regressor(algorithm, CFG, **params))
    assert preds.count() == prep.all.count() and preds.where("model_prediction < 0").count() == 0
    wide = attribution.feature_contributions(prep.all, model, prep.features).toPandas().set_index("Outlet_ID")
    raw = model.transform(prep.all).select("Outlet_ID", "prediction").toPandas().set_index("Outlet_ID").prediction
    total = wide.sum(axis=1)
    assert np.allclose(total.sort_index(), raw.sort_index(), atol=1e-8) and (wide.drop(columns="base_value").abs().sum() > 0).any()
    imp = models.feature_importance(prep.all.sparkSession, model, prep.features).toPandas()
    assert imp.importance.sum() == pytest.approx(1.0) and imp.importance.is_monotonic_decreasing


def test_cross_validation_and_search(prep):
    est = models.regressor("randomforest", CFG, numTrees=3, maxDepth=3)
    cv = {r.fold: r for r in models.kfold_cv(prep.train, est, CFG).collect()}
    assert cv["mean"].rmse == pytest.approx(np.mean([cv[str(k)].rmse for k in range(5)])) and cv["std"].mae == pytest.approx(np.std([cv[str(k)].mae for k in range(5)]))
    best = models.param_search(prep.train, est, {"maxDepth": [1, 3]}, CFG).collect()
    assert len(best) == 2 and best[0].mean_rmse <= best[1].mean_rmse


def test_submodels(master, prep):
    c = models.censor_labels(models.training_target(master, CFG))
    assert c.where("(capacity_utilization_ratio >= 0.8) <> (upper_bound is null)").count() == 0 and c.where("lower_bound < 0.001").count() == 0
    alt = models.censor_labels(master.drop("capacity_utilization_ratio").withColumn("hist_p90_monthly", F.col("hist_max_monthly") * 0.9))
    assert alt.where("hist_max_monthly > 0 and upper_bound is not null").count() == 0
    latent = models.latent_demand(prep, replace(CFG, latent_rounds=2))
    assert latent.count() == master.count() and latent.where("tobit_latent_estimate is null or tobit_latent_estimate < 0").count() == 0
    prob = models.hurdle_active_prob(prep, CFG)
    assert prob.where("p_active between 0 and 1").count() == master.count()
    volume = models.hurdle_conditional(prep, CFG, models.regressor("gbt", CFG, maxIter=2, maxDepth=2))
    h = models.hurdle_estimate(prob, volume)
    assert h.count() == master.count() and h.where("hurdle_estimate < 0").count() == 0
    single = models.Prepared(master.withColumn("hist_p90_monthly", F.col("hist_p90_monthly") + 1), CFG)
    assert {r.p_active for r in models.hurdle_active_prob(single, CFG).collect()} == {0.0, 1.0}


def test_blends(spark):
    t = lambda *r: spark.createDataFrame(list(r), "Outlet_ID string, model_prediction double")
    a, b = t(("x", 10.0), ("y", -5.0), ("z", 1.0)), t(("x", 20.0), ("y", 1.0))
    assert rows(models.ensemble_blend([a, b])) == [("x", 15.0), ("y", 0.0), ("z", None)]
    assert rows(models.ensemble_blend([a, b], [1.0, 0.5]))[0] == ("x", 20.0)
    with pytest.raises(ValueError):
        models.ensemble_blend([a, b], [1.0])
    base = spark.createDataFrame([("x", 12.0), ("y", -1.0), ("z", 0.5)], "Outlet_ID string, baseline_potential_litres double")
    final = models.floor_blend(a, base)
    assert rows(final, "Outlet_ID", "Maximum_Monthly_Liters") == [("x", 12.0), ("y", 1.0), ("z", 1.0)]
    d = {r.metric: r.value for r in models.prediction_distribution(final).collect()}
    assert d["p50"] == 1.0 and d["model_won"] == 1.0 and d["baseline_won"] == 2.0 and models.extreme_predictions(final).count() == 0


def test_baseline_rules(spark):
    one = spark.range(1)
    value = lambda c: one.select(c).first()[0]
    assert [value(baseline.poi_uplift(F.lit(float(x)))) for x in (0, 20, 40, 60, 100)] == pytest.approx([1.0, 1.0, 1.05, 1.10, 1.25])
    assert [value(baseline.recency_factor(F.lit(e), F.lit(m))) for e, m in ((0.0, 5.0), (5.0, 0.0), (9.0, 5.0), (1.0, 5.0), (5.0, 5.0))] == [1.0, 1.0, 1.3, 0.8, 1.0]
    data = [("a", "Small", 2, 10.0, 1, 0.0), ("b", "Small", 0, 20.0, 1, 0.0), ("c", "Large", 0, 0.0, 0, 5100.0), ("d", "Small", 2, 0.0, 0, 0.0), ("e", "Small", 1, 0.0, 0, 100.0)]
    df = spark.createDataFrame(data, "Outlet_ID string, Outlet_Size string, Cooler_Count int, jan_avg_volume double, jan_count int, theoretical_monthly_ceiling double")
    got = dict(rows(baseline.cold_start_potential(df), "Outlet_ID", "cold_start"))
    assert got["c"] == 15.0 * 2.0 and got["d"] == pytest.approx(15.0 * 1.3) and got["e"] == 15.0 * 0.5
    none = baseline.cold_start_potential(df.withColumn("jan_count", F.lit(0)))
    assert dict(rows(none, "Outlet_ID", "cold_start"))["e"] == 25.0


def test_cooler_and_null_rules(spark):
    df = spark.createDataFrame([("a", 2, 2550.0), ("b", 0, 10.0), ("c", 1, 9999.0)], "Outlet_ID string, Cooler_Count int, hist_p90_monthly double")
    got = {r.Outlet_ID: r for r in features.cooler_features(df, df, CFG).collect()}
    assert got["a"].theoretical_monthly_ceiling == 2550.0 and got["a"].capacity_utilization_ratio == 1.0
    assert got["b"].capacity_utilization_ratio == 0.0 and got["c"].capacity_utilization_ratio == 2.0
    pts = spark.createDataFrame([("a", None, None, "Western"), ("b", None, None, None), ("c", 6.5, 80.5, "Southern")], "Outlet_ID string, Latitude double, Longitude double, province string")
    assert rows(features.centroid_fill(pts), "Outlet_ID", "Latitude", "Longitude") == [("a", 6.9271, 79.8612), ("b", 7.0, 80.0), ("c", 6.5, 80.5)]
    assert features.round_floats(spark.createDataFrame([(0.12345,)], "x double")).first().x == 0.1234  # tie to even


def test_profiles(spark):
    df = spark.createDataFrame([("a", -1.0, 0.0, 0.0), ("b", 4.0, 80.0, 7.0), ("c", None, 7.0, 80.0), ("d", 9.0, 1.0, 1.0)], "Outlet_ID string, v double, Latitude double, Longitude double")
    assert dict(rows(profiling.null_profile(df, ["Outlet_ID", "v"]))) == {"Outlet_ID": 0, "v": 1}
    n = profiling.negative_profile(df, "v").first()
    assert (n.n, n.pct, n.mean, n.std) == (1, 25.0, -1.0, None)
    assert [s for _, s in rows(profiling.coord_status(df, CFG), "Outlet_ID", "Status")] == ["Zero Coordinates", "Swapped", "Valid", "Out of Bounds"]
    assert [r.Outlet_ID for r in profiling.residual_topk(df.where("v is not null"), "v", "Latitude", 2).collect()] == ["d", "a"]
    s = profiling.holdout_split(spark.range(2000).select(F.col("id").cast("string").alias("k")), "k")
    assert 300 < s.where("is_test").count() < 500
    c = {r.feature: r.correlation for r in profiling.target_correlation(spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0)], "t double, a double, flat double"), "t").collect()}
    assert c["a"] == pytest.approx(1.0) and c["flat"] is None
