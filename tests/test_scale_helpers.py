import numpy as np
import pytest
from pyspark.sql import functions as F

from retailpot.operators import quantiles, ranking


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(1)
    data = [("hot", float(v)) for v in rng.lognormal(3, 2, 3000)] + [("copies", 5.0)] * 500 + [("few", float(v)) for v in (4, 1, 3)]
    return spark.createDataFrame(data, "k string, v double")


@pytest.mark.parametrize("hot", [10, 10_000])
def test_grouped_quantiles_match_numpy_on_both_paths(skewed, hot):
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    got = {r.k: r.q for r in quantiles.grouped_quantiles(skewed, ["k"], "v", probs, hot_distinct=hot, bands=16).collect()}
    data = skewed.toPandas()
    for k, g in data.groupby("k"):
        assert got[k] == pytest.approx(list(np.quantile(g.v, probs)), rel=1e-12)


@pytest.mark.parametrize("hot", [10, 10_000])
def test_rows_get_the_quantiles_of_their_group(skewed, hot):
    df = skewed.union(skewed.sparkSession.createDataFrame([("few", None)], "k string, v double"))
    got = quantiles.with_group_quantiles(df, ["k"], "v", [0.25, 0.75], hot_distinct=hot)
    seen = {r.k: (r.q, r.group_rows) for r in got.select("k", "q", "group_rows").distinct().collect()}
    data = skewed.toPandas()
    assert got.count() == df.count() and set(seen) == {"hot", "copies", "few"}
    for k, g in data.groupby("k"):
        assert seen[k][0] == pytest.approx(list(np.quantile(g.v, [0.25, 0.75]))) and seen[k][1] == len(g)


@pytest.mark.parametrize("small", [0, 10_000])
def test_frame_quantiles_match_numpy_on_both_paths(skewed, small):
    probs = [0.01, 0.25, 0.5, 0.99]
    got = quantiles.frame_quantiles(skewed, "v", probs, bands=32, small=small).first().q
    assert got == pytest.approx(list(np.quantile(skewed.toPandas().v, probs)), rel=1e-12)
    empty = skewed.where("k = 'absent'")
    assert quantiles.frame_quantiles(empty, "v", probs, small=small).count() == 0
    one = skewed.where("k = 'copies'")
    assert quantiles.frame_quantiles(one, "v", [0.5], small=small).first().q == [5.0]


@pytest.mark.parametrize("block", [8, 1 << 16])
def test_global_order(spark, monkeypatch, block):
    monkeypatch.setattr(ranking, "BLOCK", block)
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("s"), F.concat(F.lit("g"), F.col("id") % 2).alias("g"))
    ranked = ranking.global_row_number(df, [F.col("s").desc(), F.col("id")], "r")
    got = [r.id for r in ranked.orderBy("r").collect()]
    assert got == [r.id for r in df.orderBy(F.col("s").desc(), "id").collect()]
    run = {r.r: r.c for r in ranking.running_sum(ranked, "r", F.col("id"), "c", block=block, rows=None if block == 8 else 1000).collect()}
    assert [run[i + 1] for i in range(1000)] == list(np.concatenate([[0], np.cumsum(got)[:-1]]))
    by = ranking.running_sum(ranked, "r", F.lit(1), "c", ["g"], block=block)
    assert by.groupBy("g").agg(F.max("c")).count() == 2 and by.agg(F.max("c")).first()[0] == 499


@pytest.mark.parametrize("kind", ["lognormal", "outlier", "ties", "two", "near"])
def test_selection_sorts_few_values_whatever_their_spread(spark, monkeypatch, kind):
    rng = np.random.default_rng(8)
    x = {"lognormal": np.exp(6 * rng.standard_normal(6000)), "outlier": np.append(rng.random(5999), 1e300), "ties": np.floor(rng.random(6000) * 4),
         "two": np.where(rng.random(6000) < 0.5, -1.0, 7.0), "near": 1.0 + rng.random(6000) * 1e-13}[kind]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double").repartition(5)
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.99, 1.0]
    small, sorted_rows = 40, []
    real = quantiles.F.row_number
    monkeypatch.setattr(quantiles.F, "row_number", lambda: sorted_rows.append(1) or real())
    got = quantiles.frame_quantiles(df, "v", probs, bands=50, small=small).first().q
    assert got == pytest.approx(np.quantile(x, probs), rel=1e-12)
    found = quantiles.order_statistics(df.where("v is not null").select(df.v.alias("_v")), {0, 17, 3000, 5999}, 50, small)
    assert [found[k] for k in (0, 17, 3000, 5999)] == np.sort(x)[[0, 17, 3000, 5999]].tolist()
    assert sorted_rows if kind == "lognormal" else True   # the last step was met
