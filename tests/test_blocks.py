import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from retailpot.config import Config
from retailpot.operators import blocks, spatial

CFG = Config()


def scattered(seed, n):
    """Uniform points, a knot, copies of latitudes and of one place, and both sides of the equator."""
    rng = np.random.default_rng(seed)
    p = rng.uniform([-0.03, 80.0], [0.03, 80.05], (n, 2))
    p[: n // 4] = rng.normal([0.0, 80.02], 0.001, (n // 4, 2))
    p[n // 4: n // 3, 0] = 0.004
    p[n // 3: n // 3 + 20] = (0.01, 80.03)
    return p[:, 0], p[:, 1]


@pytest.mark.parametrize("metric,slack", [("haversine", 1e-9), ("geodesic", 0.007)])
def test_counts_of_a_block_equal_brute_force(monkeypatch, metric, slack):
    monkeypatch.setattr(blocks, "PAIRS", 500)
    (lat, lon), (y, x) = scattered(1, 300), scattered(2, 900)
    w = np.random.default_rng(3).integers(0, 4, (900, 2))
    got = blocks.counts(blocks.Block(lat, lon, blocks.Bands.of(y, x, w, 2.0)), [0.5, 2.0], metric, slack)
    km = blocks.DISTANCES[metric](lat[:, None], lon[:, None], y, x)
    assert (got == np.stack([(km <= r) @ w[:, j] for j in (0, 1) for r in (0.5, 2.0)], axis=1)).all()


@pytest.mark.parametrize("radius", [2.0, 80.0])
def test_pulls_of_a_block_equal_brute_force(monkeypatch, radius):
    monkeypatch.setattr(blocks, "TILE_PAIRS", 700)
    (lat, lon), (y, x) = scattered(4, 300), scattered(5, 900)
    w = np.random.default_rng(6).integers(0, 4, (900, 2))
    got = blocks.pulls(blocks.Block(lat, lon, blocks.Bands.of(y, x, w, radius)), radius, 0.05)
    km = blocks.haversine_km(lat[:, None], lon[:, None], y, x)
    assert np.allclose(got, np.where(km <= radius, 1 / (km + 0.05) ** 2, 0) @ w, rtol=1e-11, atol=0)


def test_blocks_are_bounded_and_pairs_are_never_rows(spark, monkeypatch):
    lat, lon = scattered(7, 400)
    df = spark.createDataFrame([(f"p{i:04d}", float(a) + 7, float(b)) for i, (a, b) in enumerate(zip(lat, lon))], "Outlet_ID string, Latitude double, Longitude double")
    want = rows(spatial.competitor_counts(df, CFG))
    km = blocks.haversine_km(lat[:, None] + 7, lon[:, None], lat + 7, lon)
    assert want == sorted((f"p{i:04d}", *[int((km[i] <= r).sum()) - 1 for r in (0.5, 1, 2)]) for i in range(400))
    monkeypatch.setattr(blocks, "LEFT_ROWS", 40)
    monkeypatch.setattr(blocks, "RIGHT_ROWS", 60)
    assert rows(spatial.competitor_counts(df, CFG)) == want
    locs = spatial.locations(df, "Latitude", "Longitude")
    for side, most in zip(blocks.dealt(locs, locs, spatial.cell_sides(2.0, CFG), ["w"]), (40, 60), strict=True):
        keys = [c for c in side.columns if c.removeprefix("b_") in blocks.KEYS]
        assert side.groupBy(*keys).count().agg(F.max("count")).first()[0] < 2 * most   # dealt by a hash
    plan = spatial.competitor_counts(df, CFG)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") <= 8
