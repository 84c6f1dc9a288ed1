"""Steps over all transactions shuffle their rows once and compute their input once."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from retailpot import config as c
from retailpot.operators import profiling, spatial
from retailpot.operators import quality as q
from retailpot.plans.lake import Lake
from retailpot.plans import fixture_views as fx


def _tx(spark, hot=0):
    outlet = F.when(F.col("id") < hot, F.lit(1)).when(F.col("id") % 17 != 0, F.col("id") % 400)
    return spark.range(6000).select(outlet.alias("o"), (F.col("id") % 5).alias("m"), (F.col("id") % 3).alias("v"), (F.col("id") % 7).alias("d"), "id")


def _annotated(df, **options):
    bad = q.condition_check("x", F.col("m") == 4, "bad")
    return q.run_checks(df, [bad, q.duplicate_check(["o", "m", "v"], "id", order_by=["d"], **options)], "t").annotated


def test_clustered_duplicates_equal_salted_ones(spark):
    for df in (_tx(spark), _tx(spark, hot=3000)):
        for keep in ("first", "last", False):
            assert rows(_annotated(df, keep=keep, cluster="o")) == rows(_annotated(df, keep=keep))


def test_clustered_duplicates_and_a_join_shuffle_rows_once(spark):
    def dealt(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return "RepartitionByExpression" in plan, df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    assert q.evenly_spread(_tx(spark), "o") and not q.evenly_spread(_tx(spark, hot=3000), "o", 2000)
    known = spark.range(400).select(F.col("id").alias("o"), F.lit(1).alias("k")).hint("merge")
    assert dealt(_annotated(_tx(spark), cluster="o").join(known, "o", "left")) == (True, 2)
    assert dealt(_annotated(_tx(spark)).join(known, "o", "left")) == (False, 4)
    assert not dealt(_annotated(_tx(spark, hot=3000), cluster="o", hot_rows=2000))[0]   # the salted way


def test_profiles_compute_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(300_000).select((F.col("id") % 1009 - 9).cast("double").alias("v")).mapInArrow(look, "v double")
    got = profiling.iqr_profile(df, "v", 0.2).first()
    assert seen.value == 300_000
    want = df.toPandas()["v"].quantile([0.25, 0.75])
    assert abs(got.iqr - (want[0.75] - want[0.25])) < 1e-9
    seen.value = 0
    assert profiling.negative_profile(df, "v").first().min == -9
    assert seen.value == 300_000


def test_raw_seasons_are_read_from_transactions_once(spark, monkeypatch):
    looked = []

    def seasons(session, sf_dir, name):
        def look(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b

        looked.append(name)
        df = session.createDataFrame([("DIST_W_01", 2000, m, "Moderate") for m in range(1, 13)], "Distributor_ID string, Year long, Month long, Seasonality_Index string")
        return df.coalesce(1).mapInArrow(look, df.schema).withColumn("ingest_id", F.xxhash64("Distributor_ID", "Year", "Month"))

    seen = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(fx, "load_view", seasons)
    lk = Lake(spark, "/nowhere/season-rows", fx.FIXTURE)
    assert lk["seasonality"].count() == 12 and looked == ["fx_seasonality"]
    assert seen.value == 12   # 24 when the strict check and the clean table each computed them


def test_places_are_classified_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    raw = spark.range(500).select((F.col("id") * 1e-4 + 7).alias("lat"), F.lit(80.0).alias("lon"), F.when(F.col("id") % 2 == 0, "school").otherwise("well").alias("kind"))
    pois = raw.mapInArrow(look, raw.schema).select("lat", "lon", F.create_map(F.lit("amenity"), "kind").alias("tags"))
    outlets = spark.createDataFrame([("OUT_00001", 7.0, 80.0)], "Outlet_ID string, Latitude double, Longitude double")
    got = spatial.poi_radius_counts(outlets, outlets, pois, fx.FIXTURE).first()
    assert seen.value == 500 and got.schools_2000m > got.schools_500m > 0 and got.markets_2000m == 0
    assert spatial.classified(pois, c.FLAT_POI_RULES).count() == 250


def test_layers_are_built_side_by_side_and_once(spark, tmp_path):
    """Two layers over a common one run at the same time, the common one is built once, and a failure reaches the caller."""
    import threading

    from retailpot.plans import lake

    both, built = threading.Barrier(2, timeout=60), []

    class Two(lake.Lake):
        def _build_below(self):
            built.append("below")
            return self.spark.range(5)

        def _build_x(self):
            both.wait()
            return self["below"].selectExpr("id + 1 AS id")

        def _build_y(self):
            both.wait()
            return self["below"].selectExpr("id * 2 AS id")

        def _build_bad(self):
            raise ValueError("no such rows")

    two = Two(spark, f"{tmp_path}/side", lake.fx.FIXTURE)
    two.together("x", "y")
    assert built == ["below"] and set(two._ready) == {"below", "x", "y"}
    assert sorted(r.id for r in two["x"].collect()) == [1, 2, 3, 4, 5] and sorted(r.id for r in two["y"].collect()) == [0, 2, 4, 6, 8]
    with pytest.raises(ValueError, match="no such rows"):
        two.together("x", "bad")
