import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from retailpot.config import Config
from retailpot.operators import briefing, serving
from retailpot.sources import ingest, poi

CFG = Config()


def test_ingest_skips_missing_and_survives_bad(spark, tmp_path):
    raw, bronze = tmp_path / "raw", tmp_path / "bronze"
    raw.mkdir()
    (raw / "outlet_master.csv").write_text("Outlet_ID,Cooler_Count\nOUT_00001,3\nOUT_00002,\n")
    (raw / "holiday_list.csv").mkdir()  # an empty folder cannot be read as CSV
    got = ingest.ingest_csv(spark, str(raw), str(bronze), ["holiday_list", "outlet_master", "outlet_coordinates"])
    assert got == {"holiday_list": "failed", "outlet_master": "written", "outlet_coordinates": "missing"}
    df = ingest.read_parquet_with_id(spark, str(bronze / "outlet_master"))
    assert rows(df, "Outlet_ID", "Cooler_Count") == [("OUT_00001", 3), ("OUT_00002", None)] and df.select("ingest_id").distinct().count() == 2
    assert ingest.optional_input(spark, str(tmp_path / "nothing")) is None
    (tmp_path / "damaged").mkdir()
    (tmp_path / "damaged" / "part-0.parquet").write_bytes(b"no table")
    with pytest.raises(Exception):  # noqa: B017  present but damaged is not absent
        ingest.optional_input(spark, str(tmp_path / "damaged")).count()


def test_csv_quotes_breaks_missing_texts_and_order(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b,c\n1,"say ""hi"", you",NA\nN/A,"two\nlines",2.5\n3,nan,4\n')
    got = ingest.read_csv(spark, str(path), multiline=True)
    assert dict(got.drop("ingest_id").dtypes) == {"a": "bigint", "b": "string", "c": "double"}
    assert [tuple(r)[:3] for r in got.orderBy("ingest_id").collect()] == [(1, 'say "hi", you', None), (None, "two\nlines", 2.5), (3, None, 4.0)]
    long = tmp_path / "long.csv"
    long.write_text("k,v\n" + "".join(f"{i % 500},{i}\n" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = ingest.read_csv(spark, str(long))
        assert df.rdd.getNumPartitions() > 3
        first = df.groupBy("k").agg(F.min_by("v", "ingest_id").alias("v"))
        assert first.where("v <> k").count() == 0  # the first row of each key, whatever the split
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_sinks_and_idempotent_report(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 2)], "x string, y int, z int")
    ingest.parquet_sink(df, str(tmp_path / "p"), ["z", "x"])
    assert spark.read.parquet(str(tmp_path / "p")).columns == ["z", "x"]
    ingest.csv_sink(df, str(tmp_path / "c"), ["y", "x"])
    assert spark.read.csv(str(tmp_path / "c"), header=True).columns == ["y", "x"]
    rep = spark.createDataFrame([("d1", "c", 1), ("d2", "c", 2)], "dataset string, check_name string, n int")
    for run in ("r1", "r2", "r1"):
        ingest.report_append(rep, str(tmp_path / "r"), run)
    ingest.report_append(rep.where("dataset = 'd1'").withColumn("n", F.lit(9)), str(tmp_path / "r"), "r1")
    assert rows(spark.read.parquet(str(tmp_path / "r")), "run", "dataset", "n") == [("r1", "d1", 9), ("r1", "d2", 2), ("r2", "d1", 1), ("r2", "d2", 2)]
    for _ in range(2):
        ingest.run_registry(df, str(tmp_path / "g"))
    assert spark.read.parquet(str(tmp_path / "g")).count() == 2


def test_poi_tiles(spark, tmp_path):
    tile = {"cluster_id": 3, "outlet_ids": ["o1", "o2"], "elements": [
        {"lat": 1.0, "lon": 2.0, "tags": {"amenity": "", "shop": "bakery", "name": "B"}},
        {"center": {"lat": 3.0, "lon": 4.0}, "tags": {"natural": "tree"}}, {"tags": {"amenity": "x"}}]}
    other = {"cluster_id": 1, "outlet_ids": ["o2"], "elements": []}
    for name, t in (("cluster_0003.json", tile), ("cluster_0001.json", other), ("manifest.json", {"completed_clusters": [3], "failed_clusters": [7]})):
        (tmp_path / name).write_text(json.dumps(t, indent=1))
    env = poi.read_envelopes(spark, str(tmp_path))
    assert env.count() == 2 and rows(poi.outlet_cluster_link(env)) == [("o1", 3), ("o2", 1)]
    flat = poi.explode_pois(env)
    got = rows(poi.cluster_pois(flat), "cluster_id", "lat", "poi_type", "name")
    assert got == [(3, 1.0, "bakery", "B"), (3, 3.0, "unknown", "")]
    m = poi.read_manifest(spark, str(tmp_path / "manifest.json"))
    assert rows(m) == [(3, "completed"), (7, "failed")] and poi.manifest_filter(flat, m).count() == 2
    report = {r.cluster_id: tuple(r)[1:] for r in poi.tile_report(env, m, 400).collect()}
    assert report == {3: ("completed", True, True), 7: ("failed", False, None), 1: ("unlisted", False, None)}
    more = m.unionByName(spark.createDataFrame([(9, "completed"), (3, "failed")], "cluster_id int, status string"))
    again = {r.cluster_id: r.status for r in poi.tile_report(env, more).collect()}
    assert again[9] == "missing" and again[3] == "failed" and poi.manifest_filter(flat, more).count() == 0
    other = env.withColumn("config_snapshot", F.struct(F.lit(12).alias("n_clusters"), F.lit(0.1).alias("buffer_deg")))
    assert not {r.cluster_id: r.config_matches for r in poi.tile_report(other, m, 400).collect()}[3]


@pytest.fixture(scope="module")
def tables(spark):
    names = {("seasonality_multiplier_jan_2026" if k == "seasonality_multiplier" else k): v for k, v in serving.OUTLET_COLUMNS.items()}
    base = {"outlet_type": "Grocery", "outlet_size": "Large", "province": "Western", "distributor_id": "D1", "market_saturation_class": "dense", "cooler_count": 2, "competitors_500m": 4, "competitors_1km": 9,
            "recent_3m_avg": 100.0, "predicted_potential_litres": 1234.5, "capacity_utilization_ratio": 0.5, "composite_gravity_score": 12.34, "school_gravity_score": 2.0, "cooler_capacity_litres": 300.0}
    people = [{"outlet_id": "a"}, {"outlet_id": "b", "capacity_utilization_ratio": 0.9, "province": "Central"}, {"outlet_id": "c", "recent_3m_avg": 1230.0, "market_saturation_class": "isolated", "competitors_500m": 0, "composite_gravity_score": 0.0}]
    df = spark.createDataFrame([tuple({**base, **p}.get(k, d) for k, (_, d) in names.items()) for p in people], ", ".join(f"{k} {t}" for k, (t, _) in names.items()))
    alloc = spark.createDataFrame([("a", 1134.5, 0.7, "high", 2500.0, "Cooler_Subsidy", 70.0), ("b", 5.0, 0.2, "none", 0.0, "None", 0.0)],
                                  ", ".join(f"{k} {t}" for k, (t, _) in serving.ALLOCATION_COLUMNS.items()))
    ctx = spark.createDataFrame([("a", '{"outlet_id":"a","f1":-3.0,"f2":2.5,"note":"text","f3":0.1}', None)], "outlet_id string, context_json string, xai_explanation string")
    return df, alloc, ctx


def test_dashboard_queries(tables):
    o, a, ctx = tables
    s = serving.dashboard_stats(o, a, {"province": "Western"}).first()
    assert (s.total_outlets, s.total_budget, s.high_potential_outlets) == (2, 2500.0, 1)
    assert serving.dashboard_stats(o, a, {"tier": "high"}).first().total_outlets == 1
    assert tuple(serving.dashboard_stats(o, a, {"province": "Nowhere"}).first()) == (0, 0.0, 0.0, 0, 0.0)
    with pytest.raises(ValueError):
        serving.dashboard_stats(o, a, {"1=1; --": "x"})
    assert ("tiers", "high") in rows(serving.filter_options(o, a)) and ("tiers", "none") not in rows(serving.filter_options(o, a))
    page = serving.paginated_outlets(o, a, None, page=2, limit=2).collect()
    assert [(r.outlet_id, r.total) for r in page] == [("c", 3)]
    assert serving.paginated_outlets(o, a, None, page=0, limit=1000).count() == 3
    sea = o.select("outlet_id", (F.col("outlet_id") == "b").alias("in_sea"))
    assert [r.outlet_id for r in serving.map_points(o, a, sea).orderBy("outlet_id").collect()] == ["a", "c"]
    d = {r.outlet_id: r for r in serving.outlet_detail(o, a, ctx).collect()}
    assert d["a"].uplift_gap == 1134.5 and d["c"].uplift_gap == pytest.approx(4.5) and d["c"].budget_allocation is None


def test_budget_pages(tables):
    o, a, _ = tables
    r = serving.budget_allocations(o, a)
    assert [tuple(x) for x in serving.budget_by_distributor(r).collect()] == [("D1", 70.0, 2500.0, 100.0)]
    k = serving.budget_kpis(r, outlet_type="Grocery").first()
    assert (k.outlets, k.total_spend, k.spend_per_litre) == (1, 2500.0, 2500.0 / 70.0)
    assert serving.budget_kpis(r, tier="low").first().outlets == 0


def test_context_and_briefing(tables):
    o, a, ctx = tables
    drivers = serving.top_drivers(serving.context_contributions(ctx), "outlet_id", 2)
    assert [(r.feature, r.direction) for r in drivers.orderBy("position").collect()] == [("f1", "negative"), ("f2", "positive")]
    detail = serving.outlet_detail(o, a, ctx)
    packs = {r.outlet_id: json.loads(r.dossier_json) for r in serving.context_pack(detail, drivers, CFG).collect()}
    assert packs["a"]["model_top_drivers"][0] == {"feature": "f1", "impact_litres": "-3.0"} and packs["c"]["budget_allocation"] is None
    assert packs["a"]["cooler_capacity"]["capacity_utilization_pct"] == 50 and packs["c"]["model_top_drivers"] == []
    got = {r.outlet_id: (r.alert_type, json.loads(r.briefing_json)) for r in briefing.rule_briefing(detail).collect()}
    assert got["a"][0] == "success" and got["b"][0] == "critical" and got["c"][0] == "info"
    cards = got["a"][1]["driver_cards"]
    assert [c["title"] for c in cards][0] == "Investment Opportunity — High Priority Budget" and len(cards) == 5
    assert "1,235L" in cards[1]["description"] and cards[4]["description"].endswith("score of 12.3. Nearby educational facilities contribute to daily customer flow.")
    assert got["a"][1]["action_checklist"][0] == "Deploy the LKR 2,500 Cooler Subsidy to unlock the estimated 1,135L monthly volume gap."
    assert len(got["c"][1]["driver_cards"]) == 2 and "90%" in got["b"][1]["diagnostic_alert"]["message"]


def test_keyed_update(spark, tables):
    ctx = tables[2]
    new = serving.keyed_update(ctx, spark.createDataFrame([("a", "text"), ("zz", "lost")], "outlet_id string, xai_explanation string"))
    assert rows(new, "outlet_id", "xai_explanation") == [("a", "text")]
