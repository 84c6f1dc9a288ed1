import json

import pytest
from pyspark.sql import functions as F

from retailpot import schemas
from retailpot.operators import boosting, models
from retailpot.plans import fixture_views as fx
from retailpot.plans.lake import lake
from retailpot.plans.pipeline import FileLake, run_pipeline

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Raw CSV files and POI tiles with the contents of the fixture views."""
    root, lk = tmp_path_factory.mktemp("raw"), lake(spark, SF)
    for view, name in FileLake.BRONZE.items():
        df = lk.raw(view).drop("ingest_id")
        df = df.orderBy("row_id").drop("row_id") if "row_id" in df.columns else df
        df.coalesce(1).toPandas().to_csv(root / f"{name}.csv", index=False)
    tiles = root / "poi"
    tiles.mkdir()
    pois = lk.raw("fx_poi").toPandas()
    links = lk.links().toPandas()
    for k, g in pois.groupby("cluster_id"):
        elements = [{"lat": r.lat, "lon": r.lon, "tags": {r.tag_key: r.tag_value}} for r in g.itertuples()]
        ids = links[links.cluster_id == k].outlet_id.tolist()
        (tiles / f"cluster_{k:04d}.json").write_text(json.dumps({"cluster_id": k, "outlet_ids": ids, "elements": elements}))
    (tiles / "scrape_manifest.json").write_text(json.dumps({"completed_clusters": sorted(int(k) for k in set(pois.cluster_id)), "failed_clusters": []}))
    return root, lk


def test_batch_run_equals_the_view_run(spark, raw, tmp_path):
    root, lk = raw
    small = [models.regressor("randomforest", fx.FIXTURE, numTrees=3, maxDepth=3), models.regressor("gbt", fx.FIXTURE, maxIter=2, maxDepth=2)]
    out = run_pipeline(spark, str(root), str(root / "poi"), str(tmp_path), fx.FIXTURE, small, small[1], boosting.Booster(boosting.censored_normal(), rounds=3, depth=3, rate=0.4))
    for name in ("outlets", "coordinates", "sales", "poi", "gravity", "catchment", "clusters", "cooler", "master"):
        a, b = out[name], lk[name]
        assert a.exceptAll(b.select(*a.columns)).count() == 0 and a.count() == b.count(), name
    for name in ("transactions", "sales", "gravity"):
        layer = "silver" if name == "transactions" else "gold"
        assert spark.read.parquet(f"{tmp_path}/{layer}/{name}").schema.simpleString() == schemas.contract(name).simpleString()
    preds = spark.read.csv(f"{tmp_path}/outputs/predictions", header=True, inferSchema=True)
    assert preds.count() == out["outlets"].count() and preds.where("Maximum_Monthly_Liters <= 0").count() == 0
    assert spark.table("outlets").where("tobit_latent_estimate > 0").count() > 0
    spent = spark.read.csv(f"{tmp_path}/outputs/budget_allocations", header=True, inferSchema=True).agg(F.sum("Trade_Spend_Allocation_LKR")).first()[0]
    assert 0 < spent <= fx.FIXTURE.budget.total
    assert spark.table("pipeline_health").count() == 2 and spark.read.parquet(f"{tmp_path}/outputs/poi_tiles").where("not used").count() == 0
    first = json.loads(spark.table("xai_contexts").first().context_json)
    assert "base_value" in first and "gravity_x_cooler" in first
