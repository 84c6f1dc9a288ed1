"""The batch pipeline on raw files: CSV snapshots to Bronze, Silver, Gold, predictions and allocation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailpot import schemas
from retailpot.config import Config
from retailpot.operators import budget, holidays, models, quality, serving
from retailpot.plans.lake import Lake
from retailpot.sources import ingest, poi

SILVER = ("outlets", "coordinates", "transactions", "seasonality", "calendar")
GOLD = ("sales", "poi", "gravity", "catchment", "cooler", "spatial", "baseline")


class FileLake(Lake):
    """Layers over Bronze Parquet, a folder of POI tiles and models trained on the master table."""

    BRONZE = {
        "fx_outlet_master": "outlet_master", "fx_outlet_coordinates": "outlet_coordinates", "fx_transactions": "transactions_history_final",
        "fx_seasonality": "distributor_seasonality_details", "fx_holidays": "holiday_list",
    }

    def __init__(self, spark: SparkSession, bronze: str, poi_cache: str, work: str, cfg: Config, estimators: list | None = None,
                 hurdle=None, latent=None):
        self.hurdle, self.latent = hurdle, latent
        self._work, self.poi_cache = work.rstrip("/"), poi_cache
        self.estimators = estimators or [models.regressor("randomforest", cfg), models.regressor("gbt", cfg)]
        super().__init__(spark, bronze, cfg)

    def _make_root(self) -> str:
        return self._work

    def raw(self, name: str) -> DataFrame:
        return ingest.read_parquet_with_id(self.spark, f"{self.sf_dir}/{self.BRONZE[name]}")

    def envelopes(self) -> DataFrame:
        tiles = poi.read_envelopes(self.spark, f"{self.poi_cache}/cluster_*.json")
        return poi.manifest_filter(tiles, poi.read_manifest(self.spark, f"{self.poi_cache}/scrape_manifest.json"))

    def served(self) -> DataFrame:
        return poi.outlet_cluster_link(self.envelopes())

    def tile_report(self) -> DataFrame:
        tiles = poi.read_envelopes(self.spark, f"{self.poi_cache}/cluster_*.json")
        return poi.tile_report(tiles, poi.read_manifest(self.spark, f"{self.poi_cache}/scrape_manifest.json"), self.cfg.n_tiles)

    def pois(self) -> DataFrame:
        return self["poi_points"]

    def _build_poi_points(self) -> DataFrame:
        return poi.explode_pois(self.envelopes())

    def _build_calendar(self) -> DataFrame:
        return holidays.clean_holidays(self.raw("fx_holidays"), self.cfg, ingest.ROW_ID)[0]

    def model_tables(self) -> list[DataFrame]:
        return self.once("models", lambda: [models.train_regressor(self.prepared(), e)[1] for e in self.estimators])

    def _build_blend(self) -> DataFrame:
        return models.ensemble_blend(self.model_tables())

    def _build_submodels(self) -> DataFrame:
        """Censored and hurdle estimates, computed from the base features."""
        latent = models.latent_demand(self.prepared(), self.cfg, self.latent).join(self["master"].select("Outlet_ID", "hist_p90_monthly"), "Outlet_ID")
        ratio = models.censoring_ratio(F.col("tobit_latent_estimate"), F.col("hist_p90_monthly"))
        hurdle = models.hurdle_estimate(models.hurdle_active_prob(self.prepared(), self.cfg), models.hurdle_conditional(self.prepared(), self.cfg, self.hurdle))
        return latent.select("Outlet_ID", "tobit_latent_estimate", ratio.alias("tobit_censoring_ratio")).join(hurdle, "Outlet_ID")

    def _build_srv_outlets(self) -> DataFrame:
        full = self["master"].join(self["submodels"], "Outlet_ID", "left")
        return serving.serving_outlets(full, self["final"].select("Outlet_ID", "Maximum_Monthly_Liters"), self.cfg)

    def _build_srv_contexts(self) -> DataFrame:
        return serving.serving_contexts(self["contributions"])


def validate(lk: Lake) -> DataFrame:
    """Contract rules over the finished tables, one row per rule."""
    f, t, outlets = lk["final"], lk["transactions"], lk["outlets"]
    predictions = quality.expect(f, [*quality.not_null("Outlet_ID", "Maximum_Monthly_Liters"),
                                     quality.Rule("positive:Maximum_Monthly_Liters", F.col("Maximum_Monthly_Liters") <= 0)], unique=["Outlet_ID"])
    clean = quality.expect(t, [*quality.not_null("Outlet_ID"), quality.Rule("positive:Volume_Litres", F.col("Volume_Litres") <= 0)])
    catchment = quality.expect(lk["catchment"], [*quality.monotone("competitors_500m", "competitors_1km", "competitors_2km"),
                                                 quality.bounds("competition_density_score", 0, 100)], unique=["Outlet_ID"])
    tagged = [d.withColumn("dataset", F.lit(n)) for n, d in (("final", predictions), ("transactions", clean), ("catchment", catchment),
                                                             ("master", quality.same_count(lk["master"], outlets, "outlets")))]
    return quality.quarantine_union(tagged)


def run_pipeline(spark: SparkSession, raw_dir: str, poi_cache: str, out_dir: str, cfg: Config | None = None, estimators: list | None = None,
                 hurdle=None, latent=None) -> Lake:
    """Everything from raw CSV to the allocation; outputs go below ``out_dir`` and a violated contract raises."""
    cfg = cfg or Config()
    ingest.ingest_csv(spark, raw_dir, f"{out_dir}/bronze")
    lk = FileLake(spark, f"{out_dir}/bronze", poi_cache, f"{out_dir}/work", cfg, estimators, hurdle, latent)
    for layer, names in (("silver", SILVER), ("gold", GOLD)):
        for name in names:
            df = schemas.conform(lk[name], name)
            ingest.parquet_sink(df, f"{out_dir}/{layer}/{name}", df.columns)
    quality.enforce(validate(lk))
    ingest.report_append(lk.tx_run().report(), f"{out_dir}/outputs/dq_report", "latest")
    tiles = lk.tile_report()
    ingest.parquet_sink(tiles, f"{out_dir}/outputs/poi_tiles", tiles.columns)
    ingest.parquet_sink(lk["master"], f"{out_dir}/gold/master", lk["master"].columns)
    ingest.csv_sink(lk["final"], f"{out_dir}/outputs/predictions", ["Outlet_ID", "Maximum_Monthly_Liters"])
    ingest.csv_sink(lk["allocation"], f"{out_dir}/outputs/budget_allocations", ["Outlet_ID", budget.SPEND])
    ingest.parquet_sink(lk["allocation"], f"{out_dir}/outputs/budget_features", budget.DIAGNOSTIC_COLUMNS)
    serving.register({"outlets": lk["srv_outlets"], "budget_allocations": lk["srv_allocations"], "xai_contexts": lk["srv_contexts"],
                      "outlet_clusters": lk.links(), "cluster_pois": poi.cluster_pois(lk.pois()), "pipeline_health": serving.read_health(lk.health())})
    return lk
