"""Layered tables of one input folder, built on first use and kept in the shared folder.

Silver, gold and serving tables are written once per application, as the layers of the batch pipeline
are, so that each later step plans over a table instead of over everything before it.
"""

from __future__ import annotations

import hashlib
import threading
from collections import defaultdict
from collections.abc import Callable

from pyspark import InheritableThread
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailpot.config import Config
from retailpot.operators import attribution, baseline, boosting, briefing, budget, cleaning, clusters, features, holidays, models, quality, sales, serving, spatial
from retailpot.operators.target_codes import TargetCodes
from retailpot.plans import fixture_views as fx
from retailpot.session import shared_root
from retailpot.sources import geojson, poi



def padded(key: Column, width: int = 5) -> Column:
    """The key as text, shorter ones with leading zeros."""
    text = key.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), "0")


_LAKES: dict[tuple[str, str], Lake] = {}  # noqa: F821


def lake(spark: SparkSession, sf_dir: str, cfg: Config = fx.FIXTURE) -> Lake:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        _LAKES[key] = Lake(spark, sf_dir, cfg)
    return _LAKES[key]


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str, cfg: Config):
        self.spark, self.sf_dir, self.cfg = spark, sf_dir.rstrip("/"), cfg
        self.root = self._make_root()
        self._ready: dict[str, str] = {}
        self._objects: dict[str, object] = {}
        self._locks: dict[tuple[str, str], threading.RLock] = defaultdict(threading.RLock)
        self._locks_lock = threading.Lock()

    def _lock(self, kind: str, name: str) -> threading.RLock:
        """One per layer or object. Layers are built under their own lock and ask for those below them only, so no two threads wait for each other."""
        with self._locks_lock:
            return self._locks[kind, name]

    def _make_root(self) -> str:
        return f"{shared_root(self.spark)}/{hashlib.sha1(self.sf_dir.encode()).hexdigest()[:8]}"

    # --- raw views -----------------------------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        return fx.load_view(self.spark, self.sf_dir, name)

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def transactions(self) -> DataFrame:
        """Raw transactions with canonical names, date and period."""
        return cleaning.rederive_period(cleaning.canonical_columns(cleaning.synth_month_date(self.raw("fx_transactions"))))

    # --- layer tables --------------------------------------------------------------------
    def table(self, name: str) -> DataFrame:
        with self._lock("layer", name):
            if name not in self._ready:
                path = f"{self.root}/{name}"
                getattr(self, f"_build_{name}")().write.mode("overwrite").parquet(path)
                self._ready[name] = path
        return self.spark.read.parquet(self._ready[name])

    __getitem__ = table

    def together(self, *names: str) -> None:
        """Build layers that do not need each other side by side: stages of few tasks leave cores that the others can use."""
        failed: list[BaseException] = []

        def build(name: str) -> None:
            try:
                self.table(name)
            except BaseException as e:  # raised again in the caller's thread
                failed.append(e)

        threads = [InheritableThread(target=build, args=(n,), session=self.spark) for n in names if n not in self._ready]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        if failed:
            raise failed[0]

    def once(self, key: str, make: Callable[[], object]):
        with self._lock("object", key):
            if key not in self._objects:
                self._objects[key] = make()
            return self._objects[key]

    def cleaned(self, name: str) -> cleaning.Cleaned:
        makers = {
            "outlets": lambda: cleaning.clean_outlets(self.raw("fx_outlet_master"), self.cfg),
            "coordinates": lambda: cleaning.clean_coordinates(self.raw("fx_outlet_coordinates"), self["outlets"], self.cfg),
            "seasonality": lambda: cleaning.clean_seasonality(self["season_rows"], self.cfg),
        }
        return self.once(name, makers[name])

    def _build_outlets(self):
        return self.cleaned("outlets").clean

    def _build_coordinates(self):
        return self.cleaned("coordinates").clean

    def _build_tx_checked(self):
        """Transactions annotated with the first failed check (read by clean, rejected and report alike)."""
        _, run = cleaning.check_transactions(self.raw("fx_transactions"), self["outlets"], self.cfg)
        return run.annotated

    def tx_run(self) -> quality.CheckRun:
        names = tuple(c.name for c in cleaning.transaction_checks(self["outlets"], self.cfg))
        return quality.CheckRun(self["tx_checked"], names, "transactions")

    def _build_transactions(self):
        return cleaning.finish_transactions(self.tx_run().passed, self.cfg)

    def health(self) -> DataFrame:
        """Health rows of the datasets whose rows are checked one by one."""
        coords = self.cleaned("coordinates")
        a = quality.pipeline_health("outlet_coordinates", self["coordinates"], coords.rejected, "Valid Lat/Lon Coordinates")
        return a.unionByName(quality.pipeline_health("transactions", self["transactions"], self.tx_rejected(), "Valid Transactions"))

    def tx_rejected(self) -> DataFrame:
        period = cleaning.check_period(self.raw("fx_transactions"), self.cfg)
        return quality.quarantine_union([period.failed, self.tx_run().failed])

    def _build_season_rows(self):
        """Raw seasons, a few rows distilled from all transactions: stored, as the strict check and the clean table both read them."""
        return self.raw("fx_seasonality")

    def _build_seasonality(self):
        return self.cleaned("seasonality").clean

    def _build_calendar(self):
        return holidays.clean_holidays(self.raw("fx_holidays"), self.cfg)[0]

    def _build_days(self):
        return holidays.trading_days(self["calendar"], self.cfg)

    def pois(self) -> DataFrame:
        return self.raw("fx_poi").select("poi_id", "cluster_id", "lat", "lon", F.create_map("tag_key", "tag_value").alias("tags"))

    def write_envelopes(self) -> str:
        """Tile files of the POI cache (several files per tile, so that no tile is collected whole)."""
        def make():
            path = f"{self.root}/poi_cache"
            part = F.floor(F.col("poi_id") / 5000)
            tiles = self.pois().groupBy("cluster_id", part.alias("part")).agg(F.collect_list(F.struct("lat", "lon", "tags")).alias("elements"))
            key = F.col("c_custkey")
            members = self.base("customer").groupBy(F.col("c_nationkey").alias("cluster_id"), F.floor(key / 5000).alias("part")).agg(
                F.collect_list(F.concat(F.lit("OUT_"), padded(key))).alias("outlet_ids"))
            tiles.join(members, ["cluster_id", "part"], "full").drop("part").write.mode("overwrite").json(path)
            return path
        return self.once("envelopes", make)

    def envelopes(self) -> DataFrame:
        return self.spark.read.schema(poi.ENVELOPE).json(self.write_envelopes()).where("cluster_id is not null")

    def links(self) -> DataFrame:
        return poi.outlet_cluster_link(self.envelopes())

    def served(self) -> DataFrame | None:
        """Outlets of tiles that were read; None where no tile is missing."""
        return None

    def manifest(self) -> DataFrame:
        """A manifest in which one tile in seven has failed, read from its file."""
        def make():
            path = f"{self.root}/manifest"
            ids = self.pois().select("cluster_id").distinct()
            split = lambda ok: F.collect_list(F.when((F.col("cluster_id") % 7 == 3) != F.lit(ok), F.col("cluster_id")))
            ids.agg(split(True).alias("completed_clusters"), split(False).alias("failed_clusters")).coalesce(1).write.mode("overwrite").json(path)
            return path
        return poi.read_manifest(self.spark, self.once("manifest", make))

    def _build_sales(self):
        return sales.sales_features(self["transactions"], self["outlets"])

    def _build_poi(self):
        return spatial.poi_features(self["coordinates"], self["outlets"], self.pois(), self.cfg, self.served())

    def _build_gravity(self):
        return spatial.gravity_features(self["coordinates"], self["outlets"], self.pois(), self.cfg)

    def _build_catchment(self):
        return spatial.catchment_features(self["coordinates"], self["outlets"], self.cfg)

    def _build_clusters(self):
        return clusters.dbscan(self["coordinates"], self.cfg)

    def _build_spatial(self):
        stats = clusters.cluster_stats(self["clusters"], self["sales"])
        return spatial.append_missing_points(stats, self["outlets"], {
            "micro_market_id": -1, "is_spatial_outlier": True, "cluster_outlet_count": 0, "cluster_mean_volume": 0.0, "cluster_p90_volume": 0.0})

    def _build_cooler(self):
        return features.cooler_features(self["outlets"], self["sales"], self.cfg)

    def required(self) -> dict[str, DataFrame]:
        return {n: self[n] for n in ("sales", "poi", "gravity", "catchment")}

    def _build_master(self):
        """Base features: what the sub-models and the floor are computed from."""
        self.together("sales", "poi", "gravity", "catchment", "clusters", "seasonality", "days")
        return features.master_features(self["outlets"], self["coordinates"], self["seasonality"], self["days"], self.required(), self.cfg,
                                        {"cooler": self["cooler"], "spatial": self["spatial"]})

    def _build_baseline(self):
        return baseline.baseline_potential(self["master"], self.cfg)

    def model_tables(self) -> list[DataFrame]:
        p = self.raw("fx_predictions")
        return [p.select("Outlet_ID", F.col(c).alias("model_prediction")) for c in ("model_a", "model_b", "model_c")]

    def _build_blend(self):
        return models.ensemble_blend(self.model_tables(), [0.4, 0.4, 0.2])

    def _build_final(self):
        """Final potential of the outlets in the master table."""
        own = self["blend"].join(self["master"].select("Outlet_ID"), "Outlet_ID")
        return models.floor_blend(own, self["baseline"])

    def _build_limits(self):
        return budget.limits(self["master"], self["final"], self.cfg.budget)

    def _build_greedy(self):
        return budget.greedy_tier_budget(self["limits"], self.cfg.budget)

    def _build_spread(self):
        return budget.leftover_redistribution(self["greedy"], self.cfg.budget)

    def _build_rebalanced(self):
        return budget.distributor_rebalance(self["spread"], self.cfg.budget)

    def _build_adjusted(self):
        return budget.micro_adjust(self["rebalanced"], self.cfg.budget)

    def _build_allocation(self):
        return budget.projected_uplift(self["adjusted"])

    # --- models --------------------------------------------------------------------------
    def prepared(self) -> models.Prepared:
        return self.once("prepared", lambda: models.Prepared(self["master"], self.cfg))

    def forest(self, **params) -> object:
        small = {"numTrees": 20, "maxDepth": 6, **params}
        return models.regressor("randomforest", self.cfg, **small)

    def fitted(self):
        return self.once("fitted", lambda: models.train_regressor(self.prepared(), self.forest()))

    def boosted(self):
        """Boosted trees over ordered category codes: (prepared, model, predictions)."""
        def make():
            prep = models.Prepared(self["master"], self.cfg, ordered=True)
            booster = boosting.Booster(boosting.squared(), rounds=25, depth=4, rate=0.2, patience=4, subsample=0.8, seed=self.cfg.seed)
            model, predictions = models.train_regressor(prep, models.OrderedBoosting(TargetCodes(prep.categories, seed=self.cfg.seed), booster))
            return prep, model, predictions
        return self.once("boosted", make)

    def _build_contributions(self):
        return attribution.feature_contributions(self.prepared().all, self.fitted()[0], self.prepared().features)

    # --- serving -------------------------------------------------------------------------
    def _build_srv_outlets(self):
        return serving.serving_outlets(self["master"], self["final"].select("Outlet_ID", "Maximum_Monthly_Liters"), self.cfg)

    def _build_srv_allocations(self):
        return serving.serving_allocations(self["allocation"])

    def embedding_contributions(self) -> DataFrame:
        """The embeddings table as wide contributions: vector position = feature."""
        e = self.base("embeddings").select(F.concat(F.lit("OUT_"), padded(F.col("vec_id") + 1)).alias("outlet_id"),
                                           F.posexplode("embedding").alias("i", "v"))
        return e.select("outlet_id", F.concat(F.lit("f"), padded(F.col("i"), 3)).alias("feature"), F.col("v").cast("double").alias("contribution"))

    def _build_srv_contexts(self):
        """Context rows: the outlet's contributions as one JSON object (bounded by the vector length)."""
        e = self.base("embeddings")
        names = F.transform(F.sequence(F.lit(0), F.size("embedding") - 1), lambda i: F.concat(F.lit("f"), padded(i, 3)))
        values = F.transform("embedding", lambda v: F.round(v.cast("double"), 4))
        oid = F.concat(F.lit("OUT_"), padded(F.col("vec_id") + 1))
        return e.select(oid.alias("outlet_id"), F.to_json(F.map_from_arrays(names, values)).alias("context_json"), F.lit(None).cast("string").alias("xai_explanation"))

    def detail(self) -> DataFrame:
        return serving.outlet_detail(self["srv_outlets"], self["srv_allocations"], self["srv_contexts"])

    def sea(self) -> DataFrame:
        def make():
            path = f"{self.root}/outline"
            self.spark.createDataFrame([(fx.outline_geojson(),)], "value string").coalesce(1).write.mode("overwrite").text(path)
            return path
        rings = geojson.read_rings(self.spark, self.once("outline", make), {"ISO_A3": "LKA"})
        flags = spatial.point_in_polygon(self["coordinates"], spatial.ring_edges(rings))
        return flags.select(F.col("Outlet_ID").alias("outlet_id"), "in_sea")

    def briefings(self) -> DataFrame:
        return briefing.rule_briefing(self.detail())
