"""Points of interest from nested tile files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailpot.config import POI_TYPE_TAGS

ENVELOPE = (
    "cluster_id int, config_snapshot struct<n_clusters:int,buffer_deg:double>,"
    "bounding_box struct<lat_min:double,lat_max:double,lon_min:double,lon_max:double>,"
    "outlet_ids array<string>, n_outlets int, n_pois_returned int, scraped_at string,"
    "elements array<struct<lat:double,lon:double,center:struct<lat:double,lon:double>,tags:map<string,string>>>"
)
MANIFEST = "completed_clusters array<int>, failed_clusters array<int>, total_clusters int, started_at string"


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """One row per tile file; files without a cluster id (such as the manifest) are left out."""
    return spark.read.schema(ENVELOPE).option("multiLine", True).json(path).where("cluster_id is not null")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(cluster_id, status) rows of the manifest."""
    m = spark.read.schema(MANIFEST).option("multiLine", True).json(path)
    done = m.select(F.explode("completed_clusters").alias("cluster_id"), F.lit("completed").alias("status"))
    return done.unionByName(m.select(F.explode("failed_clusters").alias("cluster_id"), F.lit("failed").alias("status")))


def manifest_filter(tiles: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows of tiles listed as completed and not as failed; ``tile_report`` says what the others are."""
    failed = manifest.where("status = 'failed'").select("cluster_id").distinct()
    done = manifest.where("status = 'completed'").select("cluster_id").distinct().join(failed, "cluster_id", "left_anti")
    return tiles.join(done, "cluster_id", "left_semi")


def tile_report(tiles: DataFrame, manifest: DataFrame, n_clusters: int | None = None) -> DataFrame:
    """What became of each tile: (cluster_id, status, used, config_matches), one row per tile that the manifest or the files know.

    ``status`` is the manifest's (``failed`` wins over ``completed``), ``missing`` for a completed tile without a file and ``unlisted`` for a
    file that the manifest does not name. Only completed tiles with a file are used. ``config_matches`` is false for a used tile that was
    read for another number of clusters, which is reported but used.
    """
    listed = manifest.groupBy("cluster_id").agg(F.bool_or(F.col("status") == "failed").alias("_failed"), F.bool_or(F.col("status") == "completed").alias("_done"))
    clusters = F.col("config_snapshot.n_clusters") if "config_snapshot" in tiles.columns else F.lit(None).cast("int")
    found = tiles.groupBy("cluster_id").agg(F.max(clusters).alias("_clusters"), F.lit(True).alias("_file"))
    both = listed.join(found, "cluster_id", "full")
    status = (F.when(F.col("_failed"), "failed").when(F.col("_done") & F.col("_file").isNull(), "missing").when(F.col("_done"), "completed").otherwise("unlisted"))
    used = status == "completed"
    same = F.lit(True) if n_clusters is None else F.coalesce(F.col("_clusters") == n_clusters, F.lit(True))
    return both.select("cluster_id", status.alias("status"), used.alias("used"), F.when(used, same).alias("config_matches"))


def explode_pois(envelopes: DataFrame) -> DataFrame:
    """(cluster_id, lat, lon, tags); ways fall back to their centre, elements without a position are left out."""
    e = envelopes.select("cluster_id", F.explode("elements").alias("e"))
    return e.select("cluster_id", F.coalesce("e.lat", "e.center.lat").alias("lat"),
                    F.coalesce("e.lon", "e.center.lon").alias("lon"),
                    F.coalesce("e.tags", F.expr("map()").cast("map<string,string>")).alias("tags")
                    ).where("lat is not null and lon is not null")


def outlet_cluster_link(envelopes: DataFrame) -> DataFrame:
    """One row per outlet; the lowest cluster wins where an outlet repeats."""
    return (envelopes.select(F.explode("outlet_ids").alias("outlet_id"), "cluster_id")
            .groupBy("outlet_id").agg(F.min("cluster_id").alias("cluster_id")))


def tag(tags: Column, key: str) -> Column:
    """Tag value with the empty string read as absent."""
    return F.nullif(F.try_element_at(tags, F.lit(key)), F.lit(""))


def poi_type(tags: Column) -> Column:
    return F.coalesce(*[tag(tags, k) for k in POI_TYPE_TAGS], F.lit("unknown"))


def cluster_pois(pois: DataFrame) -> DataFrame:
    """Serving form of exploded POIs."""
    t = F.col("tags")
    return pois.select("cluster_id", "lat", "lon", poi_type(t).alias("poi_type"),
                       F.coalesce(F.try_element_at(t, F.lit("name")), F.lit("")).alias("name"), F.to_json(t).alias("tags_json"))
