"""Land outlines from GeoJSON: polygons and multi-polygons with holes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FEATURE = "struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>"
_POLYGON = "array<array<array<double>>>"


def read_rings(spark: SparkSession, path: str, where: Mapping[str, str] | None = None, lines: bool = False) -> DataFrame:
    """Rings as rows (polygon, ring, seq, lat, lon), the outer ring first (``ring`` 0), of the features whose properties match ``where``.

    A document is a FeatureCollection or a single Feature; with ``lines`` every line is a Feature, which is read in parallel. Positions are
    (longitude, latitude); further numbers of a position are left out, and so are features of other geometry types. The repeated last
    position of a ring is kept: it adds an edge of no length.
    """
    read = spark.read.schema(f"type string, features array<{_FEATURE}>, properties map<string,string>, geometry struct<type:string,coordinates:string>")
    docs = read.option("multiLine", not lines).json(path)
    own = F.array(F.struct("properties", "geometry"))
    features = docs.select(F.monotonically_increasing_id().alias("doc"), F.posexplode(F.when(F.col("type") == "Feature", own).otherwise(F.col("features"))).alias("i", "f"))
    for key, value in (where or {}).items():
        features = features.where(F.try_element_at("f.properties", F.lit(key)) == value)
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    many = F.when(kind == "MultiPolygon", F.from_json(text, f"array<{_POLYGON}>")).when(kind == "Polygon", F.array(F.from_json(text, _POLYGON)))
    polygons = features.select("doc", "i", F.posexplode(many).alias("k", "rings"))
    rings = polygons.select(F.concat_ws(":", "doc", "i", "k").alias("polygon"), F.posexplode("rings").alias("ring", "positions"))
    points = rings.select("polygon", "ring", F.posexplode("positions").alias("seq", "at"))
    return points.select("polygon", "ring", "seq", F.col("at")[1].alias("lat"), F.col("at")[0].alias("lon"))
