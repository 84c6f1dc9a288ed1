"""Views that give the driver's tables the shape of the raw inputs.

The text runs in Spark and in DuckDB. ``{x_id}`` marks where Spark adds the stable row id; DuckDB,
which needs none, gets nothing there.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession

from retailpot.config import Budget, Config
from retailpot.sources.ingest import ROW_ID, read_parquet_with_id

FIXTURE = Config(
    outlet_id_pattern=r"OUT_\d{5,}", tx_years=(1995, 2001), season_years=(1995, 2001), target=(2002, 1), n_tiles=25,
    manual_holidays=(
        (dt.date(2002, 1, 2), "Full Moon Day", True, True, True, True),
        (dt.date(2002, 1, 14), "Harvest Day", True, True, True, False),
    ),
    budget=Budget(buckets={"High": 100_000.0, "Medium": 70_000.0, "Low": 30_000.0}, min_share=0.30, min_funded=40),
)
BASE_TABLES = ("customer", "supplier", "part", "orders", "lineitem", "embeddings")

VIEWS = {
    "fx_outlet_master": """
SELECT CONCAT(CASE WHEN c_custkey % 97 = 0 THEN 'BAD_' ELSE 'OUT_' END, LPAD(CAST(c_custkey AS STRING), CAST(GREATEST(5, LENGTH(CAST(c_custkey AS STRING))) AS INT), '0')) AS Outlet_ID,
       CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 7 = 1 THEN ' small ' WHEN c_custkey % 89 = 0 THEN 'Huge'
            WHEN c_custkey % 4 = 0 THEN 'Small' WHEN c_custkey % 4 = 1 THEN 'Medium' WHEN c_custkey % 4 = 2 THEN 'Large'
            ELSE 'Extra Large' END AS Outlet_Size,
       CAST(CASE WHEN c_custkey % 113 = 0 THEN 9 ELSE c_custkey % 6 END AS BIGINT) AS Cooler_Count,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Grocery' WHEN 'BUILDING' THEN 'Grocry' WHEN 'FURNITURE' THEN ' Eatery '
            WHEN 'HOUSEHOLD' THEN 'Kiosk' ELSE 'Pharmacy' END AS Outlet_Type{customer_id}
FROM {customer} c
UNION ALL SELECT CONCAT('OUT_9', LPAD(CAST(s_suppkey AS STRING), 9, '0')), 'Small', CAST(s_suppkey % 3 AS BIGINT), 'Grocery'{supplier_id} FROM {supplier} s""",
    "fx_outlet_coordinates": """
SELECT Outlet_ID,
       CASE WHEN k % 101 = 0 THEN 0e0 WHEN k % 211 = 0 THEN 12e0 WHEN k % 53 = 0 THEN lon ELSE lat END AS Latitude,
       CASE WHEN k % 101 = 0 THEN 0e0 WHEN k % 53 = 0 AND k % 211 <> 0 THEN lat ELSE lon END AS Longitude{row_id}
FROM (SELECT c_custkey AS k, CONCAT('OUT_', LPAD(CAST(c_custkey AS STRING), CAST(GREATEST(5, LENGTH(CAST(c_custkey AS STRING))) AS INT), '0')) AS Outlet_ID,
             6.2e0 + (c_nationkey % 5) * 0.7e0  + ((c_custkey * 7919) % 1000) * 6e-5   AS lat,
             79.8e0 + FLOOR(c_nationkey / 5e0) * 0.45e0 + ((c_custkey * 104729) % 997) * 6e-5 AS lon{customer_id}
      FROM {customer} c) t""",
    "fx_poi": """
SELECT p_partkey AS poi_id, CAST(p_partkey % 25 AS INT) AS cluster_id,
       6.2e0 + ((p_partkey % 25) % 5) * 0.7e0 + ((p_partkey * 6151) % 1000) * 6e-5 AS lat,
       79.8e0 + FLOOR((p_partkey % 25) / 5e0) * 0.45e0 + ((p_partkey * 3571) % 997) * 6e-5 AS lon,
       CASE p_size % 12 WHEN 0 THEN 'amenity' WHEN 1 THEN 'amenity' WHEN 2 THEN 'amenity' WHEN 3 THEN 'highway' WHEN 4 THEN 'railway'
            WHEN 5 THEN 'shop' WHEN 6 THEN 'amenity' WHEN 7 THEN 'tourism' WHEN 8 THEN 'amenity' WHEN 9 THEN 'shop' WHEN 10 THEN 'amenity' ELSE 'leisure' END AS tag_key,
       CASE p_size % 12 WHEN 0 THEN 'school' WHEN 1 THEN 'hospital' WHEN 2 THEN 'college' WHEN 3 THEN 'bus_stop' WHEN 4 THEN 'station'
            WHEN 5 THEN 'supermarket' WHEN 6 THEN 'place_of_worship' WHEN 7 THEN 'hotel' WHEN 8 THEN 'restaurant' WHEN 9 THEN 'convenience' WHEN 10 THEN 'pharmacy' ELSE 'park' END AS tag_value
FROM {part}""",
    "fx_transactions": """
SELECT CONCAT('OUT_', LPAD(CAST(o_custkey AS STRING), CAST(GREATEST(5, LENGTH(CAST(o_custkey AS STRING))) AS INT), '0')) AS Outlet_ID,
       CAST(YEAR(o_orderdate) AS BIGINT) AS Year, CAST(MONTH(o_orderdate) AS BIGINT) AS Month,
       CASE l_suppkey % 11 WHEN 0 THEN 'DIST_W_01' WHEN 1 THEN 'DIST_W_02' WHEN 2 THEN 'DIST_W_03' WHEN 3 THEN 'DIST_C_01' WHEN 4 THEN 'DIST_C_02'
            WHEN 5 THEN 'DIST_C_03' WHEN 6 THEN 'DIST_NW_01' WHEN 7 THEN 'DIST_NW_02' WHEN 8 THEN 'DIST_S_01' WHEN 9 THEN 'DIST_S_02' ELSE 'DIST_X_99' END AS Distributor_ID,
       CASE WHEN l_partkey % 500 = 0 THEN NULL WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -l_quantity ELSE l_quantity END AS Volume_Liters{lineitem_id}
FROM {orders} o JOIN {lineitem} l ON o_orderkey = l_orderkey""",
    "fx_holidays": """
SELECT CAST(o_orderdate AS DATE) AS Date, o_orderkey AS row_id, CONCAT('Holiday ', CAST(o_orderkey AS STRING)) AS Holiday_Name,
       CASE WHEN o_orderkey % 20 <> 0 THEN 'Other' ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'Public' WHEN '2-HIGH' THEN 'Bank' WHEN '3-MEDIUM' THEN 'Mercantile' WHEN '4-NOT SPECIFIED' THEN 'Poya Day' ELSE 'Other' END END AS Holiday_Type
FROM {orders}""",
    "fx_seasonality": """
SELECT DISTINCT Distributor_ID, Year, Month,
       CASE (ASCII(SUBSTRING(Distributor_ID, 6, 1)) + ASCII(SUBSTRING(Distributor_ID, LENGTH(Distributor_ID), 1)) * 7 + Year * 3 + Month) % 3
            WHEN 0 THEN 'Favorable' WHEN 1 THEN 'Moderate' ELSE 'Un-Favorable' END AS Seasonality_Index
FROM {fx_transactions}""",
    "fx_predictions": """
SELECT CONCAT('OUT_', LPAD(CAST(o_custkey AS STRING), CAST(GREATEST(5, LENGTH(CAST(o_custkey AS STRING))) AS INT), '0')) AS Outlet_ID,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 1e4 AS model_a,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) / 1e3 AS model_b, MAX(o_totalprice) / 1e3 AS model_c
FROM {orders} GROUP BY o_custkey
UNION ALL SELECT CONCAT('OUT_9', LPAD(CAST(s_suppkey AS STRING), 9, '0')), 5e0 + s_suppkey % 7, 5e0 + s_suppkey % 5, 4e0 + s_suppkey % 3 FROM {supplier} s""",
}
# corner points (lat, lon) of two coarse land outlines, for point_in_polygon: the outer ring, then holes (a lagoon)
OUTLINE = {
    "mainland": (((6.1, 79.7), (6.1, 80.9), (7.0, 81.4), (8.3, 81.7), (9.05, 80.9), (8.9, 80.1), (8.0, 79.75), (7.0, 79.8)),
                 ((6.88, 80.2), (6.88, 80.36), (6.93, 80.36), (6.93, 80.2))),
    "islet": (((6.15, 81.58), (6.35, 81.58), (6.35, 81.7), (6.15, 81.7)),),
}


def duckdb_view(name: str) -> str:
    marks = {"customer_id": "", "supplier_id": "", "row_id": "", "lineitem_id": ""}
    names = {t: t for t in (*BASE_TABLES, *VIEWS)}
    return VIEWS[name].format(**marks, **names).strip()


def outline_geojson() -> str:
    """The outlines as a GeoJSON document beside a feature of another place."""
    closed = lambda ring: [[lon, lat] for lat, lon in (*ring, ring[0])]
    land = {"type": "MultiPolygon", "coordinates": [[closed(ring) for ring in rings] for rings in OUTLINE.values()]}
    far = {"type": "Polygon", "coordinates": [closed(((0.0, 0.0), (0.0, 90.0), (20.0, 90.0), (20.0, 0.0)))]}
    features = [{"type": "Feature", "properties": {"ISO_A3": k}, "geometry": g} for k, g in (("XXX", far), ("LKA", land))]
    return json.dumps({"type": "FeatureCollection", "features": features})


def load_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    marks = {"customer_id": f", c.{ROW_ID}", "supplier_id": f", s.{ROW_ID}", "row_id": f", {ROW_ID}", "lineitem_id": f", l.{ROW_ID}"}
    used = {t for t in (*BASE_TABLES, *VIEWS) if "{" + t + "}" in VIEWS[name]}
    frames = {}
    for t in used:
        if t in VIEWS:
            frames[t] = load_view(spark, sf_dir, t)
        elif "{" + t + "_id}" in VIEWS[name]:
            frames[t] = read_parquet_with_id(spark, f"{sf_dir}/{t}.parquet")
        else:
            frames[t] = spark.read.parquet(f"{sf_dir}/{t}.parquet")
    text = VIEWS[name]
    for mark, value in marks.items():
        text = text.replace("{" + mark + "}", value)
    df = spark.sql(text, **frames)
    if name == "fx_seasonality":  # rows are distinct by construction: any value identifies them
        from pyspark.sql import functions as F

        df = df.withColumn(ROW_ID, F.xxhash64("Distributor_ID", "Year", "Month"))
    return df
