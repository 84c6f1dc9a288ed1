"""Distances on the globe and grid cells, as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_KM = 6371.0
KM_PER_DEGREE = EARTH_KM * math.pi / 180.0
# WGS-84 ellipsoid
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres."""
    s_lat = F.sin(F.radians(lat2 - lat1) / 2)
    s_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = s_lat * s_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * s_lon * s_lon
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def reduced_latitude(lat: Column) -> Column:
    """Latitude on the auxiliary sphere of WGS-84, in radians."""
    return F.atan(F.lit(1 - WGS84_F) * F.tan(F.radians(lat)))


def with_geodesic_m(df: DataFrame, name: str, beta1: str, lon1: str, beta2: str, lon2: str) -> DataFrame:
    """Ellipsoid distance in metres by Lambert's formula for short lines.

    The latitudes are given reduced, so that they are computed per point and not per pair; the angle
    and its parts are columns of their own, so that each is computed once.
    """
    s_lat = F.sin((F.col(beta2) - F.col(beta1)) / 2)
    s_lon = F.sin(F.radians(F.col(lon2) - F.col(lon1)) / 2)
    h = s_lat * s_lat + F.cos(beta1) * F.cos(beta2) * s_lon * s_lon
    sq = lambda c: c * c
    mid, half = (F.col(beta1) + F.col(beta2)) / 2, (F.col(beta2) - F.col(beta1)) / 2
    out = df.withColumn("_h", F.least(h, F.lit(1.0))).withColumns({"_sg": F.lit(2.0) * F.asin(F.sqrt("_h")), "_ss": F.lit(2.0) * F.sqrt(F.col("_h") * (1 - F.col("_h")))})
    # sin(sigma) = 2 sqrt(h (1 - h)), cos(sigma / 2)^2 = 1 - h, sin(sigma / 2)^2 = h
    x = (F.col("_sg") - F.col("_ss")) * sq(F.sin(mid) * F.cos(half)) / (1 - F.col("_h"))
    y = (F.col("_sg") + F.col("_ss")) * sq(F.cos(mid) * F.sin(half)) / F.col("_h")
    metres = F.when(F.col("_h") == 0, F.lit(0.0)).otherwise(F.lit(WGS84_A) * (F.col("_sg") - F.lit(WGS84_F / 2) * (x + y)))
    return out.withColumn(name, metres).drop("_h", "_sg", "_ss")


def cell(c: Column, side: float) -> Column:
    return F.floor(c / F.lit(side)).cast("long")


def box_bounds_km(a: dict[str, Column], b: dict[str, Column], slack: float) -> tuple[Column, Column]:
    """Bounds (nearest, farthest) on the distance between any two points of two lat/lon boxes.

    A box is ``lat0 <= lat1, lon0 <= lon1``. The bounds hold for every great-circle distance and,
    widened by the relative ``slack``, for ellipsoid distances as well.
    """
    zero = F.lit(0.0)
    d_lat = F.greatest(a["lat0"] - b["lat1"], b["lat0"] - a["lat1"], zero)
    d_lon = F.greatest(a["lon0"] - b["lon1"], b["lon0"] - a["lon1"], zero)
    w_lat = F.greatest(a["lat1"] - b["lat0"], b["lat1"] - a["lat0"])
    w_lon = F.greatest(a["lon1"] - b["lon0"], b["lon1"] - a["lon0"])

    def cos_range(box):
        hi_abs = F.greatest(F.abs(box["lat0"]), F.abs(box["lat1"]))
        lo_abs = F.when((box["lat0"] <= 0) & (box["lat1"] >= 0), zero).otherwise(
            F.least(F.abs(box["lat0"]), F.abs(box["lat1"])))
        return F.cos(F.radians(hi_abs)), F.cos(F.radians(lo_abs))

    (a_min, a_max), (b_min, b_max) = cos_range(a), cos_range(b)

    def hav(dl, dn, cc):
        s1, s2 = F.sin(F.radians(dl) / 2), F.sin(F.radians(dn) / 2)
        return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(s1 * s1 + cc * s2 * s2, F.lit(1.0))))

    near = hav(d_lat, d_lon, a_min * b_min) * F.lit(1 - slack)
    far = hav(w_lat, w_lon, a_max * b_max) * F.lit(1 + slack)
    return near, far
