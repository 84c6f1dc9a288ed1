"""Density clusters of outlets.

The grid form of DBSCAN: a cell's diagonal is at most eps, so all points of a cell are neighbours. A
cell with enough points makes all of them core without a single distance, and the graph to connect
has cells as nodes (at most 24 neighbours each) in place of points. Point-level distances are needed
only around thinly filled cells and for cell pairs that bounding boxes leave open.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailpot.config import Config
from retailpot.functions import geo
from retailpot.operators.quantiles import grouped_quantiles
from retailpot.operators.ranking import global_row_number
from retailpot.session import cut

SUB = 8  # sub-tiles per cell side for the box test
SLACK = 1e-9


def _cells(df: DataFrame, side: float) -> DataFrame:
    return df.withColumns({"cy": geo.cell(F.col("lat"), side), "cx": geo.cell(F.col("lon"), side)})


def _offsets(cfg: Config) -> list[tuple[int, int]]:
    b = cfg.bounds
    far = math.cos(math.radians(max(abs(b.lat_min), abs(b.lat_max))))
    ry, rx = math.ceil(math.sqrt(2) * 1.002), math.ceil(math.sqrt(2) * 1.002 / far)
    return [(dy, dx) for dy in range(-ry, ry + 1) for dx in range(-rx, rx + 1)]


def _spread(df: DataFrame, offsets: Sequence[tuple[int, int]], y: str, x: str) -> DataFrame:
    """One copy of each row per neighbour cell, as (y, x)."""
    o = F.explode(F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in offsets]))
    return df.withColumn("_o", o).withColumns({y: F.col("cy") + F.col("_o.dy"), x: F.col("cx") + F.col("_o.dx")}).drop("_o")


def _km(a: str, b: str) -> Column:
    return geo.haversine_km(F.col(f"{a}lat"), F.col(f"{a}lon"), F.col(f"{b}lat"), F.col(f"{b}lon"))


def _prefixed(df: DataFrame, p: str, *names: str) -> list[Column]:
    return [F.col(n).alias(p + n) for n in names]


def _boxes(df: DataFrame, p: str, *keys: str) -> DataFrame:
    return df.groupBy(*[F.col(k).alias(p + k) for k in keys]).agg(
        F.min("lat").alias(p + "lat0"), F.max("lat").alias(p + "lat1"), F.min("lon").alias(p + "lon0"), F.max("lon").alias(p + "lon1"))


def _near_far() -> tuple[Column, Column]:
    side = ("lat0", "lat1", "lon0", "lon1")
    return geo.box_bounds_km({c: F.col("a" + c) for c in side}, {c: F.col("b" + c) for c in side}, SLACK)


def core_locations(locs: DataFrame, cfg: Config, side: float) -> DataFrame:
    """Distinct locations with their cell and a core flag; ``w`` counts the outlets at a location."""
    eps, need = cfg.dbscan_eps_km, cfg.dbscan_min_points
    at = _cells(locs, side)
    filled = at.groupBy("cy", "cx").agg(F.sum("w").alias("_cw"))
    at = at.join(filled, ["cy", "cx"]).withColumn("_dense", F.col("_cw") >= need).drop("_cw")
    thin = _spread(at.where("not _dense").select("lat", "lon", "cy", "cx"), _offsets(cfg), "ny", "nx")
    thin = thin.select(F.col("lat").alias("alat"), F.col("lon").alias("alon"), "ny", "nx")
    other = at.select(F.col("cy").alias("ny"), F.col("cx").alias("nx"), F.col("lat").alias("blat"), F.col("lon").alias("blon"), "w")
    reached = (thin.join(other, ["ny", "nx"]).where(_km("a", "b") <= eps)
               .groupBy(F.col("alat").alias("lat"), F.col("alon").alias("lon")).agg(F.sum("w").alias("_nw")))
    return (at.join(reached, ["lat", "lon"], "left")
            .withColumn("core", F.col("_dense") | F.coalesce(F.col("_nw") >= need, F.lit(False))).drop("_nw"))


def cell_edges(core: DataFrame, cfg: Config, side: float) -> DataFrame:
    """Pairs of cells (y, x, y2, x2) that hold core points within eps of each other."""
    eps = cfg.dbscan_eps_km
    half = [o for o in _offsets(cfg) if o > (0, 0)]
    sub = core.withColumns({"sy": geo.cell(F.col("lat"), side / SUB), "sx": geo.cell(F.col("lon"), side / SUB)})
    near, far = _near_far()
    pair = ["acy", "acx", "bcy", "bcx"]
    a = _boxes(core, "a", "cy", "cx").withColumns({"cy": F.col("acy"), "cx": F.col("acx")})
    cells = _spread(a, half, "bcy", "bcx").join(_boxes(core, "b", "cy", "cx"), ["bcy", "bcx"])
    cells = cells.withColumns({"near": near, "far": far}).where(F.col("near") <= eps).select(*pair, "far")
    sure = cells.where(F.col("far") <= eps).select(*pair)
    # open cell pairs: compare their sub-tiles, at most SUB * SUB of each
    tiles = (cells.where(F.col("far") > eps).select(*pair)
             .join(_boxes(sub, "a", "cy", "cx", "sy", "sx"), ["acy", "acx"])
             .join(_boxes(sub, "b", "cy", "cx", "sy", "sx"), ["bcy", "bcx"])
             .withColumns({"near": near, "far": far}).where(F.col("near") <= eps)
             .select(*pair, "asy", "asx", "bsy", "bsx", "far"))
    by_tile = tiles.where(F.col("far") <= eps).select(*pair).distinct()
    left = tiles.join(by_tile, pair, "left_anti")
    pa = sub.select(*_prefixed(sub, "a", "cy", "cx", "sy", "sx", "lat", "lon"))
    pb = sub.select(*_prefixed(sub, "b", "cy", "cx", "sy", "sx", "lat", "lon"))
    by_point = (left.join(pa, ["acy", "acx", "asy", "asx"]).join(pb, ["bcy", "bcx", "bsy", "bsx"])
                .where(_km("a", "b") <= eps).select(*pair).distinct())
    return sure.unionByName(by_tile).unionByName(by_point)


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, label) with the smallest node (a long) of each component as the label.

    Minimum-label hooking on nodes and on their labels plus pointer jumping; every round is written to
    the checkpoint folder, so lost executors cost one round. Groups are only ever reduced by ``min``.
    """
    both = cut(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    lab = cut(nodes.select("node", F.col("node").alias("label")))
    while True:
        lu = lab.select(F.col("node").alias("u"), F.col("label").alias("lu"))
        lv = lab.select(F.col("node").alias("v"), F.col("label").alias("lv"))
        seen = both.join(lu, "u").join(lv, "v").where("lu < lv")
        offers = seen.select(F.explode(F.array("v", "lv")).alias("node"), F.col("lu").alias("label"), F.lit(None).cast("long").alias("was"))
        hooked = (lab.select("node", "label", F.col("label").alias("was")).unionByName(offers)
                  .groupBy("node").agg(F.min("label").alias("label"), F.max("was").alias("was")))
        jump = hooked.select(F.col("node").alias("label"), F.col("label").alias("_to"))
        nxt = cut(hooked.join(jump, "label").select("node", F.least("label", "_to").alias("label"), "was"))
        lab = nxt.select("node", "label")
        if nxt.where("label <> was").isEmpty():
            return lab


def dbscan(points: DataFrame, cfg: Config) -> DataFrame:
    """(Outlet_ID, micro_market_id, is_spatial_outlier); labels number components by their smallest core outlet.

    A border point takes the lowest label among its core neighbours; noise is -1.
    """
    from retailpot.operators.spatial import locations

    side = cfg.dbscan_eps_km / math.sqrt(2) / geo.KM_PER_DEGREE * 0.999
    at = cut(core_locations(locations(points, "Latitude", "Longitude"), cfg, side))
    core = at.where("core")
    node = lambda y, x: F.col(y) * F.lit(1 << 32) + F.col(x)  # noqa: E731  one long per cell, |x| < 2^31
    cells = core.select("cy", "cx", node("cy", "cx").alias("node")).distinct()
    edges = cell_edges(core, cfg, side).select(node("acy", "acx").alias("u"), node("bcy", "bcx").alias("v"))
    comp = connected_components(cells, edges).join(cells, "node")
    ids = points.select("Outlet_ID", F.col("Latitude").alias("lat"), F.col("Longitude").alias("lon"))
    placed = ids.join(core, ["lat", "lon"]).join(comp, ["cy", "cx"])
    first = placed.groupBy("label").agg(F.min("Outlet_ID").alias("first_id"))
    numbered = global_row_number(first, [F.col("first_id")], "_r").select("label", (F.col("_r") - 1).cast("int").alias("m"))
    cell_label = comp.join(numbered, "label").select("cy", "cx", "m")
    in_core = core.join(cell_label, ["cy", "cx"]).select("lat", "lon", "cy", "cx", "m")
    # non-core points lie in thin cells only, so each core point meets few of them
    rim = _spread(at.where("not core").select("lat", "lon", "cy", "cx"), _offsets(cfg), "ny", "nx").select(
        F.col("lat").alias("alat"), F.col("lon").alias("alon"), "ny", "nx")
    cores = in_core.select(F.col("cy").alias("ny"), F.col("cx").alias("nx"), F.col("lat").alias("blat"), F.col("lon").alias("blon"), "m")
    border = (rim.join(cores, ["ny", "nx"]).where(_km("a", "b") <= cfg.dbscan_eps_km)
              .groupBy(F.col("alat").alias("lat"), F.col("alon").alias("lon")).agg(F.min("m").alias("m")))
    labels = in_core.select("lat", "lon", "m").unionByName(border)
    m = F.coalesce(F.col("m"), F.lit(-1))
    return ids.join(labels, ["lat", "lon"], "left").select("Outlet_ID", m.alias("micro_market_id"), (m == -1).alias("is_spatial_outlier"))


def cluster_stats(clusters: DataFrame, sales: DataFrame) -> DataFrame:
    """Size, mean and P90 volume of each cluster on its outlets; 0 for noise."""
    v = clusters.join(sales.select("Outlet_ID", "hist_p90_monthly"), "Outlet_ID", "left").withColumn(
        "_v", F.coalesce("hist_p90_monthly", F.lit(0.0)))
    inside = v.where("micro_market_id >= 0")
    stats = inside.groupBy("micro_market_id").agg(F.count("*").cast("int").alias("n"), F.avg("_v").alias("mean"))
    p90 = grouped_quantiles(inside, ["micro_market_id"], "_v", [0.9])
    s = stats.join(p90, "micro_market_id").select("micro_market_id", "n", "mean", F.col("q")[0].alias("p90"))
    return clusters.join(s, "micro_market_id", "left").select(
        "Outlet_ID", "micro_market_id", "is_spatial_outlier", F.coalesce("n", F.lit(0)).alias("cluster_outlet_count"),
        F.coalesce("mean", F.lit(0.0)).alias("cluster_mean_volume"), F.coalesce("p90", F.lit(0.0)).alias("cluster_p90_volume"))


def spatial_cluster_features(points: DataFrame, outlets: DataFrame, sales: DataFrame, cfg: Config) -> DataFrame:
    from retailpot.operators.spatial import append_missing_points

    stats = cluster_stats(dbscan(points, cfg), sales)
    return append_missing_points(stats, outlets, {
        "micro_market_id": -1, "is_spatial_outlier": True, "cluster_outlet_count": 0,
        "cluster_mean_volume": 0.0, "cluster_p90_volume": 0.0})
