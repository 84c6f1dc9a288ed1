"""Distance joins and the features built on them.

Points are first collapsed to distinct locations with weights, so copies of one location cost nothing. Sums over a radius are taken block by
block (``blocks``) and no pair becomes a row. Where ordered pairs are the result, each range of rows meets its points in one task
(``neighbours``). Where pairs of locations are joined, locations fall into grid cells a little wider than the radius,
and each cell is the root of a quadtree, the deeper the more locations it holds. A join goes down both trees at once: pairs of neighbouring
cells first, and of each pair only what its bounding boxes leave within the radius is split into the pairs of its children. Leaves are
compared point by point, with crowded ones spread over several tasks by a salt.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailpot.config import FLAT_POI_RULES, FOOTFALL_WEIGHTS, GRAVITY_POI_RULES, GRAVITY_WEIGHTS, Config
from retailpot.functions import geo
from retailpot.functions.numeric import half_even, with_min_max
from retailpot.operators import blocks, neighbours
from retailpot.operators.quantiles import scalar_quantiles
from retailpot.session import cut, kept

LOCATIONS_PER_TILE = 32
MAX_DEPTH = 8  # levels of a cell's tree below the cell itself: 256 tiles per cell side
LOCATIONS_PER_SALT = 2_000
# relative slack that box bounds on the sphere need in order to hold for a metric
SLACK = {"haversine": 1e-9, "geodesic": 0.007}
BOX = ("lat0", "lat1", "lon0", "lon1")


def cell_sides(radius_km: float, cfg: Config) -> tuple[float, float]:
    """Cell height and width in degrees, at least ``radius_km`` anywhere within the bounds."""
    b = cfg.bounds
    # a point of the other side may lie up to one radius beyond the bounds
    far = max(abs(b.lat_min), abs(b.lat_max)) + 2 * radius_km / geo.KM_PER_DEGREE
    side = 1.01 * radius_km / geo.KM_PER_DEGREE
    return side, side / math.cos(math.radians(far))


def locations(df: DataFrame, lat: str, lon: str, by: Sequence[str] = (), weights: Mapping[str, Column] | None = None) -> DataFrame:
    """Distinct (lat, lon[, by]) with one summed weight column per name; by default ``w`` = number of rows."""
    sums = {"w": F.count("*")} if weights is None else {n: F.sum(x) for n, x in weights.items()}
    return (df.withColumns({"lat": F.col(lat).cast("double"), "lon": F.col(lon).cast("double")})
            .where("lat is not null and lon is not null").groupBy("lat", "lon", *by).agg(*[x.alias(n) for n, x in sums.items()]))


def _tiled(df: DataFrame, radius_km: float, cfg: Config) -> DataFrame:
    """Adds the cell (cy, cx), the depth of its tree and the leaf tile within it (ty, tx); crowded cells get deeper trees."""
    h, w = cell_sides(radius_km, cfg)
    at = df.withColumns({"cy": geo.cell(F.col("lat"), h), "cx": geo.cell(F.col("lon"), w)})
    depth = F.greatest(F.lit(0), F.least(F.ceil(F.log2(F.count("*") / F.lit(float(LOCATIONS_PER_TILE))) / 2), F.lit(MAX_DEPTH)))
    sizes = at.groupBy("cy", "cx").agg(depth.cast("int").alias("depth"))
    part = lambda c, side, cell: F.floor((F.col(c) / F.lit(side) - F.col(cell)) * F.expr("shiftleft(1, depth)")).cast("int")
    return at.join(sizes, ["cy", "cx"]).withColumns({"ty": part("lat", h, "cy"), "tx": part("lon", w, "cx")})


def _tiles(locs: DataFrame, by: Sequence[str], side: str, weights: Sequence[str]) -> DataFrame:
    """Bounding box, number of locations and summed weights per leaf tile; columns prefixed by ``side``."""
    box = [F.min("lat").alias(f"{side}lat0"), F.max("lat").alias(f"{side}lat1"),
           F.min("lon").alias(f"{side}lon0"), F.max("lon").alias(f"{side}lon1")]
    return locs.groupBy(*[F.col(x).alias(side + x) for x in ("cy", "cx", "ty", "tx", "depth")], *by).agg(
        *box, F.count("*").alias(f"{side}n"), *[F.sum(w).alias(f"{side}_{w}") for w in weights])


A_TILE, B_TILE = ["acy", "acx", "aty", "atx"], ["bcy", "bcx", "bty", "btx"]
A_NODE, B_NODE = [*A_TILE, "alevel"], [*B_TILE, "blevel"]


def _levels(df: DataFrame, side: str) -> DataFrame:
    """``df`` once per level of its cell's tree: the level and the node's place on it in the columns of the tile."""
    up = lambda c: F.expr(f"shiftright({side}{c}, {side}depth - {side}level)")
    return df.withColumn(f"{side}level", F.explode(F.sequence(F.lit(0), F.col(f"{side}depth")))).withColumns({f"{side}ty": up("ty"), f"{side}tx": up("tx")})


def _nodes(locs: DataFrame, by: Sequence[str], side: str, weights: Sequence[str]) -> DataFrame:
    """All nodes of the trees: box, number of locations and weights, summed up from the leaf tiles."""
    keys = [side + x for x in ("cy", "cx", "ty", "tx", "level", "depth")]
    box = [F.min(f"{side}{c}").alias(f"{side}{c}") if c.endswith("0") else F.max(f"{side}{c}").alias(f"{side}{c}") for c in BOX]
    return _levels(_tiles(locs, by, side, weights), side).groupBy(*keys, *by).agg(*box, F.sum(f"{side}n").alias(f"{side}n"), *[F.sum(f"{side}_{w}").alias(f"{side}_{w}") for w in weights])


def _children(pairs: DataFrame, nodes: DataFrame, side: str, by: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``pairs`` with the node of one side replaced by its children, or by itself where it is a leaf."""
    key = [f"{side}{x}" for x in ("cy", "cx", "ty", "tx", "level")]
    leaf = F.col(f"{side}level") >= F.col(f"{side}depth")
    kid = lambda dy, dx: F.struct((F.col(f"{side}ty") * 2 + dy).alias("ty"), (F.col(f"{side}tx") * 2 + dx).alias("tx"), (F.col(f"{side}level") + 1).alias("level"))
    own = F.struct(F.col(f"{side}ty").alias("ty"), F.col(f"{side}tx").alias("tx"), F.col(f"{side}level").alias("level"))
    down = pairs.select(*keep, f"{side}cy", f"{side}cx", *by, F.explode(F.when(leaf, F.array(own)).otherwise(F.array(*[kid(y, x) for y in (0, 1) for x in (0, 1)]))).alias("_k"))
    down = down.select(*keep, f"{side}cy", f"{side}cx", *by, *[F.col(f"_k.{c}").alias(f"{side}{c}") for c in ("ty", "tx", "level")])
    return down.join(nodes, [*key, *by])


def node_pairs(left: DataFrame, right: DataFrame, radius_km: float, by: Sequence[str], weights: Sequence[str], slack: float,
               settled: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Pairs of nodes that may hold points within the radius, with box bounds (near, far): (settled ones, open pairs of leaves).

    ``settled`` tells from the bounds that a pair need not be split; without it every pair goes down to the leaves.
    """
    a, b = _nodes(left, [], "a", []), _nodes(right, by, "b", weights)
    deepest = max(left.agg(F.max("depth")).first()[0] or 0, right.agg(F.max("depth")).first()[0] or 0)
    around = F.explode(F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]))
    roots = (b.where("blevel = 0").withColumn("_o", around)
             .withColumns({"acy": F.col("bcy") + F.col("_o.dy"), "acx": F.col("bcx") + F.col("_o.dx")}).drop("_o"))
    near, far = geo.box_bounds_km({x: F.col(f"a{x}") for x in BOX}, {x: F.col(f"b{x}") for x in BOX}, slack)
    columns = [*A_NODE, "adepth", *B_NODE, "bdepth", *by, "an", *[f"b_{w}" for w in weights], "near", "far"]

    def bounded(pairs: DataFrame) -> DataFrame:
        return pairs.withColumn("near", near).where(F.col("near") <= radius_km).withColumn("far", far).select(*columns)

    leaves = (F.col("alevel") >= F.col("adepth")) & (F.col("blevel") >= F.col("bdepth"))
    open_, done, low = bounded(a.where("alevel = 0").join(roots, ["acy", "acx"])), [], []
    for level in range(deepest + 1):
        if settled is not None:
            done.append(open_.where(settled))
            open_ = open_.where(~settled)
        low.append(open_.where(leaves))
        if level < deepest:
            a_kids = _children(open_.where(~leaves), a, "a", [], [*B_NODE, "bdepth", *by])
            open_ = bounded(_children(a_kids, b, "b", by, [c for c in a_kids.columns if c not in (*B_NODE, "bdepth", *by)]))
    return (reduce(DataFrame.unionByName, done) if done else open_.limit(0)), reduce(DataFrame.unionByName, low)


def point_pairs(left: DataFrame, right: DataFrame, pairs: DataFrame, metric: str, by: Sequence[str],
                weights: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Distances ``km`` between the locations of the given tile pairs; crowded left tiles are spread by a salt."""
    n_salt = lambda n: F.ceil(n / F.lit(LOCATIONS_PER_SALT)).cast("int")
    beta = (lambda df: df.withColumn("beta", geo.reduced_latitude(F.col("lat")))) if metric == "geodesic" else (lambda df: df.withColumn("beta", F.cos(F.radians("lat"))))
    crowd = _tiles(left, [], "a", []).select(*A_TILE, n_salt(F.col("an")).alias("_m"))
    a = beta(left).select(*[F.col(x[1:]).alias(x) for x in A_TILE], F.col("lat").alias("a_lat"), F.col("lon").alias("a_lon"), F.col("beta").alias("a_beta"))
    a = a.join(crowd, A_TILE).withColumn("_salt", F.pmod(F.xxhash64("a_lat", "a_lon"), F.col("_m")).cast("int")).drop("_m")
    b = beta(right).select(*[F.col(x[1:]).alias(x) for x in B_TILE], *by, F.col("lat").alias("b_lat"), F.col("lon").alias("b_lon"),
                           F.col("beta").alias("b_beta"), *[F.col(w).alias(f"b_{w}") for w in weights])
    p = pairs.withColumn("_salt", F.explode(F.sequence(F.lit(0), n_salt(F.col("an")) - 1))).select(*A_TILE, *B_TILE, *by, "_salt", *carry)
    out = p.join(b, [*B_TILE, *by]).join(a, [*A_TILE, "_salt"])
    if metric == "geodesic":
        out = geo.with_geodesic_m(out, "m", "a_beta", "a_lon", "b_beta", "b_lon").withColumn("km", F.col("m") / F.lit(1000.0))
    else:  # the cosines of the latitudes are at hand
        s_lat, s_lon = F.sin(F.radians(F.col("b_lat") - F.col("a_lat")) / 2), F.sin(F.radians(F.col("b_lon") - F.col("a_lon")) / 2)
        h = s_lat * s_lat + F.col("a_beta") * F.col("b_beta") * s_lon * s_lon
        out = out.withColumn("km", F.lit(2 * geo.EARTH_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0)))))
    return out.select("a_lat", "a_lon", *by, "b_lat", "b_lon", *[f"b_{w}" for w in weights], *carry, "km")


def radius_counts(left: DataFrame, right: DataFrame, radii_km: Sequence[float], cfg: Config,
                  weights: Sequence[str] = ("w",), metric: str = "haversine") -> DataFrame:
    """Right weights within each radius of every left location: (lat, lon, ``{weight}_{radius number}``...).

    Both inputs are ``locations`` frames. Locations without any neighbour are absent.
    """
    slots = [f"{w}_{i}" for w in weights for i in range(len(radii_km))]
    return blocks.block_sums(left, right, cell_sides(max(radii_km), cfg), weights, slots, blocks.whole_numbers(right, weights),
                             lambda block: blocks.counts(block, radii_km, metric, SLACK[metric]))


def within_radius(left: DataFrame, right: DataFrame, radius_km: float, cfg: Config, by: Sequence[str] = (),
                  weights: Sequence[str] = ("w",), metric: str = "haversine") -> DataFrame:
    """All location pairs within the radius with their distance ``km`` and right weights ``b_{weight}``."""
    a, b = _tiled(left, radius_km, cfg), _tiled(right, radius_km, cfg)
    _, leaves = node_pairs(a, b, radius_km, by, weights, SLACK[metric])
    return point_pairs(a, b, leaves, metric, by, weights).where(F.col("km") <= radius_km)


# --- points of interest ----------------------------------------------------------------------

def classify_poi(tags: Column, rules: Mapping[str, Sequence[tuple[str, str]]]) -> Column:
    """Category of the first matching (tag, value) rule, else null."""
    out = None
    for category, pairs in rules.items():
        hit = None
        for k, v in pairs:
            t = F.coalesce(F.try_element_at(tags, F.lit(k)) == v, F.lit(False))
            hit = t if hit is None else hit | t
        out = F.when(hit, F.lit(category)) if out is None else out.when(hit, F.lit(category))
    return out


def classified(pois: DataFrame, rules) -> DataFrame:
    """(lat, lon, category) of the POIs with a category, stored: each use of the column would look all rules up again, for every reader."""
    return kept(pois.select("lat", "lon", classify_poi(F.col("tags"), rules).alias("category"))).where("category is not null")


def poi_dedup(pois: DataFrame) -> DataFrame:
    """Distinct classified POIs over all tiles."""
    return classified(pois, GRAVITY_POI_RULES).dropDuplicates(["lat", "lon", "category"])


def _per_category(cats: Sequence[str]) -> dict[str, Column]:
    return {k: (F.col("category") == k).cast("long") for k in cats}


def poi_radius_counts(points: DataFrame, outlets: DataFrame, pois: DataFrame, cfg: Config, served: DataFrame | None = None) -> DataFrame:
    """Count columns ``{category}_{radius}m`` per outlet; outlets without coordinates get 0 and a false flag.

    ``served`` (outlet_id) are the outlets of tiles that were read whole: the others, of failed tiles, get 0 and a false flag too.
    """
    if served is not None:
        points = points.join(served.select(F.col("outlet_id").alias("Outlet_ID")), "Outlet_ID", "left_semi")
    cats, radii = list(FLAT_POI_RULES), cfg.radii_m
    left = locations(points, "Latitude", "Longitude")
    right = locations(classified(pois, FLAT_POI_RULES), "lat", "lon", weights=_per_category(cats))
    counts = radius_counts(left, right, [r / 1000.0 for r in radii], cfg, cats, "geodesic")
    names = [(f"{cat}_{r}m", f"{cat}_{i}") for cat in cats for i, r in enumerate(radii)]
    wide = counts.select("lat", "lon", *[F.col(x).alias(n) for n, x in names])
    at = points.select("Outlet_ID", F.col("Latitude").alias("lat"), F.col("Longitude").alias("lon"), F.lit(True).alias("_has"))
    counted = at.join(wide, ["lat", "lon"], "left").drop("lat", "lon")
    out = outlets.select("Outlet_ID").join(counted, "Outlet_ID", "left")
    return out.select("Outlet_ID", *[F.coalesce(n, F.lit(0)).cast("int").alias(n) for n, _ in names],
                      F.coalesce("_has", F.lit(False)).alias("poi_data_available"))


def footfall_score(counts: DataFrame) -> DataFrame:
    """Weighted 500 m counts scaled to 0..100 over all outlets."""
    raw = sum((F.col(f"{cat}_500m") * F.lit(w) for cat, w in FOOTFALL_WEIGHTS.items()), F.lit(0.0))
    return with_min_max(counts.withColumn("_raw", raw), "footfall_score", "_raw").drop("_raw")


def poi_features(points: DataFrame, outlets: DataFrame, pois: DataFrame, cfg: Config, served: DataFrame | None = None) -> DataFrame:
    # the counts feed both the range and the rows of the score: compute them once
    scored = footfall_score(cut(poi_radius_counts(points, outlets, pois, cfg, served)))
    counts = [c for c in scored.columns if c.endswith("m") and c not in ("poi_data_available",)]
    return scored.select("Outlet_ID", *counts, "footfall_score", "poi_data_available")


def gravity_scores(points: DataFrame, pois: DataFrame, cfg: Config) -> DataFrame:
    """Inverse-square scores per category and the weighted raw sum, for outlets with coordinates."""
    cats = list(GRAVITY_POI_RULES)
    left = locations(points, "Latitude", "Longitude")
    right = locations(poi_dedup(pois), "lat", "lon", weights=_per_category(cats))
    sums = blocks.block_sums(left, right, cell_sides(cfg.gravity_radius_km, cfg), cats, [f"_{k}" for k in cats], False,
                             lambda block: blocks.pulls(block, cfg.gravity_radius_km, cfg.decay_epsilon_km))
    at = points.select("Outlet_ID", F.col("Latitude").alias("lat"), F.col("Longitude").alias("lon")).join(sums, ["lat", "lon"], "left")
    score = {c: F.coalesce(F.col(f"_{c}"), F.lit(0.0)) for c in cats}
    raw = sum((score[c] * F.lit(GRAVITY_WEIGHTS[c]) for c in cats), F.lit(0.0))
    return at.select("Outlet_ID", *[half_even(score[c], 4).alias(f"{c}_gravity_score") for c in cats],
                     half_even(raw, 4).alias("raw_composite_gravity"))


def append_missing_points(features: DataFrame, outlets: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Outlets absent from a spatial table get the default row."""
    kinds = {f.name: f.dataType for f in features.schema.fields}
    missing = outlets.select("Outlet_ID").join(features.select("Outlet_ID"), "Outlet_ID", "left_anti")
    return features.unionByName(missing.select("Outlet_ID", *[F.lit(v).cast(kinds[k]).alias(k) for k, v in defaults.items()]))


def gravity_features(points: DataFrame, outlets: DataFrame, pois: DataFrame, cfg: Config) -> DataFrame:
    scored = with_min_max(cut(gravity_scores(points, pois, cfg)), "composite_gravity_score", "raw_composite_gravity")
    scored = scored.withColumn("gravity_data_available", F.lit(True))
    defaults = {c: 0.0 for c in scored.columns if c not in ("Outlet_ID", "gravity_data_available")}
    return append_missing_points(scored, outlets, {**defaults, "gravity_data_available": False})


# --- competitors -----------------------------------------------------------------------------

def radius_label(metres: int) -> str:
    return f"{metres}m" if metres < 1000 else f"{metres // 1000}km"


def competitor_counts(points: DataFrame, cfg: Config) -> DataFrame:
    """Other outlets within each radius; only the row itself is left out."""
    locs = locations(points, "Latitude", "Longitude")
    c = radius_counts(locs, locs, [r / 1000.0 for r in cfg.radii_m], cfg)
    at = points.select("Outlet_ID", F.col("Latitude").alias("lat"), F.col("Longitude").alias("lon"))
    return at.join(c, ["lat", "lon"]).select(
        "Outlet_ID", *[(F.col(f"w_{i}") - 1).cast("int").alias(f"competitors_{radius_label(r)}") for i, r in enumerate(cfg.radii_m)])


def density_score(counts: DataFrame) -> DataFrame:
    return with_min_max(counts, "competition_density_score", "competitors_1km")


def saturation_class(counts: DataFrame, low: float = 0.25, high: float = 0.75) -> DataFrame:
    """At most the lower quartile: isolated; else at least the upper quartile: dense; else moderate."""
    qs = scalar_quantiles(counts, "competitors_1km", [low, high])
    c = F.col("competitors_1km")
    return counts.withColumn("market_saturation_class", F.when(c <= qs[0], "isolated").when(c >= qs[1], "dense").otherwise("moderate"))


def catchment_features(points: DataFrame, outlets: DataFrame, cfg: Config) -> DataFrame:
    scored = saturation_class(density_score(cut(competitor_counts(points, cfg))))
    counts = {f"competitors_{radius_label(r)}": 0 for r in cfg.radii_m}
    return append_missing_points(scored, outlets, {**counts, "competition_density_score": 0.0, "market_saturation_class": "isolated"})


# --- other -----------------------------------------------------------------------------------

def kmeans_tiles(points: DataFrame, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """(outlet-to-tile rows, one buffered bounding box per tile) from k-means on coordinates."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    data = VectorAssembler(inputCols=["Latitude", "Longitude"], outputCol="features").transform(points)
    model = KMeans(k=cfg.n_tiles, seed=cfg.seed, featuresCol="features", predictionCol="cluster_id").fit(data)
    members = model.transform(data).select("Outlet_ID", "cluster_id", "Latitude", "Longitude")
    b = F.lit(cfg.tile_buffer_deg)
    boxes = members.groupBy("cluster_id").agg(
        (F.min("Latitude") - b).alias("lat_min"), (F.max("Latitude") + b).alias("lat_max"),
        (F.min("Longitude") - b).alias("lon_min"), (F.max("Longitude") + b).alias("lon_max"), F.count("*").alias("n_outlets"))
    return members, boxes


def ring_edges(rings: DataFrame) -> DataFrame:
    """Edges of rings: rows (polygon[, ring], seq, lat, lon) to (polygon, lat0, lon0, lat1, lon1), closing each ring.

    Further rings of a polygon are holes; a single one needs no ``ring`` column.
    """
    by = ["polygon", "ring"] if "ring" in rings.columns else ["polygon"]
    ring = rings.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("seq", "lat", "lon"))).alias("v"))
    nxt = F.concat(F.slice("v", 2, F.size("v") - 1), F.slice("v", 1, 1))
    return ring.select("polygon", F.explode(F.arrays_zip(F.col("v").alias("a"), nxt.alias("b"))).alias("e")).select(
        "polygon", F.col("e.a.lat").alias("lat0"), F.col("e.a.lon").alias("lon0"), F.col("e.b.lat").alias("lat1"), F.col("e.b.lon").alias("lon1"))


EDGE_SLACK = 1e-9  # degrees by which a cell counts as touched


def edge_cells(edges: DataFrame, side: float) -> DataFrame:
    """Cells (band, column) that an edge passes through, row by row of the grid."""
    at = lambda c: F.floor(c / F.lit(side))
    low, high = F.least("lat0", "lat1"), F.greatest("lat0", "lat1")
    e = edges.withColumn("band", F.explode(F.sequence(at(low - EDGE_SLACK), at(high + EDGE_SLACK))))
    rise = F.col("lat1") - F.col("lat0")
    slope = (F.col("lon1") - F.col("lon0")) / F.when(rise != 0, rise)
    cross = lambda y: F.coalesce(F.col("lon0") + slope * (F.greatest(low, F.least(high, y)) - F.col("lat0")), F.col("lon0"))
    bottom, top = F.col("band") * side - EDGE_SLACK, (F.col("band") + 1) * side + EDGE_SLACK
    a, z = cross(bottom), F.when(rise == 0, F.col("lon1")).otherwise(cross(top))
    cells = F.sequence(at(F.least(a, z) - EDGE_SLACK), at(F.greatest(a, z) + EDGE_SLACK))
    return e.select("band", F.explode(cells).alias("column")).distinct()


def inside_rings(locs: DataFrame, edges: DataFrame, band_deg: float) -> DataFrame:
    """Those of ``locs`` (lat, lon) that lie in some polygon: a ray to the east crosses its rings an odd number of times.

    Edges are cut into latitude bands, so a location meets only the edges that its latitude crosses. In a hole the count is even.
    """
    band = lambda c: F.floor(c / F.lit(band_deg))
    e = edges.withColumn("band", F.explode(F.sequence(band(F.least("lat0", "lat1")), band(F.greatest("lat0", "lat1")))))
    y, x = F.col("lat"), F.col("lon")
    crosses = ((F.col("lat0") > y) != (F.col("lat1") > y)) & (
        x < (F.col("lon1") - F.col("lon0")) * (y - F.col("lat0")) / (F.col("lat1") - F.col("lat0")) + F.col("lon0"))
    odd = (locs.select("lat", "lon").withColumn("band", band(y)).join(e, "band").where(crosses)
           .groupBy("lat", "lon", "polygon").agg(F.count("*").alias("n")).where("n % 2 = 1"))
    return odd.select("lat", "lon").distinct()


def point_in_polygon(points: DataFrame, edges: DataFrame, band_deg: float = 0.25) -> DataFrame:
    """``in_sea`` per outlet: true outside every polygon and inside holes.

    The plane is a grid. No edge passes through most cells, so all of such a cell lies on one side: its centre is tested once and the answer
    stored, and its outlets look it up. Only locations in cells with an edge meet edges. An outlet without coordinates is in no polygon.
    """
    cell = lambda c: F.floor(F.col(c) / F.lit(band_deg))
    locs = locations(points, "Latitude", "Longitude").select("lat", "lon", cell("lat").alias("band"), cell("lon").alias("column"))
    border = edge_cells(edges, band_deg)
    near = inside_rings(locs.join(border, ["band", "column"], "left_semi"), edges, band_deg)
    inner = locs.join(border, ["band", "column"], "left_anti")
    centre = lambda c: (F.col(c) + F.lit(0.5)) * F.lit(band_deg)
    cells = inner.select("band", "column").distinct().select("band", "column", centre("band").alias("lat"), centre("column").alias("lon"))
    parity = cells.join(inside_rings(cells, edges, band_deg), ["lat", "lon"], "left_semi").select("band", "column")
    land = near.unionByName(inner.join(parity, ["band", "column"], "left_semi").select("lat", "lon")).withColumn("_land", F.lit(True))
    at = points.select("Outlet_ID", F.col("Latitude").cast("double").alias("lat"), F.col("Longitude").cast("double").alias("lon"))
    return at.join(land, ["lat", "lon"], "left").select("Outlet_ID", F.col("_land").isNull().alias("in_sea"))


def pois_near_outlet(points: DataFrame, links: DataFrame, pois: DataFrame, cfg: Config, radius_km: float = 2.0, columns: Sequence[str] | None = None) -> DataFrame:
    """POIs of an outlet's own tile within the radius, distance in whole metres, by outlet and nearest first.

    ``points`` is one outlet for a page and any number for a batch; ``columns`` are those of ``pois`` to return, all by default.
    """
    linked = points.join(links.select(F.col("outlet_id").alias("Outlet_ID"), "cluster_id"), "Outlet_ID")
    left = linked.select("Outlet_ID", "cluster_id", F.col("Latitude").alias("lat"), F.col("Longitude").alias("lon"))
    return neighbours.near_rows(left, "Outlet_ID", pois, "cluster_id", columns or pois.columns, radius_km, cell_sides(radius_km, cfg))
