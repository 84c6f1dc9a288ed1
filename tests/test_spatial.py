import json
import math
from dataclasses import replace

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from retailpot.config import Config
from retailpot.functions import geo
from retailpot.operators import clusters, neighbours, spatial
from retailpot.sources import geojson

CFG = Config()


def km(a, b):
    la, lb = math.radians(a[0]), math.radians(b[0])
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(h))


def cloud(seed, n, spread):
    """A dense knot, copies of one location, a loose ring and loners."""
    rng = np.random.default_rng(seed)
    knot = rng.normal([7.0, 80.0], spread / 20, (n, 2))
    ring = rng.uniform([7.0 - spread, 80.0 - spread], [7.0 + spread, 80.0 + spread], (n, 2))
    return [tuple(p) for p in np.vstack([knot, ring, np.repeat([[7.01, 80.01]], n // 3, 0), [[9.89, 81.89]], [[5.91, 79.51]]])]


@pytest.fixture(scope="module")
def points(spark):
    pts = cloud(3, 90, 0.03)
    return pts, spark.createDataFrame([(f"p{i:04d}", float(a), float(b)) for i, (a, b) in enumerate(pts)], "Outlet_ID string, Latitude double, Longitude double")


@pytest.mark.parametrize("per_tile,per_salt", [(32, 2000), (2, 3)])
def test_competitors_equal_brute_force(points, monkeypatch, per_tile, per_salt):
    monkeypatch.setattr(spatial, "LOCATIONS_PER_TILE", per_tile)
    monkeypatch.setattr(spatial, "LOCATIONS_PER_SALT", per_salt)
    pts, df = points
    want = [(f"p{i:04d}", *[sum(km(p, q) <= r for j, q in enumerate(pts) if j != i) for r in (0.5, 1, 2)]) for i, p in enumerate(pts)]
    assert rows(spatial.competitor_counts(df, CFG)) == sorted(want)


def test_poi_counts_and_gravity_equal_brute_force(spark, points, monkeypatch):
    monkeypatch.setattr(spatial, "LOCATIONS_PER_TILE", 4)
    pts, df = points
    kinds = [("amenity", "school"), ("amenity", "pharmacy"), ("shop", "supermarket"), ("leisure", "park")]
    where = cloud(8, 40, 0.03)
    data = [(float(a), float(b), *kinds[i % 4]) for i, (a, b) in enumerate(where)]
    pois = spark.createDataFrame(data, "lat double, lon double, k string, v string").select("lat", "lon", F.create_map("k", "v").alias("tags"))
    outlets = df.select("Outlet_ID").unionByName(spark.createDataFrame([("zz",)], "Outlet_ID string"))
    got = {r.Outlet_ID: r for r in spatial.poi_features(df, outlets, pois, CFG).collect()}
    grav = {r.Outlet_ID: r for r in spatial.gravity_features(df, outlets, pois, CFG).collect()}
    assert not got["zz"].poi_data_available and got["zz"].schools_2000m == 0 and not grav["zz"].gravity_data_available
    part = {r.Outlet_ID: r for r in spatial.poi_features(df, outlets, pois, CFG, df.where("Outlet_ID < 'p0020'").select(F.col("Outlet_ID").alias("outlet_id"))).collect()}
    for oid, r in part.items():
        assert r.poi_data_available == (oid < "p0020") and (r.schools_2000m == (got[oid].schools_2000m if oid < "p0020" else 0))
    seen = {(a, b, "pharmacy" if v == "pharmacy" else v) for a, b, _, v in data}
    for i, p in enumerate(pts):
        r = got[f"p{i:04d}"]
        # distances on the ellipsoid differ by less than 0.7 %
        lo, hi = (sum(v == "school" and km(p, (a, b)) <= 1.0 * f for a, b, _, v in data) for f in (0.993, 1.007))
        assert lo <= r.schools_1000m <= hi and r.hospitals_2000m == 0
        pull = sum(1 / (km(p, (a, b)) + 0.05) ** 2 for a, b, v in seen if v == "pharmacy" and km(p, (a, b)) <= 2)
        assert grav[f"p{i:04d}"].hospital_gravity_score == pytest.approx(pull, abs=1e-3)
    assert max(r.footfall_score for r in got.values()) == 100.0


def test_geodesic_against_published_length(spark):
    # one minute of latitude at 45 degrees on WGS-84 is 1852.2 m, one of longitude 1314.2 m
    df = spark.createDataFrame([(45.0 - 1 / 120, 80.0, 45.0 + 1 / 120, 80.0), (45.0, 80.0, 45.0, 80.0 + 1 / 60), (7.0, 80.0, 7.0, 80.0)], "a double, b double, c double, d double")
    df = df.withColumns({"p": geo.reduced_latitude(F.col("a")), "q": geo.reduced_latitude(F.col("c"))})
    got = [r.m for r in geo.with_geodesic_m(df, "m", "p", "b", "q", "d").collect()]
    assert got[0] == pytest.approx(1852.2, abs=0.1) and got[1] == pytest.approx(1314.2, abs=0.1) and got[2] == 0.0


def brute_dbscan(pts, eps, need):
    near = [[j for j, q in enumerate(pts) if km(p, q) <= eps] for p in pts]
    core = [len(x) >= need for x in near]
    label, m = [-1] * len(pts), 0
    for i in range(len(pts)):
        if core[i] and label[i] < 0:
            todo, label[i] = [i], m
            while todo:
                for j in near[todo.pop()]:
                    if core[j] and label[j] < 0:
                        label[j] = m
                        todo.append(j)
            m += 1
    return [label[i] if core[i] else min((label[j] for j in near[i] if core[j]), default=-1) for i in range(len(pts))]


@pytest.mark.parametrize("seed,n,spread", [(1, 60, 0.05), (2, 120, 0.12), (5, 30, 0.01)])
def test_dbscan_equals_brute_force(spark, seed, n, spread):
    pts = cloud(seed, n, spread)
    df = spark.createDataFrame([(f"p{i:04d}", float(a), float(b)) for i, (a, b) in enumerate(pts)], "Outlet_ID string, Latitude double, Longitude double")
    got = [r.micro_market_id for r in clusters.dbscan(df, CFG).orderBy("Outlet_ID").collect()]
    assert got == brute_dbscan(pts, 1.0, 5)


def test_components_of_a_long_shuffled_path(spark):
    ids = list(np.random.default_rng(0).permutation(200))
    edges = spark.createDataFrame([(int(a), int(b)) for a, b in zip(ids[:150], ids[1:151])], "u long, v long")
    got = {r.node: r.label for r in clusters.connected_components(spark.range(200).toDF("node"), edges).collect()}
    assert {got[i] for i in ids[:151]} == {min(ids[:151])} and all(got[i] == i for i in ids[151:])


def test_min_max_classes_and_missing_rows(spark):
    flat = spark.createDataFrame([("a", 3), ("b", 3)], "Outlet_ID string, competitors_1km int")
    got = spatial.saturation_class(spatial.density_score(flat))
    assert rows(got) == [("a", 3, 0.0, "isolated"), ("b", 3, 0.0, "isolated")]
    more = spatial.append_missing_points(got, spark.createDataFrame([("a",), ("n",)], "Outlet_ID string"), {"competitors_1km": 0, "competition_density_score": 0.0, "market_saturation_class": "isolated"})
    assert ("n", 0, 0.0, "isolated") in rows(more) and more.count() == 3


def test_polygon_and_tiles(spark):
    ring = spark.createDataFrame([("l", i, a, b) for i, (a, b) in enumerate([(6.0, 80.0), (6.0, 81.0), (7.0, 81.0), (6.4, 80.5), (7.0, 80.0)])], "polygon string, seq int, lat double, lon double")
    pts = spark.createDataFrame([("in", 6.2, 80.5), ("notch", 6.8, 80.5), ("out", 8.0, 80.5), ("arm", 6.8, 80.1)], "Outlet_ID string, Latitude double, Longitude double")
    assert dict(rows(spatial.point_in_polygon(pts, spatial.ring_edges(ring)))) == {"in": False, "notch": True, "out": True, "arm": False}
    members, boxes = spatial.kmeans_tiles(pts, replace(CFG, n_tiles=2))
    j = members.join(boxes, "cluster_id")
    assert j.count() == 4 and j.where("Latitude < lat_min or Latitude > lat_max or Longitude < lon_min or Longitude > lon_max").count() == 0


def crossings(lat, lon, rings):
    n = 0
    for ring in rings:
        for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1]):
            n += (a > lat) != (c > lat) and lon < (d - b) * (lat - a) / (c - a) + b
    return n % 2 == 1


def test_outlines_from_geojson_with_holes_and_islands(spark, tmp_path):
    rng = np.random.default_rng(3)
    circle = lambda y, x, r, n: [(y + r * np.sin(2 * np.pi * k / n), x + r * 1.3 * np.cos(2 * np.pi * k / n)) for k in range(n)]
    land = {0: [circle(7.0, 80.5, 0.8, 23), circle(7.1, 80.4, 0.3, 9)], 1: [circle(7.1, 80.4, 0.1, 5)], 2: [[(5.0, 82.0), (5.0, 82.5), (5.5, 82.5), (5.5, 82.0)]]}  # the second lies in the hole of the first
    closed = lambda ring: [[x, y, 0.0] for y, x in ring + ring[:1]]
    feature = lambda iso, kind, c: {"type": "Feature", "properties": {"ISO_A3": iso, "rank": 3}, "geometry": {"type": kind, "coordinates": c}}
    features = [feature("AAA", "Polygon", [closed(circle(7, 80, 5, 8))]), feature("LKA", "MultiPolygon", [[closed(r) for r in land[0]], [closed(r) for r in land[1]]]),
                feature("LKA", "Polygon", [closed(r) for r in land[2]]), feature("LKA", "Point", [80.0, 7.0])]
    (tmp_path / "a.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    (tmp_path / "b.jsonl").write_text("\n".join(map(json.dumps, features)))
    rings = geojson.read_rings(spark, str(tmp_path / "a.json"), {"ISO_A3": "LKA"})
    assert rings.select("polygon", "ring").distinct().count() == 4 and rings.select("polygon").distinct().count() == 3
    lined = geojson.read_rings(spark, str(tmp_path / "b.jsonl"), {"ISO_A3": "LKA"}, lines=True)
    assert rows(lined, "ring", "seq", "lat", "lon") == rows(rings, "ring", "seq", "lat", "lon")
    pts = [(f"p{i}", float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(4.5, 8.5, 900), rng.uniform(79, 83, 900)))]
    pts += [("hole", 7.3, 80.4), ("islet", 7.1, 80.4), ("none", None, None), ("block", 5.25, 82.25), ("edge", 5.25, 82.0)]
    df = spark.createDataFrame(pts, "Outlet_ID string, Latitude double, Longitude double")
    want = {i: not (a is not None and any(crossings(a, b, r) for r in land.values())) for i, a, b in pts}
    assert want["hole"] and not want["islet"] and want["none"] and not want["block"]
    for side in (0.25, 0.05, 2.0):
        assert dict(rows(spatial.point_in_polygon(df, spatial.ring_edges(rings), side))) == want, side
    cells = {tuple(r) for r in spatial.edge_cells(spatial.ring_edges(rings), 0.05).collect()}
    for ring in (r for rs in land.values() for r in rs):   # every point of an edge lies in a marked cell
        for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1]):
            assert {(int(np.floor((a + t * (c - a)) / 0.05)), int(np.floor((b + t * (d - b)) / 0.05))) for t in np.linspace(0, 1, 60)} <= cells


def test_a_crowded_cell_is_joined_by_levels(spark, monkeypatch):
    monkeypatch.setattr(spatial, "LOCATIONS_PER_TILE", 6)
    rng = np.random.default_rng(9)
    h, w = spatial.cell_sides(2.0, CFG)
    y, x = 7 // h * h, 80 // w * w
    pts = [(float(y + h * a), float(x + w * b)) for a, b in rng.random((5000, 2))]
    df = spark.createDataFrame([(f"p{i}", a, b) for i, (a, b) in enumerate(pts)], "Outlet_ID string, Latitude double, Longitude double")
    locs = spatial.locations(df, "Latitude", "Longitude")
    near, far = F.col("near"), F.col("far")
    found = {}
    for per_tile in (90, 22, 6):   # four times the tiles each
        monkeypatch.setattr(spatial, "LOCATIONS_PER_TILE", per_tile)
        tiled = spatial._tiled(locs, 2.0, CFG).cache()
        n_tiles = tiled.select("cy", "cx", "ty", "tx").distinct().count()
        whole, leaves = spatial.node_pairs(tiled, tiled, 2.0, (), ["w"], spatial.SLACK["haversine"], (far <= 0.5) | ((near > 0.5) & (far <= 2.0)) | (near > 2.0))
        both = whole.unionByName(leaves).agg(F.count("*").alias("pairs"), F.sum(F.col("an") * F.col("b_w")).alias("points")).first()
        assert both.points <= 5000**2   # no pair of locations is met twice
        found[n_tiles] = both.pairs
    sizes, pairs = zip(*sorted(found.items()))
    assert pairs[-1] < 0.25 * sizes[-1] ** 2 and all(pairs[i + 1] / pairs[i] < 0.72 * (sizes[i + 1] / sizes[i]) ** 2 for i in (0, 1))   # grows with the rim, not with all pairs
    got = {r.Outlet_ID: r.competitors_500m for r in spatial.competitor_counts(df, CFG).collect()}
    for i in range(0, 5000, 250):
        assert got[f"p{i}"] == sum(km(pts[i], q) <= 0.5 for q in pts) - 1


@pytest.mark.parametrize("ranges", [1, 5])
def test_pois_near_outlet_in_order_without_shuffled_pairs(spark, monkeypatch, ranges):
    """Rows equal brute force, by outlet and nearest first; the plan has no exchange of pairs and no sort behind them."""
    monkeypatch.setattr(neighbours, "LIST", 3)
    monkeypatch.setattr(neighbours, "BATCH_PAIRS", 50)
    if ranges > 1:
        monkeypatch.setattr(neighbours, "RANGE_PAIRS", 900)
    outlets = [(f"p{i:04d}", float(a), float(b)) for i, (a, b) in enumerate(cloud(3, 60, 0.03))]
    outlets += [outlets[7], ("p0008", 7.02, 80.0), ("nowhere", None, 80.0), ("nan", math.nan, 80.0), ("alone", 7.0, 80.0)]
    links = [(o, i % 3) for i, (o, _, _) in enumerate(outlets[:-1])] + [("p0005", 0), ("p0005", 1), ("p0005", 1), ("p0006", 9), ("p0009", None)]
    pois = [(i, i % 3, float(a), float(b), {"shop": str(i)}) for i, (a, b) in enumerate(cloud(8, 70, 0.03))]
    pois += [pois[4], (900, None, 7.0, 80.0, None), (901, 1, None, 80.0, None), (None, 1, 7.0, 80.0, None)]
    points = spark.createDataFrame(outlets, "Outlet_ID string, Latitude double, Longitude double")
    tiles = spark.createDataFrame(links, "outlet_id string, cluster_id int")
    places = spark.createDataFrame(pois, "poi_id long, cluster_id int, lat double, lon double, tags map<string,string>")
    want = [(o, p, c, math.floor(km((y, x), (lat, lon)) * 1000 + 0.5), lat, tags) for o, y, x in outlets if y is not None and not math.isnan(y)
            for l, c in links if l == o for p, d, lat, lon, tags in pois if d is not None and c == d and lat is not None and km((y, x), (lat, lon)) <= 2]
    df = spatial.pois_near_outlet(points, tiles, places, CFG)
    assert df.columns == ["Outlet_ID", "poi_id", "cluster_id", "lat", "lon", "tags", "distance_meters"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    behind = plan[: plan.index("MapInArrow")]
    assert "Exchange" not in behind and "Sort" not in behind and plan.count("MapInArrow") == 1
    got = [(r.Outlet_ID, r.poi_id, r.cluster_id, r.distance_meters, r.lat, r.tags) for r in df.collect()]
    assert len(want) > 500 and sorted(map(repr, got)) == sorted(map(repr, want))
    assert [(g[0], g[3]) for g in got] == sorted((g[0], g[3]) for g in got)
    few = spatial.pois_near_outlet(points, tiles, places, CFG, columns=("poi_id",))
    assert few.columns == ["Outlet_ID", "poi_id", "distance_meters"] and few.count() == len(want) and (df.rdd.getNumPartitions() > 1) == (ranges > 1)
    assert spatial.pois_near_outlet(points, tiles, places.limit(0), CFG).count() == 0 and spatial.pois_near_outlet(points.limit(0), tiles, places, CFG).count() == 0


def test_ordered_pairs_equal_the_join_of_locations(spark):
    rng = np.random.default_rng(2)
    at = lambda n: (rng.uniform(6.0, 6.1, n), rng.uniform(80.0, 80.1, n), rng.integers(0, 2, n))
    frame = lambda x: spark.createDataFrame([(int(i), float(a), float(b), int(c)) for i, (a, b, c) in enumerate(zip(*x))], "id long, lat double, lon double, c int")
    left, right = frame(at(200)), frame(at(150))
    near = neighbours.near_rows(left, "id", right.withColumnRenamed("id", "to"), "c", ["c", "to"], 2.0, spatial.cell_sides(2.0, CFG))
    pairs = spatial.within_radius(spatial.locations(left, "lat", "lon"), spatial.locations(right, "lat", "lon", ["c"]), 2.0, CFG, ["c"])
    a, b = left.selectExpr("id", "lat a_lat", "lon a_lon", "c"), right.selectExpr("id to", "lat b_lat", "lon b_lon", "c")
    want = pairs.join(a, ["a_lat", "a_lon", "c"]).join(b, ["b_lat", "b_lon", "c"]).selectExpr("id", "c", "to", "cast(floor(km * 1000 + 0.5) as bigint)")
    assert rows(near) == rows(want) and near.count() > 1000
