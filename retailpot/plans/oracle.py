"""Equivalent DuckDB SQL per query, assembled from named common table expressions.

The SQL is written independently of the Spark plans where that is possible: dense grids and windows
for the sales series, brute-force distances for the radius joins, a recursive closure for clusters.
"""

from __future__ import annotations

import re

from retailpot import config as c
from retailpot.operators import briefing, models, sales
from retailpot.plans import fixture_views as fx

CFG = fx.FIXTURE
L = CFG.target_label
B = CFG.budget


def he(x: str, n: int) -> str:
    return f"(round_even(({x}) * 1e{n}, 0) / 1e{n})"


def hav(a: str, b: str, lat="lat", lon="lon") -> str:
    return (f"(12742.0 * asin(sqrt(least(1.0, pow(sin(radians({b}.{lat} - {a}.{lat}) / 2), 2) + cos(radians({a}.{lat})) * cos(radians({b}.{lat}))"
            f" * pow(sin(radians({b}.{lon} - {a}.{lon}) / 2), 2)))))")


def lambert(a: str, b: str) -> str:
    """Ellipsoid metres between aliases a and b."""
    f = "(1 / 298.257223563)"
    b1, b2 = f"atan((1 - {f}) * tan(radians({a}.lat)))", f"atan((1 - {f}) * tan(radians({b}.lat)))"
    s = f"(2 * asin(sqrt(least(1.0, pow(sin(({b2} - {b1}) / 2), 2) + cos({b1}) * cos({b2}) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2)))))"
    p, q = f"(({b1} + {b2}) / 2)", f"(({b2} - {b1}) / 2)"
    x = f"(({s} - sin({s})) * pow(sin({p}) * cos({q}), 2) / pow(cos({s} / 2), 2))"
    y = f"(({s} + sin({s})) * pow(cos({p}) * sin({q}), 2) / pow(sin({s} / 2), 2))"
    return f"(CASE WHEN {s} = 0 THEN 0.0 ELSE 6378137.0 * ({s} - {f} / 2 * ({x} + {y})) END)"


def in_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def case_map(expr: str, mapping: dict, default="NULL") -> str:
    q = lambda v: f"'{v}'" if isinstance(v, str) else repr(v)
    return f"CASE {expr} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items()) + f" ELSE {default} END"


def title(x: str) -> str:
    return f"list_aggregate(list_transform(regexp_extract_all({x}, '[A-Za-z]+|[^A-Za-z]+'), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', '')"


def minmax(v: str, table: str, n: int = 2) -> str:
    lo, hi = f"(SELECT min({v}) FROM {table})", f"(SELECT max({v}) FROM {table})"
    return f"CASE WHEN {hi} > {lo} THEN {he(f'({v} - {lo}) / ({hi} - {lo}) * 100.0', n)} ELSE 0.0 END"


def blank(x: str) -> str:
    return f"({x} IS NULL OR trim(CAST({x} AS VARCHAR)) = '')"


def poi_case(rules: dict, k="tag_key", v="tag_value") -> str:
    arms = " ".join("WHEN " + " OR ".join(f"({k} = '{a}' AND {v} = '{b}')" for a, b in pairs) + f" THEN '{cat}'" for cat, pairs in rules.items())
    return f"CASE {arms} END"


Y0, Y1 = CFG.tx_years
TY, TM = CFG.target
CTES: dict[str, str] = {n: fx.duckdb_view(n) for n in fx.VIEWS}

# --- silver ---------------------------------------------------------------------------------
CTES["o_checked"] = f"""
SELECT *, CASE WHEN row_number() OVER (PARTITION BY Outlet_ID ORDER BY Outlet_Type) > 1 THEN 'duplicate_record'
  WHEN {blank('Outlet_ID')} THEN 'null_in_mandatory_field:Outlet_ID' WHEN {blank('Outlet_Type')} THEN 'null_in_mandatory_field:Outlet_Type'
  WHEN {blank('Cooler_Count')} THEN 'null_in_mandatory_field:Cooler_Count'
  WHEN NOT regexp_full_match(Outlet_ID, '{CFG.outlet_id_pattern}') THEN 'format_violation:Outlet_ID:pattern={CFG.outlet_id_pattern}'
  WHEN Cooler_Count < 0 OR Cooler_Count > 5 THEN 'out_of_range:Cooler_Count:value=' || CAST(Cooler_Count AS VARCHAR) END AS failure_reason
FROM fx_outlet_master"""
CTES["o_titled"] = f"""
SELECT Outlet_ID, CASE WHEN t IN ('Nan', 'None', '') THEN NULL ELSE t END AS size, Cooler_Count, trim(Outlet_Type) AS kind
FROM (SELECT *, {title('trim(Outlet_Size)')} AS t FROM o_checked WHERE failure_reason IS NULL)"""
CTES["o_fixed"] = f"""
SELECT Outlet_ID, coalesce(size, {case_map('Cooler_Count', c.SIZE_BY_COOLERS, "'Small'")}) AS Outlet_Size, Cooler_Count,
  {case_map('kind', c.TYPE_CORRECTIONS, 'kind')} AS Outlet_Type, size IS NULL AS size_imputed FROM o_titled"""
CTES["o_valid"] = f"""
SELECT *, CASE WHEN Outlet_Size NOT IN {in_list(c.OUTLET_SIZES)} THEN 'invalid_value:Outlet_Size:found=' || Outlet_Size
  WHEN Outlet_Type NOT IN {in_list(c.OUTLET_TYPES)} THEN 'invalid_value:Outlet_Type:found=' || Outlet_Type END AS failure_reason FROM o_fixed"""
CTES["outlets"] = "SELECT Outlet_ID, Outlet_Size, Cooler_Count, Outlet_Type, size_imputed FROM o_valid WHERE failure_reason IS NULL"
b = CFG.bounds
CTES["c_checked"] = f"""
SELECT *, CASE WHEN row_number() OVER (PARTITION BY Outlet_ID ORDER BY Latitude) > 1 THEN 'duplicate_record'
  WHEN {blank('Outlet_ID')} THEN 'null_in_mandatory_field:Outlet_ID' WHEN Latitude IS NULL THEN 'null_in_mandatory_field:Latitude'
  WHEN Longitude IS NULL THEN 'null_in_mandatory_field:Longitude'
  WHEN Outlet_ID NOT IN (SELECT Outlet_ID FROM outlets) THEN 'referential_integrity_violation:Outlet_ID'
  WHEN Latitude = 0 AND Longitude = 0 THEN 'zero_coordinates' END AS r FROM fx_outlet_coordinates"""
CTES["c_swapped"] = f"""
SELECT *, CASE WHEN r IS NOT NULL THEN r WHEN NOT (Latitude BETWEEN {b.lat_min} AND {b.lat_max} AND Longitude BETWEEN {b.lon_min} AND {b.lon_max})
  THEN 'coordinates_out_of_sri_lanka_bounds' END AS failure_reason
FROM (SELECT Outlet_ID, r, CASE WHEN r IS NULL AND Latitude > 50 THEN Longitude ELSE Latitude END AS Latitude,
  CASE WHEN r IS NULL AND Latitude > 50 THEN Latitude ELSE Longitude END AS Longitude, Latitude > 50 AS coords_swapped FROM c_checked)"""
CTES["coordinates"] = "SELECT Outlet_ID, Latitude, Longitude, coords_swapped FROM c_swapped WHERE failure_reason IS NULL"
CTES["tx"] = """
SELECT Outlet_ID, CAST(Year AS INTEGER) AS Year, CAST(Month AS INTEGER) AS Month, Distributor_ID, Volume_Liters AS Volume_Litres,
  make_date(Year, Month, 1) AS Date FROM fx_transactions"""
CTES["tx_checked"] = f"""
SELECT *, CASE WHEN rn > 1 THEN 'duplicate_record' WHEN {blank('Outlet_ID')} THEN 'null_in_mandatory_field:Outlet_ID'
  WHEN Date IS NULL THEN 'null_in_mandatory_field:Date' WHEN Volume_Litres IS NULL THEN 'null_in_mandatory_field:Volume_Litres'
  WHEN Outlet_ID NOT IN (SELECT Outlet_ID FROM outlets) THEN 'referential_integrity_violation:Outlet_ID'
  WHEN Distributor_ID IS NULL OR Distributor_ID NOT IN {in_list(c.DISTRIBUTORS)} THEN 'invalid_value:Distributor_ID:found=' || coalesce(Distributor_ID, 'None')
  WHEN Volume_Litres < {CFG.min_volume} THEN 'out_of_range:Volume_Litres:value=' || CAST(Volume_Litres AS VARCHAR) END AS failure_reason
FROM (SELECT *, row_number() OVER (PARTITION BY Outlet_ID, Date, Volume_Litres ORDER BY Distributor_ID) AS rn FROM tx WHERE Year BETWEEN {Y0} AND {Y1})"""
CTES["transactions"] = "SELECT Outlet_ID, Date, Year, Month, Distributor_ID, Volume_Litres FROM tx_checked WHERE failure_reason IS NULL"
CTES["seasonality"] = f"""
SELECT Distributor_ID, CAST(Year AS INTEGER) AS Year, CAST(Month AS INTEGER) AS Month, Seasonality_Index, false AS is_extrapolated FROM fx_seasonality
UNION ALL SELECT Distributor_ID, {TY}, {TM}, Seasonality_Index, true FROM fx_seasonality WHERE Year = {TY - 1} AND Month = {TM}"""
CTES["h_pivot"] = """
SELECT Date AS date, arg_min(Holiday_Name, row_id) AS Holiday_Name, bool_or(Holiday_Type = 'Public') AS is_public, bool_or(Holiday_Type = 'Bank') AS is_bank,
  bool_or(Holiday_Type = 'Mercantile') AS is_mercantile, bool_or(Holiday_Type = 'Poya Day') AS is_poya_day
FROM fx_holidays WHERE Holiday_Type IN ('Public', 'Bank', 'Mercantile', 'Poya Day') GROUP BY Date"""
_manual = ", ".join(f"(DATE '{d}', '{n}', {p}, {k}, {m}, {y}, true)" for d, n, p, k, m, y in CFG.manual_holidays)
CTES["calendar"] = f"SELECT *, false AS is_manually_added FROM h_pivot UNION ALL VALUES {_manual}"
CTES["days"] = f"""
SELECT (SELECT count(*) FROM (SELECT unnest(generate_series(DATE '{TY}-{TM:02d}-01', last_day(DATE '{TY}-{TM:02d}-01'), INTERVAL 1 DAY)) AS d)
  WHERE isodow(d) < 6 AND CAST(d AS DATE) NOT IN (SELECT date FROM calendar)) AS trading_days,
  (SELECT count(DISTINCT date) FROM calendar WHERE year(date) = {TY} AND month(date) = {TM}) AS holiday_count"""

# --- sales ----------------------------------------------------------------------------------
CTES["monthly"] = """
SELECT Outlet_ID, Year, Month, sum(Volume_Litres) AS monthly_volume, count(Volume_Litres) AS transaction_count FROM transactions GROUP BY ALL"""
CTES["grid"] = """
SELECT o.Outlet_ID, m.i - s.lo AS i, s.hi - s.lo + 1 AS n, CAST(m.i // 12 AS INTEGER) AS Year, CAST(m.i % 12 + 1 AS INTEGER) AS Month, coalesce(v.monthly_volume, 0.0) AS v
FROM (SELECT DISTINCT Outlet_ID FROM monthly) o
CROSS JOIN (SELECT min(Year * 12 + Month - 1) AS lo, max(Year * 12 + Month - 1) AS hi FROM transactions) s
CROSS JOIN LATERAL (SELECT unnest(generate_series(s.lo, s.hi)) AS i) m
LEFT JOIN (SELECT Outlet_ID, Year * 12 + Month - 1 AS i, monthly_volume FROM monthly) v ON v.Outlet_ID = o.Outlet_ID AND v.i = m.i"""
CTES["g_stats"] = """
SELECT Outlet_ID, max(v) AS hist_max_monthly, quantile_cont(v, 0.9) AS hist_p90_monthly, quantile_cont(v, 0.75) AS hist_p75_monthly, avg(v) AS hist_mean_monthly,
  coalesce(stddev_samp(v), 0.0) AS hist_std_monthly, CASE WHEN avg(v) > 0 THEN coalesce(stddev_samp(v), 0.0) / avg(v) ELSE 0.0 END AS hist_cv,
  coalesce(avg(v) FILTER (Month = 1), 0.0) AS jan_avg_volume, coalesce(max(v) FILTER (Month = 1), 0.0) AS jan_max_volume,
  CAST(count(*) FILTER (Month = 1 AND v > 0) AS INTEGER) AS jan_count, CAST(count(*) FILTER (v > 0) AS INTEGER) AS active_months,
  count(*) FILTER (v > 0) / CAST(max(n) AS DOUBLE) AS active_months_pct,
  CAST(coalesce(max(n) - 1 - max(i) FILTER (v > 0), max(n)) AS INTEGER) AS months_since_last_order,
  avg(v) FILTER (i >= n - 3) AS recent_3m_avg, CASE WHEN max(n) >= 6 THEN regr_slope(v, i) END AS trend_slope, sum(v) AS total_volume,
  sum(v * pow(0.5, n - 1 - i) * CASE WHEN i = 0 THEN 1 ELSE 0.5 END) AS ema_3m,
  sum(v * pow(5.0 / 7, n - 1 - i) * CASE WHEN i = 0 THEN 1 ELSE 2.0 / 7 END) AS ema_6m
FROM grid GROUP BY Outlet_ID"""
CTES["g_runs"] = """
SELECT o.Outlet_ID, CAST(coalesce(max(z.len), 0) AS INTEGER) AS consecutive_zero_months_max FROM (SELECT DISTINCT Outlet_ID FROM grid) o
LEFT JOIN (SELECT Outlet_ID, count(*) AS len FROM (SELECT Outlet_ID, i - row_number() OVER (PARTITION BY Outlet_ID ORDER BY i) AS island FROM grid WHERE v = 0)
  GROUP BY Outlet_ID, island) z USING (Outlet_ID) GROUP BY o.Outlet_ID"""
CTES["g_yoy"] = """
SELECT Outlet_ID, CASE WHEN count(*) >= 2 AND arg_min(a, Year) <> 0 THEN (arg_max(a, Year) - arg_min(a, Year)) / arg_min(a, Year) END AS yoy_growth_rate
FROM (SELECT Outlet_ID, Year, avg(v) AS a FROM grid GROUP BY ALL) GROUP BY Outlet_ID"""
CTES["g_mode"] = """
SELECT Outlet_ID, Distributor_ID AS distributor_id FROM (SELECT *, row_number() OVER (PARTITION BY Outlet_ID ORDER BY n DESC, Distributor_ID) AS r
  FROM (SELECT Outlet_ID, Distributor_ID, count(*) AS n FROM transactions GROUP BY ALL)) WHERE r = 1"""
CTES["g_global"] = "SELECT Distributor_ID AS d FROM transactions GROUP BY Distributor_ID ORDER BY count(*) DESC, Distributor_ID LIMIT 1"
_fill = ", ".join(f"coalesce({x}, 0) AS {x}" for x in sales.ZERO_FILLED if x != "months_since_last_order")
CTES["sales"] = f"""
SELECT o.Outlet_ID, {_fill}, yoy_growth_rate, trend_slope, coalesce(m.distributor_id, (SELECT d FROM g_global)) AS distributor_id,
  CAST(CASE WHEN coalesce(active_months, 0) = 0 THEN (SELECT max(n) FROM grid) ELSE months_since_last_order END AS INTEGER) AS months_since_last_order
FROM outlets o LEFT JOIN g_stats USING (Outlet_ID) LEFT JOIN g_runs USING (Outlet_ID) LEFT JOIN g_yoy USING (Outlet_ID) LEFT JOIN g_mode m USING (Outlet_ID)"""

# --- spatial --------------------------------------------------------------------------------
CTES["pt"] = "SELECT Outlet_ID, Latitude AS lat, Longitude AS lon FROM coordinates"
CTES["poi_flat"] = f"SELECT lat, lon, cluster_id, {poi_case(c.FLAT_POI_RULES)} AS category FROM fx_poi WHERE {poi_case(c.FLAT_POI_RULES)} IS NOT NULL"
CTES["poi_grav"] = f"SELECT DISTINCT lat, lon, {poi_case(c.GRAVITY_POI_RULES)} AS category FROM fx_poi WHERE {poi_case(c.GRAVITY_POI_RULES)} IS NOT NULL"
_box = "abs(a.lat - b.lat) < 0.03 AND abs(a.lon - b.lon) < 0.03"
CTES["near_flat"] = f"SELECT Outlet_ID, category, cluster_id, d FROM (SELECT a.Outlet_ID, b.category, b.cluster_id, {lambert('a', 'b')} AS d FROM pt a JOIN poi_flat b ON {_box}) WHERE d <= 2000"
_counts = [(f"{cat}_{r}m", cat, r) for cat in c.FLAT_POI_RULES for r in CFG.radii_m]


def poi_counts(points: str, near: str) -> str:
    filters = ", ".join(f"CAST(count(*) FILTER (n.category = '{cat}' AND n.d <= {r}) AS INTEGER) AS {name}" for name, cat, r in _counts)
    return (f"SELECT o.Outlet_ID, {filters}, bool_or(p.Outlet_ID IS NOT NULL) AS poi_data_available FROM outlets o LEFT JOIN {points} p USING (Outlet_ID) "
            f"LEFT JOIN {near} n ON n.Outlet_ID = p.Outlet_ID GROUP BY o.Outlet_ID")


CTES["poi_counts"] = poi_counts("pt", "near_flat")
POI_COUNTS_SERVED = poi_counts("(SELECT * FROM pt WHERE Outlet_ID IN (SELECT outlet_id FROM links WHERE cluster_id % 7 <> 3))", "(SELECT * FROM near_flat WHERE cluster_id % 7 <> 3)")
CTES["poi_raw"] = "SELECT *, " + " + ".join(f"{k}_500m * {w}e0" for k, w in c.FOOTFALL_WEIGHTS.items()) + " AS raw FROM poi_counts"
CTES["poi"] = f"SELECT * EXCLUDE (raw), {minmax('raw', 'poi_raw')} AS footfall_score FROM poi_raw"
CTES["near_grav"] = f"SELECT Outlet_ID, category, 1.0 / pow(d + 0.05, 2) AS pull FROM (SELECT a.Outlet_ID, b.category, {hav('a', 'b')} AS d FROM pt a JOIN poi_grav b ON {_box}) WHERE d <= 2.0"
_cats = list(c.GRAVITY_POI_RULES)
CTES["grav_sum"] = "SELECT p.Outlet_ID, " + ", ".join(f"coalesce(sum(pull) FILTER (category = '{k}'), 0.0) AS {k}" for k in _cats) + " FROM pt p LEFT JOIN near_grav USING (Outlet_ID) GROUP BY p.Outlet_ID"
CTES["grav_scored"] = ("SELECT Outlet_ID, " + ", ".join(f"{he(k, 4)} AS {k}_gravity_score" for k in _cats)
                       + f", {he(' + '.join(f'{k} * {c.GRAVITY_WEIGHTS[k]}e0' for k in _cats), 4)} AS raw_composite_gravity FROM grav_sum")
CTES["grav_composite"] = f"SELECT *, {minmax('raw_composite_gravity', 'grav_scored')} AS composite_gravity_score, true AS gravity_data_available FROM grav_scored"
CTES["gravity"] = ("SELECT * FROM grav_composite UNION ALL BY NAME SELECT Outlet_ID, " + ", ".join(f"0.0 AS {k}_gravity_score" for k in _cats)
                   + ", 0.0 AS raw_composite_gravity, 0.0 AS composite_gravity_score, false AS gravity_data_available FROM outlets WHERE Outlet_ID NOT IN (SELECT Outlet_ID FROM pt)")
CTES["competitors"] = f"""
SELECT a.Outlet_ID, CAST(count(*) FILTER (d <= 0.5) AS INTEGER) AS competitors_500m, CAST(count(*) FILTER (d <= 1.0) AS INTEGER) AS competitors_1km,
  CAST(count(*) FILTER (d <= 2.0) AS INTEGER) AS competitors_2km
FROM pt a LEFT JOIN (SELECT a.Outlet_ID, {hav('a', 'b')} AS d FROM pt a JOIN pt b ON {_box} AND a.Outlet_ID <> b.Outlet_ID) n USING (Outlet_ID) GROUP BY a.Outlet_ID"""
CTES["catch_scored"] = f"""
SELECT *, {minmax('competitors_1km', 'competitors')} AS competition_density_score,
  CASE WHEN competitors_1km <= (SELECT quantile_cont(competitors_1km, 0.25) FROM competitors) THEN 'isolated'
       WHEN competitors_1km >= (SELECT quantile_cont(competitors_1km, 0.75) FROM competitors) THEN 'dense' ELSE 'moderate' END AS market_saturation_class FROM competitors"""
CTES["catchment"] = """
SELECT * FROM catch_scored UNION ALL SELECT Outlet_ID, 0, 0, 0, 0.0, 'isolated' FROM outlets WHERE Outlet_ID NOT IN (SELECT Outlet_ID FROM pt)"""
CTES["nb"] = f"SELECT a.Outlet_ID AS i, b.Outlet_ID AS j FROM pt a JOIN pt b ON abs(a.lat - b.lat) < 0.015 AND abs(a.lon - b.lon) < 0.015 AND {hav('a', 'b')} <= {CFG.dbscan_eps_km}"
CTES["core"] = f"SELECT i FROM nb GROUP BY i HAVING count(*) >= {CFG.dbscan_min_points}"
CTES["core_edge"] = "SELECT i, j FROM nb WHERE i IN (SELECT i FROM core) AND j IN (SELECT i FROM core)"
CTES["reach"] = "SELECT i, i AS j FROM core UNION SELECT r.i, e.j FROM reach r JOIN core_edge e ON r.j = e.i"
CTES["core_label"] = "SELECT j AS id, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS m FROM (SELECT j, min(i) AS root FROM reach GROUP BY j)"
CTES["clusters"] = """
SELECT p.Outlet_ID, coalesce(l.m, e.m, -1) AS micro_market_id, coalesce(l.m, e.m, -1) = -1 AS is_spatial_outlier FROM pt p LEFT JOIN core_label l ON l.id = p.Outlet_ID
LEFT JOIN (SELECT nb.i, min(m) AS m FROM nb JOIN core_label ON nb.j = id GROUP BY nb.i) e ON e.i = p.Outlet_ID"""
CTES["cluster_vol"] = "SELECT c.*, coalesce(s.hist_p90_monthly, 0.0) AS v FROM clusters c LEFT JOIN sales s USING (Outlet_ID)"
CTES["cluster_stats"] = """
SELECT c.Outlet_ID, c.micro_market_id, c.is_spatial_outlier, coalesce(n, 0) AS cluster_outlet_count, coalesce(mean, 0.0) AS cluster_mean_volume, coalesce(p90, 0.0) AS cluster_p90_volume
FROM clusters c LEFT JOIN (SELECT micro_market_id, CAST(count(*) AS INTEGER) AS n, avg(v) AS mean, quantile_cont(v, 0.9) AS p90 FROM cluster_vol
  WHERE micro_market_id >= 0 GROUP BY micro_market_id) USING (micro_market_id)"""
CTES["spatial"] = "SELECT * FROM cluster_stats UNION ALL SELECT Outlet_ID, -1, true, 0, 0.0, 0.0 FROM outlets WHERE Outlet_ID NOT IN (SELECT Outlet_ID FROM pt)"
_edges = []
for _name, _ring in ((k, r) for k, rings in fx.OUTLINE.items() for r in rings):
    for _i, (_a, _o) in enumerate(_ring):
        _n = _ring[(_i + 1) % len(_ring)]
        _edges.append(f"('{_name}', {_a}e0, {_o}e0, {_n[0]}e0, {_n[1]}e0)")
CTES["sea"] = f"""
SELECT p.Outlet_ID, NOT coalesce(bool_or(n % 2 = 1), false) AS in_sea FROM pt p LEFT JOIN (
  SELECT Outlet_ID, polygon, count(*) AS n FROM pt JOIN (VALUES {', '.join(_edges)}) e(polygon, lat0, lon0, lat1, lon1)
  ON (lat0 > lat) <> (lat1 > lat) AND lon < (lon1 - lon0) * (lat - lat0) / (lat1 - lat0) + lon0 GROUP BY ALL) USING (Outlet_ID) GROUP BY p.Outlet_ID"""
CTES["links"] = "SELECT CONCAT('OUT_', LPAD(CAST(c_custkey AS VARCHAR), CAST(greatest(5, length(CAST(c_custkey AS VARCHAR))) AS INT), '0')) AS outlet_id, CAST(c_nationkey AS INTEGER) AS cluster_id FROM customer"

# --- features, baseline ---------------------------------------------------------------------
CTES["cooler"] = f"""
SELECT Outlet_ID, Cooler_Count, cap AS cooler_capacity_litres, ceil_ AS theoretical_monthly_ceiling,
  CASE WHEN Cooler_Count = 0 THEN 0.0 ELSE least(coalesce(hist_p90_monthly, 0.0) / greatest(ceil_, 1.0), 2.0) END AS capacity_utilization_ratio
FROM (SELECT Outlet_ID, Cooler_Count, Cooler_Count * 150e0 AS cap, Cooler_Count * 150e0 * 0.85e0 * 30e0 / 3e0 AS ceil_ FROM outlets) LEFT JOIN sales USING (Outlet_ID)"""
CTES["season_lookup"] = f"""
SELECT Distributor_ID AS distributor_id, Seasonality_Index AS seasonality_{L}, {case_map('Seasonality_Index', c.SEASON_MULTIPLIER)}::DOUBLE AS seasonality_multiplier_{L}
FROM seasonality WHERE Year = {TY} AND Month = {TM}"""
CTES["joined"] = """
SELECT o.*, k.Latitude, k.Longitude, k.coords_swapped, s.* EXCLUDE (Outlet_ID, distributor_id), s.distributor_id, p.* EXCLUDE (Outlet_ID), g.* EXCLUDE (Outlet_ID), t.* EXCLUDE (Outlet_ID),
  r.* EXCLUDE (Outlet_ID, Cooler_Count), x.* EXCLUDE (Outlet_ID), q.* EXCLUDE (distributor_id)
FROM outlets o LEFT JOIN coordinates k USING (Outlet_ID) LEFT JOIN sales s USING (Outlet_ID) LEFT JOIN poi p USING (Outlet_ID) LEFT JOIN gravity g USING (Outlet_ID)
LEFT JOIN catchment t USING (Outlet_ID) LEFT JOIN cooler r USING (Outlet_ID) LEFT JOIN spatial x USING (Outlet_ID) LEFT JOIN season_lookup q ON q.distributor_id = s.distributor_id"""
CTES["filled"] = f"""
SELECT * EXCLUDE (province_) REPLACE (coalesce(coords_swapped, false) AS coords_swapped,
  CASE WHEN Latitude IS NULL THEN coalesce({case_map('province_', {k: v[0] for k, v in c.PROVINCE_CENTROID.items()})}, 7.0)::DOUBLE ELSE Latitude END AS Latitude,
  CASE WHEN Latitude IS NULL THEN coalesce({case_map('province_', {k: v[1] for k, v in c.PROVINCE_CENTROID.items()})}, 80.0)::DOUBLE ELSE Longitude END AS Longitude,
  coalesce(trend_slope, (SELECT median(trend_slope) FROM joined)) AS trend_slope, coalesce(yoy_growth_rate, (SELECT median(yoy_growth_rate) FROM joined)) AS yoy_growth_rate,
  coalesce(seasonality_multiplier_{L}, 1.0) AS seasonality_multiplier_{L}, coalesce(seasonality_{L}, 'Moderate') AS seasonality_{L}),
  province_ AS province, Latitude IS NULL AS exclude_from_training, active_months > 0 AS has_transaction_history,
  (SELECT holiday_count FROM days) AS {L}_holiday_count, (SELECT trading_days FROM days) AS {L}_trading_days
FROM (SELECT *, {case_map('distributor_id', c.DISTRIBUTOR_PROVINCE)} AS province_ FROM joined)"""
FLOATS = ["Latitude", "Longitude", *[x for x in sales.SALES_COLUMNS if x not in ("Outlet_ID", "distributor_id", "jan_count", "active_months", "consecutive_zero_months_max", "months_since_last_order")],
          "footfall_score", *[f"{k}_gravity_score" for k in _cats], "raw_composite_gravity", "composite_gravity_score", "competition_density_score", "cooler_capacity_litres",
          "theoretical_monthly_ceiling", "capacity_utilization_ratio", "cluster_mean_volume", "cluster_p90_volume", f"seasonality_multiplier_{L}"]
CTES["master"] = "SELECT * REPLACE (" + ", ".join(f"{he(x, 4)} AS {x}" for x in FLOATS) + ") FROM filled"
CTES["size_med"] = "SELECT Outlet_Size, median(jan_avg_volume) AS size_median FROM master WHERE jan_count > 0 GROUP BY Outlet_Size"
CTES["cold"] = """
SELECT m.*, coalesce(s.size_median, (SELECT coalesce(median(jan_avg_volume), 50.0) FROM master WHERE jan_count > 0)) * CASE WHEN theoretical_monthly_ceiling > 0
  THEN least(greatest(theoretical_monthly_ceiling / 2550e0, 0.5), 2.0) ELSE 1.0 + Cooler_Count * 0.15e0 END AS cold_start
FROM master m LEFT JOIN size_med s USING (Outlet_Size)"""
RECENCY = "CASE WHEN hist_mean_monthly <= 0 OR ema_3m <= 0 THEN 1.0 ELSE least(greatest(ema_3m / hist_mean_monthly, 0.8), 1.3) END"
UPLIFT = """CASE WHEN composite_gravity_score <= 20 THEN 1.0 WHEN composite_gravity_score <= 60 THEN 1.0 + (composite_gravity_score - 20) / 40e0 * 0.10e0
  ELSE 1.10e0 + (composite_gravity_score - 60) / 40e0 * 0.15e0 END"""
CTES["baseline"] = f"""
SELECT Outlet_ID, path AS demand_path, {he(f'greatest(demand * ({RECENCY}) * seasonality_multiplier_{L} * ({L}_trading_days / 22e0) * ({UPLIFT}), hist_max_monthly)', 2)} AS baseline_potential_litres
FROM (SELECT *, CASE WHEN jan_count > 0 THEN 'january' WHEN has_transaction_history THEN 'p90' ELSE 'cold_start' END AS path,
  CASE WHEN jan_count > 0 THEN greatest(jan_avg_volume, jan_max_volume * 0.85e0) WHEN has_transaction_history THEN hist_p90_monthly ELSE cold_start END AS demand FROM cold)"""
CTES["blend"] = f"SELECT Outlet_ID, {he('greatest(model_a * 0.4e0 + model_b * 0.4e0 + model_c * 0.2e0, 0.0)', 2)} AS model_prediction FROM fx_predictions"
CTES["final"] = f"""
SELECT Outlet_ID, model_prediction, baseline_potential_litres, {he('CASE WHEN g <= 0 THEN 1.0 ELSE g END', 2)} AS Maximum_Monthly_Liters
FROM (SELECT b.Outlet_ID, model_prediction, baseline_potential_litres, greatest(model_prediction, baseline_potential_litres) AS g
  FROM blend b JOIN master m USING (Outlet_ID) LEFT JOIN baseline l ON l.Outlet_ID = b.Outlet_ID)"""
CTES["train"] = f"SELECT *, hist_p90_monthly * seasonality_multiplier_{L} * ({L}_trading_days / 22e0) AS target FROM master WHERE has_transaction_history AND NOT exclude_from_training"

# --- budget ---------------------------------------------------------------------------------
CTES["gap"] = f"""
SELECT m.*, f.Maximum_Monthly_Liters, greatest(f.Maximum_Monthly_Liters - m.recent_3m_avg, 0.0) AS uplift_gap_litres FROM master m JOIN final f USING (Outlet_ID)
WHERE m.distributor_id IN {in_list(B.cohort)}"""


def norm(x: str) -> str:
    lo, hi = f"(SELECT min({x}) FROM gap)", f"(SELECT max({x}) FROM gap)"
    return f"CASE WHEN {hi} - {lo} = 0 THEN 0.0 ELSE ({x} - {lo}) / CAST({hi} - {lo} + 1e-9 AS DOUBLE) END"


CTES["scored"] = f"SELECT *, 0.4e0 * ({norm('uplift_gap_litres')}) + 0.3e0 * ({norm('composite_gravity_score')}) + 0.2e0 * ({norm('recent_3m_avg')}) + 0.1e0 * ({norm('Cooler_Count')}) AS roi_score FROM gap"
CTES["tiers"] = """
SELECT * EXCLUDE (n), CASE WHEN roi_rank <= floor(n * 0.15e0) THEN 'High' WHEN roi_rank <= floor(n * 0.15e0) + floor(n * 0.35e0) THEN 'Medium'
  WHEN roi_rank <= floor(n * 0.15e0) + floor(n * 0.35e0) + floor(n * 0.15e0) THEN 'Low' ELSE 'None' END AS allocation_tier
FROM (SELECT *, row_number() OVER (ORDER BY roi_score DESC, Outlet_ID) AS roi_rank, count(*) OVER () AS n FROM scored)"""
CTES["guarded"] = """
SELECT * REPLACE (CASE WHEN recent_3m_avg = 0 OR uplift_gap_litres = 0 THEN 'None' WHEN allocation_tier = 'High' AND (NOT has_transaction_history OR Outlet_Size = 'Small'
  OR Outlet_Type IN ('Kiosk', 'Pharmacy')) THEN 'Medium' ELSE allocation_tier END AS allocation_tier) FROM tiers"""
_params = ", ".join(f"('{t}', {p[0]}e0, {p[1]}e0, {p[2]}e0, '{p[3]}')" for t, p in c.TIER_PARAMETERS.items())
CTES["with_params"] = f"SELECT g.*, cap AS tier_cap, floor_ AS tier_floor, eff AS volume_per_lkr, kind AS recommended_spend_type FROM guarded g JOIN (VALUES {_params}) p(t, cap, floor_, eff, kind) ON t = allocation_tier"
CTES["limits"] = """
SELECT * EXCLUDE (lim) REPLACE (CASE WHEN lim < tier_floor THEN 'None' ELSE allocation_tier END AS allocation_tier, CASE WHEN lim < tier_floor THEN 'None' ELSE recommended_spend_type END AS recommended_spend_type),
  CASE WHEN lim < tier_floor THEN 0.0 ELSE lim END AS max_headroom_allocation
FROM (SELECT *, CASE WHEN volume_per_lkr > 0 THEN round_even(least(tier_cap, uplift_gap_litres / volume_per_lkr) / 50e0, 0) * 50e0 ELSE 0.0 END AS lim FROM with_params)"""
CTES["greedy"] = f"""
SELECT * EXCLUDE (want, prev, s), CASE WHEN s > 0 AND s >= tier_floor THEN s ELSE 0.0 END AS Trade_Spend_Allocation_LKR
FROM (SELECT *, least(want, greatest(0.0, ({case_map('allocation_tier', B.buckets, '0.0')}) - prev))::DOUBLE AS s
  FROM (SELECT *, coalesce(sum(want) OVER (PARTITION BY allocation_tier ORDER BY roi_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS prev
    FROM (SELECT *, CASE WHEN allocation_tier = 'None' THEN 0.0 ELSE max_headroom_allocation END AS want FROM limits)))"""


def stepped(src: str, ok: str, amount: str, step: float) -> str:
    return f"""
SELECT * EXCLUDE (e, bef) REPLACE (CASE WHEN e = 1 AND bef < floor(({amount}) / {abs(step)}) THEN Trade_Spend_Allocation_LKR + {step} ELSE Trade_Spend_Allocation_LKR END AS Trade_Spend_Allocation_LKR)
FROM (SELECT *, coalesce(sum(e) OVER (ORDER BY roi_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef FROM (SELECT *, CASE WHEN {ok} THEN 1 ELSE 0 END AS e FROM {src}))"""


S = "Trade_Spend_Allocation_LKR"
CTES["spread1"] = stepped("greedy", f"{S} > 0 AND {S} + 50 <= tier_cap AND allocation_tier = 'High'", f"{B.total} - (SELECT sum({S}) FROM greedy)", 50.0)
CTES["spread"] = stepped("spread1", f"{S} > 0 AND {S} + 50 <= tier_cap", f"{B.total} - (SELECT sum({S}) FROM spread1)", 50.0)
_min = B.min_share * B.total
_who = "[" + ", ".join(f"'{d}'" for d in B.cohort) + "]"
PASSES = 10   # of the walk that lifts distributors to their minimum share


def _at(values: str, i: str, new: str) -> str:
    """A list with one place replaced."""
    return f"list_transform({values}, lambda v, j: CASE WHEN j = {i} THEN {new} ELSE v END)"


for _p in range(1, PASSES + 1):
    _src = "spread" if _p == 1 else f"walked{_p - 1}"
    # one row: totals by distributor, who is below and above, and the ordered queues of rows that give (g) and get (t)
    CTES[f"queues{_p}"] = f"""
SELECT tot, list_filter(range(1, {len(B.cohort)} + 1), lambda i: tot[i] < {_min}) AS under, list_filter(range(1, {len(B.cohort)} + 1), lambda i: tot[i] > {_min}) AS above, g, t FROM
  (SELECT list(coalesce(s, 0.0) ORDER BY i) AS tot FROM (SELECT unnest({_who}) AS d, unnest(range(1, {len(B.cohort)} + 1)) AS i) LEFT JOIN (SELECT distributor_id AS d, sum({S}) AS s FROM {_src} GROUP BY 1) USING (d)),
  (SELECT list(coalesce(q, []) ORDER BY i) AS g FROM (SELECT unnest({_who}) AS d, unnest(range(1, {len(B.cohort)} + 1)) AS i) LEFT JOIN
    (SELECT distributor_id AS d, list({{'r': roi_rank, 's': {S}, 'f': tier_floor}} ORDER BY roi_score, roi_rank) AS q FROM {_src} WHERE {S} > tier_floor GROUP BY 1) USING (d)),
  (SELECT list(coalesce(q, []) ORDER BY i) AS t FROM (SELECT unnest({_who}) AS d, unnest(range(1, {len(B.cohort)} + 1)) AS i) LEFT JOIN
    (SELECT distributor_id AS d, list({{'r': roi_rank, 's': {S}, 'f': tier_floor, 'h': max_headroom_allocation}} ORDER BY roi_score DESC, roi_rank) AS q
     FROM {_src} WHERE {S} < max_headroom_allocation AND max_headroom_allocation > 0 GROUP BY 1) USING (d))"""
    # one row a payment: u = place in the list of those below, gp / gs = first giver by distributor and its spend, tp / ts = first getter and its spend
    CTES[f"steps{_p}"] = f"""
SELECT 0 AS k, 1 AS u, tot, [1 FOR x IN g] AS gp, [x[1].s FOR x IN g] AS gs, 1 AS tp, t[under[1]][1].s AS ts,
  CAST(NULL AS BIGINT) AS g_rank, 0.0::DOUBLE AS g_new, CAST(NULL AS BIGINT) AS t_rank, 0.0::DOUBLE AS t_new FROM queues{_p} WHERE len(under) > 0 AND len(above) > 0
UNION ALL
SELECT k + 1, CASE WHEN pays THEN u ELSE u + 1 END, CASE WHEN pays THEN {_at(_at('tot', 'o', 'tot[o] - m'), 'd', 'tot[d] + m')} ELSE tot END,
  CASE WHEN pays AND NOT gs[o] - m > gf THEN {_at('gp', 'o', 'gp[o] + 1')} ELSE gp END,
  CASE WHEN pays THEN {_at('gs', 'o', 'CASE WHEN gs[o] - m > gf THEN gs[o] - m ELSE g[o][gp[o] + 1].s END')} ELSE gs END,
  CASE WHEN NOT pays THEN 1 WHEN ts + m < th THEN tp ELSE tp + 1 END,
  CASE WHEN NOT pays THEN t[under[u + 1]][1].s WHEN ts + m < th THEN ts + m ELSE t[d][tp + 1].s END,
  CASE WHEN pays THEN g[o][gp[o]].r END, gs[o] - m, CASE WHEN pays THEN t[d][tp].r END, ts + m
FROM (SELECT *, CASE WHEN gs[o] - want < gf THEN gs[o] ELSE want END AS m, tot[d] < {_min} AND gf IS NOT NULL AND th IS NOT NULL AS pays FROM
  (SELECT *, g[o][gp[o]].f AS gf, t[d][tp].h AS th, CASE WHEN ts = 0 THEN t[d][tp].f ELSE {B.step} END AS want FROM
    (SELECT w.*, q.g, q.t, q.under, q.under[u] AS d, list_filter(q.above, lambda a: w.tot[a] = list_max([w.tot[b] FOR b IN q.above]))[1] AS o FROM steps{_p} w, queues{_p} q WHERE u <= len(q.under))))"""
    CTES[f"walked{_p}"] = f"""
SELECT * EXCLUDE (r, n) REPLACE (coalesce(n, {S}) AS {S}) FROM {_src} LEFT JOIN
  (SELECT r, arg_max(n, k) AS n FROM (SELECT k, g_rank AS r, g_new AS n FROM steps{_p} UNION ALL SELECT k, t_rank, t_new FROM steps{_p}) WHERE r IS NOT NULL GROUP BY r) ON r = roi_rank"""
CTES["rebalanced"] = f"SELECT * FROM walked{PASSES}"
CTES["adj1"] = stepped("rebalanced", f"{S} > 0 AND {S} + 50 <= least(tier_cap, max_headroom_allocation + 100)", f"greatest(0, {B.total} - (SELECT sum({S}) FROM rebalanced))", 50.0)
CTES["adjusted"] = stepped("adj1", f"{S} > tier_floor AND {S} >= 50", f"greatest(0, (SELECT sum({S}) FROM adj1) - {B.total})", -50.0)
CTES["allocation"] = f"""
SELECT * REPLACE (CASE WHEN {S} = 0 THEN 'None' ELSE allocation_tier END AS allocation_tier, CASE WHEN {S} = 0 THEN 'None' ELSE recommended_spend_type END AS recommended_spend_type),
  {S} * volume_per_lkr AS projected_volume_uplift_litres FROM adjusted"""

# --- serving --------------------------------------------------------------------------------
_same = ("recent_3m_avg hist_p90_monthly composite_gravity_score footfall_score school_gravity_score transport_gravity_score worship_gravity_score hospitality_gravity_score active_months "
         f"seasonality_multiplier_{L} cooler_capacity_litres theoretical_monthly_ceiling capacity_utilization_ratio competitors_500m competitors_1km competition_density_score market_saturation_class").split()
CTES["srv_outlets"] = f"""
SELECT Outlet_ID AS outlet_id, Outlet_Type AS outlet_type, Outlet_Size AS outlet_size, province, distributor_id, Latitude AS latitude, Longitude AS longitude,
  CAST(Cooler_Count AS INTEGER) AS cooler_count, Maximum_Monthly_Liters AS predicted_potential_litres, CAST(active_months > 0 AS INTEGER) AS has_transaction_history, {', '.join(_same)},
  0.0::DOUBLE AS tobit_latent_estimate, 0.0::DOUBLE AS tobit_censoring_ratio, 0.0::DOUBLE AS hurdle_estimate FROM master JOIN final USING (Outlet_ID)"""
CTES["srv_allocations"] = f"""
SELECT Outlet_ID AS outlet_id, uplift_gap_litres, roi_score, lower(allocation_tier) AS allocation_tier, {S} AS trade_spend_allocation_lkr, recommended_spend_type, projected_volume_uplift_litres FROM allocation"""
CTES["emb_long"] = """
SELECT CONCAT('OUT_', LPAD(CAST(vec_id + 1 AS VARCHAR), CAST(greatest(5, length(CAST(vec_id + 1 AS VARCHAR))) AS INT), '0')) AS outlet_id, CONCAT('f', LPAD(CAST(i - 1 AS VARCHAR), CAST(greatest(3, length(CAST(i - 1 AS VARCHAR))) AS INT), '0')) AS feature, CAST(embedding[i] AS DOUBLE) AS contribution
FROM (SELECT *, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)"""
CTES["srv_rows"] = "SELECT a.*, o.distributor_id, o.outlet_type FROM srv_allocations a JOIN srv_outlets o USING (outlet_id)"
CTES["funded"] = "SELECT * FROM srv_rows WHERE allocation_tier <> 'none' AND trade_spend_allocation_lkr > 0"
CTES["tx_rejected"] = "SELECT Outlet_ID, failure_reason FROM tx_checked WHERE failure_reason IS NOT NULL"
CTES["c_rejected"] = "SELECT Outlet_ID, failure_reason FROM c_swapped WHERE failure_reason IS NOT NULL"


def _needs(sql: str) -> list[str]:
    return [n for n in CTES if re.search(rf"\b{n}\b", sql)]


def assemble(sql: str) -> str:
    """Prefix ``sql`` with the expressions it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in _needs(CTES[name]):
            if dep != name:
                visit(dep)
        order.append(name)

    for name in _needs(sql):
        visit(name)
    if not order:
        return sql
    parts = ",\n".join(f"{n} AS {'' if n == 'reach' or n.startswith('steps') else 'MATERIALIZED '}({CTES[n].strip()})" for n in order)
    return f"WITH RECURSIVE {parts}\n{sql.strip()}"
