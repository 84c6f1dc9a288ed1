"""One query per operator over the driver's tables, next to its oracle SQL.

``QUERIES[name]`` takes a :class:`Lake`; ``ORACLES[name]`` is DuckDB SQL over the named expressions of
``oracle.py``. Doubles that different engines may sum in a different order are rounded on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from retailpot import config as c
from retailpot.functions import geo
from retailpot.functions.numeric import half_even
from retailpot.operators import attribution, baseline, boosting, budget, cleaning, clusters, features, holidays, models, profiling, sales, search, serving, spatial
from retailpot.operators import quality as q
from retailpot.plans import fixture_views as fx
from retailpot.plans import oracle as o
from retailpot.plans.lake import Lake
from retailpot.session import cut
from retailpot.sources import ingest, poi
from retailpot.sources.run_store import RunStore

QUERIES: dict[str, Callable[[Lake], DataFrame]] = {}
ORACLES: dict[str, str] = {}
L = fx.FIXTURE.target_label
TX = ("Outlet_ID", "Year", "Month", "Distributor_ID", "Volume_Litres")
TXS = ", ".join(TX)


def query(sql: str | None = None, name: str | None = None):
    def add(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = o.assemble(sql)
        return fn
    return add


def rnd(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column."""
    return df.select(*[half_even(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name) for f in df.schema.fields])


def sql_rnd(doubles: str, digits: int = 4) -> str:
    return ", ".join(f"{o.he(x, digits)} AS {x}" for x in doubles.split())


def fails(df: DataFrame, check: q.Check, *columns: str) -> DataFrame:
    return q.run_checks(df, [check], "d").failed.select(*(columns or TX), q.REASON)


# === sources and sinks =======================================================================

@query("SELECT Distributor_ID, CAST(Year AS INTEGER) AS Year, CAST(Month AS INTEGER) AS Month, Seasonality_Index FROM fx_seasonality")
def ingest_csv(lk):
    raw, bronze, name = f"{lk.root}/raw", f"{lk.root}/bronze", "distributor_seasonality_details"
    ingest.csv_sink(lk.raw("fx_seasonality"), f"{raw}/{name}.csv", ["Distributor_ID", "Year", "Month", "Seasonality_Index"])
    ingest.ingest_csv(lk.spark, raw, bronze, [name, "absent_file"])
    return lk.spark.read.parquet(f"{bronze}/{name}").drop(ingest.ROW_ID)


@query("SELECT Outlet_ID, CAST(Year AS BIGINT) AS Year, CAST(Month AS BIGINT) AS Month, Distributor_ID, Volume_Litres FROM tx")
def canonical_columns(lk):
    return ingest.canonical_columns(lk.raw("fx_transactions")).select(*TX)


@query("SELECT cluster_id, lat, lon, tag_key, tag_value FROM fx_poi")
def poi_json_scan(lk):
    return poi.explode_pois(lk.envelopes()).select("cluster_id", "lat", "lon", F.explode("tags").alias("tag_key", "tag_value"))


@query("SELECT outlet_id, cluster_id FROM links")
def outlet_cluster_link(lk):
    return lk.links()


@query("SELECT poi_id, cluster_id, 'completed' AS status FROM fx_poi WHERE cluster_id % 7 <> 3 UNION ALL SELECT DISTINCT CAST(NULL AS BIGINT), cluster_id, 'failed' FROM fx_poi WHERE cluster_id % 7 = 3")
def poi_manifest_filter(lk):
    """The points of completed tiles, and a row for each tile that is not used."""
    kept = poi.manifest_filter(lk.pois(), lk.manifest()).select("poi_id", "cluster_id", F.lit("completed").alias("status"))
    lost = poi.tile_report(lk.pois(), lk.manifest()).where("not used").select(F.lit(None).cast("long").alias("poi_id"), "cluster_id", "status")
    return kept.unionByName(lost)


@query("SELECT poi_id, CASE WHEN tag_key IN ('amenity', 'shop', 'leisure', 'tourism', 'highway', 'public_transport') THEN tag_value ELSE 'unknown' END AS poi_type, "
       "concat('{\"', tag_key, '\":\"', tag_value, '\"}') AS tags_json FROM fx_poi")
def poi_type_coalesce(lk):
    return lk.pois().select("poi_id", poi.poi_type(F.col("tags")).alias("poi_type"), F.to_json("tags").alias("tags_json"))


@query(f"SELECT Outlet_ID, {o.he('total_volume', 4)} AS total_volume FROM outlets LEFT JOIN sales USING (Outlet_ID)")
def optional_input(lk):
    lk["sales"]
    out = lk["outlets"].select("Outlet_ID")
    for path in (f"{lk.root}/sales", f"{lk.root}/tobit_features"):  # the second does not exist: it adds no column
        t = ingest.optional_input(lk.spark, path)
        out = out if t is None else out.join(t.select("Outlet_ID", "total_volume"), "Outlet_ID", "left")
    return rnd(out)


@query("SELECT * FROM srv_outlets")
def serving_tables(lk):
    return lk["srv_outlets"]


@query("SELECT * FROM srv_allocations")
def serving_tables_allocations(lk):
    return lk["srv_allocations"]


@query(f"SELECT outlet_id, feature, {o.he('contribution', 4)} AS contribution, CAST(NULL AS VARCHAR) AS xai_explanation FROM emb_long")
def serving_tables_contexts(lk):
    ctx = lk["srv_contexts"]
    return rnd(serving.context_contributions(ctx).join(ctx.select("outlet_id", "xai_explanation"), "outlet_id"))


@query("SELECT cluster_id, lat, lon, CASE WHEN tag_key IN ('amenity', 'shop', 'leisure', 'tourism', 'highway', 'public_transport') THEN tag_value ELSE 'unknown' END AS poi_type, '' AS name, "
       "concat('{\"', tag_key, '\":\"', tag_value, '\"}') AS tags_json FROM fx_poi")
def serving_tables_pois(lk):
    return poi.cluster_pois(poi.explode_pois(lk.envelopes()))


@query("SELECT Outlet_ID, Outlet_Size, Cooler_Count FROM outlets")
def parquet_sink(lk):
    path, cols = f"{lk.root}/sink_parquet", ["Outlet_ID", "Outlet_Size", "Cooler_Count"]
    ingest.parquet_sink(lk["outlets"], path, cols)
    return lk.spark.read.parquet(path)


@query("SELECT Outlet_ID, Maximum_Monthly_Liters FROM final")
def csv_sink(lk):
    path = f"{lk.root}/sink_csv"
    ingest.csv_sink(lk["final"], path, ["Outlet_ID", "Maximum_Monthly_Liters"])
    return lk.spark.read.schema("Outlet_ID string, Maximum_Monthly_Liters double").csv(path, header=True)


# === data quality ============================================================================

@query(f"SELECT {TXS}, 'duplicate_record' AS failure_reason FROM (SELECT *, row_number() OVER (PARTITION BY Outlet_ID, Date, Volume_Litres ORDER BY Distributor_ID) AS rn FROM tx) WHERE rn > 1")
def dq_duplicate(lk):
    return fails(lk.transactions(), q.duplicate_check(["Outlet_ID", "Date", "Volume_Litres"], ingest.ROW_ID, order_by=["Distributor_ID"], cluster="Outlet_ID"))


@query(f"SELECT {TXS}, 'null_in_mandatory_field:Volume_Litres' AS failure_reason FROM tx WHERE Volume_Litres IS NULL")
def dq_null(lk):
    return fails(lk.transactions(), q.null_check(["Outlet_ID", "Date", "Volume_Litres"]))


@query(f"SELECT {TXS}, 'referential_integrity_violation:Outlet_ID' AS failure_reason FROM tx WHERE Outlet_ID NOT IN (SELECT Outlet_ID FROM outlets)")
def dq_ref_integrity(lk):
    return fails(lk.transactions(), q.ref_integrity_check("Outlet_ID", lk["outlets"], "Outlet_ID"))


@query(f"SELECT {TXS}, CASE WHEN Volume_Litres IS NULL THEN 'null_in_range_col:Volume_Litres' ELSE 'out_of_range:Volume_Litres:value=' || CAST(Volume_Litres AS VARCHAR) END AS failure_reason "
       "FROM tx WHERE Volume_Litres IS NULL OR Volume_Litres <= 1 OR Volume_Litres >= 49")
def dq_range(lk):
    return fails(lk.transactions(), q.range_check("Volume_Litres", 1.0, 49.0, inclusive=False))


@query("SELECT Outlet_ID, 'format_violation:Outlet_ID:pattern=OUT_\\d{5,}' AS failure_reason FROM fx_outlet_master WHERE NOT regexp_full_match(Outlet_ID, 'OUT_\\d{5,}')")
def dq_format(lk):
    return fails(lk.raw("fx_outlet_master"), q.format_check("Outlet_ID", lk.cfg.outlet_id_pattern), "Outlet_ID")


@query("SELECT Outlet_ID, Outlet_Size, 'invalid_value:Outlet_Size:found=' || coalesce(Outlet_Size, 'None') AS failure_reason FROM fx_outlet_master "
       "WHERE Outlet_Size IS NULL OR lower(Outlet_Size) NOT IN ('small', 'medium', 'large', 'extra large')")
def dq_value_set(lk):
    return fails(lk.raw("fx_outlet_master"), q.value_set_check("Outlet_Size", [s.upper() for s in c.OUTLET_SIZES], case_sensitive=False), "Outlet_ID", "Outlet_Size")


@query(f"SELECT {TXS}, coalesce(failure_reason, 'passed') AS outcome FROM tx_checked")
def dq_run_checks(lk):
    _, run = cleaning.check_transactions(lk.raw("fx_transactions"), lk["outlets"], lk.cfg)
    return run.annotated.select(*TX, F.coalesce(q.REASON, F.lit("passed")).alias("outcome"))


_STEPS = ("duplicate_check", "null_check", "ref_integrity_check", "value_set_check", "range_check")
_STEP_OF = ("CASE WHEN failure_reason = 'duplicate_record' THEN 0 WHEN starts_with(failure_reason, 'null_in_mandatory') THEN 1 WHEN starts_with(failure_reason, 'referential') THEN 2 "
            "WHEN starts_with(failure_reason, 'invalid_value') THEN 3 ELSE 4 END")
REPORT_SQL = f"""
SELECT 'transactions' AS dataset, check_name, total - before AS records_checked, total - before - bad AS records_passed, bad AS records_quarantined, reasons AS failure_reasons
FROM (SELECT s.i, s.check_name, (SELECT count(*) FROM tx_checked) AS total, coalesce(bad, 0) AS bad, coalesce(reasons, '') AS reasons,
  CAST(coalesce(sum(coalesce(bad, 0)) OVER (ORDER BY s.i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM (VALUES {', '.join(f"({i}, '{n}')" for i, n in enumerate(_STEPS))}) s(i, check_name)
  LEFT JOIN (SELECT i, CAST(sum(n) AS BIGINT) AS bad, string_agg(failure_reason, ', ' ORDER BY failure_reason) AS reasons FROM
    (SELECT {_STEP_OF} AS i, regexp_replace(failure_reason, ':(value|found)=.*$', '', 's') AS failure_reason, count(*) AS n FROM tx_checked WHERE failure_reason IS NOT NULL GROUP BY ALL) GROUP BY i) r USING (i))"""


@query(REPORT_SQL)
def dq_report(lk):
    return lk.tx_run().report()


@query(f"""
SELECT 'transactions' AS dataset, check_name, failure_reason, records FROM (SELECT {_STEP_OF} AS i, failure_reason, count(*) AS records FROM tx_checked WHERE failure_reason IS NOT NULL GROUP BY ALL)
JOIN (VALUES {', '.join(f"({i}, '{n}')" for i, n in enumerate(_STEPS))}) s(i, check_name) USING (i)""")
def dq_reason_counts(lk):
    return lk.tx_run().reason_counts()


@query(REPORT_SQL)
def report_append(lk):
    path = f"{lk.root}/dq_report"
    for _ in range(2):  # the second write replaces the first
        ingest.report_append(lk.tx_run().report(), path, "run-1")
    cols = "dataset check_name records_checked records_passed records_quarantined failure_reasons".split()
    return lk.spark.read.parquet(path).select(*cols).withColumn("failure_reasons", F.coalesce("failure_reasons", F.lit("")))


@query("SELECT Outlet_ID, Outlet_Size, Outlet_Type, CAST(NULL AS BOOLEAN) AS size_imputed, failure_reason FROM o_checked WHERE failure_reason IS NOT NULL "
       "UNION ALL SELECT Outlet_ID, Outlet_Size, Outlet_Type, size_imputed, failure_reason FROM o_valid WHERE failure_reason IS NOT NULL")
def quarantine_union(lk):
    return lk.cleaned("outlets").rejected.select("Outlet_ID", "Outlet_Size", "Outlet_Type", "size_imputed", q.REASON)


@query("SELECT 'transactions' AS dataset, count(*) AS records_in, count(failure_reason) AS records_quarantined, count(failure_reason) / count(*) * 100.0 AS quarantine_pct, "
       "count(failure_reason) / count(*) * 100.0 > 30 AS alarm FROM tx_checked")
def quarantine_rate_alarm(lk):
    run = lk.tx_run()
    return q.quarantine_rate(run.passed, run.failed, "transactions")


_CATCHMENT_RULES = {
    "not_null:Outlet_ID": "count(*) FILTER (Outlet_ID IS NULL)", "bounds:competition_density_score": "count(*) FILTER (NOT competition_density_score BETWEEN 0 AND 100)",
    "allowed:market_saturation_class": "count(*) FILTER (market_saturation_class NOT IN ('isolated', 'moderate', 'dense'))",
    "monotone:competitors_500m<=competitors_1km": "count(*) FILTER (competitors_500m > competitors_1km)", "monotone:competitors_1km<=competitors_2km": "count(*) FILTER (competitors_1km > competitors_2km)",
    "bounds:competitors_1km": "count(*) FILTER (NOT competitors_1km BETWEEN 0 AND 5)", "unique:Outlet_ID": "count(Outlet_ID) - count(DISTINCT Outlet_ID)",
    "row_count:outlets": "abs(count(*) - (SELECT count(*) FROM outlets))",
}


def _rules_sql(rules: dict[str, str], table: str) -> str:
    """One row per rule with its violations counted in ``table``."""
    return " UNION ALL ".join(f"SELECT '{n}' AS rule, CAST({x} AS BIGINT) AS violations, {x} = 0 AS ok FROM {table}" for n, x in rules.items())


@query(_rules_sql(_CATCHMENT_RULES, "catchment") + " UNION ALL " + _rules_sql({"implies:score_needs_data": "count(*) FILTER (composite_gravity_score > 1 AND NOT gravity_data_available)"}, "gravity"))
def expectations(lk):
    t, g = lk["catchment"], lk["gravity"]
    a = q.expect(t, [*q.not_null("Outlet_ID"), q.bounds("competition_density_score", 0, 100), q.allowed("market_saturation_class", ("isolated", "moderate", "dense")),
                     *q.monotone("competitors_500m", "competitors_1km", "competitors_2km"), q.bounds("competitors_1km", 0, 5)], unique=["Outlet_ID"])
    b = q.expect(g, [q.implies("score_needs_data", F.col("composite_gravity_score") > 1, F.col("gravity_data_available"))])
    return a.unionByName(b).unionByName(q.same_count(t, lk["outlets"], "outlets"))


def _health_sql(dataset: str, good: str, bad: str, base: str) -> str:
    return f"""
SELECT '{dataset}' AS dataset, g + coalesce(b, 0) AS records_checked, g AS records_passed, coalesce(b, 0) AS records_quarantined, coalesce(b, 0) / (g + coalesce(b, 0)) AS quarantine_rate,
  CAST(to_json(list_concat(coalesce(list_transform(l, lambda x: {{'check_name': 'Valid ' || {o.title("replace(x.reason, '_', ' ')")}, 'passed': g + b - x.n, 'quarantined': x.n, 'failure_reason': x.reason}}), []),
  [{{'check_name': '{base}', 'passed': g, 'quarantined': CAST(0 AS BIGINT), 'failure_reason': 'None'}}])) AS VARCHAR) AS check_details_json
FROM (SELECT count(*) AS g FROM {good}) CROSS JOIN (SELECT CAST(sum(n) AS BIGINT) AS b, list({{'reason': reason, 'n': n}} ORDER BY n DESC, reason) AS l FROM
  (SELECT regexp_replace(failure_reason, ':(value|found)=.*$', '', 's') AS reason, count(*) AS n FROM {bad} GROUP BY ALL))"""


HEALTH_SQL = _health_sql("outlet_coordinates", "coordinates", "c_rejected", "Valid Lat/Lon Coordinates") + " UNION ALL " + _health_sql("transactions", "transactions", "tx_rejected", "Valid Transactions")


@query(HEALTH_SQL)
def pipeline_health(lk):
    return lk.health()


@query(HEALTH_SQL)
def read_health(lk):
    return serving.read_health(lk.health())


@query(f"""
SELECT CAST(sum(records_checked) AS BIGINT) AS total_checked, CAST(sum(records_passed) AS BIGINT) AS total_passed, CAST(sum(records_quarantined) AS BIGINT) AS total_quarantined,
  {o.he('sum(records_passed) / sum(records_checked)', 6)} AS overall_pass_rate, {o.he('sum(records_quarantined) / sum(records_checked)', 6)} AS overall_quarantine_rate,
  {o.he('avg(records_passed / records_checked)', 6)} AS average_dataset_health, sum(records_passed) / sum(records_checked) > 0.99 AS is_healthy FROM ({HEALTH_SQL})""")
def health_summary(lk):
    return rnd(q.health_summary(lk.health()), 6)


_FINAL_RULES = {
    "not_null:Outlet_ID": "count(*) FILTER (Outlet_ID IS NULL)", "not_null:Maximum_Monthly_Liters": "count(*) FILTER (Maximum_Monthly_Liters IS NULL)",
    "bounds:Maximum_Monthly_Liters": "count(*) FILTER (Maximum_Monthly_Liters <= 0)", "unique:Outlet_ID": "count(Outlet_ID) - count(DISTINCT Outlet_ID)",
    "row_count:predictions": "abs(count(*) - (SELECT count(*) FROM master))",
}


@query(_rules_sql(_FINAL_RULES, "final") + " UNION ALL " + _rules_sql({"allocation_rows_in_band": "CAST(NOT (count(*) BETWEEN 10 AND 100000) AS INTEGER)"}, "allocation"))
def output_validation(lk):
    f = lk["final"]
    rows = q.expect(f, [*q.not_null("Outlet_ID", "Maximum_Monthly_Liters"), q.Rule("bounds:Maximum_Monthly_Liters", F.col("Maximum_Monthly_Liters") <= 0)], unique=["Outlet_ID"])
    band = ~F.count("*").between(10, 100_000)
    alloc = lk["allocation"].agg(band.cast("long").alias("violations")).select(F.lit("allocation_rows_in_band").alias("rule"), "violations", (F.col("violations") == 0).alias("ok"))
    return rows.unionByName(q.same_count(f, lk["master"], "predictions")).unionByName(alloc)


# === cleaning and calendar ===================================================================

@query("SELECT Outlet_ID, Date, Volume_Litres AS Volume_Liters FROM tx")
def synth_month_date(lk):
    return cleaning.synth_month_date(lk.raw("fx_transactions")).select("Outlet_ID", "Date", "Volume_Liters")


@query(f"SELECT {TXS}, 'date_out_of_expected_range' AS failure_reason FROM tx WHERE Year < 1996 OR Year > 2000")
def date_range_quarantine(lk):
    return fails(lk.transactions(), cleaning.date_range_check(replace(lk.cfg, tx_years=(1996, 2000))))


@query(f"SELECT Outlet_ID, CASE WHEN t IN ('Nan', 'None', '') THEN NULL ELSE t END AS Outlet_Size FROM (SELECT Outlet_ID, {o.title('trim(Outlet_Size)')} AS t FROM fx_outlet_master)")
def normalise_title(lk):
    return lk.raw("fx_outlet_master").select("Outlet_ID", cleaning.normalise_title(F.col("Outlet_Size")).alias("Outlet_Size"))


@query(f"SELECT Outlet_ID, coalesce(Outlet_Size, {o.case_map('Cooler_Count', c.SIZE_BY_COOLERS, chr(39) + 'Small' + chr(39))}) AS Outlet_Size, Outlet_Size IS NULL AS size_imputed FROM fx_outlet_master")
def impute_lookup(lk):
    size = F.col("Outlet_Size")
    return lk.raw("fx_outlet_master").select("Outlet_ID", cleaning.impute_size(size, F.col("Cooler_Count")).alias("Outlet_Size"), size.isNull().alias("size_imputed"))


@query("SELECT trim(Outlet_Type) AS found, count(*) AS corrected, 'Grocery' AS replaced_by FROM fx_outlet_master WHERE trim(Outlet_Type) = 'Grocry' GROUP BY ALL")
def typo_map(lk):
    return cleaning.typo_counts(lk.raw("fx_outlet_master"), "Outlet_Type")


@query("SELECT Outlet_ID, Outlet_Size, Outlet_Type, failure_reason FROM o_valid WHERE failure_reason IS NOT NULL")
def valid_set_quarantine(lk):
    return lk.cleaned("outlets").rejected.where("size_imputed is not null").select("Outlet_ID", "Outlet_Size", "Outlet_Type", q.REASON)


@query("SELECT Outlet_ID, 'zero_coordinates' AS failure_reason FROM fx_outlet_coordinates WHERE Latitude = 0 AND Longitude = 0")
def zero_coord_quarantine(lk):
    return fails(lk.raw("fx_outlet_coordinates"), cleaning.zero_coordinates(), "Outlet_ID")


@query("SELECT Outlet_ID, CASE WHEN Latitude > 50 THEN Longitude ELSE Latitude END AS Latitude, CASE WHEN Latitude > 50 THEN Latitude ELSE Longitude END AS Longitude, Latitude > 50 AS coords_swapped FROM fx_outlet_coordinates")
def swap_latlon(lk):
    return cleaning.swap_latlon(lk.raw("fx_outlet_coordinates")).select("Outlet_ID", "Latitude", "Longitude", "coords_swapped")


@query("SELECT Outlet_ID, failure_reason FROM c_rejected")
def bbox_quarantine(lk):
    return lk.cleaned("coordinates").rejected.select("Outlet_ID", q.REASON)


@query("""
SELECT Outlet_ID, Date, Volume_Litres, Volume_Litres > CASE WHEN n < 4 THEN g3 + 0.25e0 * (g3 - g1) ELSE q3 + 0.25e0 * (q3 - q1) END AS is_volume_outlier FROM transactions
JOIN (SELECT Outlet_ID, count(*) AS n, quantile_cont(Volume_Litres, 0.25) AS q1, quantile_cont(Volume_Litres, 0.75) AS q3 FROM transactions GROUP BY Outlet_ID) USING (Outlet_ID)
CROSS JOIN (SELECT quantile_cont(Volume_Litres, 0.25) AS g1, quantile_cont(Volume_Litres, 0.75) AS g3 FROM transactions)""")
def iqr_outlier_flag(lk):
    return cleaning.iqr_outlier_flag(lk["transactions"].drop("is_volume_outlier"), replace(lk.cfg, iqr_factor=0.25)).select("Outlet_ID", "Date", "Volume_Litres", "is_volume_outlier")


@query("""
SELECT a.Outlet_ID, CAST(m.i // 12 AS INTEGER) AS Year, CAST(m.i % 12 + 1 AS INTEGER) AS Month FROM (SELECT Outlet_ID, min(i) AS lo, max(i) AS hi FROM
  (SELECT Outlet_ID, Year * 12 + Month - 1 AS i FROM transactions) GROUP BY Outlet_ID HAVING count(DISTINCT i) >= 2) a
JOIN (SELECT DISTINCT Year * 12 + Month - 1 AS i FROM transactions) m ON m.i > a.lo AND m.i < a.hi
ANTI JOIN (SELECT DISTINCT Outlet_ID, Year * 12 + Month - 1 AS i FROM transactions) t ON t.Outlet_ID = a.Outlet_ID AND t.i = m.i""")
def blackout_months(lk):
    return cleaning.blackout_months(lk["transactions"])


@query("SELECT row_id, date AS date_parsed FROM fx_holidays WHERE row_id % 40 <> 0")
def parse_holiday_dates(lk):
    raw = lk.raw("fx_holidays")
    text = F.when(F.col("row_id") % 40 == 0, F.lit("not a date")).otherwise(F.concat(F.col("Date").cast("string"), F.lit("T00:00:00+00:00")))
    return holidays.parse_holiday_dates(raw.withColumn("Date", text)).select("row_id", "date_parsed")


@query("SELECT * FROM h_pivot")
def holiday_pivot(lk):
    run = q.run_checks(holidays.parse_holiday_dates(lk.raw("fx_holidays")), holidays.holiday_checks(), "holidays")
    return holidays.holiday_pivot(run.passed, "date_parsed", "row_id")


@query("SELECT * FROM calendar")
def append_calendar_rows(lk):
    return holidays.clean_holidays(lk.raw("fx_holidays"), lk.cfg)[0]


@query("SELECT * FROM days")
def trading_days(lk):
    return holidays.trading_days(lk["calendar"], lk.cfg)


@query(f"""
SELECT d AS Distributor_ID, CAST(y AS INTEGER) AS Year, CAST(m AS INTEGER) AS Month FROM (VALUES {', '.join(f"('{d}')" for d in c.DISTRIBUTORS)}) v(d), generate_series(1995, 2001) a(y), generate_series(1, 12) e(m)
ANTI JOIN fx_seasonality s ON s.Distributor_ID = d AND s.Year = y AND s.Month = m""")
def seasonality_completeness(lk):
    return cleaning.seasonality_completeness(lk.raw("fx_seasonality"), lk.cfg)


@query("SELECT * FROM seasonality")
def seasonality_extrapolate(lk):
    return cleaning.clean_seasonality(lk.raw("fx_seasonality"), lk.cfg).clean


@query("SELECT Distributor_ID, Year, Month, Seasonality_Index FROM fx_seasonality")
def fail_on_quarantine(lk):
    return q.fail_on_quarantine(q.run_checks(lk.raw("fx_seasonality"), cleaning.seasonality_checks(lk.cfg), "seasonality")).drop(ingest.ROW_ID)


# === sales ===================================================================================

def _series(lk) -> DataFrame:
    tx = lk["transactions"]
    return sales.series(sales.monthly_agg(tx), sales.month_span(tx))


def _sales(make, sql: str, name: str) -> None:
    query(sql, name)(lambda lk: rnd(_series(lk).select("Outlet_ID", *[x.alias(k) for k, x in make().items()])))


@query("SELECT * FROM monthly")
def monthly_agg(lk):
    return sales.monthly_agg(lk["transactions"])


@query("SELECT Outlet_ID, Year, Month, v AS monthly_volume FROM grid")
def dense_month_grid(lk):
    return sales.dense_month_grid(sales.monthly_agg(lk["transactions"]), sales.month_span(lk["transactions"]))


_sales(sales.hist_stats, f"SELECT Outlet_ID, {sql_rnd('hist_max_monthly hist_mean_monthly hist_std_monthly total_volume')} FROM g_stats", "hist_stats")
_sales(sales.hist_quantiles, f"SELECT Outlet_ID, {sql_rnd('hist_p90_monthly hist_p75_monthly')} FROM g_stats", "hist_quantiles")
_sales(sales.hist_cv, f"SELECT Outlet_ID, {sql_rnd('hist_cv')} FROM g_stats", "hist_cv")
_sales(sales.active_months, f"SELECT Outlet_ID, active_months, {sql_rnd('active_months_pct')} FROM g_stats", "active_months")
_sales(sales.january_features, f"SELECT Outlet_ID, jan_count, {sql_rnd('jan_avg_volume jan_max_volume')} FROM g_stats", "january_features")
_sales(sales.max_zero_run, "SELECT * FROM g_runs", "max_zero_run")
_sales(sales.months_since_last, "SELECT Outlet_ID, months_since_last_order FROM g_stats", "months_since_last")
_sales(sales.recent_3m_avg, f"SELECT Outlet_ID, {sql_rnd('recent_3m_avg')} FROM g_stats", "recent_3m_avg")
_sales(sales.trend_slope, f"SELECT Outlet_ID, {sql_rnd('trend_slope')} FROM g_stats", "trend_slope")
_sales(sales.yoy_growth, f"SELECT Outlet_ID, {sql_rnd('yoy_growth_rate')} FROM g_yoy", "yoy_growth")
_sales(sales.ema, f"SELECT Outlet_ID, {sql_rnd('ema_3m ema_6m')} FROM g_stats", "ema")


@query("SELECT * FROM g_mode")
def mode_distributor(lk):
    return sales.mode_distributor(lk["transactions"])


@query("SELECT Outlet_ID, coalesce(m.distributor_id, (SELECT d FROM g_global)) AS distributor_id FROM outlets LEFT JOIN g_mode m USING (Outlet_ID)")
def global_mode_fill(lk):
    tx = lk["transactions"]
    return lk["outlets"].select("Outlet_ID").join(sales.mode_distributor(tx), "Outlet_ID", "left").withColumn(
        "distributor_id", F.coalesce("distributor_id", sales.global_mode(tx)))


_SALES_FLOATS = [x for x in o.FLOATS if x in sales.SALES_COLUMNS]


@query(f"SELECT * REPLACE ({sql_rnd(' '.join(_SALES_FLOATS))}) FROM sales")
def sales_features(lk):
    return rnd(sales.sales_features(lk["transactions"], lk["outlets"]))


# === spatial =================================================================================

@query(f"SELECT poi_id, {o.poi_case(c.FLAT_POI_RULES)} AS flat_category, {o.poi_case(c.GRAVITY_POI_RULES)} AS gravity_category FROM fx_poi")
def classify_poi(lk):
    t = F.col("tags")
    return lk.pois().select("poi_id", spatial.classify_poi(t, c.FLAT_POI_RULES).alias("flat_category"), spatial.classify_poi(t, c.GRAVITY_POI_RULES).alias("gravity_category"))


@query("SELECT lat, lon, category FROM poi_grav")
def poi_dedup(lk):
    return spatial.poi_dedup(lk.pois())


def _outlet_poi(lk) -> DataFrame:
    """Each outlet beside the POI of its own number."""
    k = F.substring("Outlet_ID", 5, 20).cast("long")
    return lk["coordinates"].join(lk.pois().select(F.col("poi_id"), F.col("lat").alias("plat"), F.col("lon").alias("plon")), k == F.col("poi_id"))


_PAIR = "FROM pt a JOIN fx_poi b ON CAST(substr(a.Outlet_ID, 5) AS BIGINT) = b.poi_id"


@query(f"SELECT Outlet_ID, {o.he(o.hav('a', 'b') + ' * 1000', 3)} AS metres {_PAIR}")
def haversine(lk):
    d = geo.haversine_km(F.col("Latitude"), F.col("Longitude"), F.col("plat"), F.col("plon")) * 1000
    return rnd(_outlet_poi(lk).select("Outlet_ID", d.alias("metres")), 3)


@query(f"SELECT Outlet_ID, {o.he(o.lambert('a', 'b'), 3)} AS metres {_PAIR}")
def geodesic(lk):
    df = _outlet_poi(lk).withColumns({"b1": geo.reduced_latitude(F.col("Latitude")), "b2": geo.reduced_latitude(F.col("plat"))})
    return rnd(geo.with_geodesic_m(df, "metres", "b1", "Longitude", "b2", "plon").select("Outlet_ID", "metres"), 3)


@query(o.POI_COUNTS_SERVED)
def poi_radius_counts(lk):
    """Counts over completed tiles; outlets of failed ones are flagged."""
    done = lk.links().join(poi.tile_report(lk.pois(), lk.manifest()).where("used").select("cluster_id"), "cluster_id", "left_semi")
    return spatial.poi_radius_counts(lk["coordinates"], lk["outlets"], poi.manifest_filter(lk.pois(), lk.manifest()), lk.cfg, done)


@query("SELECT * FROM poi")
def footfall_score(lk):
    return spatial.poi_features(lk["coordinates"], lk["outlets"], lk.pois(), lk.cfg)


@query("SELECT * FROM grav_scored")
def gravity_score(lk):
    return spatial.gravity_scores(lk["coordinates"], lk.pois(), lk.cfg)


@query("SELECT * FROM gravity")
def gravity_composite(lk):
    return spatial.gravity_features(lk["coordinates"], lk["outlets"], lk.pois(), lk.cfg)


@query("SELECT * FROM competitors")
def competitor_counts(lk):
    return spatial.competitor_counts(lk["coordinates"], lk.cfg)


@query("SELECT Outlet_ID, competition_density_score FROM catch_scored")
def density_score(lk):
    return spatial.density_score(lk["catchment"].join(lk["coordinates"], "Outlet_ID", "left_semi").drop("competition_density_score")).select("Outlet_ID", "competition_density_score")


@query("SELECT Outlet_ID, market_saturation_class FROM catch_scored")
def saturation_class(lk):
    return spatial.saturation_class(lk["catchment"].join(lk["coordinates"], "Outlet_ID", "left_semi").drop("market_saturation_class")).select("Outlet_ID", "market_saturation_class")


@query("SELECT * FROM catchment")
def append_missing_points(lk):
    return spatial.catchment_features(lk["coordinates"], lk["outlets"], lk.cfg)


@query("SELECT * FROM clusters")
def dbscan(lk):
    return clusters.dbscan(lk["coordinates"], lk.cfg)


@query(f"SELECT * REPLACE ({sql_rnd('cluster_mean_volume cluster_p90_volume')}) FROM cluster_stats")
def cluster_stats(lk):
    return rnd(clusters.cluster_stats(lk["clusters"], lk["sales"]))


@query()
def kmeans_tiles(lk):
    return spatial.kmeans_tiles(lk["coordinates"], lk.cfg)[1]


@query("SELECT * FROM sea")
def point_in_polygon(lk):
    return lk.sea().withColumnRenamed("outlet_id", "Outlet_ID")


@query(f"SELECT a.Outlet_ID, b.poi_id, b.cluster_id, CAST(floor(d * 1000.0 + 0.5) AS BIGINT) AS distance_meters FROM (SELECT pt.*, cluster_id FROM pt JOIN links ON links.outlet_id = pt.Outlet_ID) a "
       f"JOIN fx_poi b ON a.cluster_id = b.cluster_id, LATERAL (SELECT {o.hav('a', 'b')} AS d) WHERE d <= 2.0")
def pois_near_outlet(lk):
    return spatial.pois_near_outlet(lk["coordinates"].select("Outlet_ID", "Latitude", "Longitude"), lk.links(), lk.pois(), lk.cfg, columns=("poi_id", "cluster_id"))


def _joined(lk) -> DataFrame:
    season = features.seasonality_lookup(lk["seasonality"], lk.cfg)
    return features.master_join(lk["outlets"], lk["coordinates"], season, lk.required(), {"cooler": lk["cooler"], "spatial": lk["spatial"], "tobit": None})


@query(f"SELECT Outlet_ID, {sql_rnd('Latitude Longitude', 6)} FROM filled")
def centroid_fill(lk):
    df = _joined(lk).withColumn("province", features.derive_province(F.col("distributor_id")))
    return rnd(features.centroid_fill(df).select("Outlet_ID", "Latitude", "Longitude"), 6)


# === physical ceiling and assembly ===========================================================

@query("SELECT Outlet_ID, cooler_capacity_litres, theoretical_monthly_ceiling FROM cooler")
def cooler_ceiling(lk):
    return lk["outlets"].withColumns(features.cooler_ceiling(lk.cfg)).select("Outlet_ID", "cooler_capacity_litres", "theoretical_monthly_ceiling")


@query(f"SELECT Outlet_ID, {sql_rnd('capacity_utilization_ratio')} FROM cooler")
def capacity_utilisation(lk):
    return rnd(features.cooler_features(lk["outlets"], lk["sales"], lk.cfg).select("Outlet_ID", "capacity_utilization_ratio"))


@query("SELECT * FROM season_lookup")
def seasonality_lookup(lk):
    return features.seasonality_lookup(lk["seasonality"], lk.cfg)


_JOIN_FLOATS = " ".join(x for x in o.FLOATS if x in ("Latitude", "Longitude", "hist_p90_monthly", "footfall_score", "composite_gravity_score", "cluster_mean_volume", "capacity_utilization_ratio"))


@query(f"SELECT Outlet_ID, Outlet_Size, distributor_id, competitors_1km, micro_market_id, seasonality_{L}, {sql_rnd(_JOIN_FLOATS)} FROM joined")
def master_join(lk):
    return rnd(_joined(lk).select("Outlet_ID", "Outlet_Size", "distributor_id", "competitors_1km", "micro_market_id", f"seasonality_{L}", *_JOIN_FLOATS.split()))


@query(f"SELECT Outlet_ID, {L}_trading_days, {L}_holiday_count FROM filled")
def scalar_features(lk):
    return features.scalar_features(lk["outlets"], lk["days"], lk.cfg).select("Outlet_ID", f"{L}_trading_days", f"{L}_holiday_count")


@query("SELECT Outlet_ID, province FROM filled")
def derive_province(lk):
    return lk["sales"].select("Outlet_ID", features.derive_province(F.col("distributor_id")).alias("province"))


@query(f"SELECT Outlet_ID, coords_swapped, exclude_from_training, has_transaction_history, seasonality_{L}, seasonality_multiplier_{L}, {sql_rnd('trend_slope yoy_growth_rate')} FROM filled")
def null_policy(lk):
    df = _joined(lk).withColumn("province", features.derive_province(F.col("distributor_id")))
    return rnd(features.null_policy(df, lk.cfg).select("Outlet_ID", "coords_swapped", "exclude_from_training", "has_transaction_history", f"seasonality_{L}",
                                                       f"seasonality_multiplier_{L}", "trend_slope", "yoy_growth_rate"))


@query("SELECT * FROM master")
def round_floats(lk):
    return lk._build_master()


# === baseline ================================================================================

@query(f"SELECT Outlet_Size, {sql_rnd('size_median', 5)} FROM size_med")
def size_medians(lk):
    return rnd(baseline.size_medians(lk["master"]), 5)


@query(f"SELECT Outlet_ID, {sql_rnd('cold_start')} FROM cold")
def cold_start_potential(lk):
    return rnd(baseline.cold_start_potential(lk["master"]).select("Outlet_ID", "cold_start"))


@query(f"SELECT Outlet_ID, {o.he(o.RECENCY, 6)} AS recency_factor FROM master")
def recency_factor(lk):
    return rnd(lk["master"].select("Outlet_ID", baseline.recency_factor(F.col("ema_3m"), F.col("hist_mean_monthly")).alias("recency_factor")), 6)


@query(f"SELECT Outlet_ID, {o.he(o.UPLIFT, 6)} AS poi_uplift FROM master")
def poi_uplift(lk):
    return rnd(lk["master"].select("Outlet_ID", baseline.poi_uplift(F.col("composite_gravity_score")).alias("poi_uplift")), 6)


@query("SELECT * FROM baseline")
def baseline_potential(lk):
    return baseline.baseline_potential(lk["master"], lk.cfg)


@query(f"""
SELECT min(v) AS min, {o.he('avg(v)', 4)} AS mean, max(v) AS max, count(*) FILTER (demand_path = 'january') AS n_january, count(*) FILTER (demand_path = 'p90') AS n_p90,
  count(*) FILTER (demand_path = 'cold_start') AS n_cold_start, {o.he('quantile_cont(v, 0.5)', 4)} AS median, {o.he('quantile_cont(v, 0.9)', 4)} AS p90 FROM (SELECT demand_path, baseline_potential_litres AS v FROM baseline)""")
def baseline_summary(lk):
    return rnd(baseline.baseline_summary(lk["baseline"]))


# === models ==================================================================================

@query(f"SELECT Outlet_ID, {sql_rnd('target')} FROM train")
def training_target(lk):
    return rnd(models.training_target(lk["master"], lk.cfg).select("Outlet_ID", "target"))


def _strategies_sql() -> str:
    """What each strategy leaves out, over one row per column of the master table with its filled cells and mean."""
    crossed = ", ".join(f"{a} * {b} AS {n}" for n, (a, b) in models.INTERACTIONS.items())
    wide, text = f"SELECT *, {crossed} FROM master", ("Outlet_ID", "distributor_id", f"seasonality_{L}", *models.CATEGORICALS)
    filled = f"SELECT feature, filled FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM ({wide})) ON COLUMNS(*) INTO NAME feature VALUE filled)"
    mean = f"SELECT feature, mean FROM (UNPIVOT (SELECT avg(CAST(COLUMNS(* EXCLUDE ({', '.join(text)})) AS DOUBLE)) FROM ({wide})) ON COLUMNS(*) INTO NAME feature VALUE mean)"
    parts = []
    for name, (groups, interactions) in models.STRATEGIES.items():
        out = set(models.base_exclude(fx.FIXTURE)).union(*groups, () if interactions else models.INTERACTIONS)
        parts.append(f"SELECT '{name}' AS strategy, feature, filled, {o.he('mean', 4)} AS mean FROM columns_ WHERE feature NOT IN {o.in_list(sorted(out))}")
    return f"SELECT * FROM (WITH columns_ AS (SELECT * FROM ({filled}) LEFT JOIN ({mean}) USING (feature)) {' UNION ALL '.join(parts)})"


@query(_strategies_sql())
def feature_strategies(lk):
    return rnd(models.strategy_table(lk["master"], lk.cfg))


@query("SELECT Outlet_ID, " + ", ".join(f"{o.he(f'{a} * {b}', 4)} AS {n}" for n, (a, b) in models.INTERACTIONS.items()) + " FROM master")
def interaction_features(lk):
    return rnd(models.interaction_features(lk["master"]).select("Outlet_ID", *models.INTERACTIONS))


@query("SELECT Outlet_ID, " + ", ".join(f"CAST((SELECT count(DISTINCT b.{x}) FROM master b WHERE b.{x} < m.{x}) AS DOUBLE) AS {x}_code" for x in models.CATEGORICALS) + " FROM master m")
def encode_categoricals(lk):
    df, codes = models.encode_categoricals(lk["master"])
    return df.select("Outlet_ID", *codes)


@query()
def kfold_cv(lk):
    return models.kfold_cv(lk.prepared().train, lk.forest(), lk.cfg)


@query()
def train_regressor(lk):
    return lk.boosted()[2]


@query()
def feature_importance(lk):
    prep, model, _ = lk.boosted()
    return models.feature_importance(lk.spark, model.fitted.model, prep.features)


@query()
def param_search(lk):
    space = {"numTrees": search.Integer(2, 6), "maxDepth": search.Integer(2, 5), "minInstancesPerNode": search.Integer(1, 10), "featureSubsetStrategy": search.Float(0.3, 1.0)}
    make = lambda p: lk.forest(**{**p, "featureSubsetStrategy": str(p["featureSubsetStrategy"])})
    train = lk.once("search_rows", lambda: cut(lk.prepared().train.select("Outlet_ID", "features", "target", "fold")))
    study = search.Study(lk.spark, f"{lk.root}/trials", space, lk.cfg.seed)
    return study.run(search.cross_validated_rmse(train, lk.cfg.folds, make), 20)


@query()
def oof_predict(lk):
    return models.oof_predict(lk.prepared().train, lk.prepared().all, lk.forest(), lk.cfg, "prediction_oof")


_LIMITED = "capacity_utilization_ratio >= 0.8"


@query(f"SELECT Outlet_ID, greatest(hist_p90_monthly, 1e-3) AS lower_bound, CASE WHEN NOT ({_LIMITED}) THEN greatest(hist_p90_monthly, 1e-3) END AS upper_bound, CASE WHEN {_LIMITED} THEN 0e0 ELSE 1e0 END AS censor FROM train")
def censor_labels(lk):
    return models.censor_labels(models.training_target(lk["master"], lk.cfg)).select("Outlet_ID", "lower_bound", "upper_bound", "censor")


@query()
def latent_demand(lk):
    booster = boosting.Booster(boosting.censored_normal(), rounds=8, depth=4, rate=0.3, subsample=0.8, seed=lk.cfg.seed)
    return models.latent_demand(lk.prepared(), lk.cfg, booster)


@query(f"SELECT Outlet_ID, {o.he('greatest(model_prediction / greatest(hist_p90_monthly, 1e-3) - 1.0, 0.0)', 4)} AS tobit_censoring_ratio FROM master JOIN blend USING (Outlet_ID)")
def censoring_ratio(lk):
    return lk["master"].join(lk["blend"], "Outlet_ID").select("Outlet_ID", models.censoring_ratio(F.col("model_prediction"), F.col("hist_p90_monthly")).alias("tobit_censoring_ratio"))


@query()
def hurdle_active_prob(lk):
    return models.hurdle_active_prob(lk.prepared(), lk.cfg)


@query()
def hurdle_conditional(lk):
    return models.hurdle_conditional(lk.prepared(), lk.cfg, models.regressor("gbt", lk.cfg, maxIter=5, maxDepth=3))


@query(f"SELECT Outlet_ID, p_active, hurdle_conditional_volume, {o.he('p_active * hurdle_conditional_volume', 4)} AS hurdle_estimate FROM "
       "(SELECT Outlet_ID, active_months_pct AS p_active, model_prediction AS hurdle_conditional_volume FROM master JOIN blend USING (Outlet_ID))")
def hurdle_estimate(lk):
    prob = lk["master"].select("Outlet_ID", F.col("active_months_pct").alias("p_active"))
    return models.hurdle_estimate(prob, lk["blend"].select("Outlet_ID", F.col("model_prediction").alias("hurdle_conditional_volume")))


@query("SELECT * FROM blend")
def ensemble_blend(lk):
    return models.ensemble_blend(lk.model_tables(), [0.4, 0.4, 0.2])


@query("SELECT * FROM final")
def floor_blend(lk):
    own = lk["blend"].join(lk["master"].select("Outlet_ID"), "Outlet_ID", "left_semi")
    return models.floor_blend(own, lk["baseline"])


@query("SELECT metric, " + o.he("value", 4) + " AS value FROM (SELECT " + ", ".join(f"quantile_cont(Maximum_Monthly_Liters, {p}) AS p{round(p * 100):02d}" for p in models.PERCENTILES)
       + ", CAST(count(*) FILTER (Maximum_Monthly_Liters > 5 * (SELECT quantile_cont(Maximum_Monthly_Liters, 0.99) FROM final)) AS DOUBLE) AS above_5x_p99, "
       "CAST(count(*) FILTER (baseline_potential_litres >= model_prediction) AS DOUBLE) AS baseline_won, CAST(count(*) FILTER (model_prediction > baseline_potential_litres) AS DOUBLE) AS model_won FROM final) "
       "UNPIVOT (value FOR metric IN (p10, p25, p50, p75, p90, p95, p99, above_5x_p99, baseline_won, model_won))")
def prediction_distribution(lk):
    return rnd(models.prediction_distribution(lk["final"]))


_DIAG = [{"seasonality": f"seasonality_{L}", "seasonality_multiplier": f"seasonality_multiplier_{L}"}.get(x, x) for x in models.DIAGNOSTICS if x != "poi_total_1km"]


@query(f"SELECT {', '.join(_DIAG)} FROM master JOIN final USING (Outlet_ID)")
def prediction_diagnostics(lk):
    return models.prediction_diagnostics(lk["final"], lk["master"], lk.cfg)


@query()
def feature_contributions(lk):
    prep, model, _ = lk.boosted()
    return attribution.feature_contributions(model.assembled(prep.all), model.fitted.model, prep.features)


@query()
def run_registry(lk):
    """Two runs stored with model, predictions and importance, and their blend by parts of their ids."""
    store, prep = RunStore(lk.spark, f"{lk.root}/runs_store"), lk.prepared()
    for depth in (3, 6):
        forest = lk.forest(numTrees=5, maxDepth=depth)
        model, predictions = models.train_regressor(prep, forest)
        entry = models.registry_entry(lk.spark, f"run-depth-{depth}", "randomforest", "strategyC", prep.features, models.kfold_cv(prep.train, forest, lk.cfg))
        store.save(entry, PipelineModel([*prep.pipeline.stages, model]), predictions, models.feature_importance(lk.spark, model, prep.features))
    blend = store.blend(["depth-3", "depth-6"], [0.4, 0.6]).withColumnRenamed("model_prediction", "blend")
    own = [store.predictions(f"depth-{d}").withColumnRenamed("model_prediction", f"depth_{d}") for d in (3, 6)]
    return blend.join(own[0], "Outlet_ID").join(own[1], "Outlet_ID")


# === budget ==================================================================================

@query("SELECT Outlet_ID, Maximum_Monthly_Liters, uplift_gap_litres FROM gap")
def uplift_gap(lk):
    return budget.uplift_gap(lk["master"], lk["final"], lk.cfg.budget).select("Outlet_ID", "Maximum_Monthly_Liters", "uplift_gap_litres")


@query(f"SELECT Outlet_ID, {sql_rnd('roi_score', 8)} FROM scored")
def roi_score(lk):
    return rnd(budget.roi_score(budget.uplift_gap(lk["master"], lk["final"], lk.cfg.budget)).select("Outlet_ID", "roi_score"), 8)


@query("SELECT Outlet_ID, roi_rank, allocation_tier FROM tiers")
def roi_rank_tiers(lk):
    b = lk.cfg.budget
    return budget.roi_rank_tiers(budget.roi_score(budget.uplift_gap(lk["master"], lk["final"], b)), b).select("Outlet_ID", "roi_rank", "allocation_tier")


def _tiers(lk) -> DataFrame:
    b = lk.cfg.budget
    return budget.roi_rank_tiers(budget.roi_score(budget.uplift_gap(lk["master"], lk["final"], b)), b)


@query("SELECT Outlet_ID, allocation_tier FROM guarded")
def tier_guardrails(lk):
    return budget.tier_guardrails(_tiers(lk)).select("Outlet_ID", "allocation_tier")


@query("SELECT Outlet_ID, allocation_tier, tier_cap, tier_floor, volume_per_lkr, recommended_spend_type FROM with_params")
def tier_parameters(lk):
    return budget.tier_parameters(budget.tier_guardrails(_tiers(lk))).select("Outlet_ID", "allocation_tier", "tier_cap", "tier_floor", "volume_per_lkr", "recommended_spend_type")


@query("SELECT Outlet_ID, allocation_tier, recommended_spend_type, max_headroom_allocation FROM limits")
def headroom_limit(lk):
    return budget.limits(lk["master"], lk["final"], lk.cfg.budget).select("Outlet_ID", "allocation_tier", "recommended_spend_type", "max_headroom_allocation")


_SP = budget.SPEND


@query(f"SELECT Outlet_ID, allocation_tier, {_SP} FROM greedy")
def greedy_tier_budget(lk):
    return budget.greedy_tier_budget(lk["limits"], lk.cfg.budget).select("Outlet_ID", "allocation_tier", _SP)


@query(f"SELECT Outlet_ID, allocation_tier, {_SP} FROM spread")
def leftover_redistribution(lk):
    return budget.leftover_redistribution(lk["greedy"], lk.cfg.budget).select("Outlet_ID", "allocation_tier", _SP)


@query(f"SELECT Outlet_ID, distributor_id, {_SP} FROM rebalanced")
def distributor_rebalance(lk):
    return budget.distributor_rebalance(lk["spread"], lk.cfg.budget).select("Outlet_ID", "distributor_id", _SP)


@query(f"SELECT Outlet_ID, {_SP} FROM adjusted")
def micro_adjust(lk):
    return budget.micro_adjust(lk["rebalanced"], lk.cfg.budget).select("Outlet_ID", _SP)


@query(f"SELECT Outlet_ID, allocation_tier, recommended_spend_type, {_SP}, {sql_rnd('projected_volume_uplift_litres')} FROM allocation")
def projected_uplift(lk):
    return rnd(budget.projected_uplift(lk["adjusted"]).select("Outlet_ID", "allocation_tier", "recommended_spend_type", _SP, "projected_volume_uplift_litres"))


_SMALL = "(Outlet_Size = 'Small' OR Outlet_Type IN ('Kiosk', 'Pharmacy'))"
_RULES = {
    "no_spend_1_499": f"count(*) FILTER ({_SP} > 0 AND {_SP} < 500)", "within_headroom_plus_100": f"count(*) FILTER ({_SP} > max_headroom_allocation + 100)",
    "small_outlets_max_3000": f"count(*) FILTER ({_SMALL} AND {_SP} > 3000)", "multiple_of_step": f"count(*) FILTER ({_SP} % 50 <> 0)",
    "exact_total": f"CAST(abs(sum({_SP}) - {o.B.total}) > 0.005 AS BIGINT)",
    "high_medium_share": f"CAST(sum({_SP}) FILTER (allocation_tier IN ('High', 'Medium')) < {o.B.min_high_medium_share * o.B.total} AS BIGINT)",
    "coverage": f"CAST(count(*) FILTER ({_SP} > 0) < {o.B.min_funded} AS BIGINT)",
    **{f"min_share:{d}": f"CAST(coalesce(sum({_SP}) FILTER (distributor_id = '{d}'), 0) < {o.B.min_share * o.B.total - 1.0} AS BIGINT)" for d in o.B.cohort},
}


@query(" UNION ALL ".join(f"SELECT '{n}' AS rule, {x} AS violations, {x} = 0 AS ok FROM allocation" for n, x in _RULES.items()))
def allocation_checks(lk):
    return budget.allocation_checks(lk["allocation"], lk.cfg.budget)


@query(f"""
SELECT CAST(least(floor((roi_score - lo) / ((hi - lo) / 60e0)), 59) AS INTEGER) AS bin, count(*) AS n, {', '.join(f"{o.he(f'min(roi_score) FILTER (allocation_tier = {chr(39)}{t}{chr(39)})', 8)} AS min_{t.lower()}" for t in ('High', 'Medium', 'Low'))}
FROM allocation, (SELECT min(roi_score) AS lo, max(roi_score) AS hi FROM allocation WHERE roi_score > 0) WHERE roi_score > 0 GROUP BY ALL""")
def roi_histogram(lk):
    return rnd(budget.roi_histogram(lk["allocation"]), 8)


# === serving =================================================================================

_FILTER = {"province": "Western", "outlet_type": "Grocery"}


@query(f"""
SELECT count(outlet_id) AS total_outlets, {o.he('coalesce(sum(predicted_potential_litres), 0)', 2)} AS total_predicted_volume, coalesce(sum(trade_spend_allocation_lkr), 0.0) AS total_budget,
  count(*) FILTER (allocation_tier = 'high') AS high_potential_outlets, {o.he('coalesce(avg(capacity_utilization_ratio), 0)', 6)} AS avg_capacity_utilization
FROM srv_outlets LEFT JOIN srv_allocations USING (outlet_id) WHERE province = 'Western' AND outlet_type = 'Grocery'""")
def dashboard_stats(lk):
    s = serving.dashboard_stats(lk["srv_outlets"], lk["srv_allocations"], _FILTER)
    return s.withColumns({"total_predicted_volume": half_even(F.col("total_predicted_volume"), 2), "avg_capacity_utilization": half_even(F.col("avg_capacity_utilization"), 6)})


@query(" UNION ".join(f"SELECT '{k}' AS option, {x} AS value FROM srv_outlets WHERE {x} IS NOT NULL" for k, x in
                      (("provinces", "province"), ("distributors", "distributor_id"), ("types", "outlet_type"), ("saturation_classes", "market_saturation_class")))
       + " UNION SELECT 'tiers', allocation_tier FROM srv_allocations WHERE allocation_tier <> 'none'")
def filter_options(lk):
    return serving.filter_options(lk["srv_outlets"], lk["srv_allocations"])


@query("SELECT *, count(*) OVER () AS total FROM srv_outlets LEFT JOIN (SELECT outlet_id, allocation_tier, trade_spend_allocation_lkr FROM srv_allocations) USING (outlet_id) "
       "WHERE province = 'Western' AND outlet_type = 'Grocery' ORDER BY outlet_id LIMIT 20 OFFSET 20")
def paginated_outlets(lk):
    return serving.paginated_outlets(lk["srv_outlets"], lk["srv_allocations"], _FILTER, page=2, limit=20)


@query("SELECT s.outlet_id, latitude, longitude, outlet_type, predicted_potential_litres, allocation_tier, market_saturation_class FROM srv_outlets s LEFT JOIN srv_allocations USING (outlet_id) "
       "JOIN sea ON sea.Outlet_ID = s.outlet_id WHERE NOT in_sea")
def map_points(lk):
    return serving.map_points(lk["srv_outlets"], lk["srv_allocations"], lk.sea())


@query(f"""
SELECT o.outlet_id, o.predicted_potential_litres, a.allocation_tier, a.trade_spend_allocation_lkr, v.outlet_id IS NOT NULL AS has_context,
  {o.he('coalesce(a.uplift_gap_litres, greatest(0.0, o.predicted_potential_litres - o.recent_3m_avg))', 4)} AS uplift_gap
FROM srv_outlets o LEFT JOIN srv_allocations a USING (outlet_id) LEFT JOIN (SELECT DISTINCT outlet_id FROM emb_long) v ON v.outlet_id = o.outlet_id""")
def outlet_detail(lk):
    b = F.col("budget_allocation")
    return rnd(lk.detail().select("outlet_id", "predicted_potential_litres", b.allocation_tier.alias("allocation_tier"),
                                  b.trade_spend_allocation_lkr.alias("trade_spend_allocation_lkr"), F.col("context_json").isNotNull().alias("has_context"), "uplift_gap"))


@query(f"SELECT * REPLACE ({sql_rnd('roi_score projected_volume_uplift_litres', 6)}) FROM srv_rows")
def budget_allocations(lk):
    return serving.budget_allocations(lk["srv_outlets"], lk["srv_allocations"]).withColumns(
        {x: half_even(F.col(x), 6) for x in ("roi_score", "projected_volume_uplift_litres")})


def _rows(lk) -> DataFrame:
    return serving.budget_allocations(lk["srv_outlets"], lk["srv_allocations"])


@query(f"""
SELECT distributor_id, {o.he('sum(projected_volume_uplift_litres)', 4)} AS lift, sum(trade_spend_allocation_lkr) AS total_spend,
  floor(sum(trade_spend_allocation_lkr) / (SELECT sum(trade_spend_allocation_lkr) FROM funded) * 1000.0 + 0.5) / 10.0 AS pct_of_budget FROM funded GROUP BY distributor_id""")
def budget_by_distributor(lk):
    return rnd(serving.budget_by_distributor(_rows(lk)))


@query(f"""
SELECT count(*) AS outlets, coalesce(sum(trade_spend_allocation_lkr), 0.0) AS total_spend, {o.he('coalesce(sum(projected_volume_uplift_litres), 0)', 4)} AS expected_lift,
  {o.he('coalesce(avg(roi_score), 0)', 6)} AS avg_roi, {o.he('coalesce(sum(trade_spend_allocation_lkr) / sum(projected_volume_uplift_litres), 0)', 6)} AS spend_per_litre FROM funded WHERE allocation_tier = 'medium'""")
def budget_kpis(lk):
    k = serving.budget_kpis(_rows(lk), tier="medium")
    return k.withColumns({"expected_lift": half_even(F.col("expected_lift"), 4), "avg_roi": half_even(F.col("avg_roi"), 6), "spend_per_litre": half_even(F.col("spend_per_litre"), 6)})


@query(f"""
SELECT outlet_id, feature, {sql_rnd('contribution', 6)}, position, CASE WHEN contribution >= 0 THEN 'positive' ELSE 'negative' END AS direction FROM
(SELECT *, CAST(row_number() OVER (PARTITION BY outlet_id ORDER BY abs(contribution) DESC, feature) AS INTEGER) AS position FROM emb_long) WHERE position <= 12""")
def top_drivers(lk):
    return rnd(serving.top_drivers(lk.embedding_contributions(), "outlet_id", 12), 6)


def _drivers(lk) -> DataFrame:
    return serving.top_drivers(serving.context_contributions(lk["srv_contexts"]), "outlet_id", 10)


_DRV = "SELECT outlet_id, list(feature ORDER BY position) AS l FROM (SELECT *, row_number() OVER (PARTITION BY outlet_id ORDER BY abs(round_even(contribution * 1e4, 0)) DESC, feature) AS position FROM emb_long) WHERE position <= 10 GROUP BY outlet_id"


@query(f"""
SELECT o.outlet_id, coalesce(o.province, 'Unknown') AS province, CAST(floor(capacity_utilization_ratio * 100.0 + 0.5) AS BIGINT) AS utilization_pct, o.competitors_500m, {o.he('o.composite_gravity_score', 2)} AS composite_score,
  a.allocation_tier AS budget_tier, {o.he('a.uplift_gap_litres', 4)} AS budget_gap, coalesce(array_to_string(d.l, ','), '') AS drivers
FROM srv_outlets o LEFT JOIN srv_allocations a USING (outlet_id) LEFT JOIN ({_DRV}) d ON d.outlet_id = o.outlet_id""")
def context_pack(lk):
    j = serving.context_pack(lk.detail(), _drivers(lk), lk.cfg)
    at = lambda p: F.get_json_object("dossier_json", "$." + p)
    return j.select("outlet_id", at("outlet_profile.province").alias("province"), at("cooler_capacity.capacity_utilization_pct").cast("long").alias("utilization_pct"),
                    at("market_competition.competitors_within_500m").cast("int").alias("competitors_500m"), half_even(at("location_footfall.composite_score").cast("double"), 2).alias("composite_score"),
                    at("budget_allocation.allocation_tier").alias("budget_tier"), half_even(at("budget_allocation.uplift_gap_litres").cast("double"), 4).alias("budget_gap"),
                    F.array_join(F.from_json(at("model_top_drivers[*].feature"), "array<string>"), ",").alias("drivers")).withColumn("drivers", F.coalesce("drivers", F.lit("")))


_T = lambda x: f"format('{{:,}}', CAST(floor(coalesce({x}, 0.0) + 0.5) AS BIGINT))"


@query(f"""
SELECT outlet_id, alert_type, CAST(2 + (b IS NOT NULL)::INT + (competitors_500m > 0)::INT + (composite_gravity_score > 0)::INT AS INTEGER) AS n_cards,
  CAST(1 + (b IS NOT NULL)::INT + (util > 80)::INT + (gap_ > 0)::INT + (sat IN ('dense', 'isolated'))::INT AS INTEGER) AS n_actions,
  CASE alert_type WHEN 'critical' THEN 'This outlet is operating at ' || util || '% cooler capacity utilization. Physical infrastructure is constraining growth. The predicted potential of ' || {_T('p')} || 'L cannot be achieved without additional cooler deployment.'
    WHEN 'success' THEN 'There is a significant ' || {_T('gap_')} || 'L monthly volume gap (' || pct || '% growth headroom) between current sales and predicted potential. This outlet is underperforming relative to its market opportunity.'
    WHEN 'warning' THEN 'This outlet operates in a densely competitive market with ' || competitors_500m || ' competitors within 500m. Focus on customer retention and share-of-wallet strategies.'
    ELSE 'This outlet has a predicted monthly potential of ' || {_T('p')} || 'L against a recent 3-month average of ' || {_T('r')} || 'L.' END AS message
FROM (SELECT *, CASE WHEN util > 80 THEN 'critical' WHEN gap_ > 0 AND pct > 30 THEN 'success' WHEN sat = 'dense' THEN 'warning' ELSE 'info' END AS alert_type
  FROM (SELECT o.*, a.allocation_tier AS b, p, r, greatest(0.0, p - r) AS gap_, CASE WHEN r > 0 THEN CAST(floor(greatest(0.0, p - r) / r * 100.0 + 0.5) AS BIGINT) ELSE 0 END AS pct,
    CAST(floor(capacity_utilization_ratio * 100.0 + 0.5) AS BIGINT) AS util, market_saturation_class AS sat
    FROM (SELECT *, predicted_potential_litres AS p, recent_3m_avg AS r FROM srv_outlets) o LEFT JOIN srv_allocations a USING (outlet_id)))""")
def rule_briefing(lk):
    return lk.briefings().select("outlet_id", "alert_type", "n_cards", "n_actions", F.get_json_object("briefing_json", "$.diagnostic_alert.message").alias("message"))


@query("SELECT DISTINCT outlet_id, CASE WHEN CAST(substr(outlet_id, 5) AS BIGINT) % 3 = 0 THEN 'briefed ' || outlet_id END AS xai_explanation FROM emb_long")
def keyed_update(lk):
    updates = lk["srv_contexts"].where(F.substring("outlet_id", 5, 10).cast("long") % 3 == 0).select("outlet_id", F.concat(F.lit("briefed "), "outlet_id").alias("xai_explanation"))
    return serving.keyed_update(lk["srv_contexts"], updates).select("outlet_id", "xai_explanation")


# === profiling ===============================================================================

@query("SELECT * FROM (SELECT count(*) FILTER (Outlet_ID IS NULL) AS Outlet_ID, count(*) FILTER (Distributor_ID IS NULL) AS Distributor_ID, count(*) FILTER (Volume_Litres IS NULL) AS Volume_Litres FROM tx) "
       "UNPIVOT (nulls FOR \"column\" IN (Outlet_ID, Distributor_ID, Volume_Litres))")
def null_profile(lk):
    return profiling.null_profile(lk.transactions(), ["Outlet_ID", "Distributor_ID", "Volume_Litres"])


@query(f"""
SELECT count(*) AS n, {o.he('count(*) * 100.0 / (SELECT count(*) FROM tx)', 6)} AS pct, {o.he('avg(v)', 6)} AS mean, {o.he('stddev_samp(v)', 6)} AS std, min(v) AS min, max(v) AS max,
  {', '.join(f"{o.he(f'quantile_cont(v, {p})', 6)} AS p{int(p * 100)}" for p in (0.25, 0.5, 0.75))} FROM (SELECT Volume_Litres AS v FROM tx WHERE Volume_Litres < 0)""")
def negative_profile(lk):
    return rnd(profiling.negative_profile(lk.transactions(), "Volume_Litres"), 6)


@query("SELECT CAST(m AS DATE) AS month FROM (SELECT unnest(generate_series(min(date_trunc('month', Date)), max(date_trunc('month', Date)), INTERVAL 1 MONTH)) AS m FROM fx_holidays WHERE Holiday_Type = 'Poya Day') "
       "WHERE CAST(m AS DATE) NOT IN (SELECT CAST(date_trunc('month', Date) AS DATE) FROM fx_holidays WHERE Holiday_Type = 'Poya Day')")
def missing_periods(lk):
    return profiling.missing_periods(lk.raw("fx_holidays").where("Holiday_Type = 'Poya Day'"), "Date")


@query(f"""
SELECT count(*) FILTER (v < q1 - 0.2e0 * (q3 - q1) OR v > q3 + 0.2e0 * (q3 - q1)) AS outliers, {o.he('count(*) FILTER (v < q1 - 0.2e0 * (q3 - q1) OR v > q3 + 0.2e0 * (q3 - q1)) * 100.0 / count(*)', 6)} AS outlier_pct,
  any_value(q3 - q1) AS iqr, any_value({o.he('q1 - 0.2e0 * (q3 - q1)', 6)}) AS lower_bound, any_value({o.he('q3 + 0.2e0 * (q3 - q1)', 6)}) AS upper_bound
FROM (SELECT Volume_Litres AS v FROM tx), (SELECT quantile_cont(Volume_Litres, 0.25) AS q1, quantile_cont(Volume_Litres, 0.75) AS q3 FROM tx)""")
def iqr_profile(lk):
    return rnd(profiling.iqr_profile(lk.transactions(), "Volume_Litres", 0.2), 6)


_KINDS = ("Public", "Bank", "Mercantile", "Poya Day", "Other")


@query("SELECT v.month, volume, " + ", ".join(f"coalesce(\"{k}\", 0) AS \"{k}\"" for k in _KINDS) + " FROM (SELECT Date AS month, coalesce(sum(Volume_Litres), 0.0) AS volume FROM tx GROUP BY Date) v LEFT JOIN "
       "(SELECT CAST(date_trunc('month', Date) AS DATE) AS month, " + ", ".join(f"count(*) FILTER (Holiday_Type = '{k}') AS \"{k}\"" for k in _KINDS) + " FROM fx_holidays GROUP BY 1) h USING (month)")
def holiday_month_counts(lk):
    return profiling.holiday_month_counts(lk.transactions(), lk.raw("fx_holidays"), _KINDS, "Date", "Volume_Litres")


@query("SELECT 'only_left' AS side, Outlet_ID FROM (SELECT Outlet_ID FROM fx_outlet_master EXCEPT SELECT Outlet_ID FROM fx_outlet_coordinates) UNION ALL "
       "SELECT 'only_right', Outlet_ID FROM (SELECT Outlet_ID FROM fx_outlet_coordinates EXCEPT SELECT Outlet_ID FROM fx_outlet_master)")
def key_coverage(lk):
    return profiling.key_coverage(lk.raw("fx_outlet_master"), lk.raw("fx_outlet_coordinates"), "Outlet_ID")


@query("SELECT (SELECT count(DISTINCT (Year, Month)) FROM fx_transactions) AS left_periods, (SELECT count(DISTINCT (Year, Month)) FROM fx_seasonality) AS right_periods")
def period_alignment(lk):
    return profiling.period_alignment(lk.raw("fx_transactions"), lk.raw("fx_seasonality"))


@query(f"SELECT Outlet_Size AS value, count(*) AS n, Outlet_Size IS NOT NULL AND coalesce(Outlet_Size NOT IN {o.in_list(c.OUTLET_SIZES)}, false) AS off_contract FROM fx_outlet_master GROUP BY Outlet_Size")
def category_profile(lk):
    return profiling.category_profile(lk.raw("fx_outlet_master"), "Outlet_Size", c.OUTLET_SIZES)


@query("SELECT Outlet_ID, CASE WHEN Latitude = 0 AND Longitude = 0 THEN 'Zero Coordinates' WHEN Latitude BETWEEN 5.9 AND 9.9 AND Longitude BETWEEN 79.5 AND 81.9 THEN 'Valid' "
       "WHEN Latitude BETWEEN 79.5 AND 81.9 AND Longitude BETWEEN 5.9 AND 9.9 THEN 'Swapped' ELSE 'Out of Bounds' END AS Status FROM fx_outlet_coordinates")
def coord_status(lk):
    return profiling.coord_status(lk.raw("fx_outlet_coordinates"), lk.cfg).select("Outlet_ID", "Status")


_CORR = ["hist_p90_monthly", "hist_mean_monthly", "jan_avg_volume", "Cooler_Count", "composite_gravity_score", "competitors_1km", "trend_slope", "footfall_score"]


@query("SELECT feature, correlation FROM (SELECT " + ", ".join(f"{o.he(f'corr({x}, baseline_potential_litres)', 6)} AS {x}" for x in _CORR)
       + f" FROM master JOIN baseline USING (Outlet_ID) WHERE has_transaction_history AND NOT exclude_from_training) UNPIVOT (correlation FOR feature IN ({', '.join(_CORR)}))")
def target_correlation(lk):
    df = lk["master"].join(lk["baseline"], "Outlet_ID").where("has_transaction_history and not exclude_from_training")
    return rnd(profiling.target_correlation(df, "baseline_potential_litres", _CORR), 6)


@query("SELECT Outlet_ID, CAST('0x' || substr(md5(concat(Outlet_ID, ':42')), 1, 8) AS BIGINT) % 10000 < 2000 AS is_test FROM master")
def holdout_split(lk):
    return profiling.holdout_split(lk["master"], "Outlet_ID").select("Outlet_ID", "is_test")


@query(f"""
SELECT n, {o.he('sqrt(sse / n)', 6)} AS rmse, {o.he('mae', 6)} AS mae, {o.he('1 - sse / sst', 6)} AS r2 FROM (SELECT count(*) AS n, sum(pow(model_prediction - baseline_potential_litres, 2)) AS sse,
  avg(abs(model_prediction - baseline_potential_litres)) AS mae, var_pop(baseline_potential_litres) * count(*) AS sst FROM final)""")
def regression_metrics(lk):
    return rnd(models.regression_metrics(lk["final"], "baseline_potential_litres", "model_prediction"), 6)


@query(f"SELECT Outlet_ID, baseline_potential_litres AS Actual, model_prediction AS Predicted, {o.he('model_prediction - baseline_potential_litres', 4)} AS Diff FROM final ORDER BY model_prediction - baseline_potential_litres DESC, Outlet_ID LIMIT 10")
def residual_topk(lk):
    return rnd(profiling.residual_topk(lk["final"], "model_prediction", "baseline_potential_litres"))


_SUMMARY = [f"{k}_gravity_score" for k in c.GRAVITY_POI_RULES] + ["composite_gravity_score"]


@query(" UNION ALL ".join(f"SELECT '{x}' AS feature, {o.he(f'avg({x})', 4)} AS mean, {o.he(f'median({x})', 4)} AS median, max({x}) AS max FROM gravity WHERE gravity_data_available" for x in _SUMMARY))
def feature_summary(lk):
    return rnd(profiling.feature_summary(lk["gravity"], _SUMMARY, F.col("gravity_data_available")))
