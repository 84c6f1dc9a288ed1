"""Serving tables and the queries a dashboard runs on them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailpot.config import Config

FILTERS = ("province", "distributor_id", "outlet_type", "tier", "market_saturation_class")
# serving column -> (type, default where the column is missing)
OUTLET_COLUMNS = {
    "outlet_id": ("string", None), "outlet_type": ("string", ""), "outlet_size": ("string", ""), "province": ("string", ""),
    "distributor_id": ("string", ""), "latitude": ("double", 0.0), "longitude": ("double", 0.0), "cooler_count": ("int", 0),
    "predicted_potential_litres": ("double", 0.0), "recent_3m_avg": ("double", 0.0), "hist_p90_monthly": ("double", 0.0),
    "has_transaction_history": ("int", 0), "composite_gravity_score": ("double", 0.0), "footfall_score": ("double", 0.0),
    "school_gravity_score": ("double", 0.0), "transport_gravity_score": ("double", 0.0), "worship_gravity_score": ("double", 0.0),
    "hospitality_gravity_score": ("double", 0.0), "active_months": ("int", 0), "seasonality_multiplier": ("double", 1.0),
    "cooler_capacity_litres": ("double", 0.0), "theoretical_monthly_ceiling": ("double", 0.0),
    "capacity_utilization_ratio": ("double", 0.0), "competitors_500m": ("int", 0), "competitors_1km": ("int", 0),
    "competition_density_score": ("double", 0.0), "market_saturation_class": ("string", "moderate"),
    "tobit_latent_estimate": ("double", 0.0), "tobit_censoring_ratio": ("double", 0.0), "hurdle_estimate": ("double", 0.0),
}
ALLOCATION_COLUMNS = {
    "outlet_id": ("string", None), "uplift_gap_litres": ("double", 0.0), "roi_score": ("double", 0.0),
    "allocation_tier": ("string", "low"), "trade_spend_allocation_lkr": ("double", 0.0),
    "recommended_spend_type": ("string", "none"), "projected_volume_uplift_litres": ("double", 0.0),
}


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def _shape(df: DataFrame, columns: Mapping[str, tuple], **given: Column) -> DataFrame:
    out = []
    for name, (kind, default) in columns.items():
        c = given.get(name, F.col(name) if name in df.columns else F.lit(default))
        out.append(c.cast(kind).alias(name))
    return df.select(*out)


def serving_outlets(master: DataFrame, predictions: DataFrame, cfg: Config) -> DataFrame:
    """Features and predictions (inner join) in serving columns, defaults for what is missing."""
    df = lower_names(master).join(lower_names(predictions), "outlet_id")
    label = f"seasonality_multiplier_{cfg.target_label}"
    columns = {(label if c == "seasonality_multiplier" else c): v for c, v in OUTLET_COLUMNS.items()}
    potential = "predicted_potential_litres" if "predicted_potential_litres" in df.columns else "maximum_monthly_liters"
    return _shape(df, columns, has_transaction_history=F.col("active_months") > 0, predicted_potential_litres=F.col(potential))


def serving_allocations(diagnostics: DataFrame) -> DataFrame:
    df = lower_names(diagnostics)
    return _shape(df, ALLOCATION_COLUMNS, allocation_tier=F.lower("allocation_tier"))


def serving_contexts(contributions: DataFrame) -> DataFrame:
    """(outlet_id, context_json, xai_explanation) from a wide contribution table."""
    df = lower_names(contributions)
    return df.select("outlet_id", F.to_json(F.struct(*df.columns)).alias("context_json"), F.lit(None).cast("string").alias("xai_explanation"))


def register(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def _matches(filters: Mapping[str, str] | None, tier: str = "allocation_tier") -> Column:
    out = F.lit(True)
    for key, value in (filters or {}).items():
        if key not in FILTERS:
            raise ValueError(f"Unknown filter '{key}'")
        if value:
            out = out & (F.col(tier if key == "tier" else key) == value)
    return out


def _with_tier(outlets: DataFrame, allocations: DataFrame, *columns: str) -> DataFrame:
    return outlets.join(allocations.select("outlet_id", "allocation_tier", *columns), "outlet_id", "left")


def dashboard_stats(outlets: DataFrame, allocations: DataFrame, filters: Mapping[str, str] | None = None) -> DataFrame:
    """Headline numbers under the filters, in one pass."""
    df = _with_tier(outlets, allocations, "trade_spend_allocation_lkr").where(_matches(filters))
    zero = lambda c, z: F.coalesce(c, F.lit(z))
    return df.agg(F.count("outlet_id").alias("total_outlets"),
                  zero(F.sum("predicted_potential_litres"), 0.0).alias("total_predicted_volume"),
                  zero(F.sum("trade_spend_allocation_lkr"), 0.0).alias("total_budget"),
                  F.count_if(F.col("allocation_tier") == "high").alias("high_potential_outlets"),
                  zero(F.avg("capacity_utilization_ratio"), 0.0).alias("avg_capacity_utilization"))


def filter_options(outlets: DataFrame, allocations: DataFrame) -> DataFrame:
    """(option, value) rows: distinct non-null values per filter, the tier ``none`` left out."""
    names = {"provinces": "province", "distributors": "distributor_id", "types": "outlet_type", "saturation_classes": "market_saturation_class"}
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("option"), F.col(c).alias("value")) for k, c in names.items()]))
    o = outlets.select(pairs.alias("x")).select("x.*")
    t = allocations.where("allocation_tier <> 'none'").select(F.lit("tiers").alias("option"), F.col("allocation_tier").alias("value"))
    return o.unionByName(t).where("value is not null").distinct()


def paginated_outlets(outlets: DataFrame, allocations: DataFrame, filters: Mapping[str, str] | None, page: int, limit: int) -> DataFrame:
    """One page ordered by id, with the total number of matches on each row."""
    page, limit = max(1, page), min(100, max(1, limit))
    df = _with_tier(outlets, allocations, "trade_spend_allocation_lkr").where(_matches(filters))
    return df.orderBy("outlet_id").offset((page - 1) * limit).limit(limit).withColumn("total", df.agg(F.count("*")).scalar())


def map_points(outlets: DataFrame, allocations: DataFrame, sea: DataFrame, filters: Mapping[str, str] | None = None) -> DataFrame:
    df = _with_tier(outlets, allocations).join(sea, "outlet_id").where(_matches(filters) & ~F.col("in_sea"))
    return df.select("outlet_id", "latitude", "longitude", "outlet_type", "predicted_potential_litres", "allocation_tier", "market_saturation_class")


def outlet_detail(outlets: DataFrame, allocations: DataFrame, contexts: DataFrame) -> DataFrame:
    """Outlets with context and nested allocation; filter ``outlets`` to one id for a page."""
    fields = [c for c in allocations.columns if c != "outlet_id"]
    a = allocations.where("allocation_tier is not null").select("outlet_id", F.struct("outlet_id", *fields).alias("budget_allocation"))
    df = outlets.join(contexts, "outlet_id", "left").join(a, "outlet_id", "left")
    gap = F.greatest(F.lit(0.0), F.col("predicted_potential_litres") - F.col("recent_3m_avg"))
    return df.withColumn("uplift_gap", F.coalesce("budget_allocation.uplift_gap_litres", gap))


def budget_allocations(outlets: DataFrame, allocations: DataFrame) -> DataFrame:
    return allocations.join(outlets.select("outlet_id", "distributor_id", "outlet_type"), "outlet_id")


def funded(rows: DataFrame) -> DataFrame:
    return rows.where("allocation_tier <> 'none' and trade_spend_allocation_lkr > 0")


def _half_up(c: Column, digits: int) -> Column:
    scale = float(10**digits)
    return F.floor(c * F.lit(scale) + 0.5) / F.lit(scale)


def budget_by_distributor(rows: DataFrame) -> DataFrame:
    """Spend, lift and share per distributor over funded rows, largest first."""
    per = funded(rows).groupBy("distributor_id").agg(
        F.sum("projected_volume_uplift_litres").alias("lift"), F.sum("trade_spend_allocation_lkr").alias("total_spend"))
    total = funded(rows).agg(F.sum("trade_spend_allocation_lkr")).scalar()
    pct = F.when(total > 0, _half_up(F.col("total_spend") / total * 100.0, 1)).otherwise(F.lit(0.0))
    return per.withColumn("pct_of_budget", pct).orderBy(F.col("total_spend").desc(), "distributor_id")


def budget_rows(rows: DataFrame, distributor: str | None = None, tier: str | None = None, outlet_type: str | None = None) -> DataFrame:
    keep = _matches({"distributor_id": distributor or "", "tier": tier or "", "outlet_type": outlet_type or ""})
    return funded(rows).where(keep).orderBy(F.col("trade_spend_allocation_lkr").desc(), "outlet_id")


def budget_kpis(rows: DataFrame, **filters: str | None) -> DataFrame:
    spend, lift = F.coalesce(F.sum("trade_spend_allocation_lkr"), F.lit(0.0)), F.coalesce(F.sum("projected_volume_uplift_litres"), F.lit(0.0))
    return budget_rows(rows, **filters).agg(
        F.count("*").alias("outlets"), spend.alias("total_spend"), lift.alias("expected_lift"),
        F.coalesce(F.avg("roi_score"), F.lit(0.0)).alias("avg_roi"), F.when(lift > 0, spend / lift).otherwise(F.lit(0.0)).alias("spend_per_litre"))


def top_drivers(long: DataFrame, key: str, k: int = 10, values: DataFrame | None = None) -> DataFrame:
    """The ``k`` contributions of largest size per key from (key, feature, contribution) rows.

    A key has one row per model feature, so a key's group is bounded by the number of features.
    """
    w = Window.partitionBy(key).orderBy(F.abs("contribution").desc(), "feature")
    top = long.withColumn("position", F.row_number().over(w)).where(F.col("position") <= k)
    out = top.withColumn("direction", F.when(F.col("contribution") >= 0, "positive").otherwise("negative"))
    return out if values is None else out.join(values, [key, "feature"], "left")


def context_contributions(contexts: DataFrame) -> DataFrame:
    """Numeric entries of the stored context JSON as (outlet_id, feature, contribution) rows."""
    m = F.from_json("context_json", "map<string,string>")
    e = contexts.select("outlet_id", F.explode(m).alias("feature", "text")).where("feature <> 'outlet_id'")
    return e.select("outlet_id", "feature", F.col("text").try_cast("double").alias("contribution")).where("contribution is not null")


def context_pack(detail: DataFrame, drivers: DataFrame, cfg: Config) -> DataFrame:
    """(outlet_id, dossier_json): profile, sales, demand, cooler, competition, location, drivers, budget."""
    top = F.transform(F.array_sort(F.collect_list(F.struct("position", "feature", "contribution"))), lambda d: F.struct(
        d.feature.alias("feature"), F.format_string("%.1f", d.contribution).alias("impact_litres")))
    listed = drivers.groupBy("outlet_id").agg(top.alias("drivers"))
    d = detail.join(listed, "outlet_id", "left")
    season = f"seasonality_multiplier_{cfg.target_label}"
    num = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    as_ = lambda c, n, z: F.coalesce(F.col(c), F.lit(z)).alias(n)
    b = F.col("budget_allocation")
    pack = F.struct(
        F.struct("outlet_id", as_("province", "province", "Unknown"), as_("outlet_type", "outlet_type", "Unknown"),
                 as_("outlet_size", "outlet_size", "Unknown"), as_("cooler_count", "cooler_count", 0)).alias("outlet_profile"),
        F.struct(num("predicted_potential_litres"), num("recent_3m_avg"), num("hist_p90_monthly"),
                 as_("active_months", "active_months", 0), as_(season, season, 1.0)).alias("sales_performance"),
        F.struct(as_("tobit_latent_estimate", "true_demand_estimate", 0.0), as_("tobit_censoring_ratio", "censoring_ratio", 0.0),
                 as_("hurdle_estimate", "sales_likelihood_estimate", 0.0)).alias("demand_analysis"),
        F.struct(as_("cooler_capacity_litres", "physical_capacity_litres", 0.0), num("theoretical_monthly_ceiling"),
                 utilisation_pct().alias("capacity_utilization_pct")).alias("cooler_capacity"),
        F.struct(as_("competitors_500m", "competitors_within_500m", 0), as_("competitors_1km", "competitors_within_1km", 0),
                 num("competition_density_score"), as_("market_saturation_class", "saturation_class", "moderate")).alias("market_competition"),
        F.struct(as_("composite_gravity_score", "composite_score", 0.0), as_("school_gravity_score", "school_impact", 0.0),
                 as_("transport_gravity_score", "transport_impact", 0.0), as_("worship_gravity_score", "worship_impact", 0.0),
                 as_("hospitality_gravity_score", "hospitality_impact", 0.0)).alias("location_footfall"),
        F.coalesce("drivers", F.array().cast("array<struct<feature:string,impact_litres:string>>")).alias("model_top_drivers"),
        F.when(b.isNotNull(), F.struct(
            b.allocation_tier.alias("allocation_tier"), b.roi_score.alias("roi_score"), b.trade_spend_allocation_lkr.alias("trade_spend_lkr"),
            b.recommended_spend_type.alias("recommended_spend_type"), b.uplift_gap_litres.alias("uplift_gap_litres"),
            b.projected_volume_uplift_litres.alias("projected_volume_uplift_litres"))).alias("budget_allocation"))
    return d.select("outlet_id", F.to_json(pack, {"ignoreNullFields": "false"}).alias("dossier_json"))


def utilisation_pct() -> Column:
    return F.floor(F.coalesce("capacity_utilization_ratio", F.lit(0.0)) * 100.0 + 0.5).cast("long")


def keyed_update(contexts: DataFrame, updates: DataFrame) -> DataFrame:
    """New snapshot of the context table with the given (outlet_id, xai_explanation) rows set."""
    u = updates.select("outlet_id", F.col("xai_explanation").alias("_new"), F.lit(True).alias("_set"))
    return (contexts.join(u, "outlet_id", "left")
            .withColumn("xai_explanation", F.when(F.col("_set"), F.col("_new")).otherwise(F.col("xai_explanation"))).drop("_new", "_set"))


def read_health(health: DataFrame) -> DataFrame:
    return health.orderBy("dataset")
