"""Cooler ceiling, feature assembly and null policy."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from retailpot.config import DISTRIBUTOR_PROVINCE, FALLBACK_CENTROID, PROVINCE_CENTROID, SEASON_MULTIPLIER, Config
from retailpot.functions.numeric import half_even, literal_map
from retailpot.operators.quantiles import scalar_median
from retailpot.operators.sales import ZERO_FILLED
from retailpot.session import cut


def cooler_ceiling(cfg: Config) -> dict[str, Column]:
    capacity = F.col("Cooler_Count").cast("int") * F.lit(cfg.litres_per_cooler)
    return {"cooler_capacity_litres": capacity,
            "theoretical_monthly_ceiling": capacity * F.lit(cfg.fills_per_cycle) * F.lit(30.0) / F.lit(cfg.replenishment_days)}


def capacity_utilisation(p90: Column, ceiling: Column, coolers: Column) -> Column:
    """P90 against the ceiling, capped at 2; 0 without coolers."""
    ratio = F.least(p90 / F.greatest(ceiling, F.lit(1.0)), F.lit(2.0))
    return F.when(coolers == 0, F.lit(0.0)).otherwise(ratio)


def cooler_features(outlets: DataFrame, sales: DataFrame, cfg: Config) -> DataFrame:
    p90 = F.coalesce("hist_p90_monthly", F.lit(0.0))
    df = outlets.select("Outlet_ID", "Cooler_Count").join(sales.select("Outlet_ID", "hist_p90_monthly"), "Outlet_ID", "left")
    df = df.withColumns(cooler_ceiling(cfg))
    return df.select("Outlet_ID", "Cooler_Count", "cooler_capacity_litres", "theoretical_monthly_ceiling",
                     capacity_utilisation(p90, F.col("theoretical_monthly_ceiling"), F.col("Cooler_Count")).alias("capacity_utilization_ratio"))


def seasonality_lookup(season: DataFrame, cfg: Config) -> DataFrame:
    """Season and multiplier of the target month per distributor."""
    year, month = cfg.target
    label = cfg.target_label
    idx = F.col("Seasonality_Index")
    return season.where((F.col("Year") == year) & (F.col("Month") == month)).select(
        F.col("Distributor_ID").alias("distributor_id"), idx.alias(f"seasonality_{label}"),
        literal_map(idx, SEASON_MULTIPLIER).alias(f"seasonality_multiplier_{label}"))


def master_join(outlets: DataFrame, coords: DataFrame, season: DataFrame, required: Mapping[str, DataFrame],
                optional: Mapping[str, DataFrame | None] | None = None) -> DataFrame:
    """One row per outlet: left joins on the id, then the season by distributor; absent optional tables add nothing."""
    out = outlets.join(coords.select("Outlet_ID", "Latitude", "Longitude", "coords_swapped"), "Outlet_ID", "left")
    for table in [*required.values(), *(t for t in (optional or {}).values() if t is not None)]:
        extra = [c for c in table.columns if c == "Outlet_ID" or c not in out.columns]
        out = out.join(table.select(*extra), "Outlet_ID", "left")
    return out.join(season, "distributor_id", "left")


def scalar_features(df: DataFrame, days: DataFrame, cfg: Config) -> DataFrame:
    """Trading days and holiday count of the target month on every row (one-row scalar subquery)."""
    s = days.agg(F.first(F.struct("trading_days", "holiday_count"))).scalar()
    return df.withColumns({f"{cfg.target_label}_holiday_count": s.getField("holiday_count"),
                           f"{cfg.target_label}_trading_days": s.getField("trading_days")})


def derive_province(distributor: Column) -> Column:
    return literal_map(distributor, DISTRIBUTOR_PROVINCE)


def centroid_fill(df: DataFrame) -> DataFrame:
    """Missing coordinates from the province centroid, else a fixed point."""
    fill = {}
    for c, i in (("Latitude", 0), ("Longitude", 1)):
        centre = literal_map(F.col("province"), {p: xy[i] for p, xy in PROVINCE_CENTROID.items()})
        value = F.coalesce(centre, F.lit(FALLBACK_CENTROID[i]))
        # a pair is filled together, decided by the latitude
        fill[c] = F.when(F.col("Latitude").isNull(), value).otherwise(F.coalesce(F.col(c), F.lit(FALLBACK_CENTROID[i])))
    return df.withColumns(fill)


def null_policy(df: DataFrame, cfg: Config) -> DataFrame:
    """Flags first, then fills: zeros for sales, false for flags, medians for trend and growth, a neutral season."""
    label = cfg.target_label
    out = df.withColumns({"coords_swapped": F.coalesce("coords_swapped", F.lit(False)),
                          "exclude_from_training": F.col("Latitude").isNull()})
    out = centroid_fill(out)
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ZERO_FILLED if c in out.columns})
    fills = {"has_transaction_history": F.col("active_months") > 0,
             f"seasonality_multiplier_{label}": F.coalesce(f"seasonality_multiplier_{label}", F.lit(1.0)),
             f"seasonality_{label}": F.coalesce(f"seasonality_{label}", F.lit("Moderate"))}
    by_median = [c for c in ("trend_slope", "yoy_growth_rate") if c in out.columns]
    if by_median:
        narrow = cut(df.select(*by_median))  # the join behind it runs once for both medians
        fills.update({c: F.coalesce(F.col(c), scalar_median(narrow, c)) for c in by_median})
    return out.withColumns(fills)


def round_floats(df: DataFrame, digits: int = 4) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: half_even(F.col(c).cast("double"), digits) for c in floats})


def master_features(outlets: DataFrame, coords: DataFrame, season: DataFrame, days: DataFrame,
                    required: Mapping[str, DataFrame], cfg: Config, optional: Mapping[str, DataFrame | None] | None = None) -> DataFrame:
    df = master_join(outlets, coords, seasonality_lookup(season, cfg), required, optional)
    df = scalar_features(df, days, cfg).withColumn("province", derive_province(F.col("distributor_id")))
    return round_floats(null_policy(df, cfg))
