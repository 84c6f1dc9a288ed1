"""Column contracts of the layer tables, as DDL; ``conform`` casts a frame to one at the sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from retailpot import config as c
from retailpot.sources import ingest

_COUNTS = ", ".join(f"{k}_{r}m int" for k in c.FLAT_POI_RULES for r in (500, 1000, 2000))
_SCORES = ", ".join(f"{k}_gravity_score float" for k in c.GRAVITY_POI_RULES)

CONTRACTS = {
    "outlets": "Outlet_ID string, Outlet_Size string, Cooler_Count tinyint, Outlet_Type string, size_imputed boolean",
    "coordinates": "Outlet_ID string, Latitude double, Longitude double, coords_swapped boolean",
    "transactions": "Outlet_ID string, Date date, Year smallint, Month tinyint, Distributor_ID string, Volume_Litres float, "
                    "is_volume_outlier boolean, is_blackout_period boolean, row_source string",
    "seasonality": "Distributor_ID string, Year smallint, Month tinyint, Seasonality_Index string, is_extrapolated boolean",
    "calendar": "date date, Holiday_Name string, is_public boolean, is_bank boolean, is_mercantile boolean, is_poya_day boolean, is_manually_added boolean",
    "sales": "Outlet_ID string, hist_max_monthly float, hist_p90_monthly float, hist_p75_monthly float, hist_mean_monthly float, hist_std_monthly float, "
             "hist_cv float, jan_avg_volume float, jan_max_volume float, jan_count tinyint, active_months smallint, active_months_pct float, "
             "consecutive_zero_months_max smallint, yoy_growth_rate float, recent_3m_avg float, trend_slope float, months_since_last_order smallint, "
             "total_volume float, distributor_id string, ema_3m float, ema_6m float",
    "poi": f"Outlet_ID string, {_COUNTS}, footfall_score float, poi_data_available boolean",
    "gravity": f"Outlet_ID string, {_SCORES}, raw_composite_gravity float, composite_gravity_score float, gravity_data_available boolean",
    "catchment": "Outlet_ID string, competitors_500m int, competitors_1km int, competitors_2km int, competition_density_score float, market_saturation_class string",
    "cooler": "Outlet_ID string, Cooler_Count tinyint, cooler_capacity_litres float, theoretical_monthly_ceiling float, capacity_utilization_ratio float",
    "spatial": "Outlet_ID string, micro_market_id int, is_spatial_outlier boolean, cluster_outlet_count int, cluster_mean_volume float, cluster_p90_volume float",
    "baseline": "Outlet_ID string, baseline_potential_litres double",
    "final": "Outlet_ID string, Maximum_Monthly_Liters double",
}


def contract(name: str) -> StructType:
    return StructType.fromDDL(CONTRACTS[name])


def conform(df: DataFrame, name: str) -> DataFrame:
    return ingest.conform(df, contract(name))
