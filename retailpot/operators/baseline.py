"""Floor estimate of the monthly potential."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailpot.config import Config
from retailpot.functions.numeric import clamp, half_even
from retailpot.operators.quantiles import grouped_quantiles, scalar_median, scalar_quantiles

NO_HISTORY_MEDIAN = 50.0
REFERENCE_CEILING = 2550.0


def size_medians(master: DataFrame) -> DataFrame:
    """Median January mean per size among outlets active in January."""
    m = grouped_quantiles(master.where("jan_count > 0"), ["Outlet_Size"], "jan_avg_volume", [0.5])
    return m.select("Outlet_Size", F.col("q")[0].alias("size_median"))


def global_median(master: DataFrame) -> Column:
    return F.coalesce(scalar_median(master.where("jan_count > 0"), "jan_avg_volume"), F.lit(NO_HISTORY_MEDIAN))


def cold_start_potential(master: DataFrame) -> DataFrame:
    """Adds ``cold_start``: the size median scaled by the cooler ceiling, or by the cooler count without one."""
    base = F.coalesce(F.col("size_median"), global_median(master))
    by_ceiling = base * clamp(F.col("theoretical_monthly_ceiling") / F.lit(REFERENCE_CEILING), 0.5, 2.0) \
        if "theoretical_monthly_ceiling" in master.columns else None
    by_count = base * (F.lit(1.0) + F.col("Cooler_Count") * F.lit(0.15))
    value = by_count if by_ceiling is None else F.when(F.col("theoretical_monthly_ceiling") > 0, by_ceiling).otherwise(by_count)
    return master.join(size_medians(master), "Outlet_Size", "left").withColumn("cold_start", value).drop("size_median")


def recency_factor(ema: Column, mean: Column) -> Column:
    return F.when((mean <= 0) | (ema <= 0), F.lit(1.0)).otherwise(clamp(ema / mean, 0.8, 1.3))


def poi_uplift(score: Column) -> Column:
    """Piecewise linear 1.00, 1.10, 1.25 with knots at 20, 60 and 100."""
    return (F.when(score <= 20, F.lit(1.0))
            .when(score <= 60, F.lit(1.0) + (score - 20) / F.lit(40.0) * F.lit(0.10))
            .otherwise(F.lit(1.10) + (score - 60) / F.lit(40.0) * F.lit(0.15)))


def demand_path() -> Column:
    return F.when(F.col("jan_count") > 0, "january").when(F.col("has_transaction_history"), "p90").otherwise("cold_start")


def baseline_potential(master: DataFrame, cfg: Config) -> DataFrame:
    label = cfg.target_label
    df = cold_start_potential(master).withColumn("demand_path", demand_path())
    january = F.greatest(F.col("jan_avg_volume"), F.col("jan_max_volume") * F.lit(0.85))
    demand = F.when(F.col("demand_path") == "january", january).when(
        F.col("demand_path") == "p90", F.col("hist_p90_monthly")).otherwise(F.col("cold_start"))
    value = (demand * recency_factor(F.col("ema_3m"), F.col("hist_mean_monthly")) * F.col(f"seasonality_multiplier_{label}")
             * (F.col(f"{label}_trading_days") / F.lit(cfg.working_days)) * poi_uplift(F.col("composite_gravity_score")))
    return df.select("Outlet_ID", "demand_path",
                     half_even(F.greatest(value, F.col("hist_max_monthly")), 2).alias("baseline_potential_litres"))


def baseline_summary(baseline: DataFrame) -> DataFrame:
    v = "baseline_potential_litres"
    qs = scalar_quantiles(baseline, v, [0.5, 0.9])
    paths = {f"n_{p}": F.count_if(F.col("demand_path") == p) for p in ("january", "p90", "cold_start")}
    return baseline.agg(F.min(v).alias("min"), F.avg(v).alias("mean"), F.max(v).alias("max"),
                        *[c.alias(n) for n, c in paths.items()]).withColumns({"median": qs[0], "p90": qs[1]})
