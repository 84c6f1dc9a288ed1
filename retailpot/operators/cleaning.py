"""Cleaning of outlets, coordinates, transactions and seasonality."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailpot.config import DISTRIBUTORS, OUTLET_SIZES, OUTLET_TYPES, SEASON_MULTIPLIER, SIZE_BY_COOLERS, TYPE_CORRECTIONS, Config
from retailpot.functions.numeric import literal_map, title_case
from retailpot.operators import quality as q
from retailpot.operators.quantiles import scalar_quantiles, with_group_quantiles
from retailpot.sources.ingest import ROW_ID, canonical_columns

OUTLET_COLUMNS = ("Outlet_ID", "Outlet_Size", "Cooler_Count", "Outlet_Type", "size_imputed")
COORDINATE_COLUMNS = ("Outlet_ID", "Latitude", "Longitude", "coords_swapped")
TRANSACTION_COLUMNS = ("Outlet_ID", "Date", "Year", "Month", "Distributor_ID", "Volume_Litres",
                       "is_volume_outlier", "is_blackout_period", "row_source")
SEASONALITY_COLUMNS = ("Distributor_ID", "Year", "Month", "Seasonality_Index", "is_extrapolated")


@dataclass(frozen=True)
class Cleaned:
    clean: DataFrame
    rejected: DataFrame
    report: DataFrame


# --- outlets ---------------------------------------------------------------------------------

def normalise_title(c: Column) -> Column:
    """Trim and title-case; textual nulls and blanks become null."""
    t = title_case(F.trim(c.cast("string")))
    return F.when(t.isin("Nan", "None", ""), F.lit(None)).otherwise(t)


def impute_size(size: Column, coolers: Column) -> Column:
    """Missing size from the cooler count."""
    return F.coalesce(size, literal_map(coolers, SIZE_BY_COOLERS, "Small"))


def fix_typos(c: Column, corrections: dict = TYPE_CORRECTIONS) -> Column:
    t = F.trim(c.cast("string"))
    return F.coalesce(literal_map(t, corrections), t)


def typo_counts(df: DataFrame, column: str, corrections: dict = TYPE_CORRECTIONS) -> DataFrame:
    """How many rows each correction touches."""
    t = F.trim(F.col(column))
    return (df.where(t.isin(*corrections)).groupBy(t.alias("found")).agg(F.count("*").alias("corrected"))
            .withColumn("replaced_by", literal_map(F.col("found"), corrections)))


def outlet_checks(cfg: Config) -> list[q.Check]:
    return [
        q.duplicate_check(["Outlet_ID"], ROW_ID),
        q.null_check(["Outlet_ID", "Outlet_Type", "Cooler_Count"]),
        q.format_check("Outlet_ID", cfg.outlet_id_pattern),
        q.range_check("Cooler_Count", *cfg.cooler_range),
    ]


def clean_outlets(raw: DataFrame, cfg: Config) -> Cleaned:
    run = q.run_checks(raw, outlet_checks(cfg), "outlet_master")
    size = normalise_title(F.col("Outlet_Size"))
    fixed = run.passed.withColumns({
        "size_imputed": size.isNull(), "Outlet_Size": impute_size(size, F.col("Cooler_Count")),
        "Outlet_Type": fix_typos(F.col("Outlet_Type"))})
    valid = q.run_checks(fixed, [q.value_set_check("Outlet_Size", OUTLET_SIZES),
                                 q.value_set_check("Outlet_Type", OUTLET_TYPES)], "outlet_master")
    rejected = q.quarantine_union([run.failed, valid.failed])
    return Cleaned(valid.passed.select(*OUTLET_COLUMNS), rejected, run.report())


# --- coordinates -----------------------------------------------------------------------------

def zero_coordinates() -> q.Check:
    zero = (F.col("Latitude") == 0.0) & (F.col("Longitude") == 0.0)
    return q.condition_check("zero_coordinates", zero, "zero_coordinates")


def swap_latlon(df: DataFrame, above: float = 50.0) -> DataFrame:
    """A latitude above any of the country's means the pair was swapped; both are exchanged at once."""
    swapped = F.col("Latitude") > above
    return df.withColumns({
        "Latitude": F.when(swapped, F.col("Longitude")).otherwise(F.col("Latitude")),
        "Longitude": F.when(swapped, F.col("Latitude")).otherwise(F.col("Longitude")),
        "coords_swapped": F.coalesce(swapped, F.lit(False))})


def in_bounds(cfg: Config, lat: str = "Latitude", lon: str = "Longitude") -> Column:
    b = cfg.bounds
    return F.col(lat).between(b.lat_min, b.lat_max) & F.col(lon).between(b.lon_min, b.lon_max)


def bbox_check(cfg: Config) -> q.Check:
    return q.condition_check("bbox", ~in_bounds(cfg), "coordinates_out_of_sri_lanka_bounds")


def clean_coordinates(raw: DataFrame, outlets: DataFrame, cfg: Config) -> Cleaned:
    run = q.run_checks(raw, [
        q.duplicate_check(["Outlet_ID"], ROW_ID),
        q.null_check(["Outlet_ID", "Latitude", "Longitude"]),
        q.ref_integrity_check("Outlet_ID", outlets, "Outlet_ID")], "outlet_coordinates")
    zero = q.run_checks(run.passed, [zero_coordinates()], "outlet_coordinates")
    box = q.run_checks(swap_latlon(zero.passed), [bbox_check(cfg)], "outlet_coordinates")
    rejected = q.quarantine_union([run.failed, zero.failed, box.failed])
    return Cleaned(box.passed.select(*COORDINATE_COLUMNS), rejected, run.report())


# --- transactions ----------------------------------------------------------------------------

def synth_month_date(df: DataFrame) -> DataFrame:
    """First-of-month date where the data has only Year and Month."""
    if "Date" in df.columns or not {"Year", "Month"} <= set(df.columns):
        return df
    return df.withColumn("Date", F.make_date(F.col("Year").cast("int"), F.col("Month").cast("int"), F.lit(1)))


def rederive_period(df: DataFrame) -> DataFrame:
    date = F.to_date("Date")
    return df.withColumns({"Year": F.year(date), "Month": F.month(date)})


def date_range_check(cfg: Config) -> q.Check:
    lo, hi = cfg.tx_years
    return q.condition_check("date_range", (F.col("Year") < lo) | (F.col("Year") > hi), "date_out_of_expected_range")


def transaction_checks(outlets: DataFrame, cfg: Config, distributors: Sequence[str] = DISTRIBUTORS) -> list[q.Check]:
    """Duplicates come before nulls, so null keys collapse as well."""
    return [
        q.duplicate_check(["Outlet_ID", "Date", "Volume_Litres"], ROW_ID, order_by=["Distributor_ID"], cluster="Outlet_ID"),
        q.null_check(["Outlet_ID", "Date", "Volume_Litres"]),
        q.ref_integrity_check("Outlet_ID", outlets, "Outlet_ID"),
        q.value_set_check("Distributor_ID", distributors),
        q.range_check("Volume_Litres", cfg.min_volume),
    ]


def iqr_outlier_flag(df: DataFrame, cfg: Config) -> DataFrame:
    """Flag volumes above Q3 + k IQR of the outlet; outlets with few rows use the whole table's quartiles."""
    k = cfg.iqr_factor
    whole = scalar_quantiles(df, "Volume_Litres", [0.25, 0.75])
    limit = lambda a: a[1] + (a[1] - a[0]) * k
    above = F.col("Volume_Litres") > F.when(F.col("group_rows") < cfg.iqr_min_rows, limit(whole)).otherwise(limit(F.col("q")))
    return (with_group_quantiles(df, ["Outlet_ID"], "Volume_Litres", [0.25, 0.75])
            .withColumn("is_volume_outlier", F.coalesce(above, F.lit(False))).drop("q", "group_rows"))


def blackout_months(df: DataFrame) -> DataFrame:
    """(Outlet_ID, Year, Month) without volume strictly between an outlet's first and last active month.

    Only months that occur in the data count. The active months of an outlet are a set no larger
    than the number of months, so the gaps are an array difference and nothing is cross-joined.
    """
    idx = (F.col("Year") * 12 + F.col("Month") - 1).cast("int")
    monthly = df.groupBy("Outlet_ID", idx.alias("i")).agg(F.sum("Volume_Litres").alias("v"))
    seen = monthly.agg(F.collect_set("i")).scalar()
    active = (monthly.where("v > 0").groupBy("Outlet_ID").agg(F.collect_set("i").alias("a")).where(F.size("a") >= 2))
    inside = F.filter("seen", lambda m: (m > F.array_min("a")) & (m < F.array_max("a")))
    out = active.withColumn("seen", seen).select("Outlet_ID", F.explode(F.array_except(inside, F.col("a"))).alias("i"))
    return out.select("Outlet_ID", F.floor(F.col("i") / 12).cast("int").alias("Year"), (F.col("i") % 12 + 1).alias("Month"))


def flag_blackouts(df: DataFrame) -> DataFrame:
    b = blackout_months(df).withColumn("_b", F.lit(True))
    return (df.join(b, ["Outlet_ID", "Year", "Month"], "left")
            .withColumn("is_blackout_period", F.coalesce("_b", F.lit(False))).drop("_b"))


def check_period(raw: DataFrame, cfg: Config) -> q.CheckRun:
    df = rederive_period(canonical_columns(synth_month_date(raw)))
    return q.run_checks(df, [date_range_check(cfg)], "transactions")


def check_transactions(raw: DataFrame, outlets: DataFrame, cfg: Config) -> tuple[q.CheckRun, q.CheckRun]:
    """(period check, data-quality run on its survivors)."""
    period = check_period(raw, cfg)
    return period, q.run_checks(period.passed, transaction_checks(outlets, cfg), "transactions")


def finish_transactions(passed: DataFrame, cfg: Config, source: str = "transactions_history_final.csv") -> DataFrame:
    flagged = iqr_outlier_flag(passed, cfg)
    # every passed row has a positive volume, so no row can lie in a month without volume: no join needed
    flagged = flagged.withColumn("is_blackout_period", F.lit(False)) if cfg.min_volume > 0 else flag_blackouts(flagged)
    return flagged.withColumns({"Date": F.trunc("Date", "MM"), "row_source": F.lit(source)}).select(*TRANSACTION_COLUMNS)


def clean_transactions(raw: DataFrame, outlets: DataFrame, cfg: Config) -> Cleaned:
    period, run = check_transactions(raw, outlets, cfg)
    return Cleaned(finish_transactions(run.passed, cfg), q.quarantine_union([period.failed, run.failed]), run.report())


# --- seasonality -----------------------------------------------------------------------------

def seasonality_checks(cfg: Config) -> list[q.Check]:
    lo, hi = cfg.season_years
    return [
        q.duplicate_check(["Distributor_ID", "Year", "Month"], ROW_ID, order_by=["Seasonality_Index"]),
        q.null_check(["Distributor_ID", "Year", "Month", "Seasonality_Index"]),
        q.value_set_check("Seasonality_Index", tuple(SEASON_MULTIPLIER)),
        q.range_check("Year", lo, hi),
        q.range_check("Month", 1, 12),
    ]


def seasonality_completeness(df: DataFrame, cfg: Config, distributors: Sequence[str] = DISTRIBUTORS) -> DataFrame:
    """(distributor, year, month) combinations the table lacks."""
    spark = df.sparkSession
    lo, hi = cfg.season_years
    expected = (spark.createDataFrame([(d,) for d in distributors], "Distributor_ID string")
                .withColumn("Year", F.explode(F.sequence(F.lit(lo), F.lit(hi))))
                .withColumn("Month", F.explode(F.sequence(F.lit(1), F.lit(12)))))
    have = df.where("Seasonality_Index is not null").select("Distributor_ID", F.col("Year").cast("int").alias("Year"), F.col("Month").cast("int").alias("Month"))
    return expected.join(have, ["Distributor_ID", "Year", "Month"], "left_anti")


def seasonality_extrapolate(df: DataFrame, cfg: Config) -> DataFrame:
    """Copy the target month of the year before as the target month, flagged."""
    year, month = cfg.target
    copied = df.where((F.col("Year") == year - 1) & (F.col("Month") == month)).withColumns(
        {"Year": F.lit(year), "is_extrapolated": F.lit(True)})
    return df.withColumn("is_extrapolated", F.lit(False)).unionByName(copied)


def clean_seasonality(raw: DataFrame, cfg: Config, strict: bool = True) -> Cleaned:
    """The source must be clean: with ``strict`` any failed row aborts."""
    run = q.run_checks(raw, seasonality_checks(cfg), "seasonality")
    passed = q.fail_on_quarantine(run) if strict else run.passed
    typed = passed.withColumns({"Year": F.col("Year").cast("int"), "Month": F.col("Month").cast("int")})
    return Cleaned(seasonality_extrapolate(typed, cfg).select(*SEASONALITY_COLUMNS), run.failed, run.report())
