"""Holiday calendar and trading days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailpot.config import HOLIDAY_TYPES, Config
from retailpot.operators import quality as q

HOLIDAY_SCHEMA = "date date, Holiday_Name string, is_public boolean, is_bank boolean, is_mercantile boolean, is_poya_day boolean"


def parse_holiday_dates(df: DataFrame, column: str = "Date") -> DataFrame:
    """UTC date of each row; rows whose date cannot be read are dropped."""
    return df.withColumn("date_parsed", F.to_date(F.try_to_timestamp(F.col(column).cast("string")))).where("date_parsed is not null")


def holiday_checks() -> list[q.Check]:
    return [q.null_check(["Holiday_Name", "Holiday_Type"]), q.value_set_check("Holiday_Type", tuple(HOLIDAY_TYPES))]


def holiday_pivot(df: DataFrame, date: str, order: str) -> DataFrame:
    """One row per date: a flag per holiday type and the name of the first row."""
    kind = F.trim("Holiday_Type")
    flags = [F.bool_or(kind == t).alias(flag) for t, flag in HOLIDAY_TYPES.items()]
    return df.groupBy(F.col(date).alias("date")).agg(F.min_by("Holiday_Name", order).alias("Holiday_Name"), *flags)


def append_calendar_rows(pivoted: DataFrame, rows, spark=None) -> DataFrame:
    """Union hand-supplied future holidays, flagged."""
    extra = pivoted.sparkSession.createDataFrame(list(rows), HOLIDAY_SCHEMA).withColumn("is_manually_added", F.lit(True))
    return pivoted.withColumn("is_manually_added", F.lit(False)).unionByName(extra)


def trading_days(holidays: DataFrame, cfg: Config) -> DataFrame:
    """One row: weekdays of the target month without holidays, and the number of holidays."""
    year, month = cfg.target
    first = F.make_date(F.lit(year), F.lit(month), F.lit(1))
    inside = holidays.where((F.col("date") >= first) & (F.col("date") <= F.last_day(first))).select("date").distinct()
    days = holidays.sparkSession.range(1).select(F.explode(F.sequence(first, F.last_day(first))).alias("date"))
    open_days = days.where(F.weekday("date") < 5).join(inside, "date", "left_anti")
    return open_days.agg(F.count("*").alias("trading_days")).withColumn("holiday_count", inside.agg(F.count("*")).scalar())


def clean_holidays(raw: DataFrame, cfg: Config, order: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """(calendar, check report)."""
    run = q.run_checks(parse_holiday_dates(raw), holiday_checks(), "holidays")
    return append_calendar_rows(holiday_pivot(run.passed, "date_parsed", order), cfg.manual_holidays), run.report()
