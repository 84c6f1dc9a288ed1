"""Profiles of raw and modelled tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from retailpot.config import Config
from retailpot.operators.quantiles import grouped_quantiles, scalar_quantiles
from retailpot.session import kept


def _unpivot(one: DataFrame, key: str, value: str) -> DataFrame:
    return one.unpivot([], one.columns, key, value)


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _unpivot(df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]), "column", "nulls")


def negative_profile(df: DataFrame, column: str) -> DataFrame:
    """Count and share of negative values and their description. The column is stored first, as quantiles take several passes."""
    df = kept(df.select(column))
    neg = df.where(F.col(column) < 0)
    qs = scalar_quantiles(neg, column, [0.25, 0.5, 0.75])
    n = df.agg(F.count("*")).scalar()
    c = F.col(column)
    return neg.agg(F.count("*").alias("n"), F.try_divide(F.count("*") * 100.0, n).alias("pct"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                   F.min(c).alias("min"), F.max(c).alias("max")).withColumns({"p25": qs[0], "p50": qs[1], "p75": qs[2]})


def missing_periods(df: DataFrame, date: str) -> DataFrame:
    """First-of-month dates between the first and last date that never occur."""
    m = F.trunc(date, "MM")
    r = df.agg(F.struct(F.min(m).alias("lo"), F.max(m).alias("hi"))).scalar()
    months = df.sparkSession.range(1).select(F.explode(F.sequence(r.getField("lo"), r.getField("hi"), F.expr("interval 1 month"))).alias("month"))
    return months.join(df.select(m.alias("month")).distinct(), "month", "left_anti")


def iqr_profile(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """Quartile fences over all rows and the rows outside. The column is stored first, as quantiles take several passes."""
    df = kept(df.select(column))
    qs = scalar_quantiles(df, column, [0.25, 0.75])
    c, iqr = F.col(column), qs[1] - qs[0]
    lo, hi = qs[0] - iqr * factor, qs[1] + iqr * factor
    out = F.count_if((c < lo) | (c > hi))
    return df.agg(out.alias("outliers"), F.try_divide(out * 100.0, F.count("*")).alias("outlier_pct")).withColumns(
        {"iqr": iqr, "lower_bound": lo, "upper_bound": hi})


def holiday_month_counts(tx: DataFrame, holidays: DataFrame, kinds: Sequence[str], date: str, volume: str) -> DataFrame:
    """Monthly volume with the number of holidays per type; months without holidays get 0."""
    h = (holidays.groupBy(F.trunc("Date", "MM").alias("month")).pivot("Holiday_Type", list(kinds)).agg(F.count(F.lit(1))))
    v = tx.groupBy(F.trunc(date, "MM").alias("month")).agg(F.sum(volume).alias("volume"))
    return v.join(h, "month", "left").select("month", F.coalesce("volume", F.lit(0.0)).alias("volume"),
                                             *[F.coalesce(F.col(f"`{k}`"), F.lit(0)).alias(k) for k in kinds])


def key_coverage(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(side, key) of keys that only one of the tables has."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    return (x.join(y, key, "left_anti").withColumn("side", F.lit("only_left"))
            .unionByName(y.join(x, key, "left_anti").withColumn("side", F.lit("only_right"))).select("side", key))


def period_alignment(a: DataFrame, b: DataFrame) -> DataFrame:
    n = lambda d: d.select("Year", "Month").distinct().agg(F.count("*")).scalar()
    return a.sparkSession.range(1).select(n(a).alias("left_periods"), n(b).alias("right_periods"))


def category_profile(df: DataFrame, column: str, contract: Sequence[str]) -> DataFrame:
    c = F.col(column)
    return df.groupBy(c.alias("value")).agg(F.count("*").alias("n")).withColumn(
        "off_contract", F.col("value").isNotNull() & ~F.coalesce(F.col("value").isin(*contract), F.lit(False)))


def coord_status(df: DataFrame, cfg: Config) -> DataFrame:
    """Zero first, then valid, then swapped, else out of bounds."""
    b, lat, lon = cfg.bounds, F.col("Latitude"), F.col("Longitude")
    valid = lat.between(b.lat_min, b.lat_max) & lon.between(b.lon_min, b.lon_max)
    swapped = lat.between(b.lon_min, b.lon_max) & lon.between(b.lat_min, b.lat_max)
    zero = (lat == 0) & (lon == 0)
    label = F.when(zero, "Zero Coordinates").when(valid, "Valid").when(swapped, "Swapped").otherwise("Out of Bounds")
    return df.withColumn("Status", label)


def numeric_columns(df: DataFrame, leave: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in leave]


def target_correlation(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every numeric column with the target, highest first; constant columns are null."""
    columns = list(columns or numeric_columns(df))

    def pearson(c: str) -> Column:
        x, y = F.col(c).cast("double"), F.col(target).cast("double")
        x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)  # pairs only
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    one = df.agg(*[pearson(c).alias(c) for c in columns])
    return _unpivot(one, "feature", "correlation").orderBy(F.col("correlation").desc_nulls_last(), "feature")


def holdout_split(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test`` by an MD5 of the key and seed: the same rows in every run, partitioning and engine."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 10_000
    return df.withColumn("is_test", bucket < int(test_share * 10_000))


def residual_topk(df: DataFrame, prediction: str, actual: str, k: int = 10) -> DataFrame:
    """The ``k`` rows predicted furthest above the actual."""
    diff = F.col(prediction) - F.col(actual)
    return df.select("Outlet_ID", F.col(actual).alias("Actual"), F.col(prediction).alias("Predicted"), diff.alias("Diff")).orderBy(
        F.col("Diff").desc(), "Outlet_ID").limit(k)


def feature_summary(df: DataFrame, columns: Sequence[str], where: Column | None = None) -> DataFrame:
    """Mean, median and max per column, over all rows or those with data."""
    rows = df if where is None else df.where(where)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in columns]))
    long = rows.select(pairs.alias("x")).select("x.*")
    stats = long.groupBy("feature").agg(F.avg("v").alias("mean"), F.max("v").alias("max"))
    return stats.join(grouped_quantiles(long, ["feature"], "v", [0.5]), "feature").select(
        "feature", "mean", F.col("q")[0].alias("median"), "max")
