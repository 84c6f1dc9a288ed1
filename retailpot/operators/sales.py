"""Monthly sales features per outlet.

The series of an outlet is dense by definition (every month of the data span, missing months 0), but
it is never densified here: after the aggregation to (outlet, month) every feature is a plain sum,
count or maximum over the months that have rows, with the empty months accounted for in closed form.
An outlet has at most one row per month by then, so a busy outlet is no heavier than a quiet one.
``dense_month_grid`` is still there for callers who want the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailpot.functions.numeric import scalar_struct

ZERO_FILLED = (
    "hist_max_monthly", "hist_p90_monthly", "hist_p75_monthly", "hist_mean_monthly", "hist_std_monthly", "hist_cv",
    "jan_avg_volume", "jan_max_volume", "jan_count", "active_months", "active_months_pct",
    "consecutive_zero_months_max", "recent_3m_avg", "months_since_last_order", "total_volume", "ema_3m", "ema_6m",
)
SALES_COLUMNS = (
    "Outlet_ID", "hist_max_monthly", "hist_p90_monthly", "hist_p75_monthly", "hist_mean_monthly", "hist_std_monthly",
    "hist_cv", "jan_avg_volume", "jan_max_volume", "jan_count", "active_months", "active_months_pct",
    "consecutive_zero_months_max", "yoy_growth_rate", "recent_3m_avg", "trend_slope", "months_since_last_order",
    "total_volume", "distributor_id", "ema_3m", "ema_6m",
)


def month_index(year: str | Column = "Year", month: str | Column = "Month") -> Column:
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    return (y * 12 + m - 1).cast("int")


def monthly_agg(tx: DataFrame) -> DataFrame:
    """Volume and row count by outlet and month, blackout rows left out."""
    return (tx.where(~F.col("is_blackout_period")).groupBy("Outlet_ID", "Year", "Month")
            .agg(F.sum("Volume_Litres").alias("monthly_volume"), F.count("Volume_Litres").alias("transaction_count")))


def month_span(tx: DataFrame) -> Column:
    """Scalar struct (lo, hi) of the first and last month index in the data."""
    i = month_index()
    return scalar_struct(tx, lo=F.min(i), hi=F.max(i))


def dense_month_grid(monthly: DataFrame, span: Column) -> DataFrame:
    """Every outlet x month of the span with 0 for missing months."""
    months = F.sequence(span.getField("lo"), span.getField("hi"))
    grid = monthly.select("Outlet_ID").distinct().select("Outlet_ID", F.explode(months).alias("_i"))
    have = monthly.select("Outlet_ID", month_index().alias("_i"), "monthly_volume")
    return grid.join(have, ["Outlet_ID", "_i"], "left").select(
        "Outlet_ID", F.floor(F.col("_i") / 12).cast("int").alias("Year"), (F.col("_i") % 12 + 1).alias("Month"),
        F.coalesce("monthly_volume", F.lit(0.0)).alias("monthly_volume"))


def series(monthly: DataFrame, span: Column) -> DataFrame:
    """One row per outlet with the sums that all features follow from.

    ``n`` months in the span, ``m`` of them with rows; ``i`` counts months from the span start. Order
    statistics of the zero-filled series come from a descending rank that leaves room for the zeros.
    """
    base = monthly.select("Outlet_ID", F.col("monthly_volume").cast("double").alias("v"), (month_index() - span.getField("lo")).alias("i"),
                          span.getField("lo").alias("lo"), (span.getField("hi") - span.getField("lo") + 1).alias("n"))
    outlet = Window.partitionBy("Outlet_ID")  # at most n rows each
    earlier = outlet.orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    v, i, n = F.col("v"), F.col("i"), F.col("n")
    rows = base.withColumns({
        "before": F.coalesce(F.max(F.when(v != 0, i)).over(earlier), F.lit(-1)),
        "down": F.row_number().over(outlet.orderBy(v.desc(), i)) + F.when(v < 0, n - F.count("*").over(outlet)).otherwise(F.lit(0)),
    })
    month, year_of = F.col("lo") + i, lambda x: F.floor(x / 12)
    january = month % 12 == 0
    last = F.col("lo") + n - 1

    def when_sum(cond: Column, x: Column) -> Column:
        return F.sum(F.when(cond, x).otherwise(F.lit(0.0)))

    def ema_sum(span_months: int) -> Column:
        alpha = 2.0 / (span_months + 1)
        return F.sum(v * F.pow(F.lit(1 - alpha), n - 1 - i) * F.when(i == 0, F.lit(1.0)).otherwise(F.lit(alpha)))

    def ranked(p: float, shift: int) -> Column:
        """Value at sorted position floor(p (n - 1)) + shift, counted from the top; 0 where a zero stands."""
        k = F.least(F.floor(F.lit(p) * (n - 1)) + shift, n - 1)
        return F.coalesce(F.max(F.when(F.col("down") == n - k, v)), F.lit(0.0))

    return rows.groupBy("Outlet_ID").agg(
        F.max("lo").alias("lo"), F.max("n").alias("n"), F.count("*").alias("m"), F.sum("v").alias("total"), F.max("v").alias("top"),
        (F.var_pop("v") * F.count("*")).alias("m2"), F.count_if(v > 0).cast("int").alias("active"), F.max(F.when(v > 0, i)).alias("last_active"),
        F.max(F.when(v != 0, i)).alias("last_used"), F.max(F.when(v != 0, i - F.col("before") - 1)).alias("gap"),
        when_sum(january, v).alias("jan_total"), F.max(F.when(january, v)).alias("jan_top"), F.count_if(january).alias("jan_rows"),
        F.count_if(january & (v > 0)).cast("int").alias("jan_active"), when_sum(i >= n - 3, v).alias("recent_total"), F.sum(v * i).alias("siv"),
        when_sum(year_of(month) == year_of(F.col("lo")), v).alias("first_year"), when_sum(year_of(month) == year_of(last), v).alias("last_year"),
        ema_sum(3).alias("ema_3"), ema_sum(6).alias("ema_6"),
        *[ranked(p, d).alias(f"q{round(p * 100)}_{d}") for p in (0.90, 0.75) for d in (0, 1)])


def _n() -> Column:
    return F.col("n").cast("double")


def hist_stats() -> dict[str, Column]:
    n, m, total = _n(), F.col("m"), F.col("total")
    zeros = n - m
    # squared deviations of the months with rows, joined with those of the empty months
    spread = F.col("m2") + (total / m) * (total / m) * m * zeros / n
    return {
        "hist_max_monthly": F.when(zeros > 0, F.greatest("top", F.lit(0.0))).otherwise(F.col("top")),
        "hist_mean_monthly": total / n,
        "hist_std_monthly": F.when(n > 1, F.sqrt(spread / (n - 1))).otherwise(F.lit(0.0)),
        "total_volume": total,
    }


def hist_quantiles() -> dict[str, Column]:
    """Exact P90 and P75 of the zero-filled series, linear interpolation."""
    def at(p: float) -> Column:
        pos = F.lit(p) * (_n() - 1)
        a, b = F.col(f"q{round(p * 100)}_0"), F.col(f"q{round(p * 100)}_1")
        return a + (b - a) * (pos - F.floor(pos))

    return {"hist_p90_monthly": at(0.90), "hist_p75_monthly": at(0.75)}


def hist_cv() -> dict[str, Column]:
    st = hist_stats()
    return {"hist_cv": F.when(st["hist_mean_monthly"] > 0, st["hist_std_monthly"] / st["hist_mean_monthly"]).otherwise(F.lit(0.0))}


def active_months() -> dict[str, Column]:
    return {"active_months": F.col("active"), "active_months_pct": F.col("active") / _n()}


def january_features() -> dict[str, Column]:
    """Januaries only; the mean counts empty Januaries, the count does not."""
    last = F.col("lo") + F.col("n") - 1
    januaries = F.floor(last / 12) - F.floor((F.col("lo") - 1) / 12)
    top = F.coalesce("jan_top", F.lit(0.0))
    return {
        "jan_avg_volume": F.when(januaries > 0, F.col("jan_total") / januaries).otherwise(F.lit(0.0)),
        "jan_max_volume": F.when(F.col("jan_rows") < januaries, F.greatest(top, F.lit(0.0))).otherwise(top),
        "jan_count": F.col("jan_active"),
    }


def max_zero_run() -> dict[str, Column]:
    """Longest run of empty months: the widest gap between used months, both ends included."""
    tail = F.col("n") - 1 - F.coalesce("last_used", F.lit(-1))
    return {"consecutive_zero_months_max": F.greatest(F.coalesce("gap", F.lit(0)), tail)}


def months_since_last() -> dict[str, Column]:
    return {"months_since_last_order": F.coalesce(F.col("n") - 1 - F.col("last_active"), F.col("n"))}


def recent_3m_avg() -> dict[str, Column]:
    return {"recent_3m_avg": F.col("recent_total") / F.least(_n(), F.lit(3.0))}


def trend_slope() -> dict[str, Column]:
    """Least-squares slope over the month index; null below six months."""
    n = _n()
    sx, sxx = n * (n - 1) / 2, n * (n - 1) * (2 * n - 1) / 6
    return {"trend_slope": F.when(n >= 6, (n * F.col("siv") - sx * F.col("total")) / (n * sxx - sx * sx))}


def yoy_growth() -> dict[str, Column]:
    """Last-year mean against first-year mean; null with one year only or an empty first year."""
    lo, hi = F.col("lo"), F.col("lo") + F.col("n") - 1
    first_months, last_months = (F.floor(lo / 12) + 1) * 12 - lo, hi - F.floor(hi / 12) * 12 + 1
    first, last = F.col("first_year") / first_months, F.col("last_year") / last_months
    return {"yoy_growth_rate": F.when((F.floor(hi / 12) > F.floor(lo / 12)) & (first != 0), (last - first) / first)}


def ema() -> dict[str, Column]:
    """Last value of the exponential moving averages of span 3 and 6, without adjustment."""
    return {"ema_3m": F.col("ema_3"), "ema_6m": F.col("ema_6")}


def all_series_features() -> dict[str, Column]:
    return {**hist_stats(), **hist_quantiles(), **hist_cv(), **january_features(), **active_months(), **max_zero_run(),
            **months_since_last(), **recent_3m_avg(), **trend_slope(), **yoy_growth(), **ema()}


def distributor_counts(tx: DataFrame) -> DataFrame:
    return tx.where("Distributor_ID is not null").groupBy("Outlet_ID", "Distributor_ID").agg(F.count("*").alias("_n"))


def mode_distributor(tx: DataFrame) -> DataFrame:
    """Most frequent distributor per outlet, ties to the smallest id."""
    best = F.min(F.struct((-F.col("_n")).alias("neg"), F.col("Distributor_ID").alias("id")))
    return distributor_counts(tx).groupBy("Outlet_ID").agg(best.getField("id").alias("distributor_id"))


def global_mode(tx: DataFrame) -> Column:
    counts = tx.where("Distributor_ID is not null").groupBy("Distributor_ID").agg(F.count("*").alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("neg"), F.col("Distributor_ID").alias("id")))
    return counts.agg(best.getField("id")).scalar()


def sales_features(tx: DataFrame, outlets: DataFrame) -> DataFrame:
    """All features on every outlet; trend and growth stay null where undefined."""
    span = month_span(tx)
    feats = all_series_features()
    computed = series(monthly_agg(tx), span).select("Outlet_ID", *[c.alias(k) for k, c in feats.items()])
    out = (outlets.select("Outlet_ID").join(computed, "Outlet_ID", "left").join(mode_distributor(tx), "Outlet_ID", "left"))
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ZERO_FILLED})
    n = span.getField("hi") - span.getField("lo") + 1
    return out.withColumns({
        "months_since_last_order": F.when(F.col("active_months") == 0, n).otherwise(F.col("months_since_last_order")),
        "distributor_id": F.coalesce("distributor_id", global_mode(tx))}).select(*SALES_COLUMNS)
