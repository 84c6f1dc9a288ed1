import numpy as np
import pandas as pd
import pytest

from retailpot.operators import sales


def expected(v, lo):
    """The features of a dense series, month by month."""
    n, s = len(v), pd.Series(v)
    years = pd.Series((lo + np.arange(n)) // 12)
    by_year = s.groupby(years).mean()
    jan = [x for i, x in enumerate(v) if (lo + i) % 12 == 0]
    run = best = 0
    for x in v:
        run = run + 1 if x == 0 else 0
        best = max(best, run)
    used = [i for i, x in enumerate(v) if x > 0]
    return {
        "hist_max_monthly": max(v), "hist_mean_monthly": s.mean(), "hist_std_monthly": s.std() if n > 1 else 0.0, "total_volume": s.sum(),
        "hist_p90_monthly": s.quantile(0.9), "hist_p75_monthly": s.quantile(0.75), "active_months": len(used),
        "jan_avg_volume": np.mean(jan) if jan else 0.0, "jan_max_volume": max(jan) if jan else 0.0, "jan_count": sum(x > 0 for x in jan),
        "consecutive_zero_months_max": best, "months_since_last_order": n - 1 - used[-1] if used else n, "recent_3m_avg": s[-3:].mean(),
        "trend_slope": np.polyfit(np.arange(n), v, 1)[0] if n >= 6 else None,
        "yoy_growth_rate": (by_year.iloc[-1] - by_year.iloc[0]) / by_year.iloc[0] if len(by_year) > 1 and by_year.iloc[0] != 0 else None,
        "ema_3m": s.ewm(span=3, adjust=False).mean().iloc[-1], "ema_6m": s.ewm(span=6, adjust=False).mean().iloc[-1],
    }


@pytest.mark.parametrize("lo,n", [(2023 * 12, 36), (2023 * 12 + 4, 14), (2023 * 12 + 10, 4), (2023 * 12 + 2, 1)])
def test_features_equal_the_dense_series(spark, lo, n):
    rng = np.random.default_rng(n)
    dense = {f"o{k}": np.where(rng.random(n) < k / 6, rng.integers(1, 50, n), 0).astype(float) for k in range(1, 7)}
    dense["all"] = rng.integers(1, 9, n).astype(float)  # spans every month, so it fixes the span
    dense["negative"] = rng.integers(-5, 6, n).astype(float)
    data = [(o, int((lo + i) // 12), int((lo + i) % 12 + 1), float(x)) for o, v in dense.items() for i, x in enumerate(v) if x != 0]
    monthly = spark.createDataFrame(data, "Outlet_ID string, Year int, Month int, monthly_volume double")
    got = sales.series(monthly, sales.month_span(monthly)).select("Outlet_ID", *[c.alias(k) for k, c in sales.all_series_features().items()])
    seen = {r.Outlet_ID: r for r in got.collect()}
    for o, v in dense.items():
        if not v.any():
            continue
        for k, x in expected(v, lo).items():
            assert (seen[o][k] is None) if x is None else seen[o][k] == pytest.approx(x, abs=1e-9), (o, k)


def test_mode_ties_and_fill(spark):
    tx = spark.createDataFrame([("a", "D2"), ("a", "D1"), ("b", "D2"), ("b", "D2"), ("b", "D1")], "Outlet_ID string, Distributor_ID string")
    assert {r.Outlet_ID: r.distributor_id for r in sales.mode_distributor(tx).collect()} == {"a": "D1", "b": "D2"}
    assert spark.range(1).select(sales.global_mode(tx)).first()[0] == "D2"


def test_outlet_without_history(spark):
    tx = spark.createDataFrame([("a", 2023, m, "D1", 5.0, False) for m in range(1, 13)], "Outlet_ID string, Year int, Month int, Distributor_ID string, Volume_Litres double, is_blackout_period boolean")
    got = {r.Outlet_ID: r for r in sales.sales_features(tx, spark.createDataFrame([("a",), ("new",)], "Outlet_ID string")).collect()}
    assert got["new"].months_since_last_order == 12 and got["new"].distributor_id == "D1" and got["new"].hist_p90_monthly == 0 and got["new"].trend_slope is None
    assert got["a"].active_months_pct == 1.0 and tuple(got["a"].asDict()) == sales.SALES_COLUMNS
    grid = sales.dense_month_grid(sales.monthly_agg(tx.where("Month in (1, 12)")), sales.month_span(tx))
    assert grid.count() == 12 and grid.where("monthly_volume = 0").count() == 10
