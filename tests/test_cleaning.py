import datetime as dt
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from retailpot.config import Config
from retailpot.operators import cleaning, holidays
from retailpot.sources import ingest

CFG = Config()


def test_outlets_are_normalised_imputed_and_checked(spark):
    data = [("OUT_00001", " small ", 1, "Grocry"), ("OUT_00002", None, 5, " Eatery "), ("OUT_00003", "nan", 0, "Kiosk"), ("OUT_00004", "Huge", 2, "Kiosk"),
            ("OUT_00005", "extra large", 2, "Moon"), ("BAD_00001", "Small", 1, "Kiosk"), ("OUT_00001", "Small", 1, "Kiosk"), ("OUT_00006", "Small", 9, "Kiosk"), ("OUT_00007", None, 3, "Kiosk")]
    raw = spark.createDataFrame([(*r, i) for i, r in enumerate(data)], "Outlet_ID string, Outlet_Size string, Cooler_Count long, Outlet_Type string, ingest_id long")
    got = cleaning.clean_outlets(raw, CFG)
    assert rows(got.clean) == [
        ("OUT_00001", "Small", 1, "Grocery", False), ("OUT_00002", "Extra Large", 5, "Eatery", True),
        ("OUT_00003", "Small", 0, "Kiosk", True), ("OUT_00007", "Large", 3, "Kiosk", True)]
    assert {r.failure_reason for r in got.rejected.collect()} == {
        "duplicate_record", r"format_violation:Outlet_ID:pattern=OUT_\d{5}", "out_of_range:Cooler_Count:value=9",
        "invalid_value:Outlet_Size:found=Huge", "invalid_value:Outlet_Type:found=Moon"}


def test_coordinates_zero_swapped_and_outside(spark):
    raw = spark.createDataFrame([("a", 0.0, 0.0, 1), ("b", 80.0, 7.0, 2), ("c", 12.0, 80.0, 3), ("d", 7.0, 80.0, 4), ("e", 5.9, 81.9, 5), ("x", 7.0, 80.0, 6), ("f", None, 80.0, 7)],
                                "Outlet_ID string, Latitude double, Longitude double, ingest_id long")
    got = cleaning.clean_coordinates(raw, spark.createDataFrame([(c,) for c in "abcdef"], "Outlet_ID string"), CFG)
    assert rows(got.clean) == [("b", 7.0, 80.0, True), ("d", 7.0, 80.0, False), ("e", 5.9, 81.9, False)]
    assert {r.Outlet_ID: r.failure_reason for r in got.rejected.collect()} == {
        "a": "zero_coordinates", "c": "coordinates_out_of_sri_lanka_bounds", "x": "referential_integrity_violation:Outlet_ID", "f": "null_in_mandatory_field:Latitude"}


def test_canonical_columns(spark):
    df = spark.createDataFrame([("a", "d", 1.0)], "` OUTLET ID` string, dist_id string, QTY double")
    assert ingest.canonical_columns(df).columns == ["Outlet_ID", "Distributor_ID", "Volume_Litres"]
    with pytest.raises(ValueError):
        ingest.canonical_columns(df.drop("QTY"))


def test_transactions_end_to_end(spark):
    data = [("a", 2023, 1, "DIST_W_01", 10.0), ("a", 2023, 1, "DIST_W_02", 10.0), ("a", 2019, 1, "DIST_W_01", 10.0), ("a", 2023, 2, "DIST_X_99", 5.0),
            ("a", 2023, 3, "DIST_W_01", -5.0), ("a", 2023, 4, "DIST_W_01", None), ("z", 2023, 1, "DIST_W_01", 1.0), (None, 2023, 1, "DIST_W_01", 2.0)]
    raw = spark.createDataFrame([(*r, i) for i, r in enumerate(data)], "Outlet_ID string, Year long, Month long, Distributor_ID string, Volume_Liters double, ingest_id long")
    got = cleaning.clean_transactions(raw, spark.createDataFrame([("a",)], "Outlet_ID string"), CFG)
    assert rows(got.clean, "Outlet_ID", "Date", "Distributor_ID", "Volume_Litres", "is_blackout_period") == [("a", dt.date(2023, 1, 1), "DIST_W_01", 10.0, False)]
    assert got.clean.count() + got.rejected.count() == len(data)
    assert sorted(r.failure_reason for r in got.rejected.collect()) == sorted([
        "date_out_of_expected_range", "duplicate_record", "invalid_value:Distributor_ID:found=DIST_X_99", "out_of_range:Volume_Litres:value=-5.0",
        "null_in_mandatory_field:Volume_Litres", "referential_integrity_violation:Outlet_ID", "null_in_mandatory_field:Outlet_ID"])


def test_iqr_flag_small_outlets_use_all_rows(spark):
    data = [("a", float(v)) for v in (1, 2, 3, 4, 100)] + [("b", 100.0), ("b", 2.0), ("b", 3.0)] + [("c", float(v)) for v in (100, 100, 100, 101)]
    df = spark.createDataFrame(data, "Outlet_ID string, Volume_Litres double")
    got = cleaning.iqr_outlier_flag(df, replace(CFG, iqr_factor=1.5))
    assert ("a", 100.0, True) in rows(got) and ("c", 101.0, True) in rows(got) and not any(r[2] for r in rows(got) if r[0] == "b")
    assert got.count() == len(data)


def test_blackouts_only_between_active_months_that_exist(spark):
    data = [("a", 2023, 1, 1.0), ("a", 2023, 4, 1.0), ("b", 2023, 2, 1.0), ("b", 2023, 5, 1.0), ("c", 2023, 3, 0.0), ("c", 2023, 2, 3.0)]
    df = spark.createDataFrame(data, "Outlet_ID string, Year int, Month int, Volume_Litres double")
    assert rows(cleaning.blackout_months(df)) == [("a", 2023, 2), ("a", 2023, 3), ("b", 2023, 3), ("b", 2023, 4)]


def test_seasonality(spark):
    raw = spark.createDataFrame([("DIST_W_01", 2025, 1, "Favorable", 1), ("DIST_W_01", 2025, 2, "Moderate", 2)], "Distributor_ID string, Year int, Month int, Seasonality_Index string, ingest_id long")
    got = cleaning.clean_seasonality(raw, CFG)
    assert ("DIST_W_01", 2026, 1, "Favorable", True) in rows(got.clean) and got.clean.count() == 3
    assert cleaning.seasonality_completeness(raw, CFG).count() == 10 * 3 * 12 - 2
    with pytest.raises(AssertionError):
        cleaning.clean_seasonality(raw.withColumn("Month", F.lit(13)), CFG)


def test_calendar(spark):
    raw = spark.createDataFrame([("2025-05-01T00:00:00+00:00", 2, "B", "Bank"), ("2025-05-01T00:00:00+00:00", 1, "A", "Public"), ("bad", 3, "C", "Bank"), ("2025-05-02", 4, "D", "Other")],
                                "Date string, row_id int, Holiday_Name string, Holiday_Type string")
    cal, _ = holidays.clean_holidays(raw, CFG)
    assert rows(cal)[0] == (dt.date(2025, 5, 1), "A", True, True, False, False, False) and cal.count() == 3
    assert tuple(holidays.trading_days(cal, CFG).first()) == (20, 2)  # 22 weekdays in January 2026, both holidays on weekdays
