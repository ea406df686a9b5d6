"""Calendar flags and the rule-generated holiday dimension."""

import datetime as dt

from pyspark.sql import functions as F

from daycast.operators.calendar import calendar_features, holiday_dim_range, holiday_expr, holiday_flag

# Known US federal holiday dates (including observed days) for 2024-2026.
KNOWN = {
    "2024-01-01", "2024-01-15", "2024-02-19", "2024-05-27", "2024-06-19", "2024-07-04", "2024-09-02",
    "2024-10-14", "2024-11-11", "2024-11-28", "2024-12-25",
    "2025-01-01", "2025-01-20", "2025-02-17", "2025-05-26", "2025-06-19", "2025-07-04", "2025-09-01",
    "2025-10-13", "2025-11-11", "2025-11-27", "2025-12-25",
    "2026-01-01", "2026-01-19", "2026-02-16", "2026-05-25", "2026-06-19", "2026-07-03", "2026-07-04",
    "2026-09-07", "2026-10-12", "2026-11-11", "2026-11-26", "2026-12-25",
}


def test_holiday_dim_2024_2026(spark):
    got = {str(r.holiday_date) for r in holiday_dim_range(spark, 2024, 2026).collect()}
    assert got == KNOWN


def test_observed_days_across_year_end(spark):
    got = {str(r.holiday_date) for r in holiday_dim_range(spark, 2021, 2022).collect()}
    assert "2021-12-31" in got          # New Year's Day 2022 was a Saturday
    assert "2022-06-20" in got          # Juneteenth 2022 was a Sunday
    assert "2021-06-18" in got          # Juneteenth 2021 (first year) was a Saturday
    assert "2022-12-26" in got


def test_expression_agrees_with_dimension(spark):
    days = spark.range(0, 365 * 12).select(F.date_add(F.lit(dt.date(2019, 1, 1)), F.col("id").cast("int")).alias("d"))
    dim = holiday_dim_range(spark, 2019, 2030)
    a = holiday_flag(days.withColumn("t", F.col("d").cast("timestamp_ntz")), "t", dim).select("d", "is_holiday")
    b = days.select("d", holiday_expr("d").alias("is_holiday"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_calendar_features(spark):
    df = spark.createDataFrame([("2024-03-10 13:00:00",)], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
    r = calendar_features(df, "t").first()
    assert (r.month, r.day_of_week, r.hour_of_day, r.is_weekend) == (3, 0, 13, 1)
