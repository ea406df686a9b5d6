"""T1-T3: naive local time, the 10:00 cutoff, day-of-week numbering."""

from pyspark.sql import functions as F

from daycast.functions.time import cutoff_time, day_of_week0, epoch_day, hour_floor, shift_days, to_ntz
from tests.conftest import ts


def test_spring_gap_hour_survives_any_session_zone(new_york):
    df = new_york.createDataFrame([("2024-03-10 02:00:00",), ("2024-03-10 02:30:00",)], "s string")
    out = df.select(to_ntz("s").alias("t")).select("t", hour_floor("t").alias("h")).collect()
    assert [r.t for r in out] == [ts("2024-03-10T02:00:00"), ts("2024-03-10T02:30:00")]
    assert [r.h for r in out] == [ts("2024-03-10T02:00:00"), ts("2024-03-10T02:00:00")]


def test_fall_back_duplicates_stay_distinct_rows(new_york):
    df = new_york.createDataFrame([("2024-11-03 01:00:00",), ("2024-11-03 01:00:00",)], "s string")
    out = df.select(to_ntz("s").alias("t")).collect()
    assert [r.t for r in out] == [ts("2024-11-03T01:00:00")] * 2


def test_cutoff_is_ten_am_day_before_inclusive(new_york):
    df = new_york.createDataFrame([("2024-03-11 05:00:00",)], "s string").select(to_ntz("s").alias("target"))
    c = df.select(cutoff_time("target", 1, 10).alias("c")).first().c
    assert c == ts("2024-03-10T10:00:00")
    assert df.schema["target"].dataType.typeName() == "timestamp_ntz"


def test_shift_days_keeps_wall_clock_across_dst(new_york):
    df = new_york.createDataFrame([("2024-03-12 02:00:00",)], "s string").select(to_ntz("s").alias("t"))
    assert df.select(shift_days("t", -2).alias("x")).first().x == ts("2024-03-10T02:00:00")
    assert df.select((epoch_day("t") - epoch_day(shift_days("t", -2))).alias("x")).first().x == 2


def test_day_of_week_sunday_is_zero(spark):
    df = spark.createDataFrame([("2024-03-10 12:00:00",), ("2024-03-16 12:00:00",), ("2024-03-11 12:00:00",)],
                               "s string").select(to_ntz("s").alias("t"))
    assert [r.w for r in df.select(day_of_week0("t").alias("w")).collect()] == [0, 6, 1]


def test_malformed_timestamp_text_raises_under_ansi(spark):
    import pytest
    df = spark.createDataFrame([("not a time",)], "s string")
    with pytest.raises(Exception):
        df.select(to_ntz("s")).collect()
    assert df.select(F.col("s").try_cast("timestamp_ntz").alias("x")).first().x is None
