"""Errors, win rate with missing and tied benchmarks (T7, T8), transforms (T9), scorecards."""

import math

from pyspark.sql import functions as F

from daycast.functions.transforms import asinh_target, clip, sinh_inverse
from daycast.operators.evaluate import forecast_errors, monthly_scorecard, paired_test, win_rate
from daycast.operators.joins import attach_benchmark


def _pred(spark):
    rows = [("2024-11-03 00:00:00", 50.0, 45.0), ("2024-11-03 01:00:00", 40.0, 41.0),
            ("2024-11-03 02:00:00", 30.0, 35.0), ("2024-12-01 00:00:00", 2014.0, 100.0)]
    return spark.createDataFrame(rows, "datetime_ept string, actual_rt double, prediction double").withColumn(
        "datetime_ept", F.col("datetime_ept").cast("timestamp_ntz"))


def _bench(spark):
    rows = [("2024-11-03 00:00:00", 52.0), ("2024-11-03 01:00:00", 39.0), ("2024-11-03 01:00:00", 38.0),
            ("2024-12-01 00:00:00", 1900.0)]  # 02:00 missing (a gap), 01:00 twice
    return spark.createDataFrame(rows, "datetime_ept string, da_pred double").withColumn(
        "datetime_ept", F.col("datetime_ept").cast("timestamp_ntz"))


def test_benchmark_duplicates_do_not_fan_out(spark):
    out = attach_benchmark(_pred(spark), _bench(spark), "datetime_ept", ["da_pred"])
    assert out.count() == _pred(spark).count()


def test_missing_benchmark_is_a_loss_and_skipped_in_mae(spark):
    e = forecast_errors(attach_benchmark(_pred(spark), _bench(spark), "datetime_ept", ["da_pred"]),
                        "actual_rt", "prediction", bench="da_pred")
    rows = {r.datetime_ept.hour + 10 * r.datetime_ept.month: r for r in e.collect()}
    assert rows[112].model_win is False and rows[112].da_abs_diff is None
    w = win_rate(e).first()
    # wins: 00:00 (5 < 2) no; 01:00 (1 < 2 with min bench 38) yes; 02:00 missing -> loss; Dec: 1914 < 114 no
    assert w.win_rate == 0.25 and w.n_hours == 4
    assert math.isclose(w.bench_mae, (2 + 2 + 114) / 3)


def test_tied_error_is_not_a_win(spark):
    df = spark.createDataFrame([(10.0, 12.0, 8.0)], "a double, p double, b double")
    assert forecast_errors(df, "a", "p", bench="b").first().model_win is False


def test_monthly_scorecard_and_gap(spark):
    e = forecast_errors(attach_benchmark(_pred(spark), _bench(spark), "datetime_ept", ["da_pred"]),
                        "actual_rt", "prediction", bench="da_pred")
    m = {r.period: r for r in monthly_scorecard(e, "datetime_ept").collect()}
    assert set(m) == {"2024-11", "2024-12"}
    assert m["2024-11"].num_hours == 3 and math.isclose(m["2024-11"].gap, m["2024-11"].model_mae - m["2024-11"].bench_mae)


def test_asinh_round_trip_and_guard(spark):
    df = spark.createDataFrame([(-41.84,), (2014.0,), (None,)], "y double")
    r = df.select(asinh_target("y").alias("t"), sinh_inverse(asinh_target("y")).alias("back"),
                  sinh_inverse(asinh_target("y") * 3, bound=10).alias("g")).collect()
    assert round(r[0].t, 6) == round(math.asinh(-41.84), 6)
    assert math.isclose(r[1].back, 2014.0)
    assert math.isclose(r[1].g, math.sinh(10))
    assert r[2].t is None and r[2].g is None


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-5.0,), (50.0,), (150.0,), (None,)], "c double")
    assert [r.x for r in df.select(clip("c", 0, 100).alias("x")).collect()] == [0.0, 50.0, 100.0, None]


def test_paired_test(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 5.0), (None, 1.0)], "a double, b double")
    r = paired_test(df, "a", "b").first()
    assert r.n == 3 and math.isclose(r.mean_diff, -1.0)


def test_correlations_skip_constant_columns_under_ansi(spark):
    from daycast.operators.profile import top_correlations
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.1), (3.0, 5.0, 5.9), (None, 5.0, 1.0)],
                               "a double, const double, y double")
    out = {r.feature: r.corr for r in top_correlations(df, "y", ["a", "const"], 5).collect()}
    assert set(out) == {"a"} and out["a"] > 0.99
