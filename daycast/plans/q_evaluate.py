"""Registered evaluation queries over the prediction view (actual, prediction,
benchmark per hour)."""

from __future__ import annotations

from pyspark.sql import functions as F

from daycast.functions.transforms import asinh_target, sinh_inverse
from daycast.operators.evaluate import forecast_errors, monthly_scorecard, naive_mae, paired_test, paired_test_hac, spread, win_rate
from daycast.operators.joins import attach_benchmark, attach_columns
from daycast.operators.lags import exact_lags
from daycast.plans import views as V
from daycast.plans.oracle import with_views
from daycast.plans.registry import register

_ERR = """SELECT *, abs(actual_rt - prediction) AS model_abs_diff, abs(actual_rt - benchmark) AS bench_abs_diff,
  coalesce(abs(actual_rt - prediction) < abs(actual_rt - benchmark), false) AS model_win FROM v_pred"""
_ERR_RND = ["actual_rt", "prediction", "benchmark", "model_abs_diff", "bench_abs_diff"]


def _errors(spark, sf):
    return forecast_errors(V.v_pred(spark, sf), "actual_rt", "prediction", bench="benchmark",
                           bench_err="bench_abs_diff")


@register("forecast_errors", with_views(_ERR, "v_pred"), _ERR_RND)
def q_forecast_errors(spark, sf):
    """Per-hour absolute errors of the model and the benchmark, and the strict-win flag."""
    return _errors(spark, sf)


@register("win_rate", with_views(
    f"""SELECT avg(CAST(model_win AS DOUBLE)) AS win_rate, avg(model_abs_diff) AS model_mae,
  avg(bench_abs_diff) AS bench_mae, count(*) AS n_hours FROM ({_ERR})""", "v_pred"),
    ["win_rate", "model_mae", "bench_mae"])
def q_win_rate(spark, sf):
    return win_rate(_errors(spark, sf), "model_abs_diff", "bench_abs_diff")


@register("monthly_scorecard", with_views(
    f"""SELECT period, model_mae, bench_mae, win_rate, num_hours, model_mae - bench_mae AS gap FROM (
  SELECT strftime(date_trunc('week', datetime_ept), '%Y-%m-%d') AS period,
    avg(model_abs_diff) AS model_mae, avg(bench_abs_diff) AS bench_mae,
    avg(CAST(model_win AS DOUBLE)) AS win_rate, count(model_win) AS num_hours
  FROM ({_ERR}) GROUP BY 1)""", "v_pred"), ["model_mae", "bench_mae", "win_rate", "gap"])
def q_monthly_scorecard(spark, sf):
    """Scorecard per period; the events data spans one month, so the period is the week."""
    return monthly_scorecard(_errors(spark, sf), "datetime_ept", period="week",
                             bench_err="bench_abs_diff")


_BENCH = """SELECT p.datetime_ept, p.actual_rt, p.prediction, b.da_pred,
  abs(p.actual_rt - p.prediction) AS model_abs_diff, abs(p.actual_rt - b.da_pred) AS da_abs_diff,
  coalesce(abs(p.actual_rt - p.prediction) < abs(p.actual_rt - b.da_pred), false) AS model_win
FROM v_pred p LEFT JOIN (SELECT datetime_ept, min(da_pred) AS da_pred FROM v_bench_dup GROUP BY 1) b
  ON b.datetime_ept = p.datetime_ept"""


@register("benchmark_compare", with_views(_BENCH, "v_pred", "v_bench_dup"),
          ["actual_rt", "prediction", "da_pred", "model_abs_diff", "da_abs_diff"])
def q_benchmark_compare(spark, sf):
    """Attach a benchmark with repeated hours: de-duplicated first, so output rows equal
    prediction rows."""
    pred = V.v_pred(spark, sf).drop("benchmark")
    out = attach_benchmark(pred, V.v_bench_dup(spark, sf), "datetime_ept", ["da_pred"])
    return forecast_errors(out, "actual_rt", "prediction", bench="da_pred")


@register("naive_baselines", with_views(
    """SELECT avg(abs(p.actual_rt - l2.v)) AS naive_2d_mae, avg(abs(p.actual_rt - l8.v)) AS naive_8d_mae,
  avg(abs(p.actual_rt - p.prediction)) AS model_mae, count(*) AS n_hours
FROM v_pred p LEFT JOIN v_all l2 ON l2.ts = p.datetime_ept - INTERVAL 2 DAY
LEFT JOIN v_all l8 ON l8.ts = p.datetime_ept - INTERVAL 8 DAY""", "v_pred", "v_all"),
    ["naive_2d_mae", "naive_8d_mae", "model_mae"])
def q_naive_baselines(spark, sf):
    """MAE of 'same hour 2 days back' and '8 days back' next to the model's."""
    lags = exact_lags(V.v_all(spark, sf), "ts", ["v"], [2, 8]).select(
        F.col("ts").alias("datetime_ept"), "v_lag2", "v_lag8")
    joined = attach_columns(V.v_pred(spark, sf), lags, "datetime_ept", ["v_lag2", "v_lag8"])
    return naive_mae(joined, "actual_rt", {"naive_2d_mae": "v_lag2", "naive_8d_mae": "v_lag8",
                                           "model_mae": "prediction"}, count_name="n_hours")


@register("rt_da_spread", with_views("SELECT datetime_ept, actual_rt - benchmark AS spread FROM v_pred", "v_pred"),
          ["spread"])
def q_rt_da_spread(spark, sf):
    return spread(V.v_pred(spark, sf), "actual_rt", "benchmark").select("datetime_ept", "spread")


@register("asinh_transform", with_views(
    """SELECT datetime_ept, asinh(actual_rt) AS y_asinh, sinh(asinh(prediction)) AS pred_back,
  sinh(CASE WHEN asinh(prediction) * 4 < -10 THEN -10 WHEN asinh(prediction) * 4 > 10 THEN 10
            ELSE asinh(prediction) * 4 END) AS pred_guarded
FROM v_pred""", "v_pred"), ["y_asinh", "pred_back", "pred_guarded"])
def q_asinh_transform(spark, sf):
    """Target transform, its inverse, and the guarded inverse (clip to [-10, 10] first)."""
    p = V.v_pred(spark, sf)
    return p.select("datetime_ept", asinh_target("actual_rt").alias("y_asinh"),
                    sinh_inverse(asinh_target("prediction")).alias("pred_back"),
                    sinh_inverse(asinh_target("prediction") * 4, bound=10).alias("pred_guarded"))


@register("paired_test", with_views(
    f"""SELECT mean_diff, std_diff, n, mean_diff / (std_diff / sqrt(n)) AS t_stat FROM (
  SELECT avg(model_abs_diff - bench_abs_diff) AS mean_diff, stddev_samp(model_abs_diff - bench_abs_diff) AS std_diff,
    count(*) AS n FROM ({_ERR}) WHERE model_abs_diff - bench_abs_diff IS NOT NULL)""", "v_pred"),
    ["mean_diff", "std_diff", "t_stat"])
def q_paired_test(spark, sf):
    """Champion / challenger: paired error differences and their t statistic."""
    return paired_test(_errors(spark, sf), "model_abs_diff", "bench_abs_diff")


HAC_LAG = 24


@register("paired_test_hac", with_views(
    f"""SELECT n, mean_diff, g0 + 2 * coalesce(weighted, 0) AS variance, mean_diff / sqrt((g0 + 2 * coalesce(weighted, 0)) / n) AS dm_stat
FROM (SELECT count(*) AS n, avg(d) AS mean_diff, var_pop(d) AS g0 FROM diffs), (
  SELECT sum((1 - hours / {HAC_LAG + 1}.0) * (a.d - m) * (b.d - m)) / max(n) AS weighted
  FROM (SELECT *, avg(d) OVER () AS m, count(*) OVER () AS n FROM diffs) a JOIN (SELECT unnest(range(1, {HAC_LAG + 1})) AS hours) ON true
  JOIN diffs b ON b.datetime_ept = a.datetime_ept - to_hours(hours))""", "v_pred",
    extra={"diffs": f"SELECT datetime_ept, model_abs_diff - bench_abs_diff AS d FROM ({_ERR}) WHERE model_abs_diff - bench_abs_diff IS NOT NULL"}),
    {"mean_diff": 6, "variance": 4, "dm_stat": 6})
def q_paired_test_hac(spark, sf):
    """Champion / challenger with the variance of serially correlated hours."""
    return paired_test_hac(_errors(spark, sf), "datetime_ept", "model_abs_diff", "bench_abs_diff", HAC_LAG)
