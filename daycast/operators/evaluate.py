"""Forecast evaluation: errors, MAE, win rate against a benchmark, period
scorecards, naive baselines, spreads and a paired comparison test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.functions.time import week_start
from daycast.functions.transforms import abs_error, win_flag


def forecast_errors(df: DataFrame, actual: str = "actual_rt", pred: str = "prediction",
                    bench: str | None = None, model_err: str = "model_abs_diff",
                    bench_err: str = "da_abs_diff", win: str = "model_win") -> DataFrame:
    """Add absolute errors (and, with a benchmark, its error and the strict-win flag)."""
    out = df.withColumn(model_err, abs_error(actual, pred))
    if bench is not None:
        out = out.withColumn(bench_err, abs_error(actual, bench))
        out = out.withColumn(win, win_flag(model_err, bench_err))
    return out


def mae(df: DataFrame, actual: str, pred: str, name: str = "mae") -> DataFrame:
    return df.agg(F.avg(abs_error(actual, pred)).alias(name))


def win_rate(df: DataFrame, model_err: str = "model_abs_diff", bench_err: str = "da_abs_diff",
             win: str = "model_win") -> DataFrame:
    """One row: share of strict wins (a missing benchmark counts as a loss), the two
    MAEs (NULLs skipped) and the number of rows."""
    return df.agg(
        F.avg(F.col(win).cast("double")).alias("win_rate"),
        F.avg(model_err).alias("model_mae"),
        F.avg(bench_err).alias("bench_mae"),
        F.count(F.lit(1)).alias("n_hours"),
    )


def monthly_scorecard(df: DataFrame, ts: str, period: str = "month", model_err: str = "model_abs_diff",
                      bench_err: str = "da_abs_diff", win: str = "model_win") -> DataFrame:
    """Per period: model MAE, benchmark MAE, win rate, hour count and MAE gap. The
    period is 'month' (text 'yyyy-MM') or 'week' (Monday's date as text)."""
    if period == "month":
        key = F.date_format(F.col(ts), "yyyy-MM")
    elif period == "week":
        key = F.date_format(week_start(ts), "yyyy-MM-dd")
    else:
        raise ValueError(period)
    out = df.groupBy(key.alias("period")).agg(
        F.avg(model_err).alias("model_mae"),
        F.avg(bench_err).alias("bench_mae"),
        F.avg(F.col(win).cast("double")).alias("win_rate"),
        F.count(F.col(win)).alias("num_hours"),
    )
    return out.withColumn("gap", F.col("model_mae") - F.col("bench_mae"))


def naive_mae(df: DataFrame, actual: str, baselines: dict[str, str], count_name: str | None = None) -> DataFrame:
    """One row: MAE of each naive baseline column against the actual (NULLs skipped),
    and optionally the row count."""
    extra = [F.count(F.lit(1)).alias(count_name)] if count_name else []
    return df.agg(*[F.avg(abs_error(actual, c)).alias(name) for name, c in baselines.items()], *extra)


def spread(df: DataFrame, actual: str, reference: str, name: str = "spread") -> DataFrame:
    """Actual minus a reference series (e.g. the market forecast)."""
    return df.withColumn(name, F.col(actual) - F.col(reference))


def paired_test(df: DataFrame, err_a: str, err_b: str, keys: Sequence[str] = ()) -> DataFrame:
    """Champion / challenger: paired differences d = err_a - err_b over rows where both
    exist; mean, sample std, n and the t statistic mean / (std / sqrt(n))."""
    d = F.col(err_a) - F.col(err_b)
    out = df.filter(d.isNotNull()).groupBy(*keys).agg(
        F.avg(d).alias("mean_diff"), F.stddev_samp(d).alias("std_diff"), F.count(F.lit(1)).alias("n"))
    return out.withColumn("t_stat", F.try_divide(F.col("mean_diff"), F.col("std_diff") / F.sqrt(F.col("n"))))


def paired_test_hac(df: DataFrame, ts: str, err_a: str, err_b: str, max_lag: int = 24, keys: Sequence[str] = (), block_hours: int = 24 * 28) -> DataFrame:
    """Champion / challenger for hourly errors, which follow one another: the Diebold-Mariano
    statistic mean(d) / sqrt(V / n) of d = err_a - err_b with the Newey-West variance

        V = g_0 + 2 sum_{k=1..max_lag} (1 - k / (max_lag + 1)) g_k,
        g_k = sum (d_t - mean)(d_{t-k} - mean) / n over the hours with one exactly k hours before.

    (keys, n, mean_diff, variance, dm_stat). ``variance`` is V; a V that isn't positive gives a
    NULL statistic. A missing hour has no products; a repeated hour raises an error.

    Lags are range frames over (keys, block of hours), so a long series is not one window group:
    a block's last ``max_lag`` hours are sent to the next block too, where they are only looked
    back at. What each row adds is summed on the map side."""
    if not 0 <= max_lag < block_hours:
        raise ValueError("max_lag is less than a block")
    d = (F.col(err_a) - F.col(err_b)).cast("double")
    hour = F.unix_date(F.to_date(F.col(ts))).cast("long") * 24 + F.hour(F.col(ts))
    rows = df.select(*keys, hour.alias("__h"), d.alias("__d")).filter(F.col("__d").isNotNull() & ~F.isnan("__d"))
    block = F.floor(F.col("__h") / block_hours)
    again = F.pmod(F.col("__h"), F.lit(block_hours)) >= block_hours - max_lag
    rows = rows.withColumn("__own", block).withColumn("__block", F.explode(F.when(again, F.array(block, block + 1)).otherwise(F.array(block))))
    part = ", ".join([*(f"`{k}`" for k in keys), "__block"])
    over = lambda k: f"OVER (PARTITION BY {part} ORDER BY __h RANGE BETWEEN {k} PRECEDING AND {k} PRECEDING)"
    seen = rows.select(*keys, "__own", "__block", "__d", F.expr(f"count(1) {over(0)}").alias("__peers"), *[F.expr(f"first(__d) {over(k)}").alias(f"__l{k}") for k in range(1, max_lag + 1)])
    once = seen.filter(F.assert_true(F.col("__peers") == 1, f"repeated {ts}: de-duplicate first").isNull()).filter("__own = __block")
    sums = [F.count("__d").alias("n"), F.sum("__d").alias("__s"), F.sum(F.col("__d") * F.col("__d")).alias("__p0")]
    for k in range(1, max_lag + 1):
        back = F.col(f"__l{k}")
        sums += [F.sum(F.col("__d") * back).alias(f"__p{k}"), F.sum(F.when(back.isNotNull(), F.col("__d") + back)).alias(f"__s{k}"), F.count(back).alias(f"__n{k}")]
    total = once.groupBy(*keys).agg(*sums).withColumn("mean_diff", F.try_divide("__s", "n"))
    m = F.col("mean_diff")
    v = F.col("__p0") - F.col("n") * m * m
    for k in range(1, max_lag + 1):
        v = v + F.lit(2.0 * (1 - k / (max_lag + 1))) * (F.coalesce(F.col(f"__p{k}"), F.lit(0.0)) - m * F.coalesce(F.col(f"__s{k}"), F.lit(0.0)) + F.col(f"__n{k}") * m * m)
    out = total.select(*keys, "n", "mean_diff", F.try_divide(v, F.col("n")).alias("variance"))
    return out.withColumn("dm_stat", F.when(F.col("variance") > 0, F.col("mean_diff") / F.sqrt(F.col("variance") / F.col("n"))))
