"""Gap-proof same-hour lags and same-hour rolling statistics.

Both are range frames over one window: rows are partitioned by (series keys, time of day) and ordered by the local
epoch day, so "exactly n days back" is the frame ``rangeBetween(-n, -n)`` and "days
2..8 back" is ``rangeBetween(-8, -2)``. Every output shares one Exchange and one sort.

A missing day is simply absent from the ordered partition, so a range frame (unlike
``lag()``) never picks a wrong row across a gap. The time of day counts in microseconds, so
stamps within one second stay apart. (series, ts) must be unique: a repeated stamp raises
an error rather than lending one of its rows; run ``dedupe_hours`` first.

Scale: a window group is one series at one time of day, so its size is bounded by the
history length in days, not by data volume; partitions spread over 24 x #series groups.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def default_lag_name(col: str, offset: int) -> str:
    return f"{col}_lag{offset}"


def q(name: str) -> str:
    """Quote a column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def time_of_day_sql(ts: str) -> str:
    """SQL text of the time of day in microseconds."""
    t = q(ts)
    return f"((hour({t}) * 3600 + minute({t}) * 60) * 1000000L + CAST(extract(SECOND FROM {t}) * 1000000 AS BIGINT))"


def _window(ts: str, series_keys: Sequence[str], frame: str) -> str:
    part = ", ".join([*map(q, series_keys), time_of_day_sql(ts)])
    return f"OVER (PARTITION BY {part} ORDER BY unix_date(to_date({q(ts)})) RANGE BETWEEN {frame})"


def window_sql(ts: str, series_keys: Sequence[str], first_back: int, last_back: int) -> str:
    """SQL text of the shared window with a frame ``first_back``..``last_back`` days back.
    Expressions are built as SQL text: one call to the JVM per expression instead of one
    per sub-expression, the same analysed plan."""
    return _window(ts, series_keys, f"{first_back} PRECEDING AND {last_back} PRECEDING")


def lag_exprs(ts: str, cols: Iterable[str], offsets: Iterable[int], series_keys: Sequence[str] = (),
              name: Callable[[str, int], str] = default_lag_name) -> list[Column]:
    """Lag columns for stamps known to be unique (say, those of a GROUP BY)."""
    out = []
    for off in offsets:
        w = window_sql(ts, series_keys, off, off)
        for c in cols:
            out.append(F.expr(f"first({q(c)}) {w}").alias(name(c, off)))
    return out


def packed_lags(df: DataFrame, ts: str, exprs: Sequence[str], offsets: Sequence[int], series_keys: Sequence[str] = (),
                extra: Sequence[Column] = (), unique: bool = False) -> tuple[DataFrame, Callable[[int, int], Column]]:
    """``df`` with one struct of all ``exprs`` (SQL texts) per offset (and ``extra`` window
    columns), and a function (index of the expression, offset) -> lag column. One window
    function per offset, however many columns lag. Unless the stamps are known to be
    ``unique``, a repeated one raises an error."""
    fields = ", ".join(f"{e} AS f{i}" for i, e in enumerate(exprs))
    packs = [F.expr(f"first(struct({fields})) {window_sql(ts, series_keys, o, o)}").alias(f"__lag{o}") for o in offsets]
    peers = [] if unique else [F.expr(f"count(1) {_window(ts, series_keys, 'CURRENT ROW AND CURRENT ROW')}").alias("__peers")]
    out = df.select("*", *packs, *extra, *peers)
    if not unique:
        out = out.filter(F.assert_true(F.col("__peers") == 1, f"repeated {ts}: de-duplicate first").isNull())
    return out, lambda i, o: F.col(f"__lag{o}.f{i}")


def exact_lags(df: DataFrame, ts: str, cols: Sequence[str], offsets: Sequence[int] = (2, 4, 8),
               series_keys: Sequence[str] = (), name: Callable[[str, int], str] = default_lag_name) -> DataFrame:
    """Append, for each column and offset n, the value at exactly the same wall-clock
    time n days earlier in the same series (NULL when that hour is missing)."""
    packed, lag = packed_lags(df, ts, [q(c) for c in cols], offsets, series_keys)
    lags = [lag(i, o).alias(name(c, o)) for o in offsets for i, c in enumerate(cols)]
    return packed.select(*[F.col(q(c)) for c in df.columns], *lags)


def rolling_exprs(ts: str, col: str, first_day: int = 2, last_day: int = 8, series_keys: Sequence[str] = (),
                  mean_name: str = "rolling_mean", std_name: str = "rolling_stddev") -> list[Column]:
    w = window_sql(ts, series_keys, last_day, first_day)
    return [F.expr(f"avg({q(col)}) {w}").alias(mean_name), F.expr(f"stddev_samp({q(col)}) {w}").alias(std_name)]


def seasonal_rolling(df: DataFrame, ts: str, col: str, first_day: int = 2, last_day: int = 8,
                     series_keys: Sequence[str] = (), mean_name: str = "rolling_mean",
                     std_name: str = "rolling_stddev") -> DataFrame:
    """Mean and sample standard deviation of the same hour over days first..last back.
    Averages whichever of those days exist; NULL when none (std NULL with one value)."""
    rolls = rolling_exprs(ts, col, first_day, last_day, series_keys, mean_name, std_name)
    out, _ = packed_lags(df, ts, [], [], series_keys, extra=rolls)
    return out.drop("__peers")


def offset_rows(df: DataFrame, ts: str, col: str, first_day: int = 2, last_day: int = 8,
                series_keys: Sequence[str] = ()) -> DataFrame:
    """Long form of the rolling input: one row per (series, ts, offset) whose same-hour
    history exists ``offset`` days back. One shifted copy per history row joined once,
    instead of a UNION ALL of one self-join per offset."""
    hist = (
        df.select(*series_keys, F.col(ts).alias("__hts"), F.col(col).alias("past_value"))
        .withColumn("offset_days", F.explode(F.sequence(F.lit(first_day), F.lit(last_day))))
        .withColumn(ts, F.timestamp_add("DAY", F.col("offset_days"), F.col("__hts")))
        .drop("__hts")
    )
    base = df.select(*series_keys, ts)
    return base.join(hist, on=[*series_keys, ts], how="inner")
