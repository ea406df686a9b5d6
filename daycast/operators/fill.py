"""Forward fill (last non-null value so far) without a single-partition window.

A plain ``last(c, ignorenulls) OVER (ORDER BY ts)`` on an unkeyed series is planned
as ``Exchange SinglePartition``: the whole table through one task. Instead a two-level
prefix scan:

1. within (series, bucket) - a bucket is a calendar day - fill from earlier rows of
   the same bucket (window groups bounded by one day of one series);
2. per (series, bucket) take the bucket's last non-null value (an aggregate with
   map-side combine), carry it forward over buckets (one row per day and series), and
   join the carry back on (series, bucket) for rows the first pass left NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_BUCKET = "__bucket"


def _bucket(ts: str, bucket: str):
    c = F.col(ts)
    day = F.unix_date(F.to_date(c)).cast("long")
    if bucket == "day":
        return day
    if bucket == "hour":
        return day * 24 + F.hour(c)
    if bucket == "month":
        return (F.year(c) * 12 + F.month(c)).cast("long")
    raise ValueError(bucket)


def forward_fill(df: DataFrame, ts: str, cols: Sequence[str], series_keys: Sequence[str] = (),
                 bucket: str = "day") -> DataFrame:
    """Replace NULLs in ``cols`` by the last non-null value at or before the row's
    timestamp in the same series (peers with equal timestamps see each other, as with
    the SQL default RANGE frame). Leading NULLs stay NULL.

    ``bucket`` sets the first-level group: 'day' bounds a group of an hourly series at
    25 rows; use 'hour' for sub-hourly readings, 'month' for daily series."""
    keys = list(series_keys)
    base = df.withColumn(_BUCKET, _bucket(ts, bucket))
    within = Window.partitionBy(*keys, _BUCKET).orderBy(F.col(ts))
    filled = base.select(
        *[c for c in base.columns if c not in cols],
        *[F.last(F.col(c), ignorenulls=True).over(within).alias(c) for c in cols],
    )
    carry = (
        base.groupBy(*keys, _BUCKET)
        .agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(ts))).alias(f"__last_{c}") for c in cols])
    )
    before = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carry = carry.select(
        *keys, _BUCKET,
        *[F.last(F.col(f"__last_{c}"), ignorenulls=True).over(before).alias(f"__carry_{c}") for c in cols],
    )
    # null-safe: the windows group rows with a NULL key, so the carry must reach them too
    carry = carry.withColumnsRenamed({k: f"__k_{k}" for k in [*keys, _BUCKET]})
    same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in [*keys, _BUCKET]]
    out = filled.join(carry, on=same, how="left")
    return out.select(
        *[F.coalesce(F.col(c), F.col(f"__carry_{c}")).alias(c) if c in cols else F.col(c) for c in df.columns]
    )


def fill_from_daily(base: DataFrame, ts: str, daily: DataFrame, date_col: str, value_cols: Sequence[str],
                    dates_from: DataFrame | None = None) -> DataFrame:
    """Attach a sparse daily series (no weekends or holidays) to hourly rows, each row
    taking the value of the latest date at or before its own date that has both a
    value and at least one base row. Dates with a value but no base rows never
    propagate, the same as joining by date first and forward-filling over base rows.
    A date that ``daily`` repeats counts with its largest value, column by column.

    Work is done on one row per distinct date: base dates are reduced by an aggregate,
    the daily table is joined to them, filled with ``forward_fill`` and attached back.
    That table has one row per calendar date of the base, about 3,650 a decade and under
    four million for all years that a date can name, so it is broadcast: joining the big
    base on the date alone would shuffle every row of a busy date to one task.
    """
    # ``dates_from`` may name a cheaper frame with the same timestamps (e.g. the base
    # before left joins that keep all of its rows)
    dates = (dates_from if dates_from is not None else base).select(F.to_date(F.col(ts)).alias(date_col)).distinct()
    one = daily.groupBy(date_col).agg(*[F.max(c).alias(c) for c in value_cols])
    per_date = dates.join(one, on=date_col, how="left")
    per_date = forward_fill(per_date.withColumn("__d_ts", F.col(date_col).cast("timestamp_ntz")),
                            "__d_ts", value_cols, bucket="month").drop("__d_ts")
    other = [c for c in base.columns if c not in value_cols]
    out = base.select(*other).withColumn("__date", F.to_date(F.col(ts)))
    out = out.join(F.broadcast(per_date.withColumnRenamed(date_col, "__date")), on="__date", how="left")
    return out.drop("__date")


def asof_fill(base: DataFrame, ts: str, source: DataFrame, source_ts: str, value_cols: Sequence[str], series_keys: Sequence[str] = (),
              bucket: str = "day", max_age_hours: float | None = None) -> DataFrame:
    """Attach to each base row the values of the latest ``source`` row at or before it in the
    same series, whatever the source's stamps; all values of one row come from one source row.
    ``max_age_hours``: older values are not attached.

    No join on time: both sides are stacked, the source's row travels as one struct, and
    ``forward_fill`` carries it in two levels, within (series, bucket) and from bucket to
    bucket, so a series that holds a third of all rows is as many window groups as it has
    buckets. Source rows that repeat a series and stamp count with their largest values;
    those without a stamp not at all. Base rows are kept as they are, repeated ones too; NULL
    keys are a series of their own."""
    keys = list(series_keys)
    taken = [c for c in base.columns if c in value_cols]
    if taken:
        raise ValueError(f"{taken[0]!r} is a column of the base already")
    one = (source.filter(F.col(source_ts).isNotNull()).groupBy(*keys, F.col(source_ts).alias("__at"))
           .agg(F.max(F.struct(*value_cols)).alias("__values")).select(*keys, F.col("__at").alias("__t"), F.struct("__at", "__values").alias("__from")))
    kind = one.schema["__from"].dataType
    rows = base.select(*keys, F.col(ts).alias("__t"), F.lit(None).cast(kind).alias("__from"), F.struct(*[F.col(c) for c in base.columns]).alias("__base"))
    stacked = rows.unionByName(one, allowMissingColumns=True)
    filled = forward_fill(stacked, "__t", ["__from"], keys, bucket).filter(F.col("__base").isNotNull())
    fresh = F.lit(True)
    if max_age_hours is not None:
        fresh = F.timestamp_diff("MICROSECOND", F.col("__from.__at"), F.col("__t")) <= F.lit(int(max_age_hours * 3_600_000_000))
    return filled.select(*[F.col("__base").getField(c).alias(c) for c in base.columns],
                         *[F.when(fresh, F.col("__from.__values").getField(c)).alias(c) for c in value_cols])
