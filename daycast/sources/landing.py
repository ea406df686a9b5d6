"""Month calendars for feed landing, resumable landing and filtered extracts."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.functions.time import month_start, range_text


def month_calendar(bounds: DataFrame, first: str = "first", last: str = "last") -> DataFrame:
    """One row per month between the dates in the single-row ``bounds`` frame:
    month (DATE, first day), month_end (last day), month_label 'yyyy_MM' and the feed's
    range text 'MM-dd-yyyy 00:00 to MM-dd-yyyy 23:59'."""
    m = bounds.select(F.explode(F.sequence(month_start(first), month_start(last),
                                           F.expr("INTERVAL 1 MONTH"))).alias("month"))
    return m.select(
        "month",
        F.last_day("month").alias("month_end"),
        F.date_format("month", "yyyy_MM").alias("month_label"),
        range_text(F.col("month"), F.last_day("month")).alias("range_text"),
    )


def missing_months(calendar: DataFrame, landed: DataFrame, month: str = "month") -> DataFrame:
    """Calendar months not yet landed (left anti join on the month key)."""
    return calendar.join(landed.select(month).distinct(), on=month, how="left_anti")


def _read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where there is none; any other failure is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def land_months(df: DataFrame, ts: str, path: str, calendar: DataFrame | None = None) -> None:
    """Append the months that have not landed under ``path``, so an interrupted backfill
    resumes where it stopped and never rewrites a month.

    The rows of one run go to a batch folder of their own, partitioned by month; only
    when all are written, the run's months are marked as landed with that batch's name.
    A batch that was cut short has no mark: ``landed_rows`` does not read it, and its months
    land with the next run."""
    spark = df.sparkSession
    staged = df.withColumn("month", month_start(ts))
    marks = _read_if_there(spark, f"{path}/landed")
    if marks is not None:
        # one row per landed month, some 120,000 for all years that a date can name
        staged = staged.join(F.broadcast(marks.select("month").distinct()), on="month", how="left_anti")
    if calendar is not None:
        staged = staged.join(F.broadcast(calendar.select("month").distinct()), on="month", how="left_semi")
    batch = uuid.uuid4().hex
    staged.write.partitionBy("month").parquet(f"{path}/rows/batch={batch}")
    written = spark.read.schema(staged.schema).parquet(f"{path}/rows/batch={batch}")
    written.select("month").distinct().withColumn("batch", F.lit(batch)).coalesce(1).write.mode("append").parquet(f"{path}/landed")


def landed_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all landed months; files without a mark are not read."""
    marks = spark.read.parquet(f"{path}/landed").select("month", "batch").distinct()
    rows = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    return rows.join(F.broadcast(marks), on=["month", "batch"], how="left_semi").drop("batch")


def extract(df: DataFrame, ts: str, start=None, end=None, key: str | None = None,
            values: Sequence[object] | None = None) -> DataFrame:
    """Rows of the chosen series within [start, end] (inclusive). Both predicates reach
    the parquet scan as pushed filters (and partition pruning for partitioned data)."""
    cond: Column = F.lit(True)
    if key is not None and values is not None:
        cond = cond & F.col(key).isin(list(values))
    if start is not None:
        cond = cond & (F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        cond = cond & (F.col(ts) <= F.lit(end).cast("timestamp_ntz"))
    return df.filter(cond)
