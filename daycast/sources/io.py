"""Parquet and CSV sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycast.schemas import PREDICTIONS


def read_table(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet over a file, a folder or a glob. With ``schema`` only those columns are
    read (and the schema is not inferred from footers); filters and projections applied
    later are pushed into the scan by Catalyst either way."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.parquet(*paths)


def write_table(df: DataFrame, path: str, partition_cols: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet sink, optionally partitioned (e.g. by month, so later reads prune)."""
    w = df.write.mode(mode)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


def write_sorted(df: DataFrame, path: str, order: Sequence[str], files: int | None = None, mode: str = "overwrite") -> None:
    """Parquet in global order: rows are dealt to files by ranges of ``order`` (sampled by
    Spark) and sorted within each, so no task sorts the table, files do not overlap, and
    their footers let a time range skip all but its own. Rows of equal ``order`` share a
    file; add further columns to split a stamp that holds too many. ``files`` defaults to
    the session's shuffle partitions."""
    cols = [F.col(f"`{c}`").asc_nulls_first() for c in order]
    ranged = df.repartitionByRange(files, *cols) if files else df.repartitionByRange(*cols)
    ranged.sortWithinPartitions(*cols).write.mode(mode).parquet(path)


def file_order(spark: SparkSession, path: str, col: str) -> DataFrame:
    """One row per file of a sorted table: its first and last value, its rows, and how many of
    them are out of order. The windows are one file each."""
    from pyspark.sql import Window
    rows = spark.read.parquet(path).select("_metadata.file_name", "_metadata.row_index", F.col(f"`{col}`").alias("v"))
    before = F.lag("v").over(Window.partitionBy("file_name").orderBy("row_index"))
    return rows.withColumn("late", (before > F.col("v")).cast("long")).groupBy("file_name").agg(
        F.min("v").alias("first"), F.max("v").alias("last"), F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("late"), F.lit(0)).alias("n_out_of_order"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; timestamps written as local wall-clock text, to the microsecond."""
    (df.write.mode(mode).option("header", True)
       .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header; naive timestamps with or without fractional seconds; NaN reads as
    NULL. Malformed rows fail the read (no silent NULLs)."""
    return nan_to_null(spark.read.schema(schema).option("header", True)
                       .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").option("mode", "FAILFAST").csv(path))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns as NULL: the form in which other tools write a missing number."""
    return df.select(*[F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) if t in ("double", "float") else F.col(f"`{c}`")
                       for c, t in df.dtypes])


def read_predictions(spark: SparkSession, path: str, schema: T.StructType = PREDICTIONS) -> DataFrame:
    """Prediction CSV (datetime_ept, actual_rt, prediction) with the timestamp parsed
    as naive local time."""
    return read_csv(spark, path, schema)
