"""Structured Streaming: hourly rollup of sub-hourly readings, kept as a table that late
readings correct. There is no watermark: no reading is too late to count."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycast.functions.time import hour_floor
from daycast.session import ensure_checkpoint_dir
from daycast.streaming.batches import BatchTable


def _merged(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return parts.groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("n_values").cast("long").alias("n_values"), F.sum("n").cast("long").alias("n"))


def rollup_table(spark: SparkSession, out_dir: str, series_keys: Sequence[str], compact_after: int = 32) -> BatchTable:
    """Sums and counts per (series, hour). Sums add up over batches, so a reading that comes
    days late corrects its hour."""
    return BatchTable(spark, out_dir, lambda parts: _merged(parts, [*series_keys, "hour_start"]), compact_after)


def read_current(spark: SparkSession, out_dir: str, keys: Sequence[str]) -> DataFrame:
    """(keys, mean_value, n) over every reading that has come so far."""
    merged = rollup_table(spark, out_dir, [k for k in keys if k != "hour_start"]).current()
    return merged.select(*keys, F.try_divide("total", F.col("n_values")).alias("mean_value"), "n")


def run_hourly_rollup(spark: SparkSession, source_dir: str, glob: str, schema: T.StructType, ts: str, value: str,
                      series_keys: Sequence[str] = (), out_dir: str | None = None, files_per_batch: int = 1000,
                      compact_after: int = 32) -> DataFrame:
    """Process every file available now under ``source_dir`` (matching ``glob``), then
    return the current rollup table. Output and checkpoint live in the session's shared
    checkpoint folder unless ``out_dir`` is given, so a restarted job resumes."""
    out_dir = out_dir or os.path.join(ensure_checkpoint_dir(spark), "hourly-rollup-" + uuid.uuid4().hex)
    stream = spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch).parquet(source_dir)
    if dict((f.name, f.dataType) for f in schema.fields).get(ts) != T.TimestampNTZType():
        stream = stream.withColumn(ts, F.col(ts).cast("timestamp_ntz"))
    keys = [*series_keys, "hour_start"]
    table = rollup_table(spark, out_dir, series_keys, compact_after)
    reading = F.col(value).cast("double")
    parts = stream.select(*series_keys, hour_floor(ts).alias("hour_start"), F.coalesce(reading, F.lit(0.0)).alias("total"),
                          reading.isNotNull().cast("long").alias("n_values"), F.lit(1).cast("long").alias("n"))
    q = (parts.writeStream.foreachBatch(table.write)
         .option("checkpointLocation", os.path.join(out_dir, "checkpoint"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return read_current(spark, out_dir, keys)
