"""Structured Streaming twin of ``latest_version``: keep the current version of every
re-published record as files arrive.

Each micro-batch is reduced to its highest version per key (limited per key before the
shuffle) and merged with the others as a ``BatchTable``: compacted every so many batches, so
a read ranks one table and at most ``compact_after`` batches, however many have come. A
lower version that comes late loses wherever it meets the higher one. A restart resumes
from the checkpoint.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from daycast.operators.dedupe import latest_version
from daycast.session import ensure_checkpoint_dir
from daycast.streaming.batches import BatchTable


def version_table(spark: SparkSession, out_dir: str, keys: Sequence[str], version: str, compact_after: int = 32) -> BatchTable:
    """The highest version per key of all batches so far."""
    return BatchTable(spark, out_dir, lambda rows: latest_version(rows, keys, version), compact_after)


def run_latest_versions(spark: SparkSession, source_dir: str, glob: str, schema: T.StructType, keys: Sequence[str],
                        version: str, prepare: Callable[[DataFrame], DataFrame] | None = None,
                        out_dir: str | None = None, files_per_batch: int = 1000, compact_after: int = 32) -> DataFrame:
    """Process the files available now under ``source_dir`` and return the current
    version per key. ``prepare`` shapes raw rows (e.g. derives the hour key)."""
    out_dir = out_dir or os.path.join(ensure_checkpoint_dir(spark), "latest-versions-" + uuid.uuid4().hex)
    table = version_table(spark, out_dir, keys, version, compact_after)
    stream = spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch).parquet(source_dir)
    rows = prepare(stream) if prepare is not None else stream
    q = (rows.writeStream.foreachBatch(table.write).option("checkpointLocation", os.path.join(out_dir, "checkpoint"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return table.current()
