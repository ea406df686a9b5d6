"""A table that a stream writes batch by batch and that stays cheap to read.

Every micro-batch is reduced and written under its id (``data/batch_id=N``), so a replayed
batch rewrites its own folder. Every so many batches all that came so far is merged into one
table (``compact/batch_id=N``, N the last batch in it). Reading takes the newest whole
compacted table and the batches after it, however long the stream has run. A compacted table
counts only with its success mark, so one that was cut short is not read and is written
again; the folders it covers are no longer read and may be removed.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _ids(spark: SparkSession, path: str) -> list[int]:
    """The batch ids that have files under ``path``, from the listing alone."""
    try:
        files = spark.read.parquet(path).inputFiles()
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return []
    return sorted({int(m.group(1)) for f in files if (m := re.search(r"/batch_id=(\d+)/", f))})


def _whole(spark: SparkSession, path: str) -> bool:
    """Does the folder carry its writer's success mark?"""
    mark = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "_SUCCESS"))
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


class BatchTable:
    """``merge`` reduces rows of several batches to what one batch of all of them would hold;
    it is applied to batches, to compacted tables and to both together."""

    def __init__(self, spark: SparkSession, out_dir: str, merge: Callable[[DataFrame], DataFrame], compact_after: int = 32) -> None:
        self.spark, self.merge, self.compact_after = spark, merge, compact_after
        self.data, self.compacted = os.path.join(out_dir, "data"), os.path.join(out_dir, "compact")

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """A foreachBatch step: reduce, write, and compact when due."""
        self.merge(rows).write.mode("overwrite").parquet(os.path.join(self.data, f"batch_id={batch_id}"))
        if (batch_id + 1) % self.compact_after == 0:
            self.compact()

    def covered(self) -> int:
        """The last batch in the newest whole compacted table, or -1."""
        return next((b for b in reversed(_ids(self.spark, self.compacted)) if _whole(self.spark, os.path.join(self.compacted, f"batch_id={b}"))), -1)

    def _rows(self, covered: int) -> DataFrame:
        later = [b for b in _ids(self.spark, self.data) if b > covered]
        folders = [os.path.join(self.data, f"batch_id={b}") for b in later]
        if covered >= 0:
            folders.insert(0, os.path.join(self.compacted, f"batch_id={covered}"))
        if not folders:  # no batch had rows
            return self.spark.read.parquet(self.data).drop("batch_id").where(F.lit(False))
        return self.spark.read.parquet(*folders)

    def compact(self, min_batches: int = 1) -> bool:
        """Merge all batches into one table, if at least ``min_batches`` have come since the last time."""
        covered, ids = self.covered(), _ids(self.spark, self.data)
        if sum(b > covered for b in ids) < max(1, min_batches):
            return False
        self.merge(self._rows(covered)).write.mode("overwrite").parquet(os.path.join(self.compacted, f"batch_id={ids[-1]}"))
        return True

    def current(self) -> DataFrame:
        """All that has come so far; right after a compaction a plain read of its table."""
        covered, ids = self.covered(), _ids(self.spark, self.data)
        rows = self._rows(covered)
        return rows if covered >= 0 and covered >= (ids or [-1])[-1] else self.merge(rows)
