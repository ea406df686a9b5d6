"""Helpers shared by the training-data operators: column names, stage tables, row order."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.session import ensure_checkpoint_dir

#: The ASCII white space of the contracts, [\x20\x09-\x0D], as a trim set.
ASCII_SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did (a checkout that is
    not installed); workers of a cluster have it installed, or sent with --py-files."""
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([home, *paths])


def col(name: str) -> Column:
    """A column by its literal name (dots and backticks are part of it)."""
    return F.col("`" + name.replace("`", "``") + "`")


def others(df: DataFrame, outputs: list[str]) -> list[Column]:
    """The columns of ``df`` that no output replaces. Names compare without case, as
    Spark resolves them: an input column named like an output gives way to it."""
    taken = {o.lower() for o in outputs}
    return [col(c) for c in df.columns if c.lower() not in taken]


def ascii_lower(c: Column) -> Column:
    """A-Z lowered, every other character unchanged (``lower`` alone folds all of Unicode)."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def text_of(name: str) -> Column:
    """The text column with null read as empty."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def stage_table(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back: cuts
    the lineage, and the files survive the executors that wrote them."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", salts: int = 8) -> DataFrame:
    """Equi-join of rows of any skew (``left``) with a table of one row per key (``right``):
    a hot key's left rows are dealt over ``salts`` tasks, its right row is sent to each."""
    others_hash = F.xxhash64(*[col(c) for c, t in left.dtypes if "map<" not in t])  # not rand(): a task run again must deal alike
    spread = left.withColumn("__salt", F.pmod(others_hash, F.lit(salts)).cast("int"))
    copies = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, [*keys, "__salt"], how).drop("__salt")


def word_pieces(raw: bytes, overlap: int, limit: int = 4 << 20):
    """The words of a text (split at ASCII space) in lists that share ``overlap`` words, so
    that a very long text is never held as one list. Every run of overlap + 1 words is
    whole in exactly one list."""
    if len(raw) <= limit:
        yield raw.split()
        return
    tail: list[bytes] = []
    at, size = 0, len(raw)
    while at < size:
        end = min(size, at + limit)
        while end < size and raw[end] not in b" \t\n\x0b\f\r":
            end += 1
        words = tail + raw[at:end].split()
        yield words
        tail = words[len(words) - min(overlap, len(words)):]
        at = end


def text_slices(batch: pa.RecordBatch, name: str, limit: int = 4 << 20, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``rows`` rows and ``limit`` bytes in the text column
    ``name`` (a longer text is a slice of its own), so that what Python holds of a batch
    at once doesn't grow with its texts."""
    ends = np.cumsum(pc.binary_length(batch.column(name)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, before = 0, 0
    while at < len(ends):
        stop = max(at + 1, min(at + rows, int(np.searchsorted(ends, before + limit, "right"))))
        yield batch.slice(at, stop - at)
        at, before = stop, int(ends[stop - 1])
