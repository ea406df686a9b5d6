"""Quantile sketches that are kept and merged: one of bounded size per key and column, so that
quantiles of any union of keys are read without the rows.

NULL and non-finite values are left out of the sketches. A key without any finite value has an
empty sketch, whose count is 0 and whose quantiles are NULL. Ranks 0 and 1 give the exact least and
greatest value; others are off by about 2.3 / ``size`` of the rows, whatever their number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.operators.profile import finite


def quantile_sketches(df: DataFrame, keys: Sequence[str], cols: Sequence[str], size: int = 400) -> DataFrame:
    """One row per key with a sketch (binary) of each column, under the column's name."""
    return df.groupBy(*keys).agg(*[F.kll_sketch_agg_double(finite(c).cast("double"), F.lit(size)).alias(c) for c in cols])


def merge_sketches(sketches: DataFrame, keys: Sequence[str], cols: Sequence[str], size: int = 400) -> DataFrame:
    """The sketches of coarser keys from those of finer ones."""
    return sketches.groupBy(*keys).agg(*[F.kll_merge_agg_double(F.col(c), F.lit(size)).alias(c) for c in cols])


def sketch_quantiles(sketches: DataFrame, keys: Sequence[str], cols: Sequence[str], ranks: Sequence[float]) -> DataFrame:
    """(keys, column, n, quantiles): one row per key and column, the quantiles in the order of ``ranks``."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("sketch")) for c in cols]))
    rows = sketches.select(*keys, each.alias("s")).select(*keys, "s.column", "s.sketch", F.kll_sketch_get_n_double("s.sketch").alias("n"))
    found = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(r)) for r in ranks]))
    return rows.select(*keys, "column", "n", F.when(F.col("n") > 0, found).alias("quantiles"))
