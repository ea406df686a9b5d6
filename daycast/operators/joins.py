"""Source joins, dimension flags and benchmark attachment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycast.operators.dedupe import dedupe_hours


def spread_join(base: DataFrame, side: DataFrame, on: Sequence[str], how: str = "left", salts: int = 8) -> DataFrame:
    """Equi-join on a coarse key (a date, a period), which many rows of ``base`` share: each
    key's rows are dealt over ``salts`` tasks and its rows of ``side`` are sent to all of
    them. Whether ``side`` is small enough to broadcast instead is left to adaptive
    execution, which knows its bytes."""
    key = F.pmod(F.xxhash64(*[F.col(c) for c in base.columns]), F.lit(salts)).cast("int")
    copies = side.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return base.withColumn("__salt", key).join(copies, on=[*on, "__salt"], how=how).drop("__salt")


def join_sources(base: DataFrame, sources: Sequence[tuple[DataFrame, object]]) -> DataFrame:
    """Left-join each source onto the base. Each entry is (df, on) where ``on`` is a
    column name / list of names shared by both sides, or (base expression, source
    column) for a derived key such as the date of the base timestamp. A derived key is
    coarse (every hour of every series shares its date), so that join is spread."""
    out = base
    for i, (src, on) in enumerate(sources):
        if isinstance(on, tuple):
            expr, src_col = on
            key = f"__jk{i}"
            out = spread_join(out.withColumn(key, expr), src.withColumnRenamed(src_col, key), [key]).drop(key)
        else:
            out = out.join(src, on=on, how="left")
    return out


def flag_in_dim(df: DataFrame, key: Column, dim: DataFrame, dim_key: str, flag: str) -> DataFrame:
    """0/1 flag: does the row's key appear in a small dimension? The dimension is
    de-duplicated (so it cannot fan out rows) and broadcast: callers pass only
    dimensions whose size is bounded by construction (e.g. rule-generated dates)."""
    keys = dim.select(F.col(dim_key).alias("__dk")).distinct().withColumn("__hit", F.lit(1))
    out = df.withColumn("__dk", key).join(F.broadcast(keys), on="__dk", how="left")
    return out.withColumn(flag, F.when(F.col("__hit").isNotNull(), 1).otherwise(0).cast("int")).drop("__dk", "__hit")


def attach_benchmark(pred: DataFrame, bench: DataFrame, key: str, value_cols: Sequence[str]) -> DataFrame:
    """Left-attach a benchmark forecast. The benchmark is de-duplicated on its key first
    (smallest value wins), so a repeated hour cannot multiply prediction rows."""
    bench = dedupe_hours(bench.select(key, *value_cols), key, order_by=list(value_cols))
    return pred.join(bench, on=key, how="left")


def attach_columns(left: DataFrame, right: DataFrame, key: Sequence[str] | str, cols: Sequence[str]) -> DataFrame:
    """Left-attach selected columns of another table keyed on ``key``. A key the table
    repeats takes its smallest row, so no row of ``left`` is multiplied."""
    key = [key] if isinstance(key, str) else list(key)
    one = right.select(*key, *cols).groupBy(*key).agg(F.min(F.struct(*cols)).alias("__row"))
    return left.join(one, on=key, how="left").select(*left.columns, *[F.col(f"__row.{c}").alias(c) for c in cols])
