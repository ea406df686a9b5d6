"""Null filters and completeness checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(cols))


def complete_rows(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Rows with no NULL (nor NaN) in any column outside ``exclude``.

    One condition per column, not ``dropna``'s single one over all of them: the optimizer
    derives, for every renamed column, each constraint with the old and with the new name, so
    a constraint that names n renamed columns becomes 2^n of them."""
    wanted = [(c, t) for c, t in df.dtypes if c not in exclude]
    if not wanted:
        return df
    tests = [f"nanvl({_quoted(c)}, NULL) IS NOT NULL" if t in ("double", "float") else f"{_quoted(c)} IS NOT NULL" for c, t in wanted]
    return df.filter(F.expr(" AND ".join(tests)))


def incomplete_count(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """One row: rows with at least one NULL (``n_any_null``) and rows where every
    checked column is NULL (``n_all_null``, what an AND-expanded NOT(... IS NOT NULL)
    check counts)."""
    cols = [c for c in df.columns if c not in exclude]
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    all_null = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in cols])
    return df.agg(
        F.count_if(any_null).alias("n_any_null"),
        F.count_if(all_null).alias("n_all_null"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts: what to look at when the
    window-based lags refuse repeated stamps. One aggregation, map-side
    combined, so a hot key costs no more than any other."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
