"""De-duplication and latest-version selection by ``row_number() = 1``.

Spark plans the filter on the rank as a WindowGroupLimit before the shuffle: each task
keeps one row per key it has seen, so even a key holding a third of all rows is reduced
where it is read, and a second one after the shuffle keeps the best of those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daycast.functions.time import cutoff_time


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], largest: bool) -> DataFrame:
    by = [F.col(c).desc_nulls_last() if largest else F.col(c).asc_nulls_first() for c in order]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return df.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")


def dedupe_hours(df: DataFrame, ts: str, series_keys: Sequence[str] = (),
                 order_by: Sequence[str] | None = None, keep: str = "first") -> DataFrame:
    """One row per (series, ts). The survivor is the smallest (``keep='first'``) or
    largest (``keep='last'``) by ``order_by``, followed by every other column, so the
    choice is deterministic even where the source order is not."""
    keys = [*series_keys, ts]
    others = [c for c in df.columns if c not in keys]
    order_cols = list(order_by or []) + [c for c in others if c not in (order_by or [])]
    return _pick(df, keys, order_cols, largest=(keep == "last"))


def issued_before(df: DataFrame, target: str, issued: str, days_before: int = 1, hour: int = 10) -> DataFrame:
    """Keep versions issued no later than ``hour`` o'clock ``days_before`` days before the
    target's date (inclusive)."""
    return df.filter(F.col(issued) <= cutoff_time(target, days_before, hour))


def latest_before_cutoff(df: DataFrame, target: str, issued: str, series_keys: Sequence[str] = (),
                         tiebreak: Sequence[str] = (), days_before: int = 1, hour: int = 10) -> DataFrame:
    """Latest forecast version per (series, target) among those issued by the cutoff.
    Ties on the issue time go to the largest ``tiebreak`` (then the other columns)."""
    kept = issued_before(df, target, issued, days_before, hour)
    keys = [*series_keys, target]
    others = [c for c in kept.columns if c not in keys and c != issued and c not in tiebreak]
    order = [issued, *tiebreak, *others]
    return _pick(kept, keys, order, largest=True)


def latest_version(df: DataFrame, keys: Sequence[str], version: str, current_flag: str | None = None) -> DataFrame:
    """Current version of a re-published record: the highest version, optionally only
    among rows flagged current."""
    if current_flag is not None:
        df = df.filter(F.col(current_flag))
    others = [c for c in df.columns if c not in keys and c != version]
    return _pick(df, list(keys), [version, *others], largest=True)
