"""Projection, renaming, casting, vintage choice and category pivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalize(df: DataFrame, mapping: Mapping[str, object], strict: bool = True) -> DataFrame:
    """Project and rename. ``mapping`` is output name -> source column name, Column, or
    ``(source, type)`` to cast. Casts are ANSI (malformed text raises) unless
    ``strict=False``, which turns malformed values into NULL via ``try_cast``."""
    out = []
    for name, spec in mapping.items():
        if isinstance(spec, tuple):
            src, typ = spec
            col = F.col(src) if isinstance(src, str) else src
            col = col.cast(typ) if strict else col.try_cast(typ)
        elif isinstance(spec, str):
            col = F.col(spec)
        else:
            col = spec
        out.append(col.alias(name))
    return df.select(*out)


def vintage_expr(ts: str, early: str, late: str, cutoff_hour: int = 10) -> Column:
    """The early vintage before ``cutoff_hour`` o'clock, the late one from it on."""
    return F.when(F.hour(F.col(ts)) < cutoff_hour, F.col(early)).otherwise(F.col(late))


def select_vintage(df: DataFrame, ts: str, pairs: Mapping[str, tuple[str, str]], cutoff_hour: int = 10,
                   require: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Choose, per row, between two forecast vintages by hour of day. ``pairs`` maps the
    output name to (early column, late column). With ``require`` a row survives only if
    every column of the vintage chosen for its hour is non-null."""
    early_hour = F.hour(F.col(ts)) < cutoff_hour
    out = df
    if require:
        early_ok = F.lit(True)
        late_ok = F.lit(True)
        for e, l in pairs.values():
            early_ok = early_ok & F.col(e).isNotNull()
            late_ok = late_ok & F.col(l).isNotNull()
        out = out.filter((early_hour & early_ok) | (~early_hour & late_ok))
    return out.select(*keep, ts, *[vintage_expr(ts, e, l, cutoff_hour).alias(n) for n, (e, l) in pairs.items()])


def pivot_share(df: DataFrame, keys: Sequence[str], category: str, value: str, categories: Sequence[str],
                names: Mapping[str, str] | None = None) -> DataFrame:
    """Long (keys, category, value) to one row per key with one column per category,
    using ``max(CASE WHEN category = k THEN value ELSE 0 END)``: a missing category
    gives 0, and a negative value gives 0 when other categories share the key (a lone
    row keeps its negative). ``pivot()`` would return NULL and keep negatives, so the
    conditional form is used. Partial aggregation happens map-side."""
    names = names or {k: k for k in categories}
    aggs = [
        F.max(F.when(F.col(category) == F.lit(k), F.col(value)).otherwise(F.lit(0.0))).alias(names[k])
        for k in categories
    ]
    return df.groupBy(*keys).agg(*aggs)
