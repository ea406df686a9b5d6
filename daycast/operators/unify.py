"""Unify feeds that carry the same quantity under different field names and codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.operators.normalize import normalize
from daycast.operators.sets import union_all


def unify_feeds(feeds: Sequence[tuple[DataFrame, Mapping[str, object], str]], code_col: str | None = None,
                code_map: Mapping[str, str] | None = None) -> DataFrame:
    """Each feed is (df, mapping to the common schema as for ``normalize``, source
    name). Codes in ``code_col`` are translated through ``code_map`` (unknown codes
    kept), and a ``source`` column records the origin. UNION ALL by name: no shuffle."""
    parts = [normalize(df, mapping).withColumn("source", F.lit(name)) for df, mapping, name in feeds]
    out = union_all(parts)
    if code_col and code_map:
        m = F.create_map(*[F.lit(x) for kv in code_map.items() for x in kv])
        out = out.withColumn(code_col, F.coalesce(m[F.col(code_col)], F.col(code_col)))
    return out
