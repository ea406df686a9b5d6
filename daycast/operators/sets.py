"""Set helpers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name (no de-duplication, no shuffle)."""
    return reduce(lambda a, b: a.unionByName(b), dfs)
