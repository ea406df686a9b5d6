"""Scalar error and transform expressions used by evaluation and modelling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def abs_error(actual, pred) -> Column:
    return F.abs(_c(actual) - _c(pred))


def clip(c, lo=None, hi=None) -> Column:
    """Clip into [lo, hi]; NULL stays NULL (greatest/least would skip it)."""
    c = _c(c)
    out = c
    if lo is not None:
        out = F.when(c < F.lit(lo), F.lit(lo)).otherwise(out)
    if hi is not None:
        out = F.when(c > F.lit(hi), F.lit(hi)).otherwise(out)
    return F.when(c.isNull(), F.lit(None)).otherwise(out.cast("double"))


def asinh_target(c) -> Column:
    """Variance-stabilising transform for a skewed target that may be negative."""
    return F.asinh(_c(c))


def sinh_inverse(c, bound: float | None = None) -> Column:
    """Back to raw units; with ``bound`` the transformed value is first clipped to
    [-bound, bound] so one wild prediction cannot overflow."""
    c = _c(c)
    if bound is not None:
        c = clip(c, -bound, bound)
    return F.sinh(c)


def win_flag(model_err, bench_err) -> Column:
    """Strict win of the model over the benchmark. A missing side is a loss, not NULL."""
    return F.coalesce(_c(model_err) < _c(bench_err), F.lit(False))
