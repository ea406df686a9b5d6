"""Named queries over the test tables, each paired with an independent DuckDB oracle.

``register`` records (spark function, oracle SQL, rounded columns). Doubles listed in
``rnd`` are rounded on both sides (6 places; money sums 2). Averages of 2-decimal
inputs often sit exactly on a rounding tie, where summation-order noise (1e-14) would
decide the direction; both sides therefore add 10^-(d+4) away from zero before
rounding, which is far below the rounding unit and far above float noise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def _round_col(c: str, d: int):
    n = "`" + c.replace("`", "``") + "`"
    return F.expr(f"round({n} + signum({n}) * {10.0 ** -(d + 4)!r}, {d})")


def _round_df(df: DataFrame, rnd: dict[str, int]) -> DataFrame:
    return df.select(*[_round_col(c, rnd[c]).alias(c) if c in rnd else F.col(c) for c in df.columns])


def _round_sql(sql: str, rnd: dict[str, int]) -> str:
    if not rnd:
        return sql
    rep = ", ".join(f"round({c} + sign({c}) * {10.0 ** -(d + 4)!r}, {d}) AS {c}" for c, d in rnd.items())
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n)"


def _dates_df(df: DataFrame, dates: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in dates else F.col(c) for c in df.columns])


def _dates_sql(sql: str, dates: list[str]) -> str:
    if not dates:
        return sql
    rep = ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" for c in dates)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n)"


def _cast_df(df: DataFrame, cols: list[str], typ: str) -> DataFrame:
    return df.select(*[F.col(c).cast(typ).alias(c) if c in cols else F.col(c) for c in df.columns])


def _cast_sql(sql: str, cols: list[str], typ: str) -> str:
    if not cols:
        return sql
    rep = ", ".join(f"CAST({c} AS {typ}) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n)"


def register(name: str, sql: str | None = None, rnd: list[str] | dict[str, int] | None = None,
             dates: list[str] | None = None, dbl: list[str] | None = None):
    """``dates`` lists DATE output columns; the check copies carry them as midnight
    timestamps on both sides, so they compare the same way as timestamp columns
    whether results are compared through Arrow or through pandas (where a DATE arrives
    as a Python date from Spark but as datetime64 from DuckDB)."""
    digits = dict(rnd) if isinstance(rnd, dict) else {c: 6 for c in (rnd or [])}
    dates = list(dates or [])
    dbl = list(dbl or [])  # nullable integer counts: carried as DOUBLE (pandas has no common nullable int)

    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(spark, sf_dir)
            out = _round_df(out, digits) if digits else out
            out = _dates_df(out, dates) if dates else out
            return _cast_df(out, dbl, "double") if dbl else out

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        text = None
        if sql is not None:
            text = _cast_sql(_dates_sql(_round_sql(sql, digits), dates), dbl, "DOUBLE")
        REGISTRY[name] = (run, text)
        return fn

    return deco


def queries() -> dict[str, QueryFn]:
    _load()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


def _load() -> None:
    # Importing the modules registers their queries.
    from daycast.plans import q_boost, q_features, q_evaluate, q_profile, q_sources, q_model, q_ridge, q_training  # noqa: F401
