"""Profiling: counts, null audits, coverage, summary statistics, histograms,
correlations, top-k and schema profiles. All are single aggregations (map-side
combine) except the histogram, which needs the range first."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycast.session import write_stage


def finite(c) -> Column:
    """The value as a double where it is a number, else NULL (NaN and infinities too)."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(F.abs(x) < F.lit(math.inf), x)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _is_nan(df: DataFrame, c: str) -> Column:
    floating = dict(df.dtypes)[c] in ("double", "float")
    return F.coalesce(F.isnan(F.col(c)), F.lit(False)) if floating else F.lit(False)


def null_audit(df: DataFrame, cols: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """One row: ``total_rows``, and per column the counts of its non-null values, its NULLs
    (``<name>_nulls``) and its NaNs (``<name>_nans``). ``cols`` maps output name to column
    (or is a list; names become ``has_<col>``)."""
    mapping = dict(cols) if isinstance(cols, Mapping) else {f"has_{c}": c for c in cols}
    counts = []
    for n, c in mapping.items():
        counts += [F.count(F.col(c)).alias(n), F.count_if(F.col(c).isNull()).alias(f"{n}_nulls"), F.count_if(_is_nan(df, c)).alias(f"{n}_nans")]
    return df.agg(F.count(F.lit(1)).alias("total_rows"), *counts)


def has_nulls(df: DataFrame) -> DataFrame:
    """One row: does any column of any row hold NULL?"""
    anynull = F.lit(False)
    for c in df.columns:
        anynull = anynull | F.col(c).isNull()
    return df.agg(F.coalesce(F.max(anynull), F.lit(False)).alias("has_nulls"))


def coverage(df: DataFrame, ts: str, series_keys: Sequence[str] = ()) -> DataFrame:
    """First and last timestamp and row count, per series."""
    return df.groupBy(*series_keys).agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n_rows"))


def describe_columns(df: DataFrame, cols: Sequence[str], approx: bool = False, accuracy: int = 100000) -> DataFrame:
    """Transposed summary (one row per column): count, mean, sample std, min, 25/50/75%
    (linear interpolation between closest ranks, as pandas / quantile_cont) and max of
    the finite values; ``n_null`` and ``n_nonfinite`` count what was left out. count / mean / std / min / max are one aggregation of one scan. The
    quartiles are exact via ``exact_quantiles`` (a few distributed bucket-count passes;
    no task ever holds a column's values), or a bounded sketch with ``approx``."""
    from daycast.operators.quantiles import exact_quantiles

    qs = [0.25, 0.5, 0.75]
    aggs = []
    for i, c in enumerate(cols):
        x = finite(c)
        parts = [F.count(x).alias("count"), F.count_if(F.col(c).isNull()).alias("n_null"), F.count(F.lit(1)).alias("n_rows"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                 F.min(x).alias("min"), F.max(x).alias("max")]
        if approx:
            parts.append(F.percentile_approx(x, qs, accuracy).alias("q"))
        aggs.append(F.struct(*parts).alias(f"s{i}"))
    row = df.agg(*aggs).first()  # one row of per-column statistics
    stats = {c: row[f"s{i}"] for i, c in enumerate(cols)}
    if approx:
        quart = {(c, q): (stats[c]["q"][j] if stats[c]["q"] else None) for c in cols for j, q in enumerate(qs)}
    else:
        quart = exact_quantiles(df, cols, qs, stats={c: (s["count"], s["min"], s["max"]) for c, s in stats.items()})
    rows = [(c, stats[c]["count"], stats[c]["mean"], stats[c]["std"], stats[c]["min"],
             *[None if quart[(c, q)] is None else float(quart[(c, q)]) for q in qs], stats[c]["max"], stats[c]["n_null"],
             stats[c]["n_rows"] - stats[c]["n_null"] - stats[c]["count"]) for c in cols]
    return df.sparkSession.createDataFrame(
        rows, "column string, count long, mean double, std double, min double, q25 double, q50 double, "
              "q75 double, max double, n_null long, n_nonfinite long")


def histogram(df: DataFrame, col: str, bins: int = 100) -> DataFrame:
    """Equal-width histogram of the finite values between min and max, the max falling in
    the last bin. Returns every bin (empty ones with 0): bin, bin_lo, bin_hi, n; NaN,
    infinite and NULL values are in none (``describe_columns`` counts them). The two
    range scalars are the only values brought to the driver."""
    spark = df.sparkSession
    x = finite(col)
    row = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi = row["lo"], row["hi"]
    if lo is None:
        return spark.range(0).select(F.col("id").cast("int").alias("bin"), F.lit(None).cast("double").alias("bin_lo"),
                                     F.lit(None).cast("double").alias("bin_hi"), F.lit(0).cast("long").alias("n"))
    lo, hi = float(lo), float(hi)
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.filter(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = edges.join(counts, on="bin", how="left")
    return out.select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"),
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"),
    )


def pearson(x, y):
    """Pearson correlation over rows where both are non-null; NULL (not an ANSI
    division error) when either side has zero variance."""
    x, y = x.cast("double"), y.cast("double")
    xm, ym = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(xm) * F.stddev_samp(ym))


def correlations(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of each column with the target over the rows that have both:
    (feature, corr, n), NULL for a constant column or one without such rows. In long form: each row is turned into
    one (feature, x) per column inside the scan's stage, and one aggregate by feature
    combines on the map side, so a task sends one row per feature whatever the number of
    rows, and the plan does not grow with the number of columns."""
    names = F.array(*[F.lit(c) for c in cols])
    values = F.array(*[F.col(_q(c)).cast("double") for c in cols])
    long = df.select(F.col(_q(target)).cast("double").alias("y"), F.posexplode_outer(values).alias("i", "x"))
    stats = long.groupBy("i").agg(pearson(F.col("x"), F.col("y")).alias("corr"), F.count(F.when(F.col("y").isNotNull(), F.col("x"))).alias("n"))
    return stats.select(F.element_at(names, F.col("i") + 1).alias("feature"), "corr", "n")


def top_correlations(df: DataFrame, target: str, cols: Sequence[str], k: int = 20) -> DataFrame:
    """The ``k`` columns of largest absolute correlation with the target (ties by name);
    constant columns are skipped. The correlations (one row per column) are written
    before they are ranked: a filter above a wide plan makes the optimizer carry every
    column's constraints through it again and again."""
    found = write_stage(correlations(df, target, cols), "correlations").filter(F.col("corr").isNotNull() & ~F.isnan("corr"))
    return top_k(found.select("feature", "corr", F.abs("corr").alias("abs_corr")), "abs_corr", k, tiebreak=["feature"])


def top_k(df: DataFrame, col: str, k: int, tiebreak: Sequence[str] = (), ascending: bool = False) -> DataFrame:
    """First ``k`` rows by ``col`` (TakeOrderedAndProject: per-partition top-k, then merge)."""
    order = [F.col(col).asc() if ascending else F.col(col).desc()] + [F.col(t).asc() for t in tiebreak]
    return df.orderBy(*order).limit(k)


def latest_rows(df: DataFrame, ts: str, n: int = 5, tiebreak: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.col(ts).desc(), *[F.col(t).desc() for t in tiebreak]).limit(n)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def schema_profile(df: DataFrame) -> DataFrame:
    """Shape and dtype counts: one row per Spark type with its column count, plus the
    table's row and column counts. The types come from the schema; the row count is
    the only distributed work (one aggregate, the type rows are generated from it)."""
    counts: dict[str, int] = {}
    for f in df.schema.fields:
        counts[f.dataType.simpleString()] = counts.get(f.dataType.simpleString(), 0) + 1
    types = F.array(*[F.struct(F.lit(t).alias("dtype"), F.lit(n).cast("int").alias("n_columns"))
                      for t, n in sorted(counts.items())])
    return (df.agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.explode(types).alias("t"), "n_rows")
            .select("t.dtype", "t.n_columns", "n_rows", F.lit(len(df.columns)).alias("total_columns")))
