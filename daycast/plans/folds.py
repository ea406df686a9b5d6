"""Expanding-window folds over calendar periods, and a walk-forward baseline that is
computed with prefix sums instead of one fit per fold.

Fold j trains on periods [0, j) and validates on period j, for j >= min_train. Rows
are tagged once with their period index; no row is copied per fold. The per-period
tables below hold one row per period (and group), so their windows are tiny.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daycast.functions.time import week_start
from daycast.operators.joins import spread_join

IDX = "period_idx"


def period_key(ts: str, period: str = "month") -> Column:
    if period == "month":
        return F.date_format(F.col(ts), "yyyy-MM")
    if period == "week":
        return F.date_format(week_start(ts), "yyyy-MM-dd")
    raise ValueError(period)


def periods(df: DataFrame, ts: str, period: str = "month") -> DataFrame:
    """Distinct periods in order with their index (one row per period)."""
    p = df.select(period_key(ts, period).alias("period")).distinct()
    return p.withColumn(IDX, (F.row_number().over(Window.orderBy("period")) - 1).cast("int"))


def tag_periods(df: DataFrame, ts: str, period: str = "month") -> DataFrame:
    """Add ``period`` and its index. The period table has one row per calendar month or
    week, at most some 120,000 for all years that a date can name, and is broadcast: a
    shuffle join on the period key would send a whole month of rows to one task."""
    return df.withColumn("period", period_key(ts, period)).join(F.broadcast(periods(df, ts, period)), on="period", how="inner")


def fold_summary(tagged: DataFrame, min_train: int = 3) -> DataFrame:
    """Per fold: validation period, training / validation row counts and the number of
    training periods, from per-period counts and a running sum."""
    per = tagged.groupBy(IDX, "period").agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy(IDX).rowsBetween(Window.unboundedPreceding, -1)
    out = per.select(
        F.col(IDX).alias("fold"), F.col("period").alias("val_period"), F.col("n").alias("n_val_rows"),
        F.coalesce(F.sum("n").over(w), F.lit(0)).cast("long").alias("n_train_rows"),
        F.col(IDX).alias("n_train_periods"))
    return out.filter(F.col("fold") >= min_train)


def fold_split(tagged: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """(training rows, validation rows) of one fold."""
    return tagged.filter(F.col(IDX) < fold), tagged.filter(F.col(IDX) == fold)


def walk_forward_variants(tagged: DataFrame, y: str, variants: list[tuple[int, Column | None, str]],
                          min_train: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """Out-of-fold predictions of seasonal-mean models, several settings in one pass.
    Each variant is (variant id, group expression or None, 'asinh' | 'raw'): for a
    validation row of fold j and group g the prediction is the mean of the training
    target of group g over periods < j (in asinh space and mapped back, or raw).

    Rows are tagged with every variant (generator, no join), per (variant, period,
    group) sums are aggregated once and accumulated with a running window, so every
    fold and every variant costs one aggregation in total."""
    items = []
    for vid, group, transform in variants:
        g = group if group is not None else F.lit(0)
        yt = F.asinh(F.col(y)) if transform == "asinh" else F.col(y).cast("double")
        items.append(F.struct(F.lit(vid).alias("vid"), g.cast("long").alias("g"), yt.alias("yt"),
                              F.lit(transform == "asinh").alias("back")))
    t = tagged.select(*keep, IDX, y, F.explode(F.array(*items)).alias("__v")).select(
        *keep, IDX, y, F.col("__v.vid").alias("variant"), F.col("__v.g").alias("__g"),
        F.col("__v.yt").alias("__yt"), F.col("__v.back").alias("__back"))
    stats = t.groupBy("variant", IDX, "__g").agg(F.sum("__yt").alias("__s"), F.count("__yt").alias("__c"))
    w = Window.partitionBy("variant", "__g").orderBy(IDX).rowsBetween(Window.unboundedPreceding, -1)
    prior = stats.select("variant", IDX, "__g", F.sum("__s").over(w).alias("__cs"), F.sum("__c").over(w).alias("__cc"))
    # one row per (variant, period, group), of as many groups as the caller has
    out = spread_join(t.filter(F.col(IDX) >= min_train), prior, ["variant", IDX, "__g"])
    mean_t = F.try_divide(F.col("__cs"), F.col("__cc"))
    pred = F.when(F.col("__back"), F.sinh(mean_t)).otherwise(mean_t)
    return out.select("variant", *keep, F.col(IDX).alias("fold"), F.col(y).alias("actual"), pred.alias("prediction"))


def walk_forward_baseline(tagged: DataFrame, y: str, group: Column | None = None, min_train: int = 3,
                          transform: str = "asinh", keep: tuple[str, ...] = ()) -> DataFrame:
    """One setting of ``walk_forward_variants`` (see there)."""
    return walk_forward_variants(tagged, y, [(0, group, transform)], min_train, keep).drop("variant")


def fold_scores(pred: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Per fold MAE (raw units) and row count (per ``by`` too, e.g. the variant)."""
    err = F.abs(F.col("actual") - F.col("prediction"))
    return pred.groupBy(*by, "fold").agg(F.avg(err).alias("mae"), F.count(F.lit(1)).alias("n_rows"),
                                    F.count(err).alias("n_scored"))


def cv_summary(pred: DataFrame) -> DataFrame:
    """Both headline metrics: the mean of per-fold MAEs (what a grid search ranks by)
    and the MAE pooled over all validation rows."""
    per = fold_scores(pred)
    return per.agg(F.avg("mae").alias("cv_mae"), F.count(F.lit(1)).alias("n_folds"),
                   F.try_divide(F.sum(F.col("mae") * F.col("n_scored")), F.sum("n_scored")).alias("pooled_mae"))
