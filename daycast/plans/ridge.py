"""Ridge regression walked forward over expanding folds, from prefix-summed Gram matrices.

All that a least-squares fit needs of its rows are the sums of products of z = (1, x_1, ..,
x_p, y). They add up over periods, so

1. one aggregation gives the sums of every period: a row is turned into one row (i, z) per
   component inside the scan's stage, and grouped by (period, i) into the sums of z_i z_j.
   It combines on the map side: a task sends periods times p + 2 rows, whatever it reads;
2. a running window over periods (one row per period and component) gives each fold the sums of
   all periods before it;
3. each fold and penalty is one small linear system, solved where its row is, in JVM
   expressions. No fold reads the training rows again, no matrix comes to the driver.

The fit minimises sum w (y - a - x b)^2 + reg_lambda sum v_i b_i^2. The intercept a is not
penalised; v_i is 1, or with ``standardize`` the training variance of feature i, which is
ridge regression on standardised features. A feature that earlier ones determine (a constant
one, say) gets coefficient 0.

Rows with a NULL or NaN in a feature, the target or the weight teach nothing, and get a NULL
prediction where a feature lacks. A fold without training rows predicts NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daycast.functions.transforms import asinh_target, sinh_inverse
from daycast.operators.joins import spread_join
from daycast.operators.lags import q
from daycast.plans.folds import IDX, fold_scores

#: A pivot below this share of its diagonal is nothing but rounding.
SINGULAR = 1e-11


def _z(features: Sequence[str], y: Column) -> Column:
    return F.array(F.lit(1.0), *[F.col(q(f)).cast("double") for f in features], y)


def _target(target: str, transform: str) -> Column:
    if transform not in ("asinh", "raw"):
        raise ValueError(transform)
    return asinh_target(F.col(q(target))) if transform == "asinh" else F.col(q(target)).cast("double")


def grams(df: DataFrame, features: Sequence[str], target: str, by: Sequence[str] = (), transform: str = "asinh", weight: str | None = None) -> DataFrame:
    """(by, i, s0 .. s{p+1}): row i of the Gram matrix of (1, features, target) in each group,
    weighted. ``i`` counts from 0; s0 of row 0 is the sum of weights."""
    n = len(features) + 2
    usable = F.forall("z", lambda x: x.isNotNull() & ~F.isnan(x))
    w = F.col(q(weight)).cast("double") if weight else F.lit(1.0)
    # unusable rows weigh nothing: a filter over all features would be a constraint on each of them
    rows = df.select(*by, _z(features, _target(target, transform)).alias("z"), w.alias("w0")).select(
        *by, F.when(usable & ~F.isnan("w0"), F.col("w0")).alias("w"), F.transform("z", lambda x: F.coalesce(F.nanvl(x, F.lit(0.0)), F.lit(0.0))).alias("z"))
    rows = rows.select(*by, F.coalesce("w", F.lit(0.0)).alias("w"), "z", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    scaled = rows.withColumn("wz", F.col("w") * F.get("z", F.col("i")))
    return scaled.groupBy(*by, "i").agg(*[F.sum(F.col("wz") * F.get("z", F.lit(j))).alias(f"s{j}") for j in range(n)])


def prior_grams(per_period: DataFrame, n: int) -> DataFrame:
    """The sums of all periods before each one (one row per period and component)."""
    before = Window.partitionBy("i").orderBy(IDX).rowsBetween(Window.unboundedPreceding, -1)
    return per_period.select(IDX, "i", *[F.coalesce(F.sum(f"s{j}").over(before), F.lit(0.0)).alias(f"s{j}") for j in range(n)])


def solve(sums: DataFrame, features: Sequence[str], reg_lambdas: Sequence[float], by: Sequence[str] = (), standardize: bool = False) -> DataFrame:
    """(by, combo_id, reg_lambda, intercept, coefs, scales, total_weight): the fit of each group
    of ``sums`` at each penalty, by Gauss-Jordan elimination of its augmented matrix.
    ``scales`` are the features' standard deviations; all NULL where the weights sum to 0. No
    rows at all give no fit."""
    p = len(features)
    row = F.struct("i", F.array(*[F.col(f"s{j}") for j in range(p + 2)]).alias("s"))
    whole = sums.groupBy(*(by or [F.lit(0).alias("__all")])).agg(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["s"]).alias("g"))  # p + 2 rows of p + 2 sums
    whole = whole.withColumn("v", F.expr(f"transform(sequence(1, {p}), i -> greatest(0D, try_divide(g[i][i], g[0][0]) - pow(try_divide(g[i][0], g[0][0]), 2)))") if p else F.array().cast("array<double>"))
    settings = F.explode(F.array(*[F.struct(F.lit(i).alias("combo_id"), F.lit(float(r)).alias("reg_lambda")) for i, r in enumerate(reg_lambdas)]))
    each = whole.select("*", settings.alias("s")).select(*by, "g", "v", "s.*")
    penalty = "reg_lambda * coalesce(v[i - 1], 0D)" if standardize else "reg_lambda"
    each = each.withColumn("m", F.expr(f"transform(slice(g, 1, {p + 1}), (r, i) -> IF(i = 0, r, transform(r, (x, j) -> IF(j = i, x + {penalty}, x))))"))
    eliminated = F.expr(f"""aggregate(sequence(0, {p}), m, (a, k) -> IF(a[k][k] > {SINGULAR!r}D * m[k][k],
      transform(a, (r, i) -> IF(i = k, transform(r, x -> x / a[k][k]), zip_with(r, a[k], (x, y) -> x - r[k] / a[k][k] * y))),
      transform(a, (r, i) -> IF(i = k, transform(r, x -> 0D), r))))""")
    solved = each.withColumn("b", F.when(F.expr("g[0][0] > 0"), F.transform(eliminated, lambda r: F.get(r, F.lit(p + 1)))))
    return solved.select(*by, "combo_id", "reg_lambda", F.get("b", F.lit(0)).alias("intercept"), F.slice("b", 2, p).alias("coefs") if p else F.array().cast("array<double>").alias("coefs"),
                         F.transform("v", lambda x: F.sqrt(x)).alias("scales"), F.expr("g[0][0]").alias("total_weight"))


def linear_prediction(features: Sequence[str], intercept: Column, coefs: Column, transform: str = "asinh", bound: float | None = None) -> Column:
    """a + x b, mapped back from asinh space."""
    total = intercept
    for j, f in enumerate(features):
        total = total + F.col(q(f)).cast("double") * F.get(coefs, F.lit(j))
    return total if transform == "raw" else sinh_inverse(total, bound)


def walk_forward_ridge(tagged: DataFrame, features: Sequence[str], target: str, reg_lambdas: Sequence[float], min_train: int = 3, transform: str = "asinh",
                       standardize: bool = False, weight: str | None = None, keep: Sequence[str] = (), bound: float | None = None) -> DataFrame:
    """Out-of-fold predictions (combo_id, keep, fold, actual, prediction) of every penalty: rows
    of period j by the fit to the periods before it."""
    per_period = grams(tagged, features, target, [IDX], transform, weight)
    fits = solve(prior_grams(per_period, len(features) + 2), features, reg_lambdas, [IDX], standardize)
    # one row per period, with the fits of all penalties
    models = fits.groupBy(IDX).agg(F.collect_list(F.struct("combo_id", "intercept", "coefs")).alias("__models"))
    kept = list(dict.fromkeys([*keep, IDX, target, *features]))
    rows = spread_join(tagged.filter(F.col(IDX) >= min_train).select(*kept), models, [IDX])
    each = rows.select(*kept, F.explode("__models").alias("__m"))
    prediction = linear_prediction(features, F.col("__m.intercept"), F.col("__m.coefs"), transform, bound)
    return each.select(F.col("__m.combo_id").alias("combo_id"), *keep, F.col(IDX).alias("fold"), F.col(q(target)).alias("actual"), prediction.alias("prediction"))


def grid_search_ridge(tagged: DataFrame, features: Sequence[str], target: str, reg_lambdas: Sequence[float], min_train: int = 3, **kw) -> DataFrame:
    """(combo_id, reg_lambda, avg_mae, n_folds): the mean over folds of each penalty's MAE in raw
    units. ``best_params`` and ``fold_scores`` take the predictions as they take any other's."""
    per_fold = fold_scores(walk_forward_ridge(tagged, features, target, reg_lambdas, min_train, **kw), ("combo_id",))
    lambdas = F.element_at(F.array(*[F.lit(float(r)) for r in reg_lambdas]), F.col("combo_id") + 1)
    return per_fold.groupBy("combo_id").agg(F.avg("mae").alias("avg_mae"), F.count("mae").alias("n_folds")).select("combo_id", lambdas.alias("reg_lambda"), "avg_mae", "n_folds")


def fit_ridge(df: DataFrame, features: Sequence[str], target: str, reg_lambda: float = 1.0, transform: str = "asinh", standardize: bool = False, weight: str | None = None) -> DataFrame:
    """One row: the final fit on all rows (intercept, coefs, scales, total_weight)."""
    return solve(grams(df, features, target, (), transform, weight), features, [reg_lambda], (), standardize).drop("combo_id")


def ridge_importances(fit: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, coef, importance): the absolute change of the fitted value when a feature moves
    by one standard deviation, as a share of all features' (NULL when none moves it)."""
    each = fit.select(F.posexplode(F.arrays_zip("coefs", "scales")).alias("i", "c"), F.expr("aggregate(zip_with(coefs, scales, (c, s) -> abs(c * s)), 0D, (a, x) -> a + x)").alias("total"))
    names = F.array(*[F.lit(f) for f in features])
    return each.select(F.element_at(names, F.col("i") + 1).alias("feature"), F.col("c.coefs").alias("coef"), F.try_divide(F.abs(F.col("c.coefs") * F.col("c.scales")), F.col("total")).alias("importance"))
