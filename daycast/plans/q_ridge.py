"""Registered ridge regressions: monthly folds over the daily series, from two features.

The SQL states each fit in closed form: with the intercept free, the coefficients solve the
2 x 2 system of the centred sums plus the penalty, by Cramer's rule, from the training rows
of each fold."""

from __future__ import annotations

from pyspark.sql import functions as F

from daycast.operators.lags import exact_lags
from daycast.plans import views as V
from daycast.plans.folds import tag_periods
from daycast.plans.oracle import with_views
from daycast.plans.q_model import _MONTHS, MIN_TRAIN
from daycast.plans.registry import register
from daycast.plans.ridge import fit_ridge, grid_search_ridge, ridge_importances, walk_forward_ridge

FEATURES = ["last_week", "weekend"]
LAMBDAS = [0.0, 5.0, 50.0]


def _rows(spark, sf):
    """Days with the asinh of the value a week before, and whether they are at a weekend."""
    daily = exact_lags(V.v_orders_daily(spark, sf), "ts", ["y"], [7])
    return tag_periods(daily.select("ts", "y", F.asinh("y_lag7").alias("last_week"), F.when(F.dayofweek("ts").isin(1, 7), 1.0).otherwise(0.0).alias("weekend"),
                                    (F.dayofmonth("ts") % 3).alias("w")), "ts", "month")


_CTES = {
    "months": _MONTHS,
    "days": """SELECT o.ts, o.y, asinh(b.y) AS x1, CAST(dayofweek(o.ts) % 6 = 0 AS DOUBLE) AS x2, asinh(o.y) AS t, dayofmonth(o.ts) % 3 AS w, m.period_idx
FROM v_orders_daily o JOIN months m ON m.period = strftime(o.ts, '%Y-%m') LEFT JOIN v_orders_daily b ON b.ts = o.ts - INTERVAL 7 DAY""",
}


def _fit_sql(source: str, key: str, penalty1: str = "lam", penalty2: str = "lam") -> str:
    """Closed-form fits by ``key`` of ``source`` (key, lam, x1, x2, t, w)."""
    return f"""SELECT {key}, lam, mt - b1 * m1 - b2 * m2 AS b0, b1, b2, sqrt(s11 / n) AS sd1, sqrt(s22 / n) AS sd2, n FROM (
  SELECT *, (s1t * (s22 + {penalty2}) - s2t * s12) / ((s11 + {penalty1}) * (s22 + {penalty2}) - s12 * s12) AS b1,
    (s2t * (s11 + {penalty1}) - s1t * s12) / ((s11 + {penalty1}) * (s22 + {penalty2}) - s12 * s12) AS b2 FROM (
    SELECT {key}, lam, max(n) AS n, max(m1) AS m1, max(m2) AS m2, max(mt) AS mt, sum(w * (x1 - m1) * (x1 - m1)) AS s11, sum(w * (x2 - m2) * (x2 - m2)) AS s22,
      sum(w * (x1 - m1) * (x2 - m2)) AS s12, sum(w * (x1 - m1) * (t - mt)) AS s1t, sum(w * (x2 - m2) * (t - mt)) AS s2t
    FROM (SELECT *, sum(w) OVER g AS n, sum(w * x1) OVER g / sum(w) OVER g AS m1, sum(w * x2) OVER g / sum(w) OVER g AS m2, sum(w * t) OVER g / sum(w) OVER g AS mt
          FROM ({source}) WHERE x1 IS NOT NULL WINDOW g AS (PARTITION BY {key}, lam))
    GROUP BY {key}, lam))"""


def _walk_sql(weight: str = "1", penalty1: str = "lam", penalty2: str = "lam") -> str:
    train = (f"SELECT m.period_idx AS fold, l.lam, d.x1, d.x2, d.t, {weight} AS w FROM months m JOIN days d ON d.period_idx < m.period_idx "
             f"CROSS JOIN (SELECT unnest({LAMBDAS}) AS lam) l WHERE m.period_idx >= {MIN_TRAIN}")
    return (f"SELECT d.ts, d.period_idx AS fold, f.lam, d.y AS actual, sinh(f.b0 + f.b1 * d.x1 + f.b2 * d.x2) AS prediction "
            f"FROM days d JOIN ({_fit_sql(train, 'fold', penalty1, penalty2)}) f ON f.fold = d.period_idx")


@register("walk_forward_ridge", with_views(f"SELECT ts, fold, actual, prediction FROM ({_walk_sql()}) WHERE lam = {LAMBDAS[1]}", "v_orders_daily", extra=_CTES),
          {"actual": 2, "prediction": 2})
def q_walk_forward_ridge(spark, sf):
    """Out-of-fold predictions of a ridge regression on last week's value and the weekend."""
    out = walk_forward_ridge(_rows(spark, sf), FEATURES, "y", [LAMBDAS[1]], MIN_TRAIN, keep=["ts"])
    return out.select("ts", "fold", "actual", "prediction")


_SCORES = "SELECT lam, fold, avg(abs(actual - prediction)) AS mae FROM ({walk}) GROUP BY lam, fold"


def _grid_sql(**kw) -> str:
    return (f"SELECT CAST(list_position({LAMBDAS}, lam) - 1 AS INTEGER) AS combo_id, CAST(lam AS DOUBLE) AS reg_lambda, avg(mae) AS avg_mae, count(mae) AS n_folds "
            f"FROM ({_SCORES.format(walk=_walk_sql(**kw))}) GROUP BY lam")


@register("grid_search_ridge", with_views(_grid_sql(), "v_orders_daily", extra=_CTES), {"avg_mae": 2})
def q_grid_search_ridge(spark, sf):
    """Every penalty's mean fold MAE, from one pass over the days."""
    return grid_search_ridge(_rows(spark, sf), FEATURES, "y", LAMBDAS, MIN_TRAIN)


@register("grid_search_ridge_weighted", with_views(_grid_sql(weight="d.w", penalty1="lam * s11 / n", penalty2="lam * s22 / n"), "v_orders_daily", extra=_CTES), {"avg_mae": 2})
def q_grid_search_ridge_weighted(spark, sf):
    """The same with sample weights (0, 1 or 2) and standardised penalties."""
    return grid_search_ridge(_rows(spark, sf), FEATURES, "y", LAMBDAS, MIN_TRAIN, weight="w", standardize=True)


_FINAL = _fit_sql(f"SELECT 0 AS k, {LAMBDAS[1]} AS lam, x1, x2, t, 1 AS w FROM days", "k")


@register("ridge_importances", with_views(
    f"""SELECT unnest({FEATURES}) AS feature, unnest([b1, b2]) AS coef,
  unnest([abs(b1 * sd1), abs(b2 * sd2)]) / (abs(b1 * sd1) + abs(b2 * sd2)) AS importance FROM ({_FINAL})""", "v_orders_daily", extra=_CTES), ["coef", "importance"])
def q_ridge_importances(spark, sf):
    """The final fit's coefficients, and each feature's share of what moves the prediction."""
    return ridge_importances(fit_ridge(_rows(spark, sf), FEATURES, "y", LAMBDAS[1]), FEATURES)


@register("final_fit_ridge", with_views(
    f"""SELECT CAST(max(n) AS DOUBLE) AS total_weight, avg(abs(d.y - sinh(f.b0 + f.b1 * d.x1 + f.b2 * d.x2))) AS train_mae
FROM days d CROSS JOIN ({_FINAL}) f""", "v_orders_daily", extra=_CTES), {"total_weight": 6, "train_mae": 2})
def q_final_fit_ridge(spark, sf):
    """Training MAE, in raw units, of the fit on all days."""
    from daycast.plans.ridge import linear_prediction
    rows = _rows(spark, sf)
    fit = fit_ridge(rows, FEATURES, "y", LAMBDAS[1]).first()  # one row of p + 1 numbers: the model itself
    fitted = linear_prediction(FEATURES, F.lit(fit.intercept), F.array(*[F.lit(c) for c in fit.coefs]))
    return rows.agg(F.lit(fit.total_weight).alias("total_weight"), F.avg(F.abs(F.col("y") - fitted)).alias("train_mae"))
