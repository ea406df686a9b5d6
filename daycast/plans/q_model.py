"""Registered fold, walk-forward, grid and model queries."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from daycast.functions.time import day_of_week0
from daycast.operators.evaluate import forecast_errors, monthly_scorecard
from daycast.operators.lags import exact_lags
from daycast.plans import model as M
from daycast.plans import views as V
from daycast.plans.features import feature_table
from daycast.plans.folds import (
    cv_summary, fold_scores, fold_summary, periods, tag_periods, walk_forward_baseline, walk_forward_variants,
)
from daycast.plans.oracle import with_views
from daycast.plans.registry import register
from daycast.session import ensure_checkpoint_dir

MIN_TRAIN = 3
_MONTHS = ("SELECT period, CAST(row_number() OVER (ORDER BY period) - 1 AS INTEGER) AS period_idx "
           "FROM (SELECT DISTINCT strftime(ts, '%Y-%m') AS period FROM v_orders_daily)")
_TAGGED = ("SELECT o.*, m.period, m.period_idx FROM v_orders_daily o "
           "JOIN months m ON m.period = strftime(o.ts, '%Y-%m')")
_FOLD_CTES = {"months": _MONTHS, "tagged": _TAGGED}


def _tagged_orders(spark, sf):
    return tag_periods(V.v_orders_daily(spark, sf), "ts", "month")


def _wf_sql(group_expr: str = "dayofweek(ts)", transform: str = "asinh") -> str:
    inner = "asinh(tr.y)" if transform == "asinh" else "tr.y"
    outer = "sinh(avg({}))" if transform == "asinh" else "avg({})"
    return (f"SELECT v.date, v.ts, v.period_idx AS fold, v.y AS actual, "
            f"(SELECT {outer.format(inner)} FROM tagged tr WHERE tr.period_idx < v.period_idx "
            f"AND {group_expr.replace('ts', 'tr.ts')} = {group_expr.replace('ts', 'v.ts')}) AS prediction "
            f"FROM tagged v WHERE v.period_idx >= {MIN_TRAIN}")


def _wf(spark, sf, group=True, transform="asinh", keep=("date",), tagged=None):
    g = day_of_week0("ts") if group else None
    tagged = tagged if tagged is not None else _tagged_orders(spark, sf)
    return walk_forward_baseline(tagged, "y", g, MIN_TRAIN, transform, keep=keep)


@register("fold_months", with_views(_MONTHS, "v_orders_daily"))
def q_fold_months(spark, sf):
    """Distinct months of the daily series in order, with their index."""
    return periods(V.v_orders_daily(spark, sf), "ts", "month")


@register("fold_summary", with_views(
    f"""SELECT m.period_idx AS fold, m.period AS val_period,
  (SELECT count(*) FROM tagged t WHERE t.period_idx = m.period_idx) AS n_val_rows,
  (SELECT count(*) FROM tagged t WHERE t.period_idx < m.period_idx) AS n_train_rows,
  m.period_idx AS n_train_periods
FROM months m WHERE m.period_idx >= {MIN_TRAIN}""", "v_orders_daily", extra=_FOLD_CTES))
def q_fold_summary(spark, sf):
    """Expanding monthly folds (at least 3 training months): sizes per fold."""
    return fold_summary(_tagged_orders(spark, sf), MIN_TRAIN)


_WF = _wf_sql()


@register("walk_forward_baseline", with_views(f"SELECT date, fold, actual, prediction FROM ({_WF})",
                                              "v_orders_daily", extra=_FOLD_CTES), {"actual": 2, "prediction": 2},
          dates=["date"])
def q_walk_forward_baseline(spark, sf):
    """Out-of-fold predictions of the weekday seasonal mean (asinh space) per fold."""
    return _wf(spark, sf)


@register("walk_forward_scores", with_views(
    f"SELECT fold, avg(abs(actual - prediction)) AS mae, count(*) AS n_rows, "
    f"count(abs(actual - prediction)) AS n_scored FROM ({_WF}) GROUP BY fold",
    "v_orders_daily", extra=_FOLD_CTES), {"mae": 2})
def q_walk_forward_scores(spark, sf):
    return fold_scores(_wf(spark, sf))


@register("cv_summary", with_views(
    f"""SELECT avg(mae) AS cv_mae, count(*) AS n_folds, sum(mae * n_scored) / sum(n_scored) AS pooled_mae FROM (
  SELECT fold, avg(abs(actual - prediction)) AS mae, count(abs(actual - prediction)) AS n_scored
  FROM ({_WF}) GROUP BY fold)""", "v_orders_daily", extra=_FOLD_CTES), {"cv_mae": 2, "pooled_mae": 2})
def q_cv_summary(spark, sf):
    """Mean of per-fold MAEs (the grid-search score) next to the pooled MAE."""
    return cv_summary(_wf(spark, sf))


@register("monthly_scorecard_orders", with_views(
    f"""SELECT period, model_mae, bench_mae, win_rate, num_hours, model_mae - bench_mae AS gap FROM (
  SELECT strftime(ts, '%Y-%m') AS period, avg(model_abs_diff) AS model_mae, avg(bench_abs_diff) AS bench_mae,
    avg(CAST(model_win AS DOUBLE)) AS win_rate, count(model_win) AS num_hours
  FROM (SELECT wf.*, abs(actual - prediction) AS model_abs_diff, abs(actual - l.y) AS bench_abs_diff,
          coalesce(abs(actual - prediction) < abs(actual - l.y), false) AS model_win
        FROM ({_WF}) wf LEFT JOIN v_orders_daily l ON l.ts = wf.ts - INTERVAL 7 DAY)
  GROUP BY 1)""", "v_orders_daily", extra=_FOLD_CTES), {"model_mae": 2, "bench_mae": 2, "win_rate": 6, "gap": 2})
def q_monthly_scorecard_orders(spark, sf):
    """Monthly scorecard of walk-forward predictions against a same-weekday-last-week
    benchmark."""
    wf = _wf(spark, sf, keep=("date", "ts"))
    od = V.v_orders_daily(spark, sf)
    bench = exact_lags(od.select("ts", "y"), "ts", ["y"], [7]).select("ts", F.col("y_lag7").alias("bench"))
    e = forecast_errors(wf.join(bench, on="ts", how="left"), "actual", "prediction", bench="bench",
                        bench_err="bench_abs_diff")
    return monthly_scorecard(e, "ts", period="month", bench_err="bench_abs_diff")


@register("param_grid", with_views(
    f"""SELECT CAST(dense_rank() OVER (ORDER BY n, r, d, w, o) - 1 AS INTEGER) AS combo_id, CAST(n AS INTEGER) AS n_estimators,
  CAST(r AS DOUBLE) AS learning_rate, CAST(d AS INTEGER) AS max_depth, CAST(w AS INTEGER) AS min_child_weight, o AS objective,
  fold, n_train_rows, n_val_rows
FROM (SELECT unnest([100, 200]) AS n), (SELECT unnest([0.01, 0.05, 0.1, 0.3]) AS r), (SELECT unnest([6, 8]) AS d),
  (SELECT unnest([1, 5, 20]) AS w), (SELECT unnest(['absolute', 'squared']) AS o),
  (SELECT m.period_idx AS fold, (SELECT count(*) FROM tagged t WHERE t.period_idx < m.period_idx) AS n_train_rows,
     (SELECT count(*) FROM tagged t WHERE t.period_idx = m.period_idx) AS n_val_rows
   FROM months m WHERE m.period_idx >= {MIN_TRAIN})
""",
    "v_orders_daily", extra=_FOLD_CTES), ["learning_rate"])
def q_param_grid(spark, sf):
    """The task list of a grid search: the distinct settings of the study's grids that the
    learner honours, each with the folds the data supports and their row counts."""
    ordered = sorted(M.honoured(M.grid_settings(M.BOOSTED_DEPTH_GRID, M.BOOSTED_DEPTH_VARIANTS)),
                     key=lambda s: (s["n_estimators"], s["learning_rate"], s["max_depth"], s["min_child_weight"], s["objective"]))
    folds = fold_summary(_tagged_orders(spark, sf), MIN_TRAIN).select("fold", "n_train_rows", "n_val_rows")
    tasks = F.explode(F.array(*[F.struct(F.lit(i).alias("combo_id"), F.lit(s["n_estimators"]).alias("n_estimators"), F.lit(float(s["learning_rate"])).alias("learning_rate"),
                                         F.lit(s["max_depth"]).alias("max_depth"), F.lit(s["min_child_weight"]).alias("min_child_weight"), F.lit(s["objective"]).alias("objective"))
                                for i, s in enumerate(ordered)]))
    return folds.select("*", tasks.alias("s")).select("s.*", "fold", "n_train_rows", "n_val_rows")


_BASELINE_GRID = [(True, "asinh"), (True, "raw"), (False, "asinh"), (False, "raw")]


def _best_sql() -> str:
    parts = []
    for cid, (grouped, tr) in enumerate(_BASELINE_GRID):
        g = "dayofweek(ts)" if grouped else "0"
        parts.append(f"SELECT {cid} AS combo_id, fold, avg(abs(actual - prediction)) AS mae "
                     f"FROM ({_wf_sql(g, tr)}) GROUP BY fold")
    return (f"SELECT combo_id, avg(mae) AS cv_mae, count(*) AS n_folds FROM ({' UNION ALL '.join(parts)}) "
            f"GROUP BY combo_id ORDER BY cv_mae, combo_id LIMIT 1")


@register("best_params", with_views(_best_sql(), "v_orders_daily", extra=_FOLD_CTES), {"cv_mae": 2})
def q_best_params(spark, sf):
    """Walk-forward search over baseline settings (weekday grouping x target
    transform); the first combination with the lowest mean fold MAE."""
    variants = [(cid, day_of_week0("ts") if grouped else None, tr) for cid, (grouped, tr) in enumerate(_BASELINE_GRID)]
    pred = walk_forward_variants(_tagged_orders(spark, sf), "y", variants, MIN_TRAIN, keep=("ts",))
    scores = fold_scores(pred, by=("variant",)).select(F.col("variant").alias("combo_id"), "fold", "mae")
    return M.best_params(scores)


# ------------------------------------------------------------------ boosted trees
#: The search of the registered queries: settings of the study's grid, on weekly folds.
SEARCH = [{"n_estimators": 30, "learning_rate": r, "max_depth": 4, "min_child_weight": 5, "objective": "reg:absoluteerror"} for r in (0.05, 0.1)]
_WEEKS = {"weeks": "SELECT wk, CAST(row_number() OVER (ORDER BY wk) - 1 AS INTEGER) AS idx FROM (SELECT DISTINCT date_trunc('week', ts) AS wk FROM feats)"}
_VALIDATED = "SELECT f.*, w.idx FROM feats f JOIN weeks w ON w.wk = date_trunc('week', f.ts)"


def _feats_sql(sql: str, **extra: str) -> str:
    """``sql`` over ``feats`` (the all-events feature table) and ``weeks`` (its weeks, numbered)."""
    from daycast.plans.q_features import FEATURE_ALL_SQL
    ctes = {"feats": FEATURE_ALL_SQL, **_WEEKS, **extra}
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + sql


def _features(spark, sf):
    ft = feature_table(V.v_all(spark, sf), "ts", "v", {"v": "v"})
    return ft, [c for c in ft.columns if c not in ("ts", "v")]


def _weekly_features(spark, sf):
    """The feature table with its week's index, the feature columns, and the folds."""
    ft, feats = _features(spark, sf)
    tagged = tag_periods(ft, "ts", "week")
    n = tagged.select("period_idx").distinct().count()
    return tagged, feats, list(range(MIN_TRAIN, n))


def _searched(spark, sf):
    tagged, feats, folds = _weekly_features(spark, sf)
    return tagged, feats, folds, M.grid_search(tagged, feats, "v", SEARCH, folds, parallelism=2, bound=10)


@register("grid_search_small", _feats_sql(
    f"""SELECT CAST(i AS INTEGER) AS combo_id, 30 AS n_estimators, [0.05, 0.1][i + 1] AS learning_rate, 4 AS max_depth,
  5 AS min_child_weight, 'reg:absoluteerror' AS objective, (SELECT count(*) FROM weeks WHERE idx >= {MIN_TRAIN}) AS n_folds,
  true AS scored FROM (SELECT unnest([0, 1]) AS i)"""), ["learning_rate"])
def q_grid_search_small(spark, sf):
    """Grid search over weekly expanding folds: one row per setting with its parameters and
    folds. The scores are the learner's own; the check sees that each setting has one."""
    *_, scores = _searched(spark, sf)
    out = M.search_results(scores, SEARCH)
    return out.select("combo_id", "n_estimators", "learning_rate", "max_depth", "min_child_weight", "objective", "n_folds",
                      F.coalesce(F.col("avg_mae") > 0, F.lit(False)).alias("scored"))


@register("walk_forward_gbt", _feats_sql(
    f"SELECT ts, idx AS fold, v AS actual, true AS predicted FROM ({_VALIDATED}) WHERE idx >= {MIN_TRAIN}"), ["actual"])
def q_walk_forward_gbt(spark, sf):
    """The search's winner walked forward: every validation hour has a prediction."""
    tagged, feats, folds, scores = _searched(spark, sf)
    out = M.walk_forward(tagged, feats, "v", M.best_setting(scores, SEARCH), folds, "ts", parallelism=2, bound=10)
    return out.select("ts", "fold", "actual", F.col("prediction").isNotNull().alias("predicted"))


def _final(spark, sf):
    ft, feats = _features(spark, sf)
    return ft, feats, M.fit_final(ft, feats, "v", SEARCH[1])


@register("final_fit", _feats_sql("SELECT count(*) AS n_rows, true AS better_than_mean FROM feats"))
def q_final_fit(spark, sf):
    """Fit on all rows; whether the training MAE in raw units beats the mean's."""
    ft, feats, model = _final(spark, sf)
    plain = ft.agg(F.avg("v").alias("m")).first()["m"]
    naive = ft.agg(F.avg(F.abs(F.col("v") - plain)).alias("e")).first()["e"]
    return M.train_mae(model, ft, "v").select("n_rows", (F.col("train_mae") < naive).alias("better_than_mean"))


@register("importances", """SELECT unnest(['month', 'day_of_week', 'hour_of_day', 'is_weekend', 'is_holiday', 'v_lag2', 'v_lag4', 'v_lag8',
  'rolling_mean', 'rolling_stddev']) AS feature, CAST(1 AS DOUBLE) AS total""", ["total"])
def q_importances(spark, sf):
    """Impurity importances: the features, whose shares sum to 1."""
    ft, feats, model = _final(spark, sf)
    imp = M.importances(spark, model, feats, 30)
    total = imp.agg(F.sum("importance").alias("t")).first()["t"]
    return imp.select("feature", F.lit(float(total)).alias("total"))


@register("split_importances", "SELECT true AS known_features, true AS within_trees")
def q_split_importances(spark, sf):
    """Split counts from the saved trees: only known features, no more splits than the trees can have."""
    ft, feats, model = _final(spark, sf)
    path = os.path.join(ensure_checkpoint_dir(spark), f"trees-{uuid.uuid4().hex}")
    top = M.split_importances(model, feats, path, 30)
    most = SEARCH[1]["n_estimators"] * (2 ** SEARCH[1]["max_depth"] - 1)
    return top.agg(F.bool_and(F.col("feature").isin(feats)).alias("known_features"),
                   F.sum("splits").between(1, most).alias("within_trees"))


@register("model_roundtrip", _feats_sql("SELECT count(*) AS n_rows, true AS same_score, 'asinh' AS target_transform FROM feats"))
def q_model_roundtrip(spark, sf):
    """Save the model with its metadata, load both back and re-score the training rows."""
    ft, feats, model = _final(spark, sf)
    path = os.path.join(ensure_checkpoint_dir(spark), f"model-{uuid.uuid4().hex}")
    score = M.train_mae(model, ft, "v").first()["train_mae"]
    M.save_model(model, {"feature_cols": feats, "best_params": SEARCH[1], "target_transform": "asinh",
                         "inverse_transform": "sinh", "train_mae": score}, path)
    loaded, meta = M.load_model(spark, path)
    again = M.train_mae(loaded, ft, "v").first()
    return meta.select(F.lit(again["n_rows"]).cast("long").alias("n_rows"), F.lit(abs(again["train_mae"] - score) < 1e-9).alias("same_score"), "target_transform")


#: Trees of no depth are means, so what the learner makes of folds, weights and splits has a value that SQL can state.
MEANS = [{"n_estimators": n, "learning_rate": 0.1, "max_depth": 0, "min_child_weight": 1, "objective": "squared"} for n in (1, 3)]


@register("weighted_fit", _feats_sql(
    f"""SELECT CASE WHEN idx = lastidx THEN 'validation' ELSE 'training' END AS period, count(*) AS n_rows, avg(abs(v - fitted)) AS mae
FROM (SELECT *, max(idx) OVER () AS lastidx FROM ({_VALIDATED})), (
  SELECT sinh(sum((abs(v) / 100 + 1) * asinh(v)) / sum(abs(v) / 100 + 1)) AS fitted FROM ({_VALIDATED}) WHERE idx < (SELECT max(idx) FROM weeks))
GROUP BY 1"""), {"mae": 6})
def q_weighted_fit(spark, sf):
    """Sample weights growing with the target's magnitude, early stopping on the last week, and
    no depth: the fit is the weighted mean of the training weeks, in asinh space."""
    tagged, feats, _ = _weekly_features(spark, sf)
    last = tagged.agg(F.max("period_idx").alias("i")).first()["i"]
    data = tagged.withColumn("w", F.abs(F.col("v")) / 100 + 1).withColumn("is_val", F.col("period_idx") == F.lit(last))
    model = M.fit_final(data, feats, "v", MEANS[1], weight_col="w", validation_col="is_val")
    scored = M.predict_raw(model, data).groupBy(F.when(F.col("is_val"), "validation").otherwise("training").alias("period"))
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), F.avg(F.abs(F.col("v") - F.col("prediction"))).alias("mae"))


_MEAN_WALK = f"""SELECT v.ts, v.idx AS fold, v.v AS actual, (SELECT sinh(avg(asinh(t.v))) FROM ({_VALIDATED}) t WHERE t.idx < v.idx) AS prediction
FROM ({_VALIDATED}) v WHERE v.idx >= {MIN_TRAIN}"""


@register("grid_search_means", _feats_sql(
    f"""SELECT CAST(i AS INTEGER) AS combo_id, [1, 3][i + 1] AS n_estimators, avg(mae) AS avg_mae, count(*) AS n_folds
FROM (SELECT fold, avg(abs(actual - prediction)) AS mae FROM ({_MEAN_WALK}) GROUP BY fold), (SELECT unnest([0, 1]) AS i) GROUP BY i"""), ["avg_mae"])
def q_grid_search_means(spark, sf):
    """The grid search itself, by value: settings of no depth, whose fold fits are means."""
    tagged, feats, folds = _weekly_features(spark, sf)
    scores = M.grid_search(tagged, feats, "v", MEANS, folds, parallelism=2)
    return M.search_results(scores, MEANS).select("combo_id", "n_estimators", "avg_mae", "n_folds")


@register("walk_forward_means", _feats_sql(_MEAN_WALK), ["actual", "prediction"])
def q_walk_forward_means(spark, sf):
    """The learner walked forward, by value: every hour's prediction is the mean of the weeks before its own."""
    tagged, feats, folds = _weekly_features(spark, sf)
    return M.walk_forward(tagged, feats, "v", MEANS[0], folds, "ts", parallelism=2).select("ts", "fold", "actual", "prediction")


_FLAGS = {"is_weekend": "is_weekend = 1", "is_morning": "hour_of_day < 12"}


@register("stump_split", _feats_sql(
    "SELECT feature, CAST(1 AS BIGINT) AS splits, gain AS total_gain FROM (" + " UNION ALL ".join(
        f"""SELECT '{name}' AS feature, max(whole) - sum(n * part) / sum(n) AS gain FROM (
  SELECT count(*) AS n, var_pop(asinh(v)) AS part, (SELECT var_pop(asinh(v)) FROM feats) AS whole FROM feats GROUP BY {test})""" for name, test in _FLAGS.items())
    + ") ORDER BY gain DESC LIMIT 1"), ["total_gain"])
def q_stump_split(spark, sf):
    """Split importance of one stump on two flags: the flag of larger variance reduction, and that reduction."""
    ft, _ = _features(spark, sf)
    flags = ft.withColumn("is_morning", F.when(F.col("hour_of_day") < 12, 1).otherwise(0))
    model = M.fit_final(flags, list(_FLAGS), "v", {"n_estimators": 1, "learning_rate": 1.0, "max_depth": 1, "objective": "squared"})
    return M.split_importances(model, list(_FLAGS), os.path.join(ensure_checkpoint_dir(spark), f"stump-{uuid.uuid4().hex}"), 5)
