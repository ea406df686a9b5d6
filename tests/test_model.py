"""Folds, the prefix-sum walk-forward baseline against brute force, grid enumeration,
first-minimum selection and a small GBT fit."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from daycast.plans import model as M
from daycast.plans.folds import fold_summary, tag_periods, walk_forward_baseline


def _daily(spark, n_days=200, seed=5):
    rng = np.random.default_rng(seed)
    days = pd.date_range("2024-01-01", periods=n_days, freq="D")
    keep = rng.random(n_days) > 0.1
    pdf = pd.DataFrame({"ts": days[keep], "y": np.round(rng.uniform(-50, 3000, keep.sum()), 2)})
    df = spark.createDataFrame([(t.to_pydatetime(), float(y)) for t, y in pdf.itertuples(index=False)],
                               "ts timestamp_ntz, y double")
    return pdf, df


def test_walk_forward_baseline_equals_brute_force(spark):
    pdf, df = _daily(spark)
    tagged = tag_periods(df, "ts", "month")
    got = walk_forward_baseline(tagged, "y", F.dayofweek("ts"), 3, "asinh", keep=("ts",)).toPandas()
    pdf["period"] = pdf["ts"].dt.strftime("%Y-%m")
    months = sorted(pdf["period"].unique())
    pdf["idx"] = pdf["period"].map({m: i for i, m in enumerate(months)})
    pdf["g"] = pdf["ts"].dt.dayofweek
    want = {}
    for _, r in pdf[pdf["idx"] >= 3].iterrows():
        tr = pdf[(pdf["idx"] < r["idx"]) & (pdf["g"] == r["g"])]["y"]
        want[r["ts"]] = math.sinh(np.arcsinh(tr).mean()) if len(tr) else None
    assert len(got) == len(want)
    for _, r in got.iterrows():
        w = want[pd.Timestamp(r["ts"])]
        assert (w is None and pd.isna(r["prediction"])) or math.isclose(r["prediction"], w, rel_tol=1e-9)


def test_fold_summary_counts(spark):
    pdf, df = _daily(spark, 120)
    s = {r.fold: r for r in fold_summary(tag_periods(df, "ts", "month"), 2).collect()}
    per = pdf.groupby(pdf["ts"].dt.strftime("%Y-%m")).size().sort_index().tolist()
    for j in range(2, len(per)):
        assert s[j].n_val_rows == per[j] and s[j].n_train_rows == sum(per[:j])


def test_grids_have_the_honoured_settings_only():
    leaves = M.grid_settings(M.BOOSTED_LEAVES_GRID, M.BOOSTED_LEAVES_VARIANTS)
    depth = M.grid_settings(M.BOOSTED_DEPTH_GRID, M.BOOSTED_DEPTH_VARIANTS)
    assert len(leaves) == 720 and len(depth) == 960 and len(list(itertools.product(*M.BOOSTED_DEPTH_GRID.values()))) * 5 == 960
    assert M.honoured(leaves) == []  # every one asks for a number of leaves
    kept = M.honoured(depth)
    assert len(kept) == 96 and len({tuple(sorted(s.items())) for s in kept}) == 96
    assert {s["objective"] for s in kept} == {"absolute", "squared"}


@pytest.mark.parametrize("bad", [{"max_depth": -1}, {"max_depth": 31}, {"num_leaves": 31}, {"reg_alpha": 1}, {"reg_lambda": 1}, {"objective": "quantile"},
                                 {"objective": "huber", "alpha": 0.1}, {"objective": "reg:pseudohubererror"}, {"alpha": 0.5}, {"subsample": 0.5}])
def test_what_cannot_be_honoured_is_refused(bad):
    with pytest.raises(ValueError):
        M.setting(bad)


def test_objectives_reach_the_learner(spark):
    assert M.gbt_for({"objective": "reg:absoluteerror"}).getLossType() == "absolute"
    assert M.gbt_for({"objective": "reg:squarederror", "reg_alpha": 0, "min_child_weight": 20}).getMinInstancesPerNode() == 20


def test_best_params_first_minimum(spark):
    scores = spark.createDataFrame([(3, 0, 1.0), (3, 1, 3.0), (1, 0, 2.0), (1, 1, 2.0), (2, 0, 5.0)],
                                   "combo_id int, fold int, mae double")
    assert M.best_params(scores).first().combo_id == 1


def test_small_gbt_walk_forward(spark):
    pdf, df = _daily(spark, 150)
    df = df.withColumn("dow", F.dayofweek("ts").cast("double")).withColumn("m", F.month("ts").cast("double"))
    tagged = tag_periods(df, "ts", "month")
    params = {"n_estimators": 5, "max_depth": 2, "objective": "mae"}
    pred = M.walk_forward(tagged, ["dow", "m"], "y", params, [3, 4], "ts", parallelism=2, bound=10)
    assert pred.count() == tagged.filter(F.col("period_idx").isin(3, 4)).count()
    scores = M.grid_search(tagged, ["dow", "m"], "y", [params], [3], parallelism=1)
    assert scores.count() == 1 and scores.first().mae > 0
    two = [params, {**params, "n_estimators": 10}]
    scores = M.grid_search(tagged, ["dow", "m"], "y", two, [3, 4], parallelism=2, bound=10)
    found = {r.n_estimators: r for r in M.search_results(scores, two).collect()}
    assert {n: r.n_folds for n, r in found.items()} == {5: 2, 10: 2}
    assert M.best_setting(scores, two)["n_estimators"] == min(found, key=lambda n: found[n].avg_mae)
    assert M.walk_forward(tagged, ["dow", "m"], "y", params, [], "ts").count() == 0


def test_quantiles_skip_what_is_no_number(spark):
    """One NaN, infinity or NULL among many values: bounded rows reach the driver, results are exact."""
    from daycast.operators.profile import describe_columns, histogram
    df = spark.range(50_000).select(F.when(F.col("id") == 7, float("nan")).when(F.col("id") == 8, float("-inf")).when(F.col("id") != 9, F.col("id").cast("double")).alias("x"))
    row = describe_columns(df, ["x"]).first()
    values = np.delete(np.arange(50_000.0), [7, 8, 9])
    assert (row["count"], row.n_null, row.n_nonfinite) == (49_997, 1, 2)
    assert (row.q25, row.q50, row.q75) == tuple(float(np.quantile(values, q)) for q in (0.25, 0.5, 0.75))
    bins = histogram(df, "x", 4).orderBy("bin").collect()
    assert sum(r.n for r in bins) == 49_997 and max(r.n for r in bins) < 12_600


def test_quantiles_of_extreme_doubles(spark):
    from daycast.operators.quantiles import exact_quantiles
    for values in ([-1.7e308, 1.7e308, 0.0, 1.0], [5e-324, 0.0, 1e-323], [1.0, math.nextafter(1.0, 2)] * 40):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        got = exact_quantiles(df, ["x"], [0.0, 1.0], buckets=4, max_leaf=1)
        assert got == {("x", 0.0): min(values), ("x", 1.0): max(values)}


def test_exact_quantiles_equal_numpy_including_ties(spark):
    from daycast.operators.quantiles import exact_quantiles
    rng = np.random.default_rng(1)
    a = np.round(rng.normal(50, 20, 5000), 1)          # many ties
    b = np.concatenate([np.full(3000, 7.0), rng.uniform(0, 1e6, 200)])  # one hot value
    pdf = pd.DataFrame({"a": a, "b": np.resize(b, 5000)})
    df = spark.createDataFrame(pdf)
    got = exact_quantiles(df, ["a", "b"], [0.0, 0.25, 0.5, 0.75, 1.0], buckets=16, max_leaf=50)
    for c in ["a", "b"]:
        for p in [0.0, 0.25, 0.5, 0.75, 1.0]:
            assert math.isclose(got[(c, p)], float(np.quantile(pdf[c], p)), rel_tol=1e-12, abs_tol=1e-12), (c, p)


def test_describe_exact_and_approx(spark):
    from daycast.operators.profile import describe_columns
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"a": rng.normal(0, 1, 4000), "b": rng.integers(0, 50, 4000).astype(float)})
    df = spark.createDataFrame(pdf)
    ex = {r["column"]: r for r in describe_columns(df, ["a", "b"]).collect()}
    ap = {r["column"]: r for r in describe_columns(df, ["a", "b"], approx=True).collect()}
    want = pdf.describe()
    for c in ["a", "b"]:
        assert ex[c]["count"] == 4000
        for q, name in [(0.25, "q25"), (0.5, "q50"), (0.75, "q75")]:
            assert math.isclose(ex[c][name], float(pdf[c].quantile(q)), abs_tol=1e-12)
            assert abs(ap[c][name] - ex[c][name]) <= 0.05 * (pdf[c].max() - pdf[c].min())
        assert math.isclose(ex[c]["std"], want.loc["std", c], rel_tol=1e-9)
