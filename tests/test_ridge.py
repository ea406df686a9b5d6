"""Ridge fits from prefix-summed Gram matrices against numpy, fold by fold."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from daycast.plans import ridge as R
from daycast.plans.folds import tag_periods

FEATURES = [f"x {i}" for i in range(12)]


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    n = 400
    x = rng.normal(size=(n, 12)) * rng.uniform(0.1, 50, 12)
    x[:, 4] = 7.0                           # constant
    x[:, 9] = 2 * x[:, 1] - x[:, 2] + 1     # determined by earlier ones
    y = x @ rng.normal(size=12) * 0.05 + rng.normal(size=n) * 3 + 4
    pdf = pd.DataFrame(x, columns=FEATURES)
    pdf["y"], pdf["w"] = y, rng.integers(0, 4, n).astype(float)
    pdf["ts"] = pd.date_range("2024-01-01", periods=n, freq="13h")
    pdf.loc[5, "x 3"], pdf.loc[60, "y"], pdf.loc[70, "x 0"] = np.nan, np.nan, np.nan
    return pdf


def plain_fit(pdf, lam, standardize=False, weight=None, transform="raw"):
    rows = pdf.dropna(subset=[*FEATURES, "y"])
    x, y = rows[FEATURES].to_numpy(), rows["y"].to_numpy()
    y = np.arcsinh(y) if transform == "asinh" else y
    w = rows[weight].to_numpy() if weight else np.ones(len(rows))
    mx, my = w @ x / w.sum(), w @ y / w.sum()
    c = x - mx
    v = (w @ c**2) / w.sum() if standardize else np.ones(12)
    b = np.linalg.lstsq((c * w[:, None]).T @ c + lam * np.diag(v), (c * w[:, None]).T @ (y - my), rcond=1e-10)[0]
    return my - mx @ b, b


def predictions(pdf, fit, transform="raw"):
    out = fit[0] + pdf[FEATURES].to_numpy() @ fit[1]
    return np.sinh(out) if transform == "asinh" else out


def make(spark, pdf):
    rows = [tuple(v.to_pydatetime() if k == "ts" else None if np.isnan(v) and k != "x 0" else v for k, v in zip(pdf.columns, r, strict=True)) for r in pdf.itertuples(index=False)]
    return tag_periods(spark.createDataFrame(rows, ", ".join(f"`{c}` {'timestamp_ntz' if c == 'ts' else 'double'}" for c in pdf.columns)), "ts", "month")


@pytest.mark.parametrize("kw", [{}, {"standardize": True}, {"weight": "w", "standardize": True}, {"transform": "asinh"}])
def test_walk_forward_equals_numpy_fold_by_fold(spark, frame, kw):
    lambdas = [0.0, 3.0, 200.0]
    got = R.walk_forward_ridge(make(spark, frame), FEATURES, "y", lambdas, 2, keep=["ts"], **{"transform": "raw", **kw}).toPandas()
    months = frame["ts"].dt.strftime("%Y-%m")
    order = sorted(months.unique())
    assert len(got) == 3 * sum(months.isin(order[2:])) and set(got["fold"]) == set(range(2, len(order)))
    for (combo, fold), part in got.groupby(["combo_id", "fold"]):
        train = frame[months.isin(order[:fold])]
        fit = plain_fit(train, lambdas[combo], kw.get("standardize", False), kw.get("weight"), kw.get("transform", "raw"))
        want = pd.Series(predictions(frame, fit, kw.get("transform", "raw")), index=frame["ts"])
        for r in part.itertuples():
            if np.isnan(want[r.ts]):
                assert pd.isna(r.prediction)  # a feature lacks
            else:
                assert r.prediction == pytest.approx(want[r.ts], rel=1e-6, abs=1e-6)


def test_integer_weights_equal_repeated_rows(spark, frame):
    df = make(spark, frame)
    repeated = df.filter("w > 0").withColumn("copy", F.explode(F.expr("sequence(1, cast(w as int))")))
    one = R.fit_ridge(df, FEATURES, "y", 5.0, weight="w").first()
    two = R.fit_ridge(repeated, FEATURES, "y", 5.0).first()
    assert one.total_weight == two.total_weight and one.coefs == pytest.approx(two.coefs, rel=1e-9) and one.intercept == pytest.approx(two.intercept, rel=1e-9)


def test_constant_and_determined_features_get_no_weight(spark, frame):
    fit = R.fit_ridge(make(spark, frame), FEATURES, "y", 0.0, transform="raw")
    row = fit.first()
    assert row.coefs[4] == 0 and row.coefs[9] == 0 and row.scales[4] == pytest.approx(0, abs=1e-5)
    shares = {r.feature: r.importance for r in R.ridge_importances(fit, FEATURES).collect()}
    assert sum(shares.values()) == pytest.approx(1) and shares["x 4"] == 0


def test_no_rows_no_features_no_training(spark, frame):
    df = make(spark, frame)
    assert R.walk_forward_ridge(df.limit(0), FEATURES, "y", [1.0]).count() == 0
    mean = R.fit_ridge(df, [], "y", 1.0, transform="raw").first()
    assert mean.intercept == pytest.approx(frame["y"].mean()) and mean.coefs == []
    untaught = R.walk_forward_ridge(df.withColumn("w", F.lit(0.0)), FEATURES, "y", [1.0], 2, weight="w", transform="raw")
    assert untaught.filter("prediction IS NULL").count() == untaught.count() > 0
    assert R.fit_ridge(df.limit(0), FEATURES, "y").count() == 0


def test_training_rows_are_read_once_for_all_folds_and_penalties(spark, frame, tmp_path):
    """Rows are combined below the first exchange, and the scan's rows cross none for the fit."""
    make(spark, frame).drop("period").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    plan = R.solve(R.prior_grams(R.grams(df, FEATURES, "y", ["period_idx"]), 14), FEATURES, [1.0, 2.0], ["period_idx"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and plan.rindex("partial_sum") > plan.rindex("Exchange") and "Python" not in plan
