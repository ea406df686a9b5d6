"""Boosting in stages against a plain version on small trees."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from daycast.plans import boost as B
from daycast.plans import model as M


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(2)
    a, b, w = rng.integers(0, 4, 300).astype(float), rng.integers(0, 3, 300).astype(float), rng.integers(1, 4, 300).astype(float)
    return a, b, np.sinh(a - 0.6 * b + a * b * 0.3 + rng.standard_t(2, 300) * 0.4), w


def plain_tree(x, target, weight, depth, num_leaves):
    """Leaves (row index arrays) of the tree grown best-first by weighted variance."""
    sse = lambda r: float(weight[r] @ (target[r] - weight[r] @ target[r] / weight[r].sum()) ** 2)

    def best(rows, level):
        found = (1e-12, None)
        for f in range(x.shape[1]) if level < depth else []:
            for t in np.unique(x[rows, f])[:-1]:
                left, right = rows[x[rows, f] <= t], rows[x[rows, f] > t]
                gain = sse(rows) - sse(left) - sse(right)
                if gain > found[0] + 1e-9:
                    found = (gain, (left, right))
        return found

    leaves = [(best(np.arange(len(x)), 0), np.arange(len(x)), 0)]
    while len(leaves) < (num_leaves or 10**9):
        leaves.sort(key=lambda e: -e[0][0])
        (_, cut), rows, level = leaves[0]
        if cut is None:
            break
        leaves[0:1] = [(best(r, level + 1), r, level + 1) for r in cut]
    return [r for _, r, _ in leaves]


def plain_boost(x, y, w, p):
    t = np.arcsinh(y)
    total = np.full(len(t), w @ t / w.sum())
    for _ in range(p["n_estimators"]):
        e = total - t
        d = p.get("alpha") or p.get("huber_slope")
        if p["objective"] == "huber":
            g, h = np.clip(e, -d, d), np.ones_like(e)
        else:
            g, h = e / np.sqrt(1 + (e / d) ** 2), (1 + (e / d) ** 2) ** -1.5
        for rows in plain_tree(x, -g / h, h * w, p["max_depth"], p.get("num_leaves")):
            sg, sh = (g * w)[rows].sum(), (h * w)[rows].sum()
            total[rows] -= p["learning_rate"] * np.sign(sg) * max(abs(sg) - p.get("reg_alpha", 0), 0) / (sh + p.get("reg_lambda", 0))
    return np.sinh(total)


@pytest.mark.parametrize("params", [
    {"objective": "huber", "alpha": 0.5, "reg_lambda": 2.0, "reg_alpha": 1.0, "max_depth": 2}, {"objective": "huber", "alpha": 0.1, "max_depth": 3, "num_leaves": 4},
    {"objective": "reg:pseudohubererror", "huber_slope": 0.3, "reg_lambda": 1.0, "max_depth": 2}])
def test_equals_plain_boosting(spark, frame, params):
    a, b, y, w = frame
    p = {"n_estimators": 3, "learning_rate": 0.3, **params}
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(zip(a, b, y, w, strict=True))], "id int, a double, b double, y double, w double")
    model = B.fit_boosted(df, ["a", "b"], "y", p, weight_col="w", stage_rounds=2)
    got = [r.prediction for r in model.predict(df).orderBy("id").collect()]
    assert got == pytest.approx(plain_boost(np.column_stack([a, b]), y, w, p).tolist(), rel=1e-9)
    if "num_leaves" in p:
        assert all(len(set(values)) <= p["num_leaves"] for _, values in model.rounds)


def test_settings_of_the_study():
    leaves = M.grid_settings(M.BOOSTED_LEAVES_GRID, M.BOOSTED_LEAVES_VARIANTS)
    depth = M.grid_settings(M.BOOSTED_DEPTH_GRID, M.BOOSTED_DEPTH_VARIANTS)
    assert len(B.honoured(leaves)) == 480  # all but the absolute loss, and 50 leaves of unlimited depth
    assert len(B.honoured(depth)) == 768   # all but the absolute loss


@pytest.mark.parametrize("bad", [{"objective": "mae"}, {"objective": "huber"}, {"objective": "reg:pseudohubererror", "huber_slope": 0.0}, {"max_depth": -1}, {"max_depth": 0},
                                 {"max_depth": -1, "num_leaves": 50}, {"num_leaves": 1}, {"reg_lambda": -1}, {"subsample": 0.5}])
def test_what_cannot_be_honoured_is_refused(bad):
    with pytest.raises(ValueError):
        B.setting(bad)


def test_rows_that_teach_nothing(spark, frame):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 3.0, 1.0), (1.0, None, 1.0), (5.0, 1e6, 0.0), (5.0, 1e6, None)], "x double, y double, w double")
    p = {"n_estimators": 1, "learning_rate": 1.0, "max_depth": 1}
    rows = {r.x: r.prediction for r in B.fit_boosted(df, ["x"], "y", p, weight_col="w").predict(df).collect()}
    assert rows[1.0] == pytest.approx(2.0) and rows[5.0] == pytest.approx(3.0)
    with pytest.raises(ValueError):
        B.fit_boosted(df.filter("x > 4"), ["x"], "y", p, weight_col="w")


def test_walk_forward_has_a_prediction_for_every_row(spark, frame):
    a, b, y, _ = frame
    df = spark.createDataFrame([(i, i // 100, *map(float, r)) for i, r in enumerate(zip(a, b, y, strict=True))], "ts int, period_idx int, a double, b double, y double")
    p = {"n_estimators": 1, "max_depth": 2, "objective": "huber", "alpha": 0.5}
    out = B.walk_forward_boosted(df, ["a", "b"], "y", p, [1, 2], "ts")
    assert out.filter(F.col("prediction").isNotNull()).groupBy("fold").count().orderBy("fold").collect() == [(1, 100), (2, 100)]
    assert B.walk_forward_boosted(df, ["a", "b"], "y", p, [], "ts").count() == 0
