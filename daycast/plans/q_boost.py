"""Registered boosting in stages: two rounds of stumps on the weekend flag, whose leaves SQL
can state round by round."""

from __future__ import annotations

from pyspark.sql import functions as F

from daycast.plans import boost as B
from daycast.plans import views as V
from daycast.plans.oracle import with_views
from daycast.plans.registry import register

_COMMON = {"n_estimators": 2, "learning_rate": 0.5, "max_depth": 1}
HUBER = {**_COMMON, "objective": "huber", "alpha": 0.25, "reg_lambda": 3.0, "reg_alpha": 1.0}
PSEUDO_HUBER = {**_COMMON, "objective": "reg:pseudohubererror", "huber_slope": 0.5, "reg_lambda": 1.0}


def _stump_sql(gradient: str, hessian: str, reg_alpha: float, reg_lambda: float) -> str:
    """Two rounds from the mean; ``e``: prediction minus label."""
    step = (f"SELECT *, p0 - 0.5 * sign(g) * greatest(abs(g) - {reg_alpha}, 0) / (h + {reg_lambda}) AS p1 FROM ("
            f"SELECT *, sum({gradient}) OVER w AS g, sum({hessian}) OVER w AS h FROM (SELECT weekend, t, p0, p0 - t AS e FROM {{0}}) WINDOW w AS (PARTITION BY weekend))")
    first = step.format("(SELECT weekend, t, avg(t) OVER () AS p0 FROM days)")
    second = step.format(f"(SELECT weekend, t, p1 AS p0 FROM ({first}))")
    return f"SELECT weekend, count(*) AS n, max(p1) AS fitted, avg(abs(sinh(p1) - sinh(t))) AS mae FROM ({second}) GROUP BY weekend"


_DAYS = {"days": "SELECT CAST(dayofweek(ts) % 6 = 0 AS INTEGER) AS weekend, asinh(y) AS t FROM v_orders_daily"}


def _stumps(spark, sf, params):
    days = V.v_orders_daily(spark, sf).select("y", F.when(F.dayofweek("ts").isin(1, 7), 1).otherwise(0).alias("weekend"))
    scored = B.fit_boosted(days, ["weekend"], "y", params).predict(days)
    return scored.groupBy("weekend").agg(F.count(F.lit(1)).alias("n"), F.max(F.asinh("prediction")).alias("fitted"), F.avg(F.abs(F.col("prediction") - F.col("y"))).alias("mae"))


@register("boost_huber", with_views(_stump_sql("greatest(-0.25, least(0.25, e))", "1.0", 1.0, 3.0), "v_orders_daily", extra=_DAYS), {"fitted": 6, "mae": 2})
def q_boost_huber(spark, sf):
    """Huber loss with L1 and L2 penalties: fitted values and errors by weekend."""
    return _stumps(spark, sf, HUBER)


@register("boost_pseudo_huber", with_views(_stump_sql("e / sqrt(1 + e * e / 0.25)", "1 / (1 + e * e / 0.25) ** 1.5", 0.0, 1.0), "v_orders_daily", extra=_DAYS), {"fitted": 6, "mae": 2})
def q_boost_pseudo_huber(spark, sf):
    """Pseudo-Huber loss: leaves are Newton steps."""
    return _stumps(spark, sf, PSEUDO_HUBER)
