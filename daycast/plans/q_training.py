"""The full five-feed pipeline as a registered query: the test events are reshaped
into the raw feed shapes (string timestamps, versioned forecasts, two weather
vintages, a weekday-only daily series as text, a long category mix), then run
through ``training_table`` to the 76-column training table."""

from __future__ import annotations

from pyspark.sql import functions as F

from daycast import schemas as S
from daycast.functions.time import hour_floor
from daycast.plans import views as V
from daycast.plans.features import REFERENCE_LAG_STEMS, reference_lag_name, training_table
from daycast.plans.oracle import training_sql
from daycast.plans.registry import register

# Fixed mapping of event types onto feed categories for the test reshaping.
FUEL_OF_EVENT = {"click": "Coal", "error": "Gas", "purchase": "Hydro", "signup": "Nuclear", "view": "Wind"}
_TS_TEXT = "yyyy-MM-dd HH:mm:ss"


def _typed(kind, what="sum"):
    hit = F.col("event_type") == kind
    if what == "sum":
        return F.sum(F.when(hit, F.col("value")))
    if what == "count":
        return F.sum(F.when(hit, F.lit(1.0)))
    return F.avg(F.when(hit, F.col("value")))


def feeds(spark, sf):
    e = V.events(spark, sf)
    hourly = e.groupBy(hour_floor("ts").alias("h"))
    prices = hourly.agg(
        F.sum("value").alias("total_lmp_rt"),
        F.coalesce(_typed("click"), F.lit(0.0)).alias("system_energy_price_rt"),
        F.coalesce(_typed("view"), F.lit(0.0)).alias("congestion_price_rt"),
        F.coalesce(_typed("error"), F.lit(0.0)).alias("marginal_loss_price_rt"),
        F.coalesce(_typed("purchase"), F.lit(0.0)).alias("total_lmp_da"),
        F.coalesce(_typed("signup"), F.lit(0.0)).alias("system_energy_price_da"),
        F.avg("value").alias("congestion_price_da"),
        F.max("value").alias("marginal_loss_price_da"),
    ).select(F.date_format("h", _TS_TEXT).alias("datetime_beginning_ept"), *S.PRICE_RT, *S.PRICE_DA)
    vv = V.v_versioned(spark, sf)
    load = vv.select(F.date_format("target", _TS_TEXT).alias("forecast_hour_beginning_ept"),
                     F.date_format("issued", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("evaluated_at_ept"),
                     (F.col("fc") * 100).alias("forecast_load_mw"))
    weather = hourly.agg(
        _typed("click").alias("temperature_2m_previous_day1"), _typed("view").alias("temperature_2m_previous_day2"),
        _typed("click", "count").alias("wind_speed_10m_previous_day1"),
        _typed("view", "count").alias("wind_speed_10m_previous_day2"),
        _typed("click", "avg").alias("cloud_cover_previous_day1"), _typed("view", "avg").alias("cloud_cover_previous_day2"),
    ).withColumn("time", F.date_format("h", _TS_TEXT)).drop("h")
    gas = V.v_daily(spark, sf).select(F.date_format("date", "yyyy-MM-dd").alias("period"),
                                      F.col("daily_value").cast("string").alias("value"))
    mapping = F.create_map(*[F.lit(x) for kv in FUEL_OF_EVENT.items() for x in kv])
    fuel = V.v_share(spark, sf).select(F.date_format("ts", _TS_TEXT).alias("datetime_beginning_ept"),
                                       mapping[F.col("event_type")].alias("fuel_type"),
                                       F.col("share").alias("fuel_percentage_of_total"))
    return {"prices": prices, "load": load, "weather": weather, "gas": gas, "fuel": fuel}


_CASE = "CASE WHEN event_type = '{k}' THEN {v} END"
FEED_SQL = {
    "f_prices": f"""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS datetime_beginning_ept,
  sum(value) AS total_lmp_rt,
  coalesce(sum({_CASE.format(k='click', v='value')}), 0) AS system_energy_price_rt,
  coalesce(sum({_CASE.format(k='view', v='value')}), 0) AS congestion_price_rt,
  coalesce(sum({_CASE.format(k='error', v='value')}), 0) AS marginal_loss_price_rt,
  coalesce(sum({_CASE.format(k='purchase', v='value')}), 0) AS total_lmp_da,
  coalesce(sum({_CASE.format(k='signup', v='value')}), 0) AS system_energy_price_da,
  avg(value) AS congestion_price_da, max(value) AS marginal_loss_price_da
FROM events GROUP BY date_trunc('hour', ts)""",
    "f_load": """SELECT strftime(date_trunc('hour', ts) + to_days(CAST(event_id % 3 + 1 AS INTEGER)), '%Y-%m-%d %H:%M:%S')
  AS forecast_hour_beginning_ept, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS evaluated_at_ept,
  value * 100 AS forecast_load_mw FROM events""",
    "f_weather": f"""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS time,
  sum({_CASE.format(k='click', v='value')}) AS temperature_2m_previous_day1,
  sum({_CASE.format(k='view', v='value')}) AS temperature_2m_previous_day2,
  sum({_CASE.format(k='click', v='1.0')}) AS wind_speed_10m_previous_day1,
  sum({_CASE.format(k='view', v='1.0')}) AS wind_speed_10m_previous_day2,
  avg({_CASE.format(k='click', v='value')}) AS cloud_cover_previous_day1,
  avg({_CASE.format(k='view', v='value')}) AS cloud_cover_previous_day2
FROM events GROUP BY date_trunc('hour', ts)""",
    "f_gas": """SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS period, CAST(avg(value) AS VARCHAR) AS value
FROM events WHERE dayofweek(ts) NOT IN (0, 6) GROUP BY CAST(ts AS DATE)""",
    "f_fuel": """SELECT strftime(h.ts, '%Y-%m-%d %H:%M:%S') AS datetime_beginning_ept,
  CASE h.event_type """ + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FUEL_OF_EVENT.items()) + """ END AS fuel_type,
  h.v / sum(h.v) OVER (PARTITION BY h.ts) - 0.05 AS fuel_percentage_of_total
FROM (SELECT event_type, date_trunc('hour', ts) AS ts, sum(value) AS v FROM events GROUP BY 1, 2) h""",
}


def _sql() -> str:
    body = training_sql("f_prices", "f_load", "f_weather", "f_gas", "f_fuel").strip()
    assert body.startswith("WITH ")
    feeds_cte = ",\n".join(f"{k} AS ({v})" for k, v in FEED_SQL.items())
    return "WITH " + feeds_cte + ",\n" + body[len("WITH "):]


_RND = (["temperature_2m_selected", "wind_speed_10m_selected", "cloud_cover_selected", "forecast_load_mw"]
        + [reference_lag_name(stem, off) for stem in REFERENCE_LAG_STEMS for off in S.LAG_SUFFIX]
        + ["rolling_rt_mean", "rolling_rt_stddev", "total_lmp_rt"])


@register("training_table", _sql(), _RND)
def q_training_table(spark, sf):
    """Five raw feeds -> normalise -> latest load before cutoff -> weather vintage ->
    fuel pivot -> joins -> gas fill -> filters -> de-dup -> calendar, holiday, 63 lags,
    rolling stats -> complete rows: the 76-column training table."""
    return training_table(**feeds(spark, sf))


def _corr_sql() -> str:
    body = _sql()
    feats = ["month", "day_of_week", "hour_of_day", "is_weekend", "is_holiday"] + _RND[:-1]
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), asinh(total_lmp_rt)) AS corr FROM tt" for c in feats)
    return (f"WITH tt AS ({body})\nSELECT feature, corr, abs(corr) AS abs_corr FROM ({parts}) "
            f"WHERE corr IS NOT NULL AND NOT isnan(corr) ORDER BY abs(corr) DESC, feature LIMIT 20")


@register("training_correlations", _corr_sql(), ["corr", "abs_corr"])
def q_training_correlations(spark, sf):
    """The 20 features most correlated (|Pearson|) with the asinh-transformed target."""
    from daycast.operators.profile import top_correlations
    tt = q_training_table(spark, sf).withColumn("__y", F.asinh("total_lmp_rt"))
    feats = [c for c in tt.columns if c not in ("datetime_ept", "total_lmp_rt", "__y")]
    return top_correlations(tt, "__y", feats, k=20)
