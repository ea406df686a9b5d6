"""Registered feature-building queries (normalise, join, fill, lags, rolling, calendar)."""

from __future__ import annotations

from pyspark.sql import functions as F

from daycast.operators.calendar import calendar_features, holiday_dim, holiday_flag, holidays_for
from daycast.operators.dedupe import dedupe_hours, latest_before_cutoff, latest_version
from daycast.operators.fill import asof_fill, fill_from_daily, forward_fill
from daycast.operators.filters import complete_rows, incomplete_count, require_not_null
from daycast.operators.joins import join_sources
from daycast.operators.lags import exact_lags, offset_rows, seasonal_rolling
from daycast.operators.normalize import pivot_share, select_vintage
from daycast.plans import views as V
from daycast.plans.features import feature_table
from daycast.plans.oracle import back, holiday_sql, lag_list, rolling_lateral, share_sql, with_views
from daycast.plans.registry import register

LAGS = [2, 4, 8]

# ---------------------------------------------------------------- feature table
_CAL = ("CAST(month(b.ts) AS INTEGER) AS month, CAST(dayofweek(b.ts) AS INTEGER) AS day_of_week, "
        "CAST(hour(b.ts) AS INTEGER) AS hour_of_day, CAST(dayofweek(b.ts) % 6 = 0 AS INTEGER) AS is_weekend")
_HOL = "CAST(CAST(b.ts AS DATE) IN (SELECT holiday_date FROM hol) AS INTEGER) AS is_holiday"
_LAG_V, _LAG_VN = lag_list("v_hourly", "ts", ["v"], LAGS, "event_type"), lag_list("v_hourly", "ts", ["v", "n"], LAGS, "event_type")
FEATURE_SQL = with_views(
    f"""SELECT * FROM (
  SELECT b.event_type, b.ts, {_CAL}, {_HOL}, {_LAG_VN}, roll.rolling_mean, roll.rolling_stddev, b.v
  FROM v_hourly b {rolling_lateral("v_hourly", "ts", "v", "event_type")}
) WHERE COLUMNS(* EXCLUDE (event_type, ts)) IS NOT NULL""",
    "v_hourly",
    extra={"yrs": "SELECT DISTINCT year(ts) AS year FROM v_hourly", "hol": holiday_sql("yrs")},
)
_FEAT_RND = ["v_lag2", "v_lag4", "v_lag8", "rolling_mean", "rolling_stddev", "v"]


@register("feature_table", FEATURE_SQL, _FEAT_RND)
def q_feature_table(spark, sf):
    """Calendar, holiday, exact lags, same-hour rolling stats; complete rows, per event type."""
    h = V.v_hourly(spark, sf)
    return feature_table(h, "ts", "v", {"v": "v", "n": "n"}, series_keys=["event_type"])


FEATURE_ALL_SQL = with_views(
    f"""SELECT * FROM (
  SELECT b.ts, {_CAL}, {_HOL}, {lag_list("v_all", "ts", ["v"], LAGS)}, roll.rolling_mean, roll.rolling_stddev, b.v
  FROM v_all b {rolling_lateral("v_all", "ts", "v")}
) WHERE COLUMNS(* EXCLUDE (ts)) IS NOT NULL""",
    "v_all",
    extra={"yrs": "SELECT DISTINCT year(ts) AS year FROM v_all", "hol": holiday_sql("yrs")},
)


@register("feature_table_all", FEATURE_ALL_SQL, _FEAT_RND)
def q_feature_table_all(spark, sf):
    """The flagship: feature table of the single all-events hourly series."""
    return feature_table(V.v_all(spark, sf), "ts", "v", {"v": "v"})


@register("feature_columns", f"SELECT * EXCLUDE (ts, v) FROM ({FEATURE_SQL})", _FEAT_RND[:-1])
def q_feature_columns(spark, sf):
    """Model inputs: every feature-table column except the timestamp and the target."""
    return q_feature_table(spark, sf).drop("ts", "v")


# ---------------------------------------------------------------- lags and rolling
@register("exact_lags", with_views(f"SELECT b.*, {_LAG_VN} FROM v_hourly b", "v_hourly"),
          ["v", "v_lag2", "v_lag4", "v_lag8"], dbl=["n_lag2", "n_lag4", "n_lag8"])
def q_exact_lags(spark, sf):
    return exact_lags(V.v_hourly(spark, sf), "ts", ["v", "n"], LAGS, ["event_type"])


_dsel = ", ".join(f"{back('v_hourly', 'ts', o, 'past.v - past.n', 'event_type')} AS diff_lag{o}" for o in LAGS)


@register("lag_differences", with_views(f"SELECT b.event_type, b.ts, {_dsel} FROM v_hourly b", "v_hourly"), [f"diff_lag{o}" for o in LAGS])
def q_lag_differences(spark, sf):
    lagged = exact_lags(V.v_hourly(spark, sf), "ts", ["v", "n"], LAGS, ["event_type"])
    return lagged.select("event_type", "ts", *[(F.col(f"v_lag{o}") - F.col(f"n_lag{o}")).alias(f"diff_lag{o}")
                                               for o in LAGS])


@register("seasonal_rolling", with_views(
    f"SELECT b.*, roll.* FROM v_hourly b {rolling_lateral('v_hourly', 'ts', 'v', 'event_type')}", "v_hourly"),
    ["v", "rolling_mean", "rolling_stddev"])
def q_seasonal_rolling(spark, sf):
    return seasonal_rolling(V.v_hourly(spark, sf), "ts", "v", 2, 8, ["event_type"])


@register("offset_union", with_views(
    """SELECT b.event_type, b.ts, CAST(date_diff('day', past.ts, b.ts) AS INTEGER) AS offset_days, past.v AS past_value
FROM v_hourly b JOIN v_hourly past USING (event_type)
WHERE b.ts::TIME = past.ts::TIME AND past.ts::DATE + 2 <= b.ts::DATE AND past.ts::DATE + 8 >= b.ts::DATE""", "v_hourly"), ["past_value"])
def q_offset_union(spark, sf):
    """Long form of the same-hour history (days 2..8 back), one row per existing offset."""
    return offset_rows(V.v_hourly(spark, sf), "ts", "v", 2, 8, ["event_type"])


@register("calendar_features", with_views(f"SELECT b.event_type, b.ts, {_CAL} FROM v_hourly b", "v_hourly"))
def q_calendar(spark, sf):
    return calendar_features(V.v_hourly(spark, sf).select("event_type", "ts"), "ts")


@register("require_not_null", with_views(
    f"SELECT * FROM (SELECT b.*, {lag_list('v_hourly', 'ts', ['v'], [2, 8], 'event_type')} FROM v_hourly b) WHERE v_lag2 IS NOT NULL AND v_lag8 IS NOT NULL",
    "v_hourly"), ["v", "v_lag2", "v_lag8"])
def q_require_not_null(spark, sf):
    lagged = exact_lags(V.v_hourly(spark, sf), "ts", ["v"], [2, 8], ["event_type"])
    return require_not_null(lagged, ["v_lag2", "v_lag8"])


_LAGGED_V = f"SELECT b.*, {_LAG_V} FROM v_hourly b"


def _lagged_v(spark, sf):
    return exact_lags(V.v_hourly(spark, sf), "ts", ["v"], LAGS, ["event_type"])


@register("complete_rows", with_views(
    f"SELECT * FROM ({_LAGGED_V}) WHERE COLUMNS(* EXCLUDE (event_type, ts)) IS NOT NULL", "v_hourly"),
    ["v", "v_lag2", "v_lag4", "v_lag8"])
def q_complete_rows(spark, sf):
    return complete_rows(_lagged_v(spark, sf), exclude=["event_type", "ts"])


@register("incomplete_count", with_views(
    f"""SELECT count(*) FILTER (WHERE v IS NULL OR n IS NULL OR v_lag2 IS NULL OR v_lag4 IS NULL OR v_lag8 IS NULL)
       AS n_any_null,
     count(*) FILTER (WHERE v IS NULL AND n IS NULL AND v_lag2 IS NULL AND v_lag4 IS NULL AND v_lag8 IS NULL)
       AS n_all_null,
     count(*) AS n_rows
   FROM ({_LAGGED_V})""", "v_hourly"))
def q_incomplete_count(spark, sf):
    return incomplete_count(_lagged_v(spark, sf), exclude=["event_type", "ts"])


@register("point_lookup", with_views(
    "SELECT ts, v FROM v_all WHERE ts IN (TIMESTAMP '2024-01-20 15:00:00', TIMESTAMP '2024-01-18 15:00:00', "
    "TIMESTAMP '2024-01-16 15:00:00', TIMESTAMP '2024-01-12 15:00:00')", "v_all"), ["v"])
def q_point_lookup(spark, sf):
    """One target hour and the three hours its lags come from."""
    stamps = ["2024-01-20 15:00:00", "2024-01-18 15:00:00", "2024-01-16 15:00:00", "2024-01-12 15:00:00"]
    return V.v_all(spark, sf).filter(F.col("ts").isin([F.lit(s).cast("timestamp_ntz") for s in stamps]))


# ---------------------------------------------------------------- normalise / versions
@register("latest_before_cutoff", with_views(
    """SELECT series, target, last.* FROM (
  SELECT series, target, arg_max({'issued': issued, 'fc': fc, 'event_id': event_id}, (issued, event_id))
    FILTER (issued <= target::DATE - INTERVAL 14 HOUR) AS last
  FROM v_versioned GROUP BY series, target) WHERE last IS NOT NULL""", "v_versioned"), ["fc"])
def q_latest_before_cutoff(spark, sf):
    return latest_before_cutoff(V.v_versioned(spark, sf), "target", "issued", ["series"], tiebreak=["event_id"])


@register("dedupe_hours", with_views(
    "SELECT event_type, ts, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM v_dup GROUP BY ALL", "v_dup"), ["value"])
def q_dedupe_hours(spark, sf):
    return dedupe_hours(V.v_dup(spark, sf), "ts", ["event_type"], order_by=["event_id"])


@register("latest_version", with_views(
    "SELECT event_type, ts, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM v_dup GROUP BY ALL", "v_dup"), ["value"])
def q_latest_version(spark, sf):
    """Current version of a re-published hour: the highest version number wins."""
    return latest_version(V.v_dup(spark, sf), ["event_type", "ts"], "event_id").select(
        "event_type", "ts", "event_id", "value")


@register("vintage_select", with_views(
    """SELECT ts, chosen[1] AS v_selected, CAST(chosen[2] AS BIGINT) AS n_selected FROM (
  SELECT ts, [[v_day1, n_day1], [v_day2, n_day2]][1 + (hour(ts) // 10 > 0)::INTEGER] AS chosen FROM v_twovintage)
WHERE chosen[1] + chosen[2] IS NOT NULL""", "v_twovintage"), ["v_selected"])
def q_vintage_select(spark, sf):
    return select_vintage(V.v_twovintage(spark, sf), "ts",
                          {"v_selected": ("v_day1", "v_day2"), "n_selected": ("n_day1", "n_day2")}, 10)


_piv = ", ".join(f"{share_sql('event_type', 'share', t)} AS {t}_share" for t in ["click", "error", "purchase", "signup", "view"])


@register("category_pivot", with_views(f"SELECT ts, {_piv} FROM v_share GROUP BY ts", "v_share"),
          [f"{t}_share" for t in V.EVENT_TYPES])
def q_category_pivot(spark, sf):
    return pivot_share(V.v_share(spark, sf), ["ts"], "event_type", "share", V.EVENT_TYPES,
                       {t: f"{t}_share" for t in V.EVENT_TYPES})


# ---------------------------------------------------------------- joins and fills
_TYPES = ["click", "error", "purchase", "signup", "view"]
SOURCE_JOIN_SQL = (
    "SELECT a.ts, a.v, " + ", ".join(f"(SELECT v FROM v_hourly s WHERE s.ts = a.ts AND s.event_type = '{t}') AS {t}_v" for t in _TYPES)
    + ", (SELECT daily_value FROM v_daily d WHERE d.date = CAST(a.ts AS DATE)) AS daily_value FROM v_all a")
SOURCE_JOIN_VIEWS = ("v_all", "v_hourly", "v_daily")


def source_join(spark, sf):
    """The all-events hours with each event type's series (missing hours are NULL) and the daily series."""
    h = V.v_hourly(spark, sf)
    sides = [(h.filter(F.col("event_type") == t).select("ts", F.col("v").alias(f"{t}_v")), "ts") for t in V.EVENT_TYPES]
    return join_sources(V.v_all(spark, sf), [*sides, (V.v_daily(spark, sf), (F.to_date("ts"), "date"))])


@register("source_join", with_views(SOURCE_JOIN_SQL, *SOURCE_JOIN_VIEWS), ["v", *[f"{t}_v" for t in _TYPES], "daily_value"])
def q_source_join(spark, sf):
    return source_join(spark, sf)


@register("fill_from_daily", with_views(
    """SELECT a.ts, a.v, d.daily_value FROM v_all a
ASOF LEFT JOIN (SELECT * FROM v_daily WHERE daily_value IS NOT NULL AND date IN (SELECT CAST(ts AS DATE) FROM v_all)) d ON CAST(a.ts AS DATE) >= d.date""",
    "v_all", "v_daily"), ["v", "daily_value"])
def q_fill_from_daily(spark, sf):
    return fill_from_daily(V.v_all(spark, sf), "ts", V.v_daily(spark, sf), "date", ["daily_value"])


@register("forward_fill", with_views(
    """SELECT h.event_type, h.ts, h.v, h.n, full_.v AS v_sparse FROM v_hourly h
ASOF LEFT JOIN (SELECT * FROM v_hourly WHERE n > 2 AND v IS NOT NULL) full_ ON h.event_type = full_.event_type AND h.ts >= full_.ts""", "v_hourly"), ["v", "v_sparse"])
def q_forward_fill(spark, sf):
    h = V.v_hourly(spark, sf).withColumn("v_sparse", F.when(F.col("n") > 2, F.col("v")))
    return forward_fill(h, "ts", ["v_sparse"], ["event_type"])


@register("forward_fill_wide", with_views(
    """SELECT t.ts, one.v_day1, t.n_day1, two.v_day2, t.n_day2 FROM v_twovintage t
ASOF LEFT JOIN (SELECT * FROM v_twovintage WHERE v_day1 IS NOT NULL) one ON t.ts >= one.ts
ASOF LEFT JOIN (SELECT * FROM v_twovintage WHERE v_day2 IS NOT NULL) two ON t.ts >= two.ts""", "v_twovintage"), ["v_day1", "v_day2"], dbl=["n_day1", "n_day2"])
def q_forward_fill_wide(spark, sf):
    """Unkeyed fill across day boundaries (the two-level scan's carry path)."""
    return forward_fill(V.v_twovintage(spark, sf), "ts", ["v_day1", "v_day2"])


# ---------------------------------------------------------------- holidays
_OD_YEARS = {"yrs": "SELECT DISTINCT year(date) AS year FROM v_orders_daily"}


@register("holiday_dim", with_views("SELECT holiday_date, holiday_name FROM hol", "v_orders_daily",
                                    extra={**_OD_YEARS, "hol": holiday_sql("yrs")}), dates=["holiday_date"])
def q_holiday_dim(spark, sf):
    """Holiday dates for every year the daily orders series covers."""
    od = V.v_orders_daily(spark, sf)
    return holiday_dim(od.select(F.year("date").alias("year")).distinct())


@register("holiday_flag", with_views(
    """SELECT o.date, o.y, CASE WHEN o.date IN (SELECT holiday_date FROM hol) THEN 1 ELSE 0 END AS is_holiday
FROM v_orders_daily o""", "v_orders_daily", extra={**_OD_YEARS, "hol": holiday_sql("yrs")}), {"y": 2},
          dates=["date"])
def q_holiday_flag(spark, sf):
    od = V.v_orders_daily(spark, sf).select("date", "y", "ts")
    return holiday_flag(od, "ts", holidays_for(od, "ts")).select("date", "y", "is_holiday")


# ---------------------------------------------------------------- unify feeds
@register("unify_feeds", """SELECT date_trunc('hour', ts) AS datetime_ept, 'DOM' AS area,
  value * (1 + (event_type IN ('signup', 'view'))::INTEGER) AS price, event_id AS record_id,
  CASE WHEN event_type IN ('signup', 'view') THEN 'da_feed' ELSE 'rt_feed' END AS source FROM events""", ["price"])
def q_unify_feeds(spark, sf):
    """Two feeds with different field names and area codes mapped onto one schema."""
    from daycast.functions.time import hour_floor
    from daycast.operators.unify import unify_feeds
    e = V.events(spark, sf)
    second = F.col("event_type").isin("signup", "view")
    a = e.filter(~second).select(
        F.col("ts").alias("datetime_beginning_ept"), F.lit("DOM").alias("zone"), F.col("value").alias("lmp"),
        F.col("event_id").alias("id"))
    b = e.filter(second).select(
        F.col("ts").alias("interval_start"), F.lit("DOMINION").alias("area_code"),
        (F.col("value") * 2).alias("price_usd"), F.col("event_id").alias("row_id"))
    return unify_feeds([
        (a, {"datetime_ept": hour_floor("datetime_beginning_ept"), "area": "zone", "price": "lmp",
             "record_id": "id"}, "rt_feed"),
        (b, {"datetime_ept": hour_floor("interval_start"), "area": "area_code", "price": "price_usd",
             "record_id": "row_id"}, "da_feed"),
    ], code_col="area", code_map={"DOMINION": "DOM"})


@register("asof_fill", with_views("""SELECT h.event_type, h.ts, h.n, r.value AS reading, CAST(r.user_id AS DOUBLE) AS reader
FROM v_hourly h ASOF LEFT JOIN (
  SELECT event_type, ts, max((value, user_id)) AS last, max(value) AS value, arg_max(user_id, (value, user_id)) AS user_id
  FROM events WHERE event_id % 11 = 0 GROUP BY event_type, ts) r ON h.event_type = r.event_type AND h.ts >= r.ts""", "v_hourly"), ["reading"], dbl=["reader"])
def q_asof_fill(spark, sf):
    """Each series' hours with the latest of its irregular readings (every eleventh event)."""
    readings = V.events(spark, sf).filter("event_id % 11 = 0").select("event_type", F.col("ts").alias("read_at"), F.col("value").alias("reading"), F.col("user_id").alias("reader"))
    return asof_fill(V.v_hourly(spark, sf).select("event_type", "ts", "n"), "ts", readings, "read_at", ["reading", "reader"], ["event_type"])
