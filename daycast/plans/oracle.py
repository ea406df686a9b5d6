"""DuckDB SQL for the test views and shared CTEs, used as independent oracles.

Each text states a rule in another form than the Spark plan it checks: lags are look-ups
by row value, rolling statistics a lateral aggregate over the days a rule names, versions
an ``arg_max`` with a filter, fills an ASOF join, holidays day arithmetic. Names and
constants are restated here rather than imported from the code under test.
"""

from __future__ import annotations

VIEWS = {
    "v_hourly": "SELECT event_type, date_trunc('hour', ts) AS ts, sum(value) AS v, count(*) AS n "
                "FROM events GROUP BY 1, 2",
    "v_all": "SELECT date_trunc('hour', ts) AS ts, sum(value) AS v FROM events GROUP BY 1",
    "v_versioned": "SELECT event_type AS series, ts AS issued, "
                   "date_trunc('hour', ts) + to_days(CAST(event_id % 3 + 1 AS INTEGER)) AS target, "
                   "value AS fc, event_id FROM events",
    "v_twovintage": "SELECT date_trunc('hour', ts) AS ts, "
                    "sum(value) FILTER (event_type NOT IN ('signup', 'view')) AS v_day1, "
                    "nullif(count(*) FILTER (event_type NOT IN ('signup', 'view')), 0) AS n_day1, "
                    "sum(value) FILTER (event_type IN ('signup', 'view')) AS v_day2, "
                    "nullif(count(*) FILTER (event_type IN ('signup', 'view')), 0) AS n_day2 "
                    "FROM events GROUP BY 1",
    "v_daily": "SELECT CAST(ts AS DATE) AS date, avg(value) AS daily_value FROM events "
               "WHERE dayofweek(ts) NOT IN (0, 6) GROUP BY 1",
    "v_share": "SELECT h.ts, h.event_type, h.v / t.tot - 0.05 AS share FROM v_hourly h "
               "JOIN (SELECT ts, sum(v) AS tot FROM v_hourly GROUP BY ts) t ON h.ts = t.ts",
    "v_dup": "SELECT event_type, date_trunc('hour', ts) AS ts, event_id, value FROM events",
    "v_orders_daily": "SELECT CAST(o_orderdate AS DATE) AS date, sum(o_totalprice) AS y, "
                      "CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS ts FROM orders GROUP BY 1, 3",
    "v_pred": "SELECT b.ts AS datetime_ept, b.v AS actual_rt, p.v AS prediction, "
              "(SELECT avg(d.v) FROM v_all d WHERE d.ts IN (b.ts - INTERVAL 2 DAY, b.ts - INTERVAL 3 DAY, "
              "b.ts - INTERVAL 4 DAY, b.ts - INTERVAL 5 DAY, b.ts - INTERVAL 6 DAY, b.ts - INTERVAL 7 DAY, "
              "b.ts - INTERVAL 8 DAY)) AS benchmark "
              "FROM v_all b JOIN v_all p ON p.ts = b.ts - INTERVAL 2 DAY",
    "v_bench_dup": "SELECT date_trunc('hour', ts) AS datetime_ept, value * 2 AS da_pred FROM events",
}

# Views that other views read (emitted first).
_DEPS = {"v_share": ["v_hourly"], "v_pred": ["v_all"]}


def with_views(sql: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with a WITH clause defining the named views (and extra CTEs,
    emitted after the views, in the given order)."""
    order: list[str] = []

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = [f"{n} AS ({VIEWS[n]})" for n in order]
    for k, v in (extra or {}).items():
        ctes.append(f"{k} AS ({v})")
    return ("WITH " + ",\n".join(ctes) + "\n" + sql) if ctes else sql


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# Fixed values, restated: US federal holidays. Dates (month, day, first year) with the
# neighbouring weekday they are also observed on, and weekdays by their place in the month.
_DATES = """(VALUES (1, 1, 0, 'New Year''s Day'), (6, 19, 2021, 'Juneteenth National Independence Day'),
  (7, 4, 0, 'Independence Day'), (11, 11, 0, 'Veterans Day'), (12, 25, 0, 'Christmas Day')) fixed(mon, dom, since, holiday)"""
_PLACES = """(VALUES (1, 1, 15, 21, 'Martin Luther King Jr. Day'), (2, 1, 15, 21, 'Washington''s Birthday'), (5, 1, 25, 31, 'Memorial Day'),
  (9, 1, 1, 7, 'Labor Day'), (10, 1, 8, 14, 'Columbus Day'), (11, 4, 22, 28, 'Thanksgiving')) placed(mon, dow, lo, hi, holiday)"""


def holiday_sql(years_relation: str) -> str:
    """SELECT holiday_date, holiday_name for the years in ``years_relation`` (column
    ``year``): every calendar day of those years is held against the rules."""
    days = (f"(SELECT CAST(unnest(generate_series(make_date(CAST(year AS INTEGER), 1, 1), make_date(CAST(year AS INTEGER), 12, 31), "
            f"INTERVAL 1 DAY)) AS DATE) AS day FROM {years_relation})")
    return f"""SELECT day AS holiday_date, holiday AS holiday_name FROM {days}, {_PLACES}
WHERE month(day) = mon AND dayofweek(day) = dow AND dayofmonth(day) BETWEEN lo AND hi
UNION ALL SELECT day, CASE WHEN moved = 0 THEN holiday ELSE holiday || ' (observed)' END FROM {days}, {_DATES}, (VALUES (0), (1), (-1)) m(moved)
WHERE month(day + moved) = mon AND dayofmonth(day + moved) = dom AND year(day + moved) >= since
  AND (moved = 0 OR (moved = 1 AND dayofweek(day) = 5) OR (moved = -1 AND dayofweek(day) = 1))"""


def back(base: str, ts: str, days: int | str, value: str, *keys: str, of: str = "b") -> str:
    """Scalar look-up: ``value`` (over the alias ``past``) at the same time so many days before ``of``."""
    same = "".join(f" AND past.{k} = {of}.{k}" for k in keys)
    return f"(SELECT {value} FROM {base} past WHERE past.{ts} = {of}.{ts} - to_days({days}){same})"


def lag_list(base: str, ts: str, cols: list[str], offsets: list[int], *keys: str) -> str:
    return ", ".join(f"{back(base, ts, o, 'past.' + c, *keys)} AS {c}_lag{o}" for c in cols for o in offsets)


def rolling_lateral(base: str, ts: str, col: str, *keys: str, first: int = 2, last: int = 8, names=("rolling_mean", "rolling_stddev")) -> str:
    """LATERAL join that gives mean and deviation over the days ``first`` to ``last`` before ``b``, at the same time of day."""
    same = "".join(f" AND past.{k} = b.{k}" for k in keys)
    return (f"LEFT JOIN LATERAL (SELECT avg(past.{col}) AS {names[0]}, stddev_samp(past.{col}) AS {names[1]} FROM {base} past "
            f"WHERE past.{ts}::TIME = b.{ts}::TIME AND date_diff('day', past.{ts}::DATE, b.{ts}::DATE) BETWEEN {first} AND {last}{same}) roll ON true")


# Fixed values, restated: the training table's columns.
_RT = ["total_lmp_rt", "system_energy_price_rt", "congestion_price_rt", "marginal_loss_price_rt"]
_DA = ["total_lmp_da", "system_energy_price_da", "congestion_price_da", "marginal_loss_price_da"]
_WEATHER = ["temperature_2m", "wind_speed_10m", "cloud_cover"]
_FUELS = {"Coal": "coal", "Gas": "gas", "Hydro": "hydro", "Multiple Fuels": "multiple_fuels", "Nuclear": "nuclear", "Oil": "oil",
          "Other Renewables": "other_renewables", "Solar": "solar", "Wind": "wind", "Storage": "storage"}
_LAGGED = {"lmp_rt": "total_lmp_rt", "system_energy_price_rt": "system_energy_price_rt", "congestion_price_rt": "congestion_price_rt",
           "da_rt_lmp_difference": "total_lmp_da - total_lmp_rt", "da_rt_congestion_difference": "congestion_price_da - congestion_price_rt",
           "marginal_loss_price_rt": "marginal_loss_price_rt", "lmp_da": "total_lmp_da", "system_energy_price_da": "system_energy_price_da",
           "congestion_price_da": "congestion_price_da", "marginal_loss_price_da": "marginal_loss_price_da", "gas_price": "gas_price",
           **{f"{f}_percentage": f"{f}_percentage" for f in _FUELS.values()}}
_LAG_DAYS = {"1": 2, "3": 4, "7": 8}


def share_sql(category: str, share: str, value: str) -> str:
    """The largest share of a category in its group, 0 where it has none, and never below 0
    while the group holds other categories."""
    mine = f"max({share}) FILTER ({category} = '{value}')"
    others = f"count(*) FILTER ({category} IS DISTINCT FROM '{value}')"
    return f"CASE WHEN {mine} IS NULL THEN 0 WHEN {others} > 0 AND {mine} < 0 THEN 0 ELSE {mine} END"


def training_sql(prices: str, load: str, weather: str, gas: str, fuel: str) -> str:
    """The training table from the five feeds, as rules over whole rows."""
    prices_cols = ", ".join(_RT + _DA)
    weather_cols = [f"{v}_selected" for v in _WEATHER]
    choose = ", ".join(f"(CASE WHEN early THEN {v}_previous_day1 ELSE {v}_previous_day2 END) AS {v}_selected" for v in _WEATHER)
    shares = ", ".join(f"{share_sql('fuel_type', 'fuel_percentage_of_total', k)} AS {v}_percentage" for k, v in _FUELS.items())
    fuels = [f"{v}_percentage" for v in _FUELS.values()]
    lagged = ", ".join(f"back{s}.x{i} AS lagged_{stem}_{s}" for i, stem in enumerate(_LAGGED) for s in _LAG_DAYS)
    values = ", ".join(f"x{i} := {e}" for i, e in enumerate(_LAGGED.values()))
    looked_up = ", ".join(f"{back('kept', 'hr', d, 'past.pack')} AS back{s}" for s, d in _LAG_DAYS.items())
    wanted = ["temperature_2m_selected", "wind_speed_10m_selected", "cloud_cover_selected", "forecast_load_mw"]
    every = ", ".join(f"lagged_{stem}_{s}" for stem in _LAGGED for s in _LAG_DAYS)
    return f"""
WITH hours AS (SELECT datetime_beginning_ept::TIMESTAMP AS hr, * EXCLUDE (datetime_beginning_ept) FROM {prices}),
loads AS (
  SELECT forecast_hour_beginning_ept::TIMESTAMP AS hr,
    arg_max(forecast_load_mw, (evaluated_at_ept::TIMESTAMP, forecast_load_mw))
      FILTER (evaluated_at_ept::TIMESTAMP <= forecast_hour_beginning_ept::TIMESTAMP::DATE - INTERVAL 14 HOUR) AS forecast_load_mw
  FROM {load} GROUP BY ALL),
skies AS (
  SELECT hr, {', '.join(weather_cols)} FROM (SELECT hr, {choose} FROM (SELECT time::TIMESTAMP AS hr, hour(time::TIMESTAMP) <= 9 AS early, * FROM {weather}))
  WHERE {' + '.join(weather_cols)} IS NOT NULL),
mixes AS (SELECT datetime_beginning_ept::TIMESTAMP AS hr, {shares} FROM {fuel} GROUP BY ALL),
burnt AS (SELECT period::DATE AS day, value::DOUBLE AS gas_price FROM {gas} WHERE period::DATE IN (SELECT hr::DATE FROM hours) AND value IS NOT NULL),
rows AS (
  SELECT h.*, forecast_load_mw, {', '.join(weather_cols)}, gas_price, {', '.join(fuels)},
    row_number() OVER (PARTITION BY h.hr ORDER BY {prices_cols}) AS copy
  FROM hours h ASOF LEFT JOIN burnt ON h.hr::DATE >= burnt.day
  JOIN loads ON loads.hr = h.hr AND forecast_load_mw IS NOT NULL JOIN skies ON skies.hr = h.hr JOIN mixes ON mixes.hr = h.hr),
kept AS (SELECT *, struct_pack({values}) AS pack FROM rows WHERE copy = 1),
yrs AS (SELECT DISTINCT year(hr) AS year FROM kept),
hol AS ({holiday_sql("yrs")}),
looked AS (SELECT b.*, {looked_up}, roll.* FROM kept b {rolling_lateral('kept', 'hr', 'total_lmp_rt', names=('rolling_rt_mean', 'rolling_rt_stddev'))}),
flat AS (
  SELECT hr AS datetime_ept, month(hr)::INTEGER AS month, dayofweek(hr)::INTEGER AS day_of_week, hour(hr)::INTEGER AS hour_of_day,
    (dayofweek(hr) % 6 = 0)::INTEGER AS is_weekend, (hr::DATE IN (SELECT holiday_date FROM hol))::INTEGER AS is_holiday,
    {', '.join(wanted)}, {lagged}, rolling_rt_mean, rolling_rt_stddev, total_lmp_rt FROM looked)
SELECT * FROM flat WHERE len([x FOR x IN [{', '.join(wanted)}, {every}, rolling_rt_mean, rolling_rt_stddev, total_lmp_rt]::DOUBLE[] IF x IS NULL]) = 0"""
