"""Feature tables: a generic leakage-safe hourly feature table, and the full five-feed
pipeline (prices, load forecasts, weather, gas, fuel mix) to the training table.

Calendar, lag and rolling features are columns of one plan: they share one window
Exchange on (series, time of day), so the re-assembly joins of a table-per-stage
pipeline never exist.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast import schemas as S
from daycast.functions.time import to_ntz
from daycast.operators.calendar import holiday_expr
from daycast.operators.dedupe import dedupe_hours, latest_before_cutoff
from daycast.operators.fill import fill_from_daily
from daycast.operators.filters import complete_rows, require_not_null
from daycast.operators.joins import join_sources
from daycast.operators.lags import default_lag_name, packed_lags, q, time_of_day_sql, window_sql
from daycast.operators.normalize import normalize, pivot_share, select_vintage


def feature_table(df: DataFrame, ts: str, target: str, lag_cols: Mapping[str, object] | Sequence[str],
                  series_keys: Sequence[str] = (), offsets: Sequence[int] = (2, 4, 8),
                  roll: tuple[int, int] | None = (2, 8), roll_col: str | None = None,
                  lag_name=None, roll_names=("rolling_mean", "rolling_stddev"),
                  holidays: bool = True, complete: bool = True, front: Sequence[str] = (),
                  dedupe: bool = False) -> DataFrame:
    """Calendar + holiday + exact lags + same-hour rolling stats + target, one row per
    (series, ts). ``lag_cols`` maps an output stem to a column name or to a pair
    (a, b) meaning the lagged difference a - b. With ``complete`` only rows without
    NULLs (keys aside) are kept. Needs unique (series, ts), or ``dedupe=True``: rows
    are then hash-partitioned once by (series, time of day), the repeated hour is
    dropped by ``row_number`` over (series, time of day, day) with a total tie-break
    (smallest row wins, as ``dedupe_hours``), and the lag window runs in the same stage
    on the same partitioning: one shuffle for de-duplication and all features. Meant
    for feeds whose copies per hour are few (a clock change gives two)."""
    stems = dict(lag_cols) if isinstance(lag_cols, Mapping) else {c: c for c in lag_cols}
    lag_name = lag_name or default_lag_name
    if dedupe:
        t = q(ts)
        tod = time_of_day_sql(ts)
        others = [c for c in df.columns if c not in (*series_keys, ts)]
        order = ", ".join(f"{q(c)} ASC NULLS FIRST" for c in others)
        part = ", ".join([*map(q, series_keys), tod, f"unix_date(to_date({t}))"])
        df = (df.repartition(*[F.col(k) for k in series_keys], F.expr(tod))
              .withColumn("__rn", F.expr(f"row_number() OVER (PARTITION BY {part} ORDER BY {order})"))
              .filter(F.col("__rn") == 1).drop("__rn"))
    c = F.col(ts)
    dow = F.dayofweek(c)
    cal = [
        F.month(c).cast("int").alias("month"),
        (dow - 1).cast("int").alias("day_of_week"),
        F.hour(c).cast("int").alias("hour_of_day"),
        F.when(dow.isin(1, 7), 1).otherwise(0).cast("int").alias("is_weekend"),
    ]
    if holidays:
        cal.append(holiday_expr(f"to_date({q(ts)})").alias("is_holiday"))
    exprs = [f"{q(src[0])} - {q(src[1])}" if isinstance(src, tuple) else q(src) for src in stems.values()]
    rolls = []
    if roll is not None:
        w = window_sql(ts, series_keys, roll[1], roll[0])
        rc = q(roll_col or target)
        rolls = [F.expr(f"avg({rc}) {w}").alias(roll_names[0]), F.expr(f"stddev_samp({rc}) {w}").alias(roll_names[1])]
    packed, lag = packed_lags(df, ts, exprs, offsets, series_keys, extra=rolls, unique=dedupe)
    lags = [lag(i, off).alias(lag_name(stem, off)) for i, stem in enumerate(stems) for off in offsets]
    out = packed.select(*series_keys, ts, *cal, *[F.col(f) for f in front], *lags, *(roll_names if rolls else ()), F.col(target))
    if complete:
        out = complete_rows(out, exclude=[*series_keys, ts])
    return out


# ---------------------------------------------------------------------------
# Lag feature stems of the training table, in column order. A pair means
# the lagged difference (first - second).
REFERENCE_LAG_STEMS = {
    "lmp_rt": "total_lmp_rt",
    "system_energy_price_rt": "system_energy_price_rt",
    "congestion_price_rt": "congestion_price_rt",
    "da_rt_lmp_difference": ("total_lmp_da", "total_lmp_rt"),
    "da_rt_congestion_difference": ("congestion_price_da", "congestion_price_rt"),
    "marginal_loss_price_rt": "marginal_loss_price_rt",
    "lmp_da": "total_lmp_da",
    "system_energy_price_da": "system_energy_price_da",
    "congestion_price_da": "congestion_price_da",
    "marginal_loss_price_da": "marginal_loss_price_da",
    "gas_price": "gas_price",
    **{c: c for c in S.FUEL_COLUMNS},
}
# ---------------------------------------------------------------------------


def reference_lag_name(stem: str, offset: int) -> str:
    return f"lagged_{stem}_{S.LAG_SUFFIX[offset]}"


def clean_prices(prices: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    return normalize(prices, {**{k: k for k in series_keys}, S.TS: to_ntz("datetime_beginning_ept"),
                              **{c: c for c in S.PRICE_RT + S.PRICE_DA}})


def clean_load(load: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """Latest load forecast per target hour issued by 10:00 the day before."""
    versions = normalize(load, {
        **{k: k for k in series_keys},
        S.TS: to_ntz("forecast_hour_beginning_ept"),
        "evaluated_at": to_ntz("evaluated_at_ept"),
        "forecast_load_mw": "forecast_load_mw",
    })
    latest = latest_before_cutoff(versions, S.TS, "evaluated_at", series_keys,
                                  days_before=S.CUTOFF_DAYS_BEFORE, hour=S.CUTOFF_HOUR)
    return latest.select(*series_keys, S.TS, "forecast_load_mw")


def clean_weather(weather: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    w = weather.withColumn(S.TS, to_ntz("time"))
    pairs = {f"{v}_selected": (f"{v}_previous_day1", f"{v}_previous_day2") for v in S.WEATHER_VARS}
    return select_vintage(w, S.TS, pairs, cutoff_hour=S.VINTAGE_HOUR, require=True, keep=series_keys)


def clean_gas(gas: DataFrame) -> DataFrame:
    return normalize(gas, {"gas_date": ("period", "date"), "gas_price": ("value", "double")})


def clean_fuel(fuel: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    f = fuel.withColumn(S.TS, to_ntz("datetime_beginning_ept"))
    names = {t: S.fuel_column(t) for t in S.FUEL_TYPES}
    return pivot_share(f, [*series_keys, S.TS], "fuel_type", "fuel_percentage_of_total", S.FUEL_TYPES, names)


def joined_filled(prices: DataFrame, load: DataFrame, weather: DataFrame, gas: DataFrame, fuel: DataFrame,
                  series_keys: Sequence[str] = (), dedupe: bool = True) -> DataFrame:
    """Normalise the five feeds, left-join them onto the price hours, forward-fill the
    daily gas price over price rows, drop rows missing load, weather or fuel, and
    keep one row per hour (fill before the filter, de-duplication after it)."""
    keys = [*series_keys, S.TS]
    base = clean_prices(prices, series_keys)
    joined = join_sources(base, [
        (clean_load(load, series_keys), keys),
        (clean_weather(weather, series_keys), keys),
        (clean_fuel(fuel, series_keys), keys),
    ])
    gas_c = clean_gas(gas)
    # left joins keep every price row, so the price rows carry the same dates as ``joined``
    joined = fill_from_daily(joined, S.TS, gas_c.withColumnRenamed("gas_date", "date"), "date", ["gas_price"],
                             dates_from=base)
    order = [*series_keys, S.TS, *S.PRICE_RT, *S.PRICE_DA, "forecast_load_mw",
             *[f"{v}_selected" for v in S.WEATHER_VARS], "gas_price", *S.FUEL_COLUMNS]
    joined = joined.select(*order)
    kept = require_not_null(joined, ["forecast_load_mw", "temperature_2m_selected", "coal_percentage"])
    return dedupe_hours(kept, S.TS, series_keys).select(*order) if dedupe else kept


def training_table(prices: DataFrame, load: DataFrame, weather: DataFrame, gas: DataFrame, fuel: DataFrame,
                   series_keys: Sequence[str] = ()) -> DataFrame:
    """The 76-column training table (plus series keys): key, calendar (5), weather (3),
    load, 63 lags, rolling mean and std of the target over days 2..8, target; complete
    rows only."""
    # de-duplication happens inside the feature window's partitioning (one shuffle)
    j = joined_filled(prices, load, weather, gas, fuel, series_keys, dedupe=False)
    front = [f"{v}_selected" for v in S.WEATHER_VARS] + ["forecast_load_mw"]
    return feature_table(
        j, S.TS, S.TARGET, REFERENCE_LAG_STEMS, series_keys=series_keys, offsets=tuple(S.LAG_SUFFIX),
        roll=S.ROLL_DAYS, lag_name=reference_lag_name, roll_names=("rolling_rt_mean", "rolling_rt_stddev"),
        holidays=True, complete=True, front=front, dedupe=True)
