"""Hand-made feeds with every edge row the pipeline must handle: the spring gap, a
fall-back duplicate hour, forecasts issued at exactly 10:00 and at 10:01, weather
nulls at hours 9 and 10, negative storage shares (with company and alone), weekends
without gas, a leading missing gas day, a missing day inside a lag range, prices of
-41.84 and 2014."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd

from daycast import schemas as S


def _hours(start: str, days: int):
    t0 = dt.datetime.fromisoformat(start)
    for i in range(days * 24):
        yield t0 + dt.timedelta(hours=i)


def feeds(seed: int = 11) -> dict[str, pd.DataFrame]:
    rnd = random.Random(seed)
    stamps = [t for t in _hours("2024-03-01T00:00:00", 22)] + [t for t in _hours("2024-10-26T00:00:00", 14)]
    # spring gap: 2024-03-10 02:00 does not exist locally; a missing day inside lag ranges: 2024-03-15
    stamps = [t for t in stamps if t != dt.datetime(2024, 3, 10, 2) and t.date() != dt.date(2024, 3, 15)]
    # fall back: 2024-11-03 01:00 twice
    stamps.append(dt.datetime(2024, 11, 3, 1))
    fmt = "%Y-%m-%d %H:%M:%S"
    prices = []
    for i, t in enumerate(stamps):
        rt = round(rnd.uniform(10, 120), 2)
        if i == 100:
            rt = -41.84
        if i == 200:
            rt = 2014.0
        row = {"datetime_beginning_ept": t.strftime(fmt)}
        for c in S.PRICE_RT:
            row[c] = rt if c == "total_lmp_rt" else round(rnd.uniform(-5, 60), 2)
        for c in S.PRICE_DA:
            row[c] = round(rt + rnd.uniform(-10, 10), 2) if c == "total_lmp_da" else round(rnd.uniform(-5, 60), 2)
        prices.append(row)
    load = []
    for t in sorted(set(stamps)):
        day_before = dt.datetime.combine(t.date() - dt.timedelta(days=1), dt.time(0))
        for issued, mw in [(day_before + dt.timedelta(hours=8), 1.0), (day_before + dt.timedelta(hours=10), 2.0),
                           (day_before + dt.timedelta(hours=10, minutes=1), 3.0), (t, 4.0)]:
            load.append({"forecast_hour_beginning_ept": t.strftime(fmt), "evaluated_at_ept": issued.strftime(fmt),
                         "forecast_load_mw": 1000 * mw + t.hour})
    # one target hour whose forecasts were all issued late: it has no load row
    late = dt.datetime(2024, 3, 5, 7).strftime(fmt)
    load = [r for r in load if not (r["forecast_hour_beginning_ept"] == late and r["forecast_load_mw"] < 3000)]
    weather = []
    for t in sorted(set(stamps)):
        row = {"time": t.strftime(fmt)}
        for v in S.WEATHER_VARS:
            row[f"{v}_previous_day1"] = round(rnd.uniform(0, 30), 1)
            row[f"{v}_previous_day2"] = round(rnd.uniform(0, 30), 1)
        if t.date() == dt.date(2024, 3, 6) and t.hour == 9:
            row["temperature_2m_previous_day1"] = None   # hour 9 needs day1 -> dropped
        if t.date() == dt.date(2024, 3, 6) and t.hour == 10:
            row["temperature_2m_previous_day1"] = None   # hour 10 uses day2 -> kept
        if t.date() == dt.date(2024, 3, 7) and t.hour == 10:
            row["cloud_cover_previous_day2"] = None      # hour 10 needs day2 -> dropped
        weather.append(row)
    gas = []
    day = dt.date(2024, 2, 28)
    while day <= dt.date(2024, 11, 12):
        if day.weekday() < 5 and day != dt.date(2024, 3, 1):  # no weekends; the first day has no value
            gas.append({"period": day.isoformat(), "value": f"{rnd.uniform(1.5, 3.5):.3f}"})
        day += dt.timedelta(days=1)
    fuel = []
    for i, t in enumerate(sorted(set(stamps))):
        for k, f in enumerate(S.FUEL_TYPES):
            share = round(rnd.uniform(0, 0.4), 3)
            if f == "Storage":
                share = -0.01 if i % 5 == 0 else share
            if f == "Oil" and i % 7 == 0:
                continue  # a category missing in some hours -> 0
            fuel.append({"datetime_beginning_ept": t.strftime(fmt), "fuel_type": f,
                         "fuel_percentage_of_total": share})
    return {"prices": pd.DataFrame(prices), "load": pd.DataFrame(load), "weather": pd.DataFrame(weather),
            "gas": pd.DataFrame(gas), "fuel": pd.DataFrame(fuel)}


def to_spark(spark, frames: dict[str, pd.DataFrame]):
    schemas = {"prices": S.PRICES_RAW, "load": S.LOAD_RAW, "weather": S.WEATHER_RAW, "gas": S.GAS_RAW,
               "fuel": S.FUEL_RAW}
    out = {}
    for k, pdf in frames.items():
        cols = [f.name for f in schemas[k].fields]
        rows = [tuple(None if (isinstance(v, float) and pd.isna(v)) else v for v in r)
                for r in pdf[cols].itertuples(index=False, name=None)]
        out[k] = spark.createDataFrame(rows, schemas[k])
    return out
