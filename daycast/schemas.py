"""Fixed names and schemas of the hourly price-forecasting data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source pipeline's names for results to line up)
# ---------------------------------------------------------------------------
# Lag offsets in days before the target hour, and the suffix each one carries in
# feature names. The suffix counts days before the prediction is made (the day
# before the target), so 2 / 4 / 8 days back are named _1 / _3 / _7.
LAG_SUFFIX = {2: "1", 4: "3", 8: "7"}
# Same-hour rolling window, days back (inclusive).
ROLL_DAYS = (2, 8)
# Forecasts must be issued by this hour on the day before the target day.
CUTOFF_DAYS_BEFORE = 1
CUTOFF_HOUR = 10
# Weather: the day-1 vintage is used before this hour, the day-2 vintage from it on.
VINTAGE_HOUR = 10
# Fuel categories of the generation-mix feed, in output order.
FUEL_TYPES = [
    "Coal", "Gas", "Hydro", "Multiple Fuels", "Nuclear",
    "Oil", "Other Renewables", "Solar", "Wind", "Storage",
]
PRICE_RT = ["total_lmp_rt", "system_energy_price_rt", "congestion_price_rt", "marginal_loss_price_rt"]
PRICE_DA = ["total_lmp_da", "system_energy_price_da", "congestion_price_da", "marginal_loss_price_da"]
WEATHER_VARS = ["temperature_2m", "wind_speed_10m", "cloud_cover"]
TARGET = "total_lmp_rt"
TS = "datetime_ept"
# ---------------------------------------------------------------------------


def fuel_column(fuel_type: str) -> str:
    return fuel_type.lower().replace(" ", "_") + "_percentage"


FUEL_COLUMNS = [fuel_column(f) for f in FUEL_TYPES]

# Raw feed schemas (strings where the feed delivers strings; casts happen in normalize).
PRICES_RAW = T.StructType(
    [T.StructField("datetime_beginning_ept", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in PRICE_RT + PRICE_DA]
)
LOAD_RAW = T.StructType([
    T.StructField("forecast_hour_beginning_ept", T.StringType()),
    T.StructField("evaluated_at_ept", T.StringType()),
    T.StructField("forecast_load_mw", T.DoubleType()),
])
WEATHER_RAW = T.StructType(
    [T.StructField("time", T.StringType())]
    + [T.StructField(f"{v}_previous_day{d}", T.DoubleType()) for d in (1, 2) for v in WEATHER_VARS]
)
GAS_RAW = T.StructType([T.StructField("period", T.StringType()), T.StructField("value", T.StringType())])
FUEL_RAW = T.StructType([
    T.StructField("datetime_beginning_ept", T.StringType()),
    T.StructField("fuel_type", T.StringType()),
    T.StructField("fuel_percentage_of_total", T.DoubleType()),
])
PREDICTIONS = T.StructType([
    T.StructField("datetime_ept", T.TimestampNTZType()),
    T.StructField("actual_rt", T.DoubleType()),
    T.StructField("prediction", T.DoubleType()),
])
