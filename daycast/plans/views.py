"""Views over the shared test tables that carry the shapes of the forecasting feeds.

Each view is a plain Spark plan over the parquet tables, so everything built on top
of it scales with the tables: ``events`` stands for hourly sources with a series key,
``orders`` for a long daily series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.functions.time import hour_floor, to_ntz
from daycast.operators.lags import lag_exprs, rolling_exprs
from daycast.sources.io import read_table

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", to_ntz("ts"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("o_orderdate", to_ntz("o_orderdate"))


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("l_shipdate", to_ntz("l_shipdate"))


def v_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_type, ts hour, v = sum(value), n = count): hourly series with a key."""
    e = events(spark, sf_dir)
    return e.groupBy("event_type", hour_floor("ts").alias("ts")).agg(
        F.sum("value").alias("v"), F.count(F.lit(1)).alias("n"))


def v_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ts hour, v): one series over all events."""
    e = events(spark, sf_dir)
    return e.groupBy(hour_floor("ts").alias("ts")).agg(F.sum("value").alias("v"))


def v_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast versions: series, issued, target = issue hour + 1..3 days, fc."""
    e = events(spark, sf_dir)
    days = (F.col("event_id") % 3 + 1).cast("int")
    return e.select(
        F.col("event_type").alias("series"), F.col("ts").alias("issued"),
        F.timestamp_add("DAY", days, hour_floor("ts")).alias("target"),
        F.col("value").alias("fc"), "event_id")


def v_twovintage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour rows with two vintages side by side, each of some of the event types (NULL in an
    hour without them)."""
    e = events(spark, sf_dir)

    def part(kinds, what):
        hit = F.col("event_type").isin(kinds)
        return F.sum(F.when(hit, F.col("value") if what == "v" else F.lit(1)))

    one, two = ["click", "error", "purchase"], ["signup", "view"]
    return e.groupBy(hour_floor("ts").alias("ts")).agg(
        part(one, "v").alias("v_day1"), part(one, "n").cast("long").alias("n_day1"),
        part(two, "v").alias("v_day2"), part(two, "n").cast("long").alias("n_day2"))


def v_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse daily series, as markets have it: weekdays only, (date, daily_value)."""
    e = events(spark, sf_dir)
    d = F.to_date("ts")
    return (e.filter(~F.dayofweek(d).isin(1, 7))
            .groupBy(d.alias("date")).agg(F.avg("value").alias("daily_value")))


def v_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category shares per hour minus 0.05 (so some are negative)."""
    from pyspark.sql import Window
    h = v_hourly(spark, sf_dir)
    tot = F.sum("v").over(Window.partitionBy("ts"))
    return h.select("ts", "event_type", (F.try_divide(F.col("v"), tot) - 0.05).alias("share"))


def v_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events keyed by their hour, not aggregated: duplicate hours per series."""
    e = events(spark, sf_dir)
    return e.select("event_type", hour_floor("ts").alias("ts"), "event_id", "value")


def v_orders_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long daily series: (ts as midnight NTZ, date, y = sum(o_totalprice))."""
    o = orders(spark, sf_dir)
    d = F.to_date("o_orderdate")
    return o.groupBy(d.alias("date")).agg(F.sum("o_totalprice").alias("y")).withColumn(
        "ts", F.col("date").cast("timestamp_ntz"))


def v_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions over the all-events series: actual = v, prediction = the same hour
    2 days back, benchmark = mean of the same hour over days 2..8 back. Rows without a
    prediction are dropped (a model predicts every validation hour); the benchmark may
    be missing."""
    a = v_all(spark, sf_dir)
    out = a.select("ts", "v", *lag_exprs("ts", ["v"], [2], name=lambda c, o: "prediction"),
                   *rolling_exprs("ts", "v", 2, 8, mean_name="benchmark", std_name="__std"))
    return out.filter(F.col("prediction").isNotNull()).select(
        F.col("ts").alias("datetime_ept"), F.col("v").alias("actual_rt"), "prediction", "benchmark")


def v_bench_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A benchmark with repeated hours: every event is a (datetime_ept, da_pred) row."""
    e = events(spark, sf_dir)
    return e.select(hour_floor("ts").alias("datetime_ept"), (F.col("value") * 2).alias("da_pred"))

