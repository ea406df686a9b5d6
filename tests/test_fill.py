"""Forward fill (two-level scan) and the daily-to-hourly fill (T10, T14)."""

import random

import pandas as pd
from pyspark.sql import functions as F

from daycast.operators.fill import fill_from_daily, forward_fill
from tests.conftest import d, ts


def test_forward_fill_matches_pandas_ffill_across_days(spark):
    rnd = random.Random(3)
    rows = []
    for k in ["a", "b"]:
        for day in range(1, 11):
            for h in range(0, 24, 3):
                v = round(rnd.uniform(0, 10), 2) if rnd.random() < 0.25 else None
                rows.append((k, f"2024-04-{day:02d} {h:02d}:00:00", v))
    pdf = pd.DataFrame(rows, columns=["k", "t", "v"])
    want = pdf.sort_values(["k", "t"]).groupby("k")["v"].ffill()
    want = dict(zip(zip(pdf.loc[want.index, "k"], pdf.loc[want.index, "t"]), want))
    df = spark.createDataFrame(rows, "k string, t string, v double").withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = {(r.k, r.t.strftime("%Y-%m-%d %H:%M:%S")): r.v for r in forward_fill(df, "t", ["v"], ["k"]).collect()}
    for key, v in want.items():
        assert (got[key] is None and pd.isna(v)) or got[key] == v, key


def test_unkeyed_fill_does_not_route_base_rows_through_one_partition(spark):
    df = spark.range(200).select((F.lit("2024-01-01").cast("timestamp_ntz") +
                                  F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("t"),
                                 F.when(F.col("id") % 7 == 0, F.col("id").cast("double")).alias("v"))
    out = forward_fill(df, "t", ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the base rows are partitioned by day bucket; only the one-row-per-day carry is global
    assert "hashpartitioning(__bucket" in plan
    rows = {r.t: r.v for r in out.collect()}
    assert rows[ts("2024-01-01T06:00:00")] == 0.0
    assert rows[ts("2024-01-02T00:00:00")] == 21.0  # carried across the day boundary


def test_fill_from_daily_weekend_and_unseen_dates(spark):
    base = spark.createDataFrame([
        ("2024-01-05 10:00:00", 1.0),  # Friday
        ("2024-01-06 10:00:00", 2.0),  # Saturday: no gas -> Friday
        ("2024-01-08 10:00:00", 3.0),  # Monday: gas missing -> Friday (Sunday has a value but no base row)
        ("2024-01-09 10:00:00", 4.0),
    ], "t string, p double").withColumn("t", F.col("t").cast("timestamp_ntz"))
    gas = spark.createDataFrame([(d("2024-01-05"), 2.5), (d("2024-01-07"), 9.9), (d("2024-01-09"), 3.0)],
                                "date date, gas double")
    out = {r.t.day: r.gas for r in fill_from_daily(base, "t", gas, "date", ["gas"]).collect()}
    assert out == {5: 2.5, 6: 2.5, 8: 2.5, 9: 3.0}


def test_leading_null_stays_null(spark):
    base = spark.createDataFrame([("2024-01-01 00:00:00", 1.0), ("2024-01-02 00:00:00", 1.0)],
                                 "t string, p double").withColumn("t", F.col("t").cast("timestamp_ntz"))
    gas = spark.createDataFrame([(d("2024-01-02"), 2.0)], "date date, gas double")
    out = {r.t.day: r.gas for r in fill_from_daily(base, "t", gas, "date", ["gas"]).collect()}
    assert out == {1: None, 2: 2.0}


def test_forward_fill_reaches_rows_with_a_null_key(spark):
    df = spark.createDataFrame([(None, "2024-01-01 00:00:00", 1.0), (None, "2024-01-02 00:00:00", None), ("a", "2024-01-02 00:00:00", None)],
                               "k string, t string, v double").selectExpr("k", "cast(t as timestamp_ntz) AS t", "v")
    from daycast.operators.fill import forward_fill
    out = {(r.k, r.t.day): r.v for r in forward_fill(df, "t", ["v"], ["k"]).collect()}
    assert out == {(None, 1): 1.0, (None, 2): 1.0, ("a", 2): None}


def test_repeated_daily_dates_do_not_multiply_rows(spark):
    from daycast.operators.fill import fill_from_daily
    base = spark.sql("SELECT timestamp_ntz '2024-01-01 05:00:00' + make_dt_interval(cast(id as int)) AS t FROM range(3)")
    daily = spark.sql("SELECT date '2024-01-01' AS d, cast(id as double) AS x FROM range(2)")
    assert [r.x for r in fill_from_daily(base, "t", daily, "d", ["x"]).collect()] == [1.0, 1.0, 1.0]


def test_attached_columns_do_not_multiply_rows(spark):
    from daycast.operators.joins import attach_columns
    left = spark.range(3).withColumnRenamed("id", "k")
    right = spark.sql("SELECT * FROM VALUES (0L, 5), (0L, 3), (1L, 7) AS r(k, v)")
    assert sorted((r.k, r.v) for r in attach_columns(left, right, "k", ["v"]).collect()) == [(0, 3), (1, 7), (2, None)]
