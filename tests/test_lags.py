"""Exact lags and same-hour rolling statistics: gaps, equivalence with the self-join
form, and the physical plan (one exchange, no single partition)."""

import datetime as dt
import random
import statistics

import pytest

from pyspark.sql import functions as F

from daycast.operators.lags import exact_lags, offset_rows, seasonal_rolling
from tests.conftest import ts


def _series(spark, rows):
    return spark.createDataFrame(rows, "k string, t string, v double").withColumn(
        "t", F.col("t").cast("timestamp_ntz"))


def test_missing_day_gives_null_not_previous_row(spark):
    rows = [("a", "2024-01-01 15:00:00", 1.0), ("a", "2024-01-02 15:00:00", 2.0),
            # 2024-01-03 missing
            ("a", "2024-01-04 15:00:00", 4.0), ("a", "2024-01-05 15:00:00", 5.0)]
    out = {r.t: r for r in exact_lags(_series(spark, rows), "t", ["v"], [2], ["k"]).collect()}
    assert out[ts("2024-01-05T15:00:00")].v_lag2 is None  # the 3rd is missing
    assert out[ts("2024-01-04T15:00:00")].v_lag2 == 2.0
    assert out[ts("2024-01-02T15:00:00")].v_lag2 is None


def test_lag_across_spring_gap_uses_wall_clock(new_york):
    rows = [("a", "2024-03-08 02:00:00", 8.0), ("a", "2024-03-10 02:00:00", 10.0)]
    out = exact_lags(_series(new_york, rows), "t", ["v"], [2], ["k"]).orderBy("t").collect()
    assert out[1].v_lag2 == 8.0


def test_window_form_equals_self_join_form_on_random_gappy_series(spark):
    rnd = random.Random(7)
    rows = []
    for k in ["a", "b", "c"]:
        for day in range(1, 29):
            for h in range(24):
                if rnd.random() < 0.8:
                    rows.append((k, f"2024-02-{day:02d} {h:02d}:00:00", round(rnd.uniform(-50, 500), 2)))
    df = _series(spark, rows)
    got = {(r.k, r.t): (r.v_lag2, r.v_lag4, r.v_lag8) for r in exact_lags(df, "t", ["v"], [2, 4, 8], ["k"]).collect()}
    assert got == {key: tuple(past(rows, key, o) for o in (2, 4, 8)) for key in got} and len(got) == len(rows)


def test_rolling_mean_std_over_existing_days_only(spark):
    rows = [("a", "2024-01-01 10:00:00", 10.0), ("a", "2024-01-02 10:00:00", 20.0),
            ("a", "2024-01-09 10:00:00", 99.0), ("a", "2024-01-04 10:00:00", 7.0)]
    out = {r.t: r for r in seasonal_rolling(_series(spark, rows), "t", "v", 2, 8, ["k"]).collect()}
    r = out[ts("2024-01-09T10:00:00")]  # days 1..7 back from the 9th: 1st, 2nd, 4th? 1st is 8 back
    assert abs(r.rolling_mean - (10.0 + 20.0 + 7.0) / 3) < 1e-12
    r2 = out[ts("2024-01-04T10:00:00")]  # only the 2nd (2 back) and 1st (3 back)
    assert abs(r2.rolling_mean - 15.0) < 1e-12
    only_one = out[ts("2024-01-02T10:00:00")]  # nothing 2..8 days back
    assert only_one.rolling_mean is None and only_one.rolling_stddev is None


def test_std_of_single_value_is_null(spark):
    rows = [("a", "2024-01-01 10:00:00", 10.0), ("a", "2024-01-03 10:00:00", 20.0)]
    out = {r.t: r for r in seasonal_rolling(_series(spark, rows), "t", "v", 2, 8, ["k"]).collect()}
    r = out[ts("2024-01-03T10:00:00")]
    assert r.rolling_mean == 10.0 and r.rolling_stddev is None


def test_offset_rows_matches_union_of_joins(spark):
    rows = [("a", f"2024-01-{d:02d} 10:00:00", float(d)) for d in range(1, 15) if d != 6]
    df = _series(spark, rows)
    got = {(r.t, r.offset_days): r.past_value for r in offset_rows(df, "t", "v", 2, 8, ["k"]).collect()}
    want = {}
    vals = {r[1]: r[2] for r in rows}
    for t, v in vals.items():
        day = int(t[8:10])
        for k in range(2, 9):
            src = f"2024-01-{day - k:02d} 10:00:00"
            if day - k >= 1 and src in vals:
                want[(ts(t.replace(" ", "T")), k)] = vals[src]
    assert got == want


def test_lags_and_rolling_share_one_exchange_and_no_single_partition(spark):
    rows = [("a", f"2024-01-{d:02d} {h:02d}:00:00", float(d * h)) for d in range(1, 12) for h in range(24)]
    df = _series(spark, rows)
    from daycast.plans.features import feature_table
    out = feature_table(df, "t", "v", {"v": "v"}, series_keys=["k"], complete=False)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert plan.count("Exchange hashpartitioning") == 1, plan


def past(rows, key, days):
    """The value ``days`` before a (series, time) key, looked up."""
    at = (key[1] - dt.timedelta(days=days)).strftime("%Y-%m-%d %H:%M:%S")
    return next((v for k, t, v in rows if (k, t) == (key[0], at)), None)


def test_rolling_equals_looked_up_days(spark):
    rnd = random.Random(9)
    rows = [(k, f"2024-02-{day:02d} {h:02d}:00:00", round(rnd.uniform(-50, 500), 2))
            for k in ["a", "b"] for day in range(1, 25) for h in range(0, 24, 4) if rnd.random() < 0.7]
    for r in seasonal_rolling(_series(spark, rows), "t", "v", 2, 8, ["k"]).collect():
        found = [v for v in (past(rows, (r.k, r.t), o) for o in range(2, 9)) if v is not None]
        assert (r.rolling_mean is None) == (not found) and (r.rolling_stddev is None) == (len(found) < 2)
        assert not found or abs(r.rolling_mean - statistics.mean(found)) < 1e-9
        assert len(found) < 2 or abs(r.rolling_stddev - statistics.stdev(found)) < 1e-9


def test_stamps_within_a_second_stay_apart(spark):
    rows = [("a", "2024-01-01 05:00:00.1", 1.0), ("a", "2024-01-03 05:00:00.5", 3.0), ("a", "2024-01-03 05:00:00.1", 4.0)]
    out = {r.v: r.v_lag2 for r in exact_lags(_series(spark, rows), "t", ["v"], [2], ["k"]).collect()}
    assert out == {1.0: None, 3.0: None, 4.0: 1.0}
    rolled = {r.v: r.rolling_mean for r in seasonal_rolling(_series(spark, rows), "t", "v", 2, 8, ["k"]).collect()}
    assert rolled == {1.0: None, 3.0: None, 4.0: 1.0}


def test_repeated_stamps_are_refused(spark):
    rows = [("a", "2024-01-01 05:00:00", 1.0), ("a", "2024-01-01 05:00:00", 2.0), ("a", "2024-01-03 05:00:00", 3.0)]
    for out in (exact_lags(_series(spark, rows), "t", ["v"], [2], ["k"]), seasonal_rolling(_series(spark, rows), "t", "v", 2, 8, ["k"])):
        with pytest.raises(Exception, match="repeated t"):
            out.collect()


def test_feature_table_inline_dedupe_equals_dedupe_then_features(spark):
    from daycast.operators.dedupe import dedupe_hours
    from daycast.plans.features import feature_table
    rnd = random.Random(4)
    rows = [(k, f"2024-03-{day:02d} {h:02d}:00:00", round(rnd.uniform(0, 100), 2))
            for k in ["a", "b"] for day in range(1, 20) for h in range(0, 24, 6)]
    rows += [("a", "2024-03-12 06:00:00", 1.0), ("b", "2024-03-15 12:00:00", 999.0)]  # repeated hours
    df = _series(spark, rows)
    a = feature_table(df, "t", "v", {"v": "v"}, series_keys=["k"], complete=False, dedupe=True)
    b = feature_table(dedupe_hours(df, "t", ["k"]), "t", "v", {"v": "v"}, series_keys=["k"], complete=False)
    assert a.count() == b.count() == len(rows) - 2
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    p = a._jdf.queryExecution().executedPlan().toString()
    assert p.count("Exchange") == 1, p


def test_duplicate_keys_check(spark):
    from daycast.operators.filters import duplicate_keys
    rows = [("a", "2024-11-03 01:00:00", 1.0), ("a", "2024-11-03 01:00:00", 2.0), ("a", "2024-11-03 02:00:00", 3.0)]
    out = duplicate_keys(_series(spark, rows), ["k", "t"]).collect()
    assert len(out) == 1 and out[0].n == 2 and out[0].t == ts("2024-11-03T01:00:00")
