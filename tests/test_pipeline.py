"""The five-feed pipeline to the training table, checked value by value against an
independent DuckDB formulation (one self-join per lag offset, UNION ALL for the
rolling window), plus the leakage property."""

import duckdb
import pandas as pd
import pytest

from daycast.plans.features import training_table
from daycast.plans.oracle import training_sql
from tests.fixtures import feeds, to_spark


def _duck_training(frames):
    con = duckdb.connect()
    for k, v in frames.items():
        con.register(f"raw_{k}", v)
    return con.sql(training_sql("raw_prices", "raw_load", "raw_weather", "raw_gas", "raw_fuel")).df()


@pytest.fixture(scope="module")
def frames():
    return feeds()


def test_training_table_shape_and_names(spark, frames):
    out = training_table(**to_spark(spark, frames))
    assert len(out.columns) == 76
    assert out.columns[:10] == ["datetime_ept", "month", "day_of_week", "hour_of_day", "is_weekend", "is_holiday",
                                "temperature_2m_selected", "wind_speed_10m_selected", "cloud_cover_selected",
                                "forecast_load_mw"]
    assert out.columns[10:13] == ["lagged_lmp_rt_1", "lagged_lmp_rt_3", "lagged_lmp_rt_7"]
    assert out.columns[-3:] == ["rolling_rt_mean", "rolling_rt_stddev", "total_lmp_rt"]
    assert dict(out.dtypes)["datetime_ept"] == "timestamp_ntz"


def test_training_table_equals_independent_sql(spark, frames):
    got = training_table(**to_spark(spark, frames)).toPandas()
    want = _duck_training(frames)
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want) > 100
    got = got.sort_values("datetime_ept").reset_index(drop=True)
    want = want.sort_values("datetime_ept").reset_index(drop=True)
    for c in got.columns:
        if c == "datetime_ept":
            assert (pd.to_datetime(got[c]) == pd.to_datetime(want[c])).all()
        else:
            assert ((got[c].astype(float) - want[c].astype(float)).abs() < 1e-9).all(), c


def test_edge_rows(spark, frames):
    j = training_table(**to_spark(spark, frames)).toPandas().set_index("datetime_ept")
    # load: the version issued at exactly 10:00 the day before wins (2000 + hour)
    assert (j["forecast_load_mw"] == 2000 + j["hour_of_day"]).all()
    # late-only forecast hour and the hour-9 / hour-10 weather gaps are dropped
    assert pd.Timestamp("2024-03-05 07:00") not in j.index
    assert pd.Timestamp("2024-03-06 09:00") not in j.index
    assert pd.Timestamp("2024-03-07 10:00") not in j.index
    # the fall-back hour appears once
    assert (j.index == pd.Timestamp("2024-11-03 01:00")).sum() <= 1
    # a lag 2 days back of a real hour equals that hour's price
    t = pd.Timestamp("2024-03-12 15:00")
    if t in j.index and pd.Timestamp("2024-03-10 15:00") in j.index:
        assert j.loc[t, "lagged_lmp_rt_1"] == j.loc[pd.Timestamp("2024-03-10 15:00"), "total_lmp_rt"]
    assert not j.isna().any().any()


def test_leakage_future_changes_do_not_move_features(spark, frames):
    """Changing anything after a row's information cutoff leaves that row unchanged."""
    base = training_table(**to_spark(spark, frames)).toPandas().set_index("datetime_ept")
    cut = pd.Timestamp("2024-03-18 00:00")
    changed = {k: v.copy() for k, v in frames.items()}
    p = changed["prices"]
    later = pd.to_datetime(p["datetime_beginning_ept"]) >= cut
    p.loc[later, "total_lmp_rt"] = p.loc[later, "total_lmp_rt"] * 3 + 7
    ld = changed["load"]
    late = pd.to_datetime(ld["evaluated_at_ept"]) > cut - pd.Timedelta(hours=14)
    ld.loc[late, "forecast_load_mw"] = -1.0
    after = training_table(**to_spark(spark, changed)).toPandas().set_index("datetime_ept")
    # feature rows for targets on days up to cut (their inputs are >= 2 days old)
    rows = base.index[(base.index < cut + pd.Timedelta(days=2)) & (base.index.isin(after.index))]
    feats = [c for c in base.columns if c != "total_lmp_rt"]
    diff = (base.loc[rows, feats] - after.loc[rows, feats]).abs().max().max()
    assert diff < 1e-9


def test_many_series_at_once_equal_one_at_a_time(spark, frames):
    """Two nodes through the keyed pipeline give, per node, exactly the single-node table."""
    from pyspark.sql import functions as F
    feeds_a = to_spark(spark, frames)
    shifted = {k: v.copy() for k, v in frames.items()}
    shifted["prices"]["total_lmp_rt"] = shifted["prices"]["total_lmp_rt"] * 1.5 - 3
    feeds_b = to_spark(spark, shifted)
    keyed = {}
    for k in feeds_a:
        if k == "gas":  # the daily gas price is shared by all nodes
            keyed[k] = feeds_a[k]
        else:
            keyed[k] = feeds_a[k].withColumn("node", F.lit("A")).unionByName(feeds_b[k].withColumn("node", F.lit("B")))
    both = training_table(**keyed, series_keys=["node"])
    one_a = training_table(**feeds_a)
    one_b = training_table(**to_spark(spark, shifted))
    for node, single in [("A", one_a), ("B", one_b)]:
        part = both.filter(F.col("node") == node).drop("node")
        assert part.count() == single.count() > 0
        assert part.exceptAll(single).count() == 0
