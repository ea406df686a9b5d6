"""Vintage choice, issue-time cutoff, latest version, de-duplication, category pivot (T4, T5)."""

from pyspark.sql import functions as F

from daycast.operators.dedupe import dedupe_hours, latest_before_cutoff, latest_version
from daycast.operators.normalize import normalize, pivot_share, select_vintage
from tests.conftest import ts


def test_vintage_switches_at_ten_and_requires_chosen_vintage(spark):
    df = spark.createDataFrame([
        ("2024-05-01 09:00:00", 1.0, 2.0, None, 20.0),   # hour 9 -> day1 (complete)
        ("2024-05-01 10:00:00", 1.0, 2.0, 10.0, 20.0),   # hour 10 -> day2
        ("2024-05-01 11:00:00", 1.0, 2.0, None, 20.0),   # day2 incomplete -> dropped
        ("2024-05-01 08:00:00", None, 2.0, 10.0, 20.0),  # day1 incomplete -> dropped
    ], "t string, a1 double, b1 double, a2 double, b2 double").withColumn("t", F.col("t").cast("timestamp_ntz"))
    out = {r.t.hour: r for r in select_vintage(df, "t", {"a": ("a1", "a2"), "b": ("b1", "b2")}, 10).collect()}
    assert set(out) == {9, 10}
    assert (out[9].a, out[9].b) == (1.0, 2.0)
    assert (out[10].a, out[10].b) == (10.0, 20.0)


def _versions(spark):
    rows = [
        ("2024-01-05 14:00:00", "2024-01-04 10:00:00", 100.0, 1),  # exactly at the cutoff: kept, latest
        ("2024-01-05 14:00:00", "2024-01-04 10:01:00", 999.0, 2),  # one minute late: excluded
        ("2024-01-05 14:00:00", "2024-01-03 18:00:00", 90.0, 3),
        ("2024-01-06 00:00:00", "2024-01-04 09:00:00", 50.0, 4),   # tie on issue time
        ("2024-01-06 00:00:00", "2024-01-04 09:00:00", 55.0, 5),
    ]
    df = spark.createDataFrame(rows, "target string, issued string, fc double, vid int")
    return normalize(df, {"target": ("target", "timestamp_ntz"), "issued": ("issued", "timestamp_ntz"),
                          "fc": "fc", "vid": "vid"})


def test_latest_before_cutoff_inclusive_boundary_and_tiebreak(spark):
    out = {r.target: r for r in latest_before_cutoff(_versions(spark), "target", "issued", tiebreak=["vid"]).collect()}
    assert out[ts("2024-01-05T14:00:00")].fc == 100.0
    assert out[ts("2024-01-06T00:00:00")].fc == 55.0  # tie on issued -> larger vid


def test_leakage_late_version_never_changes_result(spark):
    base = latest_before_cutoff(_versions(spark), "target", "issued", tiebreak=["vid"])
    late = spark.createDataFrame([("2024-01-05 14:00:00", "2024-01-05 13:00:00", -1.0, 9)],
                                 "target string, issued string, fc double, vid int")
    late = normalize(late, {"target": ("target", "timestamp_ntz"), "issued": ("issued", "timestamp_ntz"),
                            "fc": "fc", "vid": "vid"})
    more = latest_before_cutoff(_versions(spark).unionByName(late), "target", "issued", tiebreak=["vid"])
    assert sorted(base.collect()) == sorted(more.collect())


def test_dedupe_fall_back_duplicate_is_deterministic(spark):
    rows = [("2024-11-03 01:00:00", 30.0, 1.0), ("2024-11-03 01:00:00", 25.0, 2.0),
            ("2024-11-03 02:00:00", 40.0, 3.0)]
    df = spark.createDataFrame(rows, "t string, p double, q double").withColumn("t", F.col("t").cast("timestamp_ntz"))
    a = dedupe_hours(df, "t").orderBy("t").collect()
    b = dedupe_hours(df.orderBy(F.desc("p")), "t").orderBy("t").collect()
    assert len(a) == 2 and a == b and a[0].p == 25.0


def test_latest_version_picks_highest_current(spark):
    rows = [("h1", 1, True, 10.0), ("h1", 2, True, 11.0), ("h1", 3, False, 99.0), ("h2", 1, True, 5.0)]
    df = spark.createDataFrame(rows, "hour string, version_nbr int, row_is_current boolean, v double")
    out = {r.hour: r.v for r in latest_version(df, ["hour"], "version_nbr", "row_is_current").collect()}
    assert out == {"h1": 11.0, "h2": 5.0}


def test_pivot_negative_share_clamped_only_with_company(spark):
    rows = [("t1", "Storage", -0.3), ("t1", "Coal", 0.5), ("t2", "Storage", -0.2)]
    df = spark.createDataFrame(rows, "t string, k string, s double")
    out = {r.t: r for r in pivot_share(df, ["t"], "k", "s", ["Coal", "Storage", "Wind"]).collect()}
    assert (out["t1"].Coal, out["t1"].Storage, out["t1"].Wind) == (0.5, 0.0, 0.0)
    assert out["t2"].Storage == -0.2 and out["t2"].Coal == 0.0


def test_latest_before_cutoff_equals_max_by(spark):
    v = _versions(spark)
    a = latest_before_cutoff(v, "target", "issued", tiebreak=["vid"])
    kept = v.filter("issued <= timestampadd(HOUR, -14, cast(to_date(target) as timestamp_ntz))")
    b = kept.groupBy("target").agg(F.max_by(F.struct("issued", "fc", "vid"), F.struct("issued", "vid")).alias("r")).select("target", "r.*")
    assert sorted(a.collect()) == sorted(b.select(*a.columns).collect())


def test_incomplete_count_any_versus_all_null(spark):
    from daycast.operators.filters import complete_rows, incomplete_count
    df = spark.createDataFrame([("k1", 1.0, 2.0), ("k2", None, 2.0), ("k3", None, None)], "k string, a double, b double")
    r = incomplete_count(df, exclude=["k"]).first()
    assert (r.n_any_null, r.n_all_null, r.n_rows) == (2, 1, 3)
    assert [x.k for x in complete_rows(df, exclude=["k"]).collect()] == ["k1"]
