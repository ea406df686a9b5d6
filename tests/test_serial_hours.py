"""Keyed as-of fill, the test for serially correlated errors, and sorted output, against plain versions."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daycast.operators.evaluate import paired_test_hac
from daycast.operators.fill import asof_fill
from daycast.sources.io import file_order, write_sorted

START = dt.datetime(2024, 3, 1)


def test_asof_fill_equals_plain(spark):
    rng = random.Random(1)
    at = lambda: START + dt.timedelta(minutes=rng.randint(0, 60 * 24 * 12))
    keys = ["hot", "hot", "hot", "b", None]
    base = [(i, rng.choice(keys), at()) for i in range(300)] + [(300, "hot", None), (301, "none", START)]
    base += base[:5]
    source = [(rng.choice(keys), at(), rng.choice([None, 1.0, 2.0, 3.0]), rng.choice(["p", "q", None])) for _ in range(120)] + [("hot", None, 9.0, "z")]
    source += [("b", source[0][1], 1.0, "p"), ("b", source[0][1], 1.0, "q"), ("b", source[0][1], None, "z")]
    b = spark.createDataFrame(base, "i int, k string, t timestamp_ntz").repartition(4)
    s = spark.createDataFrame(source, "k string, at timestamp_ntz, x double, y string").repartition(3)
    order = lambda v: tuple((x is not None, x) if x is not None else (False,) for x in v)

    def plain(age=None):
        out = []
        for i, k, t in base:
            fit = [(a, order((x, y)), (x, y)) for key, a, x, y in source if key == k and a is not None and t is not None and a <= t]
            best = max(fit, default=None)
            old = best is not None and age is not None and t - best[0] > dt.timedelta(hours=age)
            out.append((i, k, t, *(best[2] if best and not old else (None, None))))
        return sorted(out, key=str)

    for bucket in ("hour", "day", "month"):
        assert sorted(map(tuple, asof_fill(b, "t", s, "at", ["x", "y"], ["k"], bucket).collect()), key=str) == plain()
    assert sorted(map(tuple, asof_fill(b, "t", s, "at", ["x", "y"], ["k"], max_age_hours=7.5).collect()), key=str) == plain(7.5)
    assert asof_fill(b, "t", s.limit(0), "at", ["x"], ["k"]).filter("x IS NULL").count() == len(base)
    assert asof_fill(b.limit(0), "t", s, "at", ["x"], ["k"]).count() == 0
    with pytest.raises(ValueError):
        asof_fill(b, "t", s, "at", ["i"], ["k"])


def test_asof_fill_splits_a_series_by_bucket(spark):
    b = spark.range(10).select(F.lit("a").alias("k"), F.lit(START).cast("timestamp_ntz").alias("t"))
    plan = asof_fill(b, "t", b.withColumn("x", F.lit(1.0)), "t", ["x"], ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "__bucket" in plan[plan.index("Window"):]


def plain_hac(hours, d, lags):
    m, n = d.mean(), len(d)
    at = dict(zip(hours, d - m, strict=True))
    v = (d - m) @ (d - m) / n
    for k in range(1, lags + 1):
        v += 2 * (1 - k / (lags + 1)) * sum(x * at[h - k] for h, x in at.items() if h - k in at) / n
    return n, m, v, m / math.sqrt(v / n)


@pytest.mark.parametrize("block", [26, 100, 24 * 28])
def test_hac_equals_plain_over_gaps_and_blocks(spark, block):
    rng = np.random.default_rng(4)
    hours = np.flatnonzero(rng.random(500) > 0.1)
    noise = np.convolve(rng.normal(size=len(hours) + 9), np.ones(10), "valid") + 0.4
    a = rng.uniform(1, 5, len(hours))
    rows = [("s", START + dt.timedelta(hours=int(h)), float(x + e), float(x)) for h, x, e in zip(hours, a, noise, strict=True)]
    rows += [("one", START, 2.0, 1.0), ("s", START + dt.timedelta(hours=600), None, 1.0), ("none", START, None, 1.0)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, a double, b double").repartition(3)
    got = {r.k: r for r in paired_test_hac(df, "t", "a", "b", 24, ["k"], block_hours=block).collect()}
    want = plain_hac(hours.tolist(), np.array([r[2] - r[3] for r in rows[:len(hours)]]), 24)
    assert (got["s"].n, got["s"].mean_diff, got["s"].variance, got["s"].dm_stat) == pytest.approx(want, rel=1e-9)
    assert got["one"].n == 1 and got["one"].dm_stat is None and "none" not in got


def test_hac_refuses_repeated_hours_and_zero_lags_are_the_plain_variance(spark):
    rows = [(START + dt.timedelta(hours=h), float(h % 5), 1.0) for h in range(40)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, a double, b double")
    d = np.array([a - b for _, a, b in rows])
    assert paired_test_hac(df, "t", "a", "b", 0).first().variance == pytest.approx(d.var())
    with pytest.raises(Exception, match="repeated t"):
        paired_test_hac(df.union(df.limit(1)), "t", "a", "b", 3).collect()


def test_sorted_files_do_not_overlap(spark, tmp_path):
    rng = random.Random(2)
    rows = [(START + dt.timedelta(minutes=rng.randint(0, 5000)), i) for i in range(4000)] + [(None, -1)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, i int").repartition(7)
    write_sorted(df, f"{tmp_path}/s", ["t", "i"], files=5)
    files = sorted(file_order(spark, f"{tmp_path}/s", "t").collect(), key=lambda r: r.first)
    assert len(files) == 5 and sum(r.n_rows for r in files) == 4001 and not any(r.n_out_of_order for r in files)
    assert all(a.last <= b.first for a, b in zip(files, files[1:], strict=False))
    whole = spark.read.parquet(f"{tmp_path}/s").select("t", "i", "_metadata.file_name", "_metadata.row_index").collect()
    place = {r.file_name: n for n, r in enumerate(files)}
    in_order = [(r.t, r.i) for r in sorted(whole, key=lambda r: (place[r.file_name], r.row_index))]
    assert in_order == sorted(rows, key=lambda r: (r[0] or dt.datetime.min, r[1]))
    plan = df.repartitionByRange(5, "t").sortWithinPartitions("t")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
