"""Quantile sketches: merged like the rows, bounded in size and in the error of ranks."""

import pytest
from pyspark.sql import functions as F

from daycast.operators.sketches import merge_sketches, quantile_sketches, sketch_quantiles

RANKS = [0.0, 0.1, 0.5, 0.9, 1.0]


def test_merged_sketches_keep_the_rank_error(spark):
    rows = spark.range(200000).selectExpr("id % 40 AS part", "CAST((id * 7919) % 200000 AS double) AS x", "CAST(id % 3 AS float) AS few")
    parts = quantile_sketches(rows, ["part"], ["x", "few"])
    whole = merge_sketches(parts.withColumn("half", F.col("part") % 2), ["half"], ["x", "few"])
    assert whole.select(F.max(F.length("x"))).first()[0] < 20000
    for r in sketch_quantiles(whole, ["half"], ["x", "few"], RANKS).collect():
        assert r.n == 100000
        if r.column == "x":
            assert r.quantiles[0] <= 1 and r.quantiles[-1] >= 199998
            assert [q / 200000 for q in r.quantiles] == pytest.approx(RANKS, abs=0.02)
        else:
            assert r.quantiles == [0, 0, 1, 2, 2]


def test_nulls_nans_and_empty_keys(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, 1.5D), (1, NULL), (1, double('NaN')), (1, double('inf')), (2, NULL), (NULL, 2.0D) AS t(k, x)")
    parts = quantile_sketches(rows, ["k"], ["x"])
    got = {r.k: (r.n, r.quantiles) for r in sketch_quantiles(parts, ["k"], ["x"], [0.0, 1.0]).collect()}
    assert got == {1: (1, [1.5, 1.5]), 2: (0, None), None: (1, [2.0, 2.0])}
    merged = merge_sketches(parts, [], ["x"])
    assert sketch_quantiles(merged, [], ["x"], [0.0, 1.0]).first() == ("x", 2, [1.5, 2.0])
    assert sketch_quantiles(quantile_sketches(rows.limit(0), ["k"], ["x"]), ["k"], ["x"], [0.5]).count() == 0
