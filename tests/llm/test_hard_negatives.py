"""Hard negatives against SQL and a plain version."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daycast.llm import hard_negatives as H
from tests.llm.conftest import SF


def plain(rows, every=5, positives=5, negatives=3, low=50, high=95, scale=256.0):
    """rows: (id, label, vector); the rows with id divisible by ``every`` are anchors."""
    one = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i not in one or (label, v) < one[i]:
            one[i] = (label, v)
    ints = {i: (label, [math.floor(x * scale) for x in v]) for i, (label, v) in one.items()}
    out = set()
    for a, (label, u) in ints.items():
        if a % every:
            continue
        scores = sorted((-sum(x * y for x, y in zip(u, v, strict=True)), i) for i, (_, v) in ints.items() if i != a and len(v) == len(u))
        for ps, p in [(-s, i) for s, i in scores if ints[i][0] == label][:positives]:
            fit = [(-s, i) for s, i in scores if ints[i][0] != label and low * ps <= -100 * s <= high * ps]
            out |= {(a, p, r, i, ps, s) for r, (s, i) in enumerate(fit[:negatives], 1)}
    return out


def mined(spark, rows, every=5, **kw):
    df = spark.createDataFrame(rows, "vec_id long, label long, embedding array<double>").selectExpr("*", "1 AS id", "2 AS part", "'x' AS `a.b`", "3 AS size").repartition(3)
    got = H.mine_hard_negatives(df, F.col("vec_id") % every == 0, F.col("label"), **kw).collect()
    assert len(set(got)) == len(got)
    return {tuple(r) for r in got}


def vectors(n, d, seed, groups=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, d))
    return [(i, int(rng.integers(4)), (centres[i % groups] + 0.4 * rng.normal(size=d)).tolist()) for i in range(n)]


def test_query_matches_sql(spark):
    from daycast.llm.queries import ORACLE_SQL, QUERIES
    from tools.oracle_check import duck, rows
    got = QUERIES["op12_hard_negatives"](spark, SF).toArrow()
    assert got.num_rows and rows(got) == rows(duck(SF).sql(ORACLE_SQL["op12_hard_negatives"]).to_arrow_table())


@pytest.mark.parametrize("seed", [1, 2])
def test_many_blocks_and_clusters(spark, seed):
    rows = vectors(400, 6, seed)
    assert mined(spark, rows, group_rows=60, members=9) == plain(rows)


def test_scaled_windows(spark):
    rows = vectors(150, 4, 5)
    kw = {"positives": 2, "negatives": 4, "low": 10, "high": 100, "scale": 16.0}
    assert mined(spark, rows, **kw) == plain(rows, **kw)


def test_defined_cases(spark):
    rng = random.Random(4)
    rows = [(i, i % 3, [rng.randint(-2, 2) / 256 for _ in range(3)]) for i in range(60)]  # many ties and zero vectors
    rows += [(60, None, [1.0, 2.0, 3.0]), (65, 1, None), (70, 1, [1.0, None, 2.0]), (75, 1, [1.0, math.nan, 2.0]), (80, 1, [math.inf, 0.0, 0.0]), (None, 1, [1.0, 1.0, 1.0])]
    rows += [(100, 0, [1.0, 2.0]), (101, 0, [1.0, 2.0]), (102, 1, [1.0, 1.2]), (110, 2, []), (111, 2, []), (112, 1, [])]
    rows += rows[:20] + [(5, 7, [9.0, 9.0, 9.0]), (6, -1, [0.5, 0.5, 0.5])]  # repeated rows, and ids with other rows
    assert mined(spark, rows, group_rows=16, members=4) == plain(rows)
    assert mined(spark, []) == set() and mined(spark, [(1, 1, [1.0])]) == set() and mined(spark, [(5, 1, [1.0])]) == set()


def test_scores_beyond_doubles(spark):
    rng = random.Random(6)
    rows = [(i, i % 2, [float(rng.randint(-1 << 22, 1 << 22)) for _ in range(4)]) for i in range(40)]
    assert mined(spark, rows, group_rows=8, members=3) == plain(rows)


def test_the_shared_bound_holds_and_ends_walks_early():
    rng = np.random.default_rng(8)
    rows = np.floor(rng.normal(size=(3000, 8)) * 256) + np.r_[np.zeros((1500, 8)), np.full((1500, 8), 600.0)]
    members = np.floor(rng.normal(size=(20, 8)) * 40) + 600.0
    order, bound, length = H.shared_list(rows, members)
    assert (np.diff(bound) <= 0).all()
    assert (members @ rows[order].T <= length[:, None] * bound[None, :] + 1e-6).all()
    seen = []
    products = H._products

    def counted(a, b):
        seen.append(len(b))
        return products(a, b)

    H._products = counted
    try:
        wants = (np.arange(20), np.full(20, -np.inf), np.full(20, np.inf), np.full(20, -np.inf))
        ids = np.arange(3000)
        who, what, score = H.walk(ids, np.zeros(3000, int), rows, np.full(20, -1), np.zeros(20, int), members, wants, 5, True)
    finally:
        H._products = products
    assert sum(seen) < 1600  # the half of the candidates that points elsewhere is never scored
    for m in range(20):
        best = sorted(zip(-(rows @ members[m]), ids, strict=True))[:5]
        assert [(-s, i) for s, i in best] == list(zip(score[who == m], what[who == m], strict=True))
