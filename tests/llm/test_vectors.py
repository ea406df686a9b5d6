import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daycast.llm import topk_search
from daycast.llm.topk_search import best_rows, search_top_k
from daycast.llm.vector_dedup import collision, dedup_vectors, plan_tables
from tests.llm import brute


def frame(spark, vectors):
    return spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3).selectExpr(
        "*", "1 AS node", "2 AS copies", "3 AS N_LINKS", "'x' AS `a.b`", "4 AS id", "5 AS score", "6 AS g")


def clusters(seed, n=150, d=24):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n // 6):
        centre = rng.standard_normal(d)
        for _ in range(int(rng.integers(1, 12))):
            out.append((centre + rng.standard_normal(d) * rng.choice([0.0, 0.05, 0.12, 0.3])).tolist())
    random.Random(seed).shuffle(out)
    return list(enumerate(out))


BAD = [None, [], [0.0] * 24, [None] + [1.0] * 23, [math.nan] * 24, [math.inf] + [0.0] * 23]


def test_links_match_brute_force(spark):
    rows = clusters(1)
    rows += [(1000 + i, v) for i, v in enumerate(BAD)] + [(2000, [2 * x for x in rows[0][1]]), (2001, rows[1][1]), (2002, rows[1][1]), (2003, [1.0, 2.0]), (2004, [2.0, 4.0]), (2005, [1e200, 2e200])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in dedup_vectors(frame(spark, rows)).collect()}
    want = brute.vector_links(dict(rows))
    found, links = sum(v[0] for v in got.values()), sum(v[0] for v in want.values())
    assert links > 100 and found >= 0.97 * links
    assert all(got[i][0] <= want[i][0] for i in want)  # no link that is none
    assert sum(got[i] == want[i] for i in want) >= 0.95 * len(want)
    for i in range(1000, 1000 + len(BAD)):
        assert got[i] == (0, i)


def test_hot_bucket_counts_each_pair_once(spark):
    """One cluster much larger than a chunk: every vector links with every other."""
    rng = np.random.default_rng(3)
    centre = rng.standard_normal(16)
    rows = [(i, (centre + 0.01 * rng.standard_normal(16)).tolist()) for i in range(120)] + [(200 + i, centre.tolist()) for i in range(30)]
    for chunk in (16, 2048):
        got = dedup_vectors(frame(spark, rows), chunk=chunk).collect()
        assert {r.n_links for r in got} == {149} and {r.component_id for r in got} == {0}
        assert [r.vec_id for r in got if r.kept] == [0]


def test_null_ids_and_columns(spark):
    v = [1.0, 2.0, 3.0]
    rows = dedup_vectors(frame(spark, [(None, v), (4, v), (5, v), (5, v)])).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in rows) == [
        ("4", 2, "4", True), ("5", 2, "4", False), ("5", 2, "4", False), ("None", 0, "None", False)]
    assert rows[0]["a.b"] == "x" and rows[0].node == 1
    assert dedup_vectors(frame(spark, [])).count() == 0


def test_chance_of_a_miss():
    assert collision(0.3, 1.6) > collision(1.4, 1.6)
    for n in (100, 10**5, 10**9):
        hashes, tables = plan_tables(n, 0.95, 0.01)
        near = collision(math.sqrt(0.1), 1.6) ** hashes
        assert (1 - near) ** tables <= 0.0101


def top(rows, k=5, step=3):
    def whole(v):
        return None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(256 * x) for x in v]

    ints = [(i, whole(v)) for i, v in rows if i is not None and whole(v) is not None]
    out = set()
    for q, a in ints:
        if q % step == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in ints if i != q and len(a) == len(b))
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])}
    return out


def search(spark, rows, **kw):
    from pyspark.sql import functions as F
    return {(r.query_id, r["rank"], r.vec_id, r.score) for r in search_top_k(frame(spark, rows), F.col("vec_id") % 3 == 0, **kw).collect()}


def test_search_matches_brute_force(spark):
    rows = clusters(5, 240) + [(1000 + i, v) for i, v in enumerate(BAD)]
    assert search(spark, rows) == top(rows)
    assert search(spark, rows, group_rows=20, query_rows=7) == top(rows)
    assert search(spark, rows, k=1) == top(rows, 1)


def test_search_ties_few_rows_and_large_numbers(spark):
    same = [(i, [0.5, 0.25]) for i in range(20)]
    assert search(spark, same) == top(same)
    few = [(0, [1.0]), (1, [0.5]), (2, [0.1, 0.2]), (None, [1.0])]
    assert search(spark, few) == top(few) and search(spark, few[:1]) == set() and search(spark, []) == set()
    large = [(i, [1e6 * i, -3e5, 2.0**20]) for i in range(9)]
    assert search(spark, large) == top(large)
    huge = search(spark, [(i, [1e300, -1e300 * i]) for i in range(6)])
    assert len(huge) == 10 and {s for *_, s in huge} <= {(1 << 63) - 1, -(1 << 63)}


def test_search_keeps_repeated_rows_apart(spark):
    """Rows of one id are candidates of their own, and those of a query's id are one query."""
    rows = clusters(8, 90) + [(7, [2.0] * 24)] * 6 + [(8, [1.5] * 24), (8, [1.25] * 24), (0, [1.0] * 24)]
    pairs = {}
    for q, a in rows:
        if q % 3 == 0:
            pairs.setdefault(q, []).extend((-sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b, strict=True)), i) for i, b in rows if i != q)
    want = sorted((q, r + 1, i, -s) for q, found in pairs.items() for r, (s, i) in enumerate(sorted(found)[:5]))
    for kw in ({}, {"group_rows": 20, "query_rows": 7}):
        found = search_top_k(frame(spark, rows), F.col("vec_id") % 3 == 0, **kw)
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == want
    assert [w[2] for w in want if w[0] == 0] == [7] * 5


def test_blocks_are_left_out_without_loss():
    """Clustered rows in id order: the bounds spare blocks, and the answer is the plain one."""
    rng = np.random.default_rng(0)
    centres = rng.integers(-200, 200, (20, 8))
    rows = np.repeat(centres, 64, axis=0) + rng.integers(-3, 4, (1280, 8))
    queries = centres[:5] + 1
    ids = np.arange(1280)
    who, what, score = best_rows(ids, rows.astype(float), np.arange(5000, 5005), queries.astype(float), np.full(5, -np.inf), 4, False)
    plain = queries @ rows.T
    for q in range(5):
        want = sorted(zip(-plain[q], ids, strict=True))[:4]
        assert [(-s, i) for s, i in zip(score[who == q], what[who == q], strict=True)] == [(s, i) for s, i in want]


def test_blocks_in_id_order_are_scored_less_often(monkeypatch):
    """Ids that follow clusters: the blocks scored are a small part, and far fewer than of shuffled ids."""
    rng = np.random.default_rng(2)
    rows = (np.repeat(rng.integers(-200, 200, (40, 8)), 64, axis=0) + rng.integers(-3, 4, (2560, 8))).astype(float)
    queries = rows[::256] + 1
    plain, scored = topk_search._products, []
    monkeypatch.setattr(topk_search, "_products", lambda a, b: scored.append(len(a)) or plain(a, b))
    found = {}
    for name, order in (("ranges", np.arange(2560)), ("shuffled", rng.permutation(2560))):
        scored.clear()
        _, _, score = best_rows(np.arange(2560), rows[order], np.arange(5000, 5010), queries, np.full(10, -np.inf), 4, False)
        found[name] = (sum(scored[2:]), sorted(score))  # the first two calls are the bounds
    assert found["ranges"][1] == found["shuffled"][1]
    assert found["ranges"][0] <= 10 * 40 / 8 < 10 * 40 / 2 < found["shuffled"][0]


@pytest.mark.parametrize("cuts,parts", [([100, 200, 300], 1), ([7, 7, 7, 500], 2), ([], 3), ([], 1)])
def test_groups_are_id_ranges(spark, cuts, parts):
    """An id stays in its range; one that spans cuts is dealt over the ranges between them."""
    rows = spark.range(600).selectExpr("IF(id < 300, 7, id) AS id", "array(CAST(id AS double)) AS vec")
    got = {}
    for r in rows.select("id", topk_search._group_of(cuts, parts).alias("g")).collect():
        got.setdefault(r.id, set()).add(r.g // parts)
        assert 0 <= r.g < (len(cuts) + 1) * parts
    for i, groups in got.items():
        low, high = sum(c < i for c in cuts), sum(c <= i for c in cuts)
        assert groups <= set(range(low, high + 1)) and (len(groups) == high - low + 1 or i != 7)


def test_many_ranges_match_brute_force(spark, monkeypatch):
    """More groups than ranges, and negative, huge and repeated ids."""
    monkeypatch.setattr(topk_search, "RANGES", 4)
    rows = clusters(6, 120) + [(-(1 << 62), [0.5] * 24), ((1 << 63) - 1, [0.75] * 24), (-5, [0.25] * 24)]
    assert search(spark, rows, group_rows=7, query_rows=20) == top(rows)


@pytest.mark.parametrize("first_only", [True, False])
def test_threshold_keeps_equal_scores(first_only):
    rows = np.ones((10, 2))
    who, what, score = best_rows(np.arange(10), rows, np.array([99]), np.ones((1, 2)), np.array([2.0]), 3, first_only)
    assert what.tolist() == [0, 1, 2] and score.tolist() == [2, 2, 2]
