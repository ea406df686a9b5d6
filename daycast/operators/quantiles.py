"""Exact quantiles (linear interpolation between closest ranks) without sending a
column's values to one task.

Spark's exact ``percentile`` merges a value -> count map per group in one task, which
grows with the number of distinct values. Here each needed rank is located by
successive bucket counts. Every round is one distributed aggregation over the rows
that fall inside a still-open interval, returning at most ``buckets`` rows per
interval; it narrows each interval to the bucket holding its rank. An interval with
at most ``max_leaf`` values (or one repeated value) is read as (value, count) pairs
and the rank is read off. Rounds needed: about log_buckets(n / max_leaf) + 2.
Results equal an exact sort; only per-bucket counts ever reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.operators.profile import finite


def _tagged(df: DataFrame, intervals: list[tuple[int, str, float, float]]) -> DataFrame:
    """(iid, x) for every value inside one of the open intervals (literal predicates,
    no join; nested intervals of different depths may both match)."""
    items = [F.when(finite(c).between(lo, hi), F.struct(F.lit(iid).alias("iid"), finite(c).alias("x")))
             for iid, c, lo, hi in intervals]
    return df.select(F.explode(F.array(*items)).alias("s")).filter(F.col("s").isNotNull()).select("s.iid", "s.x")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], buckets: int = 4096,
                    max_leaf: int = 10000, stats: dict | None = None) -> dict[tuple[str, float], float | None]:
    """{(column, p): quantile} of the finite values, the definition of pandas / SQL
    ``quantile_cont``. ``stats`` may pass precomputed {column: (n, min, max)} of those."""
    if stats is None:
        row = df.agg(*[F.struct(F.count(finite(c)).alias("n"), F.min(finite(c)).alias("lo"), F.max(finite(c)).alias("hi")).alias(f"s{i}")
                       for i, c in enumerate(cols)]).first()
        stats = {c: (row[f"s{i}"]["n"], row[f"s{i}"]["lo"], row[f"s{i}"]["hi"]) for i, c in enumerate(cols)}
    need: dict[tuple[str, int], tuple[float, float, int, int]] = {}  # (col, rank) -> (lo, hi, below, n_in)
    for c in cols:
        n, lo, hi = stats[c]
        if not n:
            continue
        for p in probs:
            pos = (n - 1) * p
            for k in {math.floor(pos), math.ceil(pos)}:
                need[(c, k)] = (lo, hi, 0, n)
    found: dict[tuple[str, int], float] = {}
    while need:
        for key, (lo, hi, below, n_in) in list(need.items()):
            if lo == hi:
                found[key] = lo
                del need[key]
        if not need:
            break
        ivs = sorted({(key[0], lo, hi, below, n_in) for key, (lo, hi, below, n_in) in need.items()})
        ids = {iv: i for i, iv in enumerate(ivs)}
        leaf = [iv for iv in ivs if iv[4] <= max_leaf]
        split = [iv for iv in ivs if iv[4] > max_leaf]
        if leaf:
            tagged = _tagged(df, [(ids[iv], iv[0], iv[1], iv[2]) for iv in leaf])
            got: dict[int, list] = {}
            for r in tagged.groupBy("iid", "x").agg(F.count(F.lit(1)).alias("cnt")).collect():
                got.setdefault(r["iid"], []).append((r["x"], r["cnt"]))
            for key, (lo, hi, below, n_in) in list(need.items()):
                iid = ids[(key[0], lo, hi, below, n_in)]
                if iid not in got:
                    continue
                acc = below
                for x, cnt in sorted(got[iid]):
                    acc += cnt
                    if acc > key[1]:
                        found[key] = x
                        break
                del need[key]
        if split:
            tagged = _tagged(df, [(ids[iv], iv[0], iv[1], iv[2]) for iv in split])
            meta = {ids[iv]: iv for iv in split}
            lo_of = F.element_at(F.create_map(*[F.lit(v) for i in meta for v in (i, meta[i][1])]), F.col("iid"))
            hi_of = F.element_at(F.create_map(*[F.lit(v) for i in meta for v in (i, meta[i][2])]), F.col("iid"))
            # halves first: the width of an interval of doubles may exceed a double; the ends
            # fall in different buckets, so every round narrows
            share = F.coalesce(F.try_divide(F.col("x") / 2 - lo_of / 2, hi_of / 2 - lo_of / 2), F.lit(0.0))
            b = F.when(F.col("x") == hi_of, buckets - 1).otherwise(F.least(F.floor(share * buckets), F.lit(buckets - 2))).cast("int")
            per: dict[int, list] = {}
            for r in tagged.groupBy("iid", b.alias("b")).agg(
                    F.count(F.lit(1)).alias("cnt"), F.min("x").alias("bmin"), F.max("x").alias("bmax")).collect():
                per.setdefault(r["iid"], []).append(r)
            for key, (lo, hi, below, n_in) in list(need.items()):
                iid = ids.get((key[0], lo, hi, below, n_in))
                if iid not in meta:
                    continue
                acc = below
                for r in sorted(per[iid], key=lambda r: r["b"]):
                    if acc + r["cnt"] > key[1]:
                        if r["cnt"] == n_in:
                            raise ArithmeticError(f"the interval {lo!r} to {hi!r} of {key[0]} does not narrow")
                        need[key] = (r["bmin"], r["bmax"], acc, r["cnt"])
                        break
                    acc += r["cnt"]
    out = {}
    for c in cols:
        n = stats[c][0]
        for p in probs:
            if not n:
                out[(c, p)] = None
                continue
            pos = (n - 1) * p
            a, b_ = found[(c, math.floor(pos))], found[(c, math.ceil(pos))]
            out[(c, p)] = a + (b_ - a) * (pos - math.floor(pos))
    return out
