"""Exact top-k by inner product, with block-at-a-time pruning.

Vectors become integers, floor(scale * x). A component is a term, its integer the term's
weight. The candidates are dealt into groups by ranges of their id, kept in id order and cut
into blocks, so a block is a range of ids; it has its rows (its forward index) and, per term, its largest and smallest weight. Their sum
over a query's terms bounds every score of the block. For each query the blocks are taken
in order of their bounds, scored through their forward index, and left out once the bound
is below the k-th score so far; equal bounds are still scored, for ties.

The ranges' cuts are approximate quantiles of the id, at most ``RANGES`` - 1 of them; where
more groups are needed, each range is dealt over several by a hash of the id. An id that
many rows repeat spans several cuts, and its rows are dealt over the ranges between them
by their vectors. Groups of candidates meet groups of queries as blocks of bounded size (``group_rows`` times
``query_rows``), so neither side is ever whole in one task. A first round scores each
query's best block of every group only; its k-th score is the second round's threshold in
all groups. Per group at most k rows of a query leave, and the last step ranks those.

Scores are exact: sums of integer products below 2^53 in doubles, larger ones in Python
integers, limited to the range of a long (scores beyond it tie at its end).

Defined cases
- Vectors null, or holding null or non-finite components: neither query nor candidate.
- Vectors of different lengths don't meet; empty vectors score 0 with each other.
- Fewer candidates than k: all of them. Ties: the smaller id first.
- Rows that repeat an id are candidates of their own, so an id can take several ranks; a
  query never meets its own id. Rows that repeat a query's id are one query, whose rows
  each meet every candidate.
- A null id takes no part. Other columns play none, under any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daycast.llm.common import col, stage_table

BLOCK = 64
RANGES = 256
EXACT = float(1 << 53)
TOP, LOW = (1 << 63) - 1, -(1 << 63)


def _integers(column: pa.ChunkedArray, scale: float) -> np.ndarray:
    """The vectors of one length as a matrix of whole numbers (doubles)."""
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(values * scale).reshape(len(flat), -1)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of whole numbers, exactly."""
    if not a.size or not b.size or np.abs(a).max() * np.abs(b).max() * max(a.shape[1], 1) < EXACT:
        return a @ b.T
    whole = np.array([[int(x) for x in r] for r in a], object) @ np.array([[int(x) for x in r] for r in b], object).T
    return np.array([[min(max(x, LOW), TOP) for x in r] for r in whole], object)


def _not_above(scores: np.ndarray) -> np.ndarray:
    """Scores as doubles that are never above them."""
    found = scores.astype(np.float64)
    return np.where(np.abs(found) >= EXACT, np.nextafter(found, -math.inf), found)


def best_rows(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int,
              first_only: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the query, id, score) of the best k rows of each query, of those that reach
    ``least``. ``rows`` are in id order."""
    n, m = len(ids), len(query_ids)
    cuts = np.arange(0, n, BLOCK)
    big, small = np.maximum.reduceat(rows, cuts, axis=0), np.minimum.reduceat(rows, cuts, axis=0)
    bound = _products(np.maximum(queries, 0), big) + _products(np.minimum(queries, 0), small)
    if bound.dtype == object or np.abs(bound).max(initial=0) >= EXACT:
        bound = np.full(bound.shape, math.inf)  # too large to compare in doubles: score all
    order = np.argsort(-bound, axis=1, kind="stable")
    least = least.copy()
    top = (np.zeros(0, np.int64), np.zeros(0, ids.dtype), np.zeros(0))
    active, done, width = np.arange(m), 0, 1
    while len(active) and done < len(cuts):
        take = order[active, done:done + width]
        q, b = np.repeat(active, take.shape[1]), take.ravel()
        wanted = bound[q, b] >= least[q]
        q, b = q[wanted], b[wanted]
        by = np.argsort(b, kind="stable")
        q, b = q[by], b[by]
        found = [top]
        for s, e in zip(starts := np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])) if len(b) else [], [*starts[1:], len(b)], strict=True):
            who, lo = q[s:e], int(cuts[b[s]])
            score = _products(queries[who], rows[lo:lo + BLOCK])
            fit = (score >= least[who][:, None]) & (ids[None, lo:lo + BLOCK] != query_ids[who][:, None])
            x, y = np.nonzero(fit)
            found.append((who[x], ids[lo + y], score[x, y]))
        who, what, score = (np.concatenate(c) for c in zip(*found, strict=True))
        rank = np.lexsort((what, -score, who))
        who, what, score = who[rank], what[rank], score[rank]
        new = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]])) if len(who) else np.zeros(0, int)
        place = np.arange(len(who)) - np.repeat(new, np.diff(np.append(new, len(who))))
        keep = place < k
        top = who[keep], what[keep], score[keep]
        last = place == k - 1
        least[who[last]] = np.maximum(least[who[last]], _not_above(score[last]))
        done, width = done + width, min(2 * width, 64)
        if first_only:
            break
        if done < len(cuts):
            active = active[bound[active, order[active, done]] >= least[active]]
    return top


def _search(scale: float, k: int, first_only: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        if not left.num_rows or not right.num_rows:
            return empty
        left = left.sort_by("id")
        ids, query_ids = left.column("id").to_numpy(), right.column("ask").to_numpy()
        least = _not_above(right.column("least").to_numpy(zero_copy_only=False))
        least = np.where(np.isnan(least), -math.inf, least)
        who, what, score = best_rows(ids, _integers(left.column("vec"), scale), query_ids, _integers(right.column("ask_vec"), scale), least, k, first_only)
        return pa.table({"query_id": pa.array(query_ids[who], pa.int64()), "vec_id": pa.array(what, pa.int64()),
                         "score": pa.array([min(max(int(s), LOW), TOP) for s in score], pa.int64())})

    return run


def _group_of(cuts: list[int], parts: int) -> Column:
    """The group of a row of ``id`` and ``vec``: its range between the sorted ``cuts`` (any of
    those that its id spans, by its vector), and which of the range's ``parts``."""
    below, up_to = F.lit(0), F.lit(0)
    if cuts:
        ends = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<long>")  # folded to one literal
        below, up_to = (F.size(F.filter(ends, f)) for f in (lambda c: c < F.col("id"), lambda c: c <= F.col("id")))
    spot = below + F.pmod(F.xxhash64("vec"), up_to - below + 1)
    return (spot * parts + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts))).cast("int")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
                 scale: float = 256.0, group_rows: int = 16384, query_rows: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates for each row where ``is_query``
    holds: all rows but those of the query's id, by the inner product of floor(scale * x)."""
    finite = F.forall(col(vec_col), lambda x: F.coalesce(F.abs(x) < F.lit(math.inf), F.lit(False)))
    rows = vectors.select(col(id_col).cast("long").alias("id"), col(vec_col).alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asks")).where(
        F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)))
    n = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("asks").alias("asks"),
                 F.percentile_approx("id", [i / RANGES for i in range(1, RANGES)], 10000).alias("quantiles")).first()
    n_groups, n_asks = max(1, math.ceil(n.rows / group_rows)), max(1, math.ceil(n.asks / query_rows))
    ranges = min(n_groups, RANGES)
    parts = math.ceil(n_groups / ranges)
    n_groups = ranges * parts
    cuts = [n.quantiles[RANGES * i // ranges - 1] for i in range(1, ranges)]
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    keys, out = ["size", "g", "a"], "query_id long, vec_id long, score long"
    candidates = rows.select("id", "vec", F.size("vec").alias("size"), _group_of(cuts, parts).alias("g"), every(n_asks).alias("a")).toDF("id", "vec", *keys)
    asks = rows.where("asks").select("id", "vec").toDF("ask", "ask_vec")

    def round_(queries: DataFrame, first_only: bool) -> DataFrame:
        dealt = queries.select("ask", "ask_vec", "least", F.size("ask_vec").alias("ask_size"), every(n_groups).alias("ask_g"),
                               F.pmod(F.xxhash64("ask", F.lit(2)), F.lit(n_asks)).cast("int").alias("ask_a"))
        met = candidates.groupBy(*keys).cogroup(dealt.groupBy("ask_size", "ask_g", "ask_a"))
        return _ranked(met.applyInArrow(_search(scale, k, first_only), out), k)

    kth = round_(asks.withColumn("least", F.lit(None).cast("double")), True).where(F.col("rank") == k)
    known = stage_table(kth.select(F.col("query_id").alias("ask"), F.col("score").cast("double").alias("least")))
    best = round_(asks.join(known, "ask", "left"), False)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
