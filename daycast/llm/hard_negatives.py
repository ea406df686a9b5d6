"""Hard negatives for contrastive training, by shared candidate lists of anchor clusters.

For each anchor the ``positives`` best rows of its label are found first, then, for each of
those, the best ``negatives`` rows of other labels whose score lies between ``low`` and
``high`` hundredths of the positive's. Scores are integer inner products of floor(scale * x).

Both searches walk shared lists. Anchors are dealt to clusters of similar direction. With c
the direction of a cluster, b its members' largest angle to c, and a_i the angle of
candidate i, no member u scores more with i than |u| |i| cos(max(0, a_i - b)). The
candidates are sorted by |i| cos(max(0, a_i - b)) once for a cluster; every member walks
down that list, and has done so for certain when the bound falls below what it still wants:
its k-th best score so far, or the lower end of its window.

A list is never whole in one task: candidates are cut into blocks of about ``group_rows`` by
the hash of their id, clusters into parts of about ``members`` anchors, and each block meets
each part. Block 0, a random part of the candidates, is walked first; its k-th scores
start all other walks. Of a block at most k rows leave for each thing wanted. The directions by which anchors are dealt come
from a sample of at most ``sample`` anchors (those of smallest id hash); they only set how
tight the bounds are. A cluster's own direction and angle are taken from its members.

Exact: bounds are widened beyond the error of the angles, and scores are sums of integer
products below 2^53 in doubles, larger ones in Python integers within the range of a long.

Defined cases
- Rows with a null id, a null label, a null vector, or a null or non-finite component take no part.
- Rows that repeat an id are one row: that of the smallest label, then the smallest vector; it is an anchor if one of them is.
- Vectors of different lengths don't meet; a zero vector scores 0 with every other.
- Fewer positives or negatives than asked: all of them. Ties: the smaller id first.
- A negative positive score leaves no window. Other columns play no part, under any name.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from daycast.llm.common import col, stage_table
from daycast.llm.topk_search import EXACT, _integers, _products

#: Radians by which an angle may be off (arccos near 1), and the relative error of a bound.
ANGLE_ERROR, BOUND_ERROR = 1e-6, 1e-9
CHUNK = 256


def _directions(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors, lengths); a zero vector keeps a zero direction."""
    length = np.sqrt((rows * rows).sum(axis=1))
    return rows / np.where(length > 0, length, 1.0)[:, None], length


def shared_list(rows: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the candidates, their bounds in that order for a member of length 1, members' lengths)."""
    unit, length = _directions(rows)
    own, own_length = _directions(members)
    centre = own.sum(axis=0)
    norm = math.sqrt(float(centre @ centre))
    centre = centre / norm if norm > 0 else centre
    inside = np.arccos(np.clip(own[own_length > 0] @ centre, -1, 1))
    widest = float(inside.max(initial=0.0)) if norm > 0 else math.pi
    apart = np.arccos(np.clip(unit @ centre, -1, 1))
    bound = length * np.cos(np.maximum(0.0, apart - widest - ANGLE_ERROR))
    order = np.argsort(-bound, kind="stable")
    return order, bound[order], own_length


def walk(ids, labels, rows, member_ids, member_labels, members, wants, k: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the want, id, score) of the first ``k`` candidates of each want. ``wants``:
    (index of the member, lowest, highest and least score), candidates of the member's
    label or, unless ``same``, of another."""
    who, low, high, least = wants
    order, bound, length = shared_list(rows, members)
    need = np.maximum(low, least)
    top = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, low.dtype))
    active = np.flatnonzero(low <= high)
    at, width = 0, CHUNK
    while len(active) and at < len(order):
        # the slack covers the bound's rounding, whatever its sign
        reach = length[who[active]] * bound[at]
        active = active[reach + np.abs(reach) * BOUND_ERROR + BOUND_ERROR >= need[active].astype(np.float64)]
        if not len(active):
            break
        part = order[at:at + width]
        walking, place = np.unique(who[active], return_inverse=True)
        score = _products(members[walking], rows[part])[place]
        like = labels[part][None, :] == member_labels[walking][place][:, None]
        fit = (like if same else ~like) & (ids[part][None, :] != member_ids[walking][place][:, None])
        fit &= (score >= need[active][:, None]) & (score <= high[active][:, None])
        x, y = np.nonzero(fit)
        one = np.concatenate([top[0], active[x]])
        two = np.concatenate([top[1], ids[part][y]])
        three = np.concatenate([top[2], score[x, y].astype(low.dtype)])
        rank = np.lexsort((two, -three, one))
        one, two, three = one[rank], two[rank], three[rank]
        new = np.flatnonzero(np.concatenate([[True], one[1:] != one[:-1]])) if len(one) else np.zeros(0, np.int64)
        nth = np.arange(len(one)) - np.repeat(new, np.diff(np.append(new, len(one))))
        keep = nth < k
        top = one[keep], two[keep], three[keep]
        last = nth == k - 1
        need[one[last]] = np.maximum(need[one[last]], three[last])
        at, width = at + width, min(2 * width, 4096)
    return top


def _exact(values: list) -> np.ndarray:
    """Whole numbers (or infinities) as doubles where those hold them, else as Python's."""
    big = any(abs(v) >= 1 << 53 for v in values if not math.isinf(v))
    return np.array(values, object if big else np.float64)


def _searcher(scale: float, k: int, same: bool):
    """Walk of one block of candidates by one part of a cluster."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = {"anchor_id": [], "want": [], "id": [], "score": []}
        if left.num_rows and right.num_rows:
            member_ids, wants = right.column("ask").to_numpy(), right.column("wants").to_pylist()
            who = np.repeat(np.arange(len(wants)), [len(w) for w in wants])
            flat = [w for own in wants for w in own]
            inf = lambda v, other: other if v is None else v
            low, high = _exact([inf(w["low"], -math.inf) for w in flat]), _exact([inf(w["high"], math.inf) for w in flat])
            least = _exact([inf(w["least"], -math.inf) for w in flat])
            rows, members = _integers(left.column("vec"), scale), _integers(right.column("ask_vec"), scale)
            if object in (low.dtype, high.dtype, least.dtype) or np.abs(rows).max(initial=0) * np.abs(members).max(initial=0) * rows.shape[1] >= EXACT:
                low, high, least = low.astype(object), high.astype(object), least.astype(object)
            if len(flat):
                one, two, three = walk(left.column("id").to_numpy(), left.column("label").to_numpy(), rows, member_ids,
                                       right.column("ask_label").to_numpy(), members, (who, low, high, least), k, same)
                found = {"anchor_id": member_ids[who[one]], "want": np.array([flat[i]["want"] for i in one.tolist()], np.int64), "id": two,
                         "score": [int(s) for s in three]}
        return pa.table({n: pa.array(v, pa.int64()) for n, v in found.items()})

    return run


def cluster_directions(sample: np.ndarray, clusters: int, rounds: int = 5) -> np.ndarray:
    """Directions of at most ``clusters`` groups of the sample (spherical k-means, started from the rows furthest apart)."""
    unit, length = _directions(sample)
    unit = unit[length > 0]
    if not len(unit):
        return np.zeros((1, sample.shape[1]))
    chosen = [unit[0]]
    nearest = unit @ chosen[0]
    while len(chosen) < min(clusters, len(unit)):
        chosen.append(unit[int(np.argmin(nearest))])
        nearest = np.maximum(nearest, unit @ chosen[-1])
    centres = np.array(chosen)
    for _ in range(rounds):
        at = np.argmax(unit @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, unit)
        moved, size = _directions(sums)
        centres = np.where(size[:, None] > 0, moved, centres)
    return centres


def _dealt(anchors: DataFrame, scale: float, members: int, sample: int, max_clusters: int) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """(anchors with the number ``part`` of their part of a cluster, first and last part by vector length)."""
    counts = {r["size"]: r.n for r in anchors.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = anchors.orderBy(F.xxhash64("id"), "id").limit(sample).select("size", "vec").collect()
    centres = {}
    for size, n in counts.items():
        rows = [r.vec for r in few if r["size"] == size and size]
        centres[size] = cluster_directions(np.floor(np.array(rows, np.float64) * scale), min(max_clusters, math.ceil(n / members))) if rows else np.zeros((1, size))

    def nearest(batches):
        for batch in batches:
            at = np.zeros(batch.num_rows, np.int32)
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                values = _integers(pa.chunked_array([batch.column("vec").take(pa.array(rows))]), scale) if size else np.zeros((len(rows), 0))
                at[rows] = np.argmax(_directions(values)[0] @ centres[size].T, axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], [*batch.schema.names, "cluster"])

    placed = stage_table(anchors.mapInArrow(nearest, StructType([*anchors.schema.fields, StructField("cluster", IntegerType())])))
    first, parts, spans = 0, [], {}
    for r in placed.groupBy("size", "cluster").agg(F.count(F.lit(1)).alias("n")).orderBy("size", "cluster").collect():
        n = math.ceil(r.n / members)
        parts.append(((r["size"], r.cluster), (first, n)))
        spans[r["size"]] = (min(first, spans.get(r["size"], (first, 0))[0]), first + n - 1)
        first += n
    numbers = placed.sparkSession.createDataFrame([(*k, *v) for k, v in parts], "size int, cluster int, first int, n int")
    # one row for each cluster, of which there are at most max_clusters for a vector length
    dealt = placed.join(F.broadcast(numbers), ["size", "cluster"])
    return dealt.withColumn("part", (F.col("first") + F.pmod(F.xxhash64("id", F.lit(3)), F.col("n"))).cast("int")).drop("first", "n", "cluster"), spans


def mine_hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vec_col: str = "embedding",
                        positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0, group_rows: int = 16384,
                        members: int = 512, sample: int = 4096, max_clusters: int = 256, max_lengths: int = 64) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each row
    where ``is_anchor`` holds and each of its ``positives``, the first ``negatives`` rows of
    another label with low * positive_score <= 100 * negative_score <= high * positive_score."""
    finite = F.forall(col(vec_col), lambda x: F.coalesce(F.abs(x) < F.lit(math.inf), F.lit(False)))
    usable = vectors.select(col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), col(vec_col).alias("vec"), F.coalesce(is_anchor, F.lit(False)).alias("asks")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    one = usable.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("row"), F.max("asks").alias("asks"))
    rows = stage_table(one.select("id", "row.label", "row.vec", "asks", F.size("row.vec").alias("size")))
    spark = rows.sparkSession
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    n_blocks = max(1, math.ceil(rows.count() / group_rows))
    anchors = rows.where("asks").drop("asks")
    if len(anchors.select("size").distinct().limit(max_lengths + 1).collect()) > max_lengths:
        raise ValueError(f"the anchors' vectors have more than {max_lengths} lengths")
    dealt, spans = _dealt(anchors, scale, members, sample, max_clusters)
    if not spans:
        return spark.createDataFrame([], out)
    dealt = stage_table(dealt)
    meets = F.lit(None).cast("array<int>")
    for size, (first, last) in spans.items():
        meets = F.when(F.col("size") == size, F.sequence(F.lit(first), F.lit(last))).otherwise(meets)
    candidates = rows.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_blocks)).cast("int")).select("id", "label", "vec", "block", F.explode(meets).alias("part"))

    def search(wants: DataFrame, k: int, same: bool) -> DataFrame:
        """(anchor_id, want, id, score, rank): the first k rows of every want (ask, want, low, high)."""

        def blocks(which: str, asked: DataFrame) -> DataFrame:
            lists = asked.groupBy("ask").agg(F.collect_list(F.struct("want", "low", "high", "least")).alias("wants"))  # at most ``positives`` each
            members_of = dealt.select(F.col("id").alias("ask"), F.col("label").alias("ask_label"), F.col("vec").alias("ask_vec"), F.col("part").alias("ask_part")).join(lists, "ask")
            met = members_of.withColumn("ask_block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).where(which.format("ask_block"))
            return candidates.where(which.format("block")).groupBy("part", "block").cogroup(met.groupBy("ask_part", "ask_block")).applyInArrow(
                _searcher(scale, k, same), "anchor_id long, want long, id long, score long")

        def ranked(found: DataFrame) -> DataFrame:
            order = Window.partitionBy("anchor_id", "want").orderBy(F.desc("score"), "id")
            return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)

        asked = wants.withColumn("least", F.lit(None).cast("long"))
        if n_blocks == 1:
            return ranked(blocks("{} = 0", asked))
        first = stage_table(ranked(blocks("{} = 0", asked)))
        kth = first.where(F.col("rank") == k).select(F.col("anchor_id").alias("ask"), "want", F.col("score").alias("least"))
        return ranked(first.drop("rank").unionByName(blocks("{} > 0", wants.join(kth, ["ask", "want"], "left"))))

    everything = dealt.select(F.col("id").alias("ask"), F.lit(0).cast("long").alias("want"), F.lit(None).cast("long").alias("low"), F.lit(None).cast("long").alias("high"))
    best = stage_table(search(everything, positives, True).select(F.col("anchor_id").alias("ask"), F.col("id").alias("want"), F.col("score").alias("positive_score")))
    wide = F.col("positive_score").cast("decimal(38,0)")
    bounds = (F.ceil(wide * low / 100).cast("long").alias("low"), F.floor(wide * high / 100).cast("long").alias("high"))
    found = search(best.select("ask", "want", *bounds).where("low <= high"), negatives, False)
    scored = found.join(best.withColumnsRenamed({"ask": "anchor_id"}), ["anchor_id", "want"])
    return scored.select("anchor_id", F.col("want").alias("positive_id"), "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
