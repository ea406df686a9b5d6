"""Compare the members of buckets with one another, in blocks of bounded size.

Near-duplicate search puts records into buckets and compares the records of each bucket.
A bucket may hold any share of all records, so it is cut into chunks of about
``chunk`` members (by the record's hash), and every pair of chunks is a block of its own:
all pairs of the bucket are still compared, none twice, and no task holds more than two
chunks at a time. What leaves a block is not its links but, per record, how many it has
and a record it hangs together with: at most one row per member.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.llm.common import salted_join

PAIRS = 1 << 18


def bucket_blocks(entries: DataFrame, keys: list[str], node: str, chunk: int = 2048) -> DataFrame:
    """``entries`` of buckets with two members or more, one row for each block they are
    in: adds ``block_a``, ``block_b`` and ``part`` (the entry's own chunk)."""
    sizes = entries.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(
        *keys, F.ceil(F.col("__n") / chunk).cast("int").alias("__chunks"))
    placed = salted_join(entries, sizes, keys, salts=4)
    part = F.pmod(F.xxhash64(node), F.col("__chunks")).cast("int")
    return (placed.withColumn("part", part)
            .withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__chunks") - 1)))
            .withColumn("block_a", F.least("part", "__other")).withColumn("block_b", F.greatest("part", "__other"))
            .drop("__chunks", "__other"))


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For n nodes and links a-b: the smallest node each hangs together with."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            break
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def pairs(group: np.ndarray, part: np.ndarray, cross: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of equal ``group`` (a sorted array), in pieces; where ``cross``
    is set only those of different ``part``."""
    at, step = np.arange(len(group)), 0
    while True:
        step += 1
        at = at[at + step < len(group)]
        at = at[group[at] == group[at + step]]
        if not len(at):
            return
        for k in range(0, len(at), PAIRS):
            i = at[k:k + PAIRS]
            j = i + step
            keep = ~cross[i] | (part[i] != part[j])
            if keep.any():
                yield i[keep], j[keep]


def link_blocks(blocks: DataFrame, keys: list[str], node: str, payload: list[str],
                matcher: Callable[[pa.Table], Callable[[np.ndarray, np.ndarray], np.ndarray]],
                weight: str | None = None) -> DataFrame:
    """Compare the rows of each block: ``matcher(table)`` gets the rows of some whole blocks
    and returns a function that says which index pairs are links.

    Returns (node, root, n_links): for each row with a link its number of links there
    (or the sum of the others' ``weight``), and a row of the block it is joined with
    (itself for the first).
    """
    group = [*keys, "block_a", "block_b"]
    sorted_rows = blocks.select(*group, "part", node, *payload).repartition(*group).sortWithinPartitions(*group)

    def judge(table: pa.Table) -> pa.RecordBatch:
        n = table.num_rows
        same = np.ones(max(n - 1, 0), bool)
        for k in group:
            v = table.column(k).to_numpy()
            same &= v[1:] == v[:-1]
        block = np.concatenate([[0], np.cumsum(~same)]) if n else np.zeros(0, int)
        part = table.column("part").to_numpy()
        cross = table.column("block_a").to_numpy() != table.column("block_b").to_numpy()
        ids = table.column(node).to_numpy()
        match, count = matcher(table), np.zeros(n, np.int64)
        times = table.column(weight).to_numpy() if weight else np.ones(n, np.int64)
        from_, to = [], []
        label = np.arange(n)
        held = 0
        for i, j in pairs(block, part, cross):
            ok = match(i, j) & (ids[i] != ids[j])
            i, j = i[ok], j[ok]
            np.add.at(count, i, times[j])
            np.add.at(count, j, times[i])
            apart = label[i] != label[j]
            from_.append(i[apart])
            to.append(j[apart])
            held += int(apart.sum())
            if held > 1 << 20:
                label = roots(n, np.concatenate([*from_, np.arange(n)]), np.concatenate([*to, label]))
                from_, to, held = [], [], 0
        if from_:
            label = roots(n, np.concatenate([*from_, np.arange(n)]), np.concatenate([*to, label]))
        linked = np.flatnonzero(count)
        return pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(ids[label[linked]]), pa.array(count[linked])],
                                          ["node", "root", "n_links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            n = table.num_rows
            if not n:
                continue
            last = np.ones(n, bool)
            for k in group:
                v = table.column(k).to_numpy()
                last &= v == v[-1]
            cut = int(np.flatnonzero(last)[0]) if last.any() else n
            if cut:
                yield judge(table.slice(0, cut).combine_chunks())
            held = table.slice(cut)
        if held is not None and held.num_rows:
            yield judge(held.combine_chunks())

    return sorted_rows.mapInArrow(run, "node long, root long, n_links long")
