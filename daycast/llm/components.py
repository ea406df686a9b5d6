"""Connected components of a link table, by alternating large-star and small-star rounds.

Each round is two aggregates (smallest neighbour, combined before the shuffle) and two
salted joins, so a node with very many links is no hot task. A round's links are written
to the shared checkpoint folder; nothing but a count and a check sum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.llm.common import salted_join, stage_table


def _smallest(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("low"))


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _smallest(both).withColumn("low", F.least("a", "low"))
    return salted_join(both.where("b > a"), low, ["a"]).select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them (links have a > b)."""
    low = _smallest(links)
    moved = salted_join(links, low, ["a"]).where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(low.select("a", F.col("low").alias("b")))


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b): the smallest node reachable.

    Null ends and self-links are ignored; direction and repeats don't matter. Nodes that
    no link names are not returned.
    """
    now = stage_table(links.dropna().where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(max_rounds):
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        now = stage_table(_small_star(_large_star(now).distinct()).distinct())
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
