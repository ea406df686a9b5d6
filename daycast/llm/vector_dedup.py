"""Near-duplicate vectors by Euclidean p-stable hashing.

On unit vectors a cosine is a distance: |a - b|^2 = 2 - 2 cos. A p-stable hash
floor((g . x + u) / width) with Gaussian g puts near vectors into one cell more often than
far ones; ``hashes`` of them make a table's bucket key, and several tables make it
unlikely that a near pair shares no bucket. The members of a bucket are compared by their
exact cosine in double precision, in blocks of bounded size (see ``blocks``), so no link
is wrong; a pair that shares several buckets counts in the first table only.

The number of hashes follows the number of vectors (a bucket should hold some dozens of
unrelated ones), the number of tables the chance that a pair just at the limit is missed
(``miss``); pairs further inside are missed far less often. Equal vectors are one record
with a weight, so copies are not compared with each other.

Defined cases
- Vectors that are null, zero, or hold null or non-finite components: no link, a component
  of their own.
- Vectors of different lengths don't link.
- Equal vectors link (cosine 1), whatever their number.
- An id is expected once. Rows that repeat an id as the smallest of their vectors are one
  vertex with the links of all. A row with a null id links with nothing and is not kept.
- Input columns named like an output are replaced by it; all others are carried through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycast.llm.blocks import bucket_blocks, link_blocks
from daycast.llm.common import col, others, salted_join, stage_table
from daycast.llm.components import components

WIDTH = 1.6


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: not null, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(math.inf), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def collision(distance: float, width: float) -> float:
    """The chance that two vectors at ``distance`` share a cell of ``width``."""
    t = width / distance
    return math.erf(t / math.sqrt(2)) - math.sqrt(2 / math.pi) / t * (1 - math.exp(-t * t / 2))


def plan_tables(n: int, min_cosine: float, miss: float, crowd: int = 32) -> tuple[int, int]:
    """(hashes, tables) for n vectors."""
    near = collision(math.sqrt(max(2 - 2 * min_cosine, 1e-12)), WIDTH)
    far = collision(math.sqrt(2), WIDTH)
    hashes = max(1, math.ceil(math.log(max(n / crowd, 2)) / -math.log(far)))
    tables = math.ceil(math.log(miss) / math.log(1 - min(near ** hashes, 1 - 1e-9)))
    return hashes, max(1, tables)


def unit_rows(column: pa.Array) -> list[np.ndarray]:
    """Vectors as double arrays scaled to length 1 (by their largest component first, so that no square overflows)."""
    out = []
    for v in column:
        x = np.array(v.as_py(), np.float64)
        x /= np.abs(x).max()
        out.append(x / math.sqrt(x @ x))
    return out


def _keys(hashes: int, tables: int, seed: int):
    """Adds to each record its bucket key in every table, and its unit vector, packed."""
    made: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def random(d: int) -> tuple[np.ndarray, np.ndarray]:
        if d not in made:
            rng = np.random.default_rng([seed, d])
            made[d] = rng.standard_normal((d, tables * hashes)), rng.uniform(0, WIDTH, tables * hashes)
        return made[d]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mix = np.random.default_rng([seed, 0]).integers(1, 1 << 62, hashes, dtype=np.int64) | 1
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                units = unit_rows(part.column("vec"))
                keys = []
                sizes = np.array([len(u) for u in units])
                cells = np.zeros((len(units), tables, hashes), np.int64)
                for d in np.unique(sizes):
                    which = np.flatnonzero(sizes == d)
                    g, u = random(int(d))
                    x = np.array([units[i] for i in which])
                    cells[which] = np.floor((x @ g + u) / WIDTH).astype(np.int64).reshape(len(which), tables, hashes)
                with np.errstate(over="ignore"):
                    code = (cells * mix).sum(axis=2) + sizes[:, None]
                    code ^= code >> 31
                    code *= np.int64(0x5851F42D4C957F2D)
                keys = [row.tobytes() for row in code]
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("copies"), pa.array([u.tobytes() for u in units], pa.binary()), pa.array(keys, pa.binary()),
                     pa.array(list(code), pa.list_(pa.int64()))], ["node", "copies", "unit", "keys", "codes"])

    return run


def _matcher(tables: int, min_cosine: float):
    def prepare(table: pa.Table):
        codes = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.int64).reshape(-1, tables)
        own = table.column("table").to_numpy()
        raw = table.column("unit").to_pylist()
        sizes = np.array([len(x) // 8 for x in raw])
        units = np.zeros((len(raw), int(sizes.max(initial=0))))
        for i, x in enumerate(raw):
            units[i, :sizes[i]] = np.frombuffer(x)
        before = np.arange(tables)[None, :] < own[:, None]

        def match(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            found = np.zeros(len(i), bool)
            for k in range(0, len(i), 1 << 14):
                a, b = i[k:k + (1 << 14)], j[k:k + (1 << 14)]
                near = (np.einsum("ij,ij->i", units[a], units[b]) >= min_cosine) & (sizes[a] == sizes[b])
                near[near] = ~((codes[a[near]] == codes[b[near]]) & before[a[near]]).any(axis=1)
                found[k:k + (1 << 14)] = near
            return found

        return match

    return prepare


def dedup_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", min_cosine: float = 0.95,
                  miss: float = 0.01, chunk: int = 2048, seed: int = 7) -> DataFrame:
    """The input's columns with ``n_links`` (other vectors at a cosine of at least
    ``min_cosine``), ``component_id`` (the smallest id reachable by links) and ``kept``."""
    outputs = ["n_links", "component_id", "kept"]
    kept = [c for c in vectors.columns if c.lower() not in outputs]
    good = usable(col(vec_col)) & col(id_col).isNotNull()
    double = col(vec_col).cast("array<double>")
    base = vectors.select(*others(vectors, outputs), F.when(good, F.xxhash64(F.lit(1), double)).alias("__h1"),
                          F.when(good, F.xxhash64(F.lit(2), double)).alias("__h2"))
    records = stage_table(base.where("__h1 IS NOT NULL").groupBy("__h1", "__h2").agg(
        F.min(col(id_col)).cast("long").alias("node"), F.count(F.lit(1)).alias("copies"), F.first(col(vec_col).cast("array<double>")).alias("vec")))
    hashes, tables = plan_tables(records.count(), min_cosine, miss)
    coded = records.select("node", "copies", "vec").mapInArrow(_keys(hashes, tables, seed), "node long, copies long, unit binary, keys binary, codes array<long>")
    entries = coded.select("node", "copies", "unit", "keys", F.posexplode("codes").alias("table", "code"))
    blocks = bucket_blocks(entries, ["table", "code"], "node", chunk)
    links = stage_table(link_blocks(blocks, ["table", "code"], "node", ["copies", "unit", "keys"], _matcher(tables, min_cosine), "copies"))
    counts = links.groupBy("node").agg(F.sum("n_links").alias("__others"))
    parts = components(links.select(F.col("node").alias("a"), F.col("root").alias("b"))).withColumnRenamed("component", "__component")
    known = (records.select("__h1", "__h2", F.col("node").alias("__node"), "copies")
             .join(counts, F.col("__node") == counts.node, "left").drop("node")
             .join(parts, F.col("__node") == parts.node, "left").drop("node")
             .select("__h1", "__h2", (F.coalesce("__others", F.lit(0)) + F.col("copies") - 1).alias("__links"), F.coalesce("__component", "__node").alias("__part")))
    joined = salted_join(base, known, ["__h1", "__h2"], "left")
    part = F.coalesce("__part", col(id_col).cast("long"))
    return joined.select(*[col(c) for c in kept], F.coalesce("__links", F.lit(0)).cast("long").alias("n_links"), part.alias("component_id"),
                         F.coalesce(col(id_col) == part, F.lit(False)).alias("kept"))
