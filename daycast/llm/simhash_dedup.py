"""SimHash near-duplicates: fingerprints at a small Hamming distance, by the generalised
pigeonhole principle.

A document's fingerprint is the majority, bit by bit, of its word shingles' XXH64. To find
all pairs within ``max_bits`` of each other:

1. Documents of one fingerprint are one record (grouped before any comparison).
2. The 64 bits are cut into parts of correlated bits, so that the parts are as independent
   of each other as they can be (greedy, from the bits' correlations over all records).
3. Each part i gets a threshold t_i with sum(t_i) = max_bits - parts + 1. If every part
   differed by more than its threshold, the whole would differ by more than max_bits; so
   any pair within max_bits agrees within t_i on some part i. Thresholds are unequal: a
   dynamic programme takes those of least estimated cost (entries probed plus candidate
   pairs), from the parts' collision counts over all records. -1 leaves a part out.
4. Within t_i of each other on a part of w bits means equal on some w - t_i of them: the
   records are put in a bucket for every such choice, and the members of a bucket are
   verified against the whole fingerprint in blocks (see ``blocks``).
5. Links give components; a component's id is the smallest document id in it.

Defined cases
- Null or blank text: no shingles, fingerprint zero; such documents link like any other.
- Fewer words than a shingle: the whole sequence is the one shingle.
- Repeated rows, or several texts under one id: each row is judged by its own text; of
  the rows that repeat a staying id, ``dedup_simhash`` returns one.
- A null id: the row gets its fingerprint and component but never names a component (a
  component of null ids alone has a null id), and does not stay.
- Other columns play no part; ``dedup_simhash`` carries them through under any name.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.llm.blocks import bucket_blocks, link_blocks
from daycast.llm.common import col, salted_join, stage_table, word_pieces
from daycast.llm.components import components

BITS = 64
FLUSH = 1 << 18


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprint_batch(texts: list[bytes | None], words_per_shingle: int = 3, seed: int = 42) -> np.ndarray:
    """The SimHash of each text, as unsigned 64-bit integers."""
    totals = np.zeros((len(texts), BITS), np.int64)
    sizes = np.zeros(len(texts), np.int64)
    digest, w = xxhash.xxh64_intdigest, words_per_shingle
    hashes: list[int] = []
    owners: list[int] = []
    starts: list[int] = []

    def flush() -> None:
        if not hashes:
            return
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ends = [*starts[1:], len(hashes)]
        for d, s, e in zip(owners, starts, ends, strict=True):
            totals[d] += bits[s:e].sum(axis=0, dtype=np.int32)
            sizes[d] += e - s
        hashes.clear(), owners.clear(), starts.clear()

    for d, raw in enumerate(texts):
        if not raw:
            continue
        first = True
        for words in word_pieces(raw.lower(), w - 1):
            if first and 0 < len(words) < w and len(raw) <= 4 << 20:
                got = [digest(b" ".join(words), seed)]
            else:
                got = [digest(b" ".join(t), seed) for t in zip(*(words[k:] for k in range(w)), strict=False)]
            first = False
            if got:
                owners.append(d)
                starts.append(len(hashes))
                hashes += got
                if len(hashes) > FLUSH:
                    flush()
        if len(raw) > 4 << 20 and not sizes[d] and d not in owners:  # long, but hardly any words
            words = raw.lower().split()
            if words:
                owners.append(d)
                starts.append(len(hashes))
                hashes.append(digest(b" ".join(words), seed))
    flush()
    on = (2 * totals > sizes[:, None]).astype(np.uint8)
    return np.packbits(on, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, text_col: str = "text", words_per_shingle: int = 3, out: str = "__fp") -> DataFrame:
    """``docs`` with the SimHash of each text as a long column ``out``."""
    kept = [c for c in docs.columns if c.lower() != out.lower()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = part.column(text_col).cast(pa.binary()).to_pylist()
                fp = pa.array(fingerprint_batch(texts, words_per_shingle).view(np.int64))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), fp], [*kept, out])

    schema = docs.select(*[col(c) for c in kept]).schema.add(out, "long")
    return docs.select(*[col(c) for c in kept]).mapInArrow(run, schema)


def bit_statistics(records: DataFrame) -> tuple[int, np.ndarray]:
    """(records, 64 x 64 counts of two bits set together), over all fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS), np.int64)
        n = 0
        for batch in batches:
            x = np.unpackbits(batch.column(0).to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            for at in range(0, len(x), 1 << 16):
                y = x[at:at + (1 << 16)]
                total += np.rint(y.T @ y).astype(np.int64)
            n += len(x)
        if n:
            i, j = np.triu_indices(BITS)
            yield pa.RecordBatch.from_arrays([pa.array([*i.tolist(), -1]), pa.array([*j.tolist(), -1]), pa.array([*total[i, j].tolist(), n])], ["i", "j", "n"])

    both = np.zeros((BITS, BITS))
    n = 0
    for r in records.select("fp").mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        if r.i < 0:
            n = r.n
        else:
            both[r.i, r.j] = both[r.j, r.i] = r.n
    return n, both


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Cut the bits into ``parts`` of nearly equal width, correlated bits together."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(p * (1 - p))
    with np.errstate(divide="ignore", invalid="ignore"):
        r = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    r = np.nan_to_num(r, nan=0.0, posinf=0.0)
    np.fill_diagonal(r, 0)
    free, found = list(range(BITS)), []
    for k in range(parts):
        width = (BITS - sum(map(len, found))) // (parts - k)
        part = [max(free, key=lambda b: (r[b, free].sum(), -b))]
        free.remove(part[0])
        while len(part) < width:
            best = max(free, key=lambda b: (r[b, part].sum(), -b))
            part.append(best)
            free.remove(best)
        found.append(sorted(part))
    return found


def _within(differ: np.ndarray, most: int) -> np.ndarray:
    """P(at most e of independent bits differ), e = 0..most."""
    at = np.zeros(most + 2)
    at[0] = 1.0
    for p in differ:
        at[1:] = at[1:] * (1 - p) + at[:-1] * p
        at[0] *= 1 - p
    return np.cumsum(at[:most + 1])


def allocate(costs: list[list[float]], total: int) -> list[int]:
    """Thresholds (from -1) of the parts that sum to ``total`` at the least cost;
    ``costs[i][t + 1]`` is the cost of threshold t on part i."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for options in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t, c in enumerate(options, start=-1):
                if used + t not in step or cost + c < step[used + t][0]:
                    step[used + t] = (cost + c, [*chosen, t])
        best = step
    return best[total][1]


def _mask(bits: list[int]) -> int:
    return _signed(sum(1 << b for b in bits))


def probe_masks(records: DataFrame, max_bits: int, part_counts: tuple[int, ...] = (2, 3, 4, 5)) -> list[int]:
    """The bit masks on which near fingerprints must collide: for each part, every choice
    of its bits less its threshold."""
    n, both = bit_statistics(records)
    p = np.diag(both) / max(n, 1)
    differ = 2 * p * (1 - p)
    part_counts = tuple(m for m in part_counts if m <= max_bits + 1) or (1,)
    cut = {m: group_bits(n, both, m) for m in part_counts}
    equal = records.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(_mask(part))).alias("v"))
        for m in part_counts for i, part in enumerate(cut[m])])).alias("e"))
    found = (equal.groupBy("e.m", "e.i", "e.v").agg(F.count(F.lit(1)).cast("double").alias("c"))
             .groupBy("m", "i").agg(F.sum(F.col("c") * (F.col("c") - 1) / 2).alias("pairs")).collect())
    collide = {(r.m, r.i): r.pairs for r in found}
    plans = []
    for m in part_counts:
        costs = []
        for i, part in enumerate(cut[m]):
            near = _within(differ[part], max_bits)
            costs.append([0.0] + [4.0 * n * math.comb(len(part), t) + collide.get((m, i), 0.0) * near[t] / max(near[0], 1e-300)
                                  for t in range(max_bits + 1)])
        t = allocate(costs, max_bits - m + 1)
        plans.append((sum(costs[i][x + 1] for i, x in enumerate(t)), m, t))
    _, m, thresholds = min(plans)
    masks = []
    for part, t in zip(cut[m], thresholds, strict=True):
        if t >= 0:
            masks += [_mask([b for b in part if b not in out]) for out in itertools.combinations(part, t)]
    return masks


def near_links(records: DataFrame, max_bits: int, chunk: int = 2048) -> DataFrame:
    """(a, b) for distinct fingerprints within ``max_bits``: not all links, but enough to
    hang together all that do."""
    masks = probe_masks(records, max_bits)
    entries = records.select(F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("mask", "value"), "fp")
    blocks = bucket_blocks(entries, ["mask", "value"], "fp", chunk)

    def matcher(table: pa.Table):
        fp = table.column("fp").to_numpy().view(np.uint64)
        return lambda i, j: np.bitwise_count(fp[i] ^ fp[j]) <= max_bits

    links = link_blocks(blocks, ["mask", "value"], "fp", [], matcher)
    return links.select(F.col("node").alias("a"), F.col("root").alias("b"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3,
                   max_bits: int = 3) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``fingerprint`` (16 lowercase hex digits) and
    ``component_id`` (the smallest id reachable over links of at most ``max_bits`` differing bits)."""
    texts = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    prints = stage_table(fingerprints(texts, "text", words_per_shingle, "fp").select("id", "fp"))
    records = stage_table(prints.groupBy("fp").agg(F.min("id").alias("first_id")))
    parts = components(near_links(records.select("fp"), max_bits))
    placed = records.join(parts, records.fp == parts.node, "left").select("fp", "first_id", F.coalesce("component", "fp").alias("component"))
    named = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_print = salted_join(placed.select("fp", "component"), named, ["component"]).select("fp", "component_id")
    return salted_join(prints, by_print, ["fp"]).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def dedup_simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3,
                  max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the document with the smallest id, once."""
    groups = simhash_groups(docs, id_col, text_col, words_per_shingle, max_bits)
    stay = groups.where(col(id_col) == F.col("component_id")).select(id_col).distinct()
    rows = docs.join(stay, id_col, "left_semi").select(*[col(c) for c in docs.columns])
    whole = F.struct(*[col(c) for c in docs.columns])
    one = rows.groupBy(col(id_col).alias("__id")).agg(F.min_by(whole, F.xxhash64(col(text_col))).alias("__row"))
    return one.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns])
