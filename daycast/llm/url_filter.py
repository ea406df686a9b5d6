"""URL filter rules by a cascade of Bloom filters.

A rule is a host and a path: it fits the host and all its subdomains where the url's path
starts with the rule's. So every rule is one key (host followed by path), and a url's
candidate keys are few: for each (labels in the host, length of the path) that some rule
has, the url's last labels and first path characters. The key universe is the set of all
candidate keys of the whole corpus.

For that universe a cascade answers exactly whether a key is listed, without a join:
level 1 holds the listed keys, level 2 the universe's keys that pass level 1 without
being listed, level 3 the listed keys that pass level 2, and so on until a level lets
nothing wrong pass. A key is judged by the first level that does not hold it. Each list
(block, allow) has its own cascade. Filter words are literals of the plan; their size
follows the number of listed keys (and the logarithm of the universe), and is checked
against ``max_filter_bytes`` before it reaches the driver.

Defined cases
- Null url, or no ``://``: host and path empty; only a rule with an empty host and path fits.
- Hosts and paths are text: a port or user name stays part of the host.
- Several rules fit: the longest key wins, then the longer host; a key in both lists blocks.
- Rules with a null host, path or verdict are left out; no rules: every url is allowed.
- No rule fits: the url's keys are in no list, and the verdict is allow.
- Repeated urls and rules change nothing; each row is judged by itself.
- Input columns named like an output are replaced by it; all others are carried through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycast.llm.common import ascii_lower, col, others, stage_table

MAX_LEVELS = 64
WORD_BITS = 64


@dataclass(frozen=True)
class BloomLevel:
    """One filter: ``bits`` positions in 64-bit ``words``, ``hashes`` probes, its own seed."""

    seed: int
    bits: int
    hashes: int
    words: tuple[int, ...]

    def holds(self, key: Column) -> Column:
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")  # folded to one literal
        hit = F.lit(True)
        for p in _positions(key, self.seed, self.bits, self.hashes):
            word = F.get(words, F.shiftright(p, 6).cast("int"))
            hit = hit & _bit(word, p)
        return hit


def _bit(word: Column, position: Column) -> Column:
    return F.call_function("shiftrightunsigned", word, position.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1


def _positions(key: Column, seed: int, bits: int, hashes: int) -> list[Column]:
    mask = F.lit((1 << 48) - 1)
    a = F.xxhash64(F.lit(2 * seed), key).bitwiseAND(mask)
    b = F.xxhash64(F.lit(2 * seed + 1), key).bitwiseAND(mask)
    return [F.pmod(a + b * F.lit(i).cast("long"), F.lit(bits).cast("long")) for i in range(hashes)]


@dataclass(frozen=True)
class Cascade:
    levels: tuple[BloomLevel, ...]

    def holds(self, key: Column) -> Column:
        """Whether ``key`` is listed; exact for the keys of the universe it was built over."""
        if not self.levels:
            return F.lit(False)
        answer = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            answer = F.when(self.levels[i].holds(key), answer).otherwise(F.lit(i % 2 == 1))
        return answer

    @property
    def n_bytes(self) -> int:
        return sum(8 * len(x.words) for x in self.levels)


def build_level(keys: DataFrame, n: int, rate: float, seed: int, max_filter_bytes: int) -> BloomLevel:
    """A Bloom filter of the column ``key``: positions set by a distributed bit_or per word."""
    bits = max(WORD_BITS, WORD_BITS * math.ceil(n * math.log(1 / rate) / math.log(2) ** 2 / WORD_BITS))
    if bits > 8 * max_filter_bytes:
        raise ValueError(f"a filter of {n} keys takes {bits // 8} bytes; max_filter_bytes is {max_filter_bytes}")
    hashes = max(1, round(math.log(2) * bits / max(n, 1)))
    hashes = min(hashes, max(1, math.ceil(math.log2(1 / rate))))
    spots = keys.select(F.explode(F.array(*_positions(F.col("key"), seed, bits, hashes))).alias("p"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))
    rows = spots.groupBy(F.shiftright("p", 6).alias("i")).agg(F.bit_or(one).alias("w")).collect()
    words = [0] * (bits // WORD_BITS)
    for r in rows:
        words[r.i] = r.w
    return BloomLevel(seed, bits, hashes, tuple(words))


def build_cascade(universe: DataFrame, listed: str, max_filter_bytes: int = 64 << 20, seed: int = 1) -> Cascade:
    """The cascade of the keys of ``universe`` (columns ``key`` and the boolean ``listed``).

    The first level's rate balances listed keys against the rest of the universe; every
    later level halves what is still wrong. Each level is one pass over the keys that the
    level before got wrong.
    """
    n = universe.agg(F.count_if(F.col(listed)).alias("yes"), F.count_if(~F.col(listed)).alias("no")).first()
    inside, outside = universe.where(F.col(listed)).select("key"), universe.where(~F.col(listed)).select("key")
    n_in, n_out = n.yes, n.no
    levels: list[BloomLevel] = []
    rate = min(0.5, math.sqrt(0.5) * n_in / n_out) if n_in and n_out else 0.5
    while n_in:
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascade does not end; the listed keys and the rest hash alike")
        level = build_level(inside, n_in, rate, seed + len(levels), max_filter_bytes)
        levels.append(level)
        if not n_out:
            break
        wrong = stage_table(outside.where(level.holds(F.col("key"))))
        outside, n_out = inside, n_in
        inside, n_in = wrong, wrong.count()
        rate = 0.5
    return Cascade(tuple(levels))


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): the host after the first ``://`` with A-Z lowered, the path up to ? or #."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _candidates(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The url's keys, as an array of (key, host length): one for each shape it is long enough for."""
    labels = F.char_length(host) - F.char_length(F.replace(host, F.lit("."), F.lit(""))) + 1
    found = []
    for n, size in shapes:
        end = F.substring_index(host, ".", -n)
        key = F.concat(end, F.substring(path, 1, size))
        found.append(F.when((labels >= n) & (F.char_length(path) >= size),
                            F.struct(key.alias("key"), F.char_length(end).alias("host_len"))))
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<struct<key:string,host_len:int>>")


def filter_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", max_filter_bytes: int = 64 << 20,
                max_shapes: int = 4096) -> DataFrame:
    """Judge every url by ``rules`` (host, path, verdict 'allow' or 'block').

    Returns the input's columns with ``host``, ``path``, ``rule`` (the winning rule's host
    and path, else null) and ``verdict`` ('allow' or 'block'; 'allow' where no rule fits).
    """
    rules = (rules.select(ascii_lower(F.col("host")).alias("host"), "path", "verdict").dropna()
             .where(F.col("verdict").isin("allow", "block")))
    n_labels = F.char_length("host") - F.char_length(F.replace(F.col("host"), F.lit("."), F.lit(""))) + 1
    shapes = [tuple(r) for r in rules.select(n_labels, F.char_length("path")).distinct().limit(max_shapes + 1).collect()]
    if len(shapes) > max_shapes:
        raise ValueError(f"the rules have more than {max_shapes} forms (host labels, path length)")
    shapes = sorted(shapes)
    outputs = ["host", "path", "rule", "verdict"]
    host, path = split_url(col(url_col))
    rest = [c.alias(f"__in{i}") for i, c in enumerate(others(pages, outputs))]
    names = [c for c in pages.columns if c.lower() not in outputs]
    split = pages.select(*rest, host.alias("host"), path.alias("path"))
    keyed = split.withColumn("__keys", _candidates(F.col("host"), F.col("path"), shapes))

    no = F.lit(False)
    seen = keyed.select(F.explode("__keys.key").alias("key"), no.alias("block"), no.alias("allow"))
    told = rules.select(F.concat("host", "path").alias("key"), (F.col("verdict") == "block").alias("block"),
                        (F.col("verdict") == "allow").alias("allow"))
    universe = stage_table(seen.unionByName(told).groupBy("key").agg(F.bool_or("block").alias("block"), F.bool_or("allow").alias("allow")))
    block = build_cascade(universe, "block", max_filter_bytes, seed=1)
    allow = build_cascade(universe, "allow", max_filter_bytes, seed=1 + MAX_LEVELS)

    def judged(k: Column) -> Column:
        verdict = F.when(block.holds(k["key"]), F.lit("block")).when(allow.holds(k["key"]), F.lit("allow"))
        return F.struct(F.char_length(k["key"]).alias("len"), k["host_len"].alias("host_len"), k["key"].alias("key"), verdict.alias("verdict"))

    best = F.array_max(F.filter(F.transform("__keys", judged), lambda j: j["verdict"].isNotNull()))
    return (keyed.withColumn("__best", best)
            .select(*[F.col(f"__in{i}").alias(c) for i, c in enumerate(names)], "host", "path",
                    F.col("__best.key").alias("rule"),
                    F.coalesce(F.col("__best.verdict"), F.lit("allow")).alias("verdict")))
