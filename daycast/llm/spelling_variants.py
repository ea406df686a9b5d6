"""Groups of spelling variants, by permuterm rotations.

Words are counted over the whole corpus (combined by batch, then by task, before the
shuffle). A word w of L code points, marked with a terminator as w$, has L + 1 rotations.
With w = a c b, the rotation that ends in c is b $ a c; its prefix b $ a skips the character
c. So

- words that differ by a replacement of c have a rotation each with the same prefix b $ a,
  followed by another character, and
- the word a b, without c, has the rotation b $ a itself: an indel.

In the sorted rotations, all of these stand together: the range of the prefix b $ a, cut
off after one more character. The rotations are dealt by that prefix, sorted, and each
range is scanned once: its members are all near each other and differ in the skipped
character, so a range has at most one member more than there are letters, whatever the
corpus. The scan gives each member how many others are near and which is the best; no pair
is written out. An indel beside an equal letter is found at several places (the two l of
"hello"); it counts at the first only.

A word's form is its near word of largest n, if that is at least ``factor`` times its own
n. Counts grow along forms by that factor, so chains are short; roots are found by pointer
doubling over (word, form) pairs, in as many joins as the logarithm of the longest chain.

Words travel as numbers that rise in code-point order (they are sorted by range once), so
ties go to the smaller word without its text. Prefixes of over ``LONG`` code points are
replaced by a 127-bit polynomial hash, made from running sums: a word of a million letters costs
rows in proportion to its length, not its square.

Defined cases
- Null or empty text: no words. A null id counts as an empty one in the deletion's hash.
- Repeated rows are counted again. Ties of n: the smaller word in code-point order.
- An empty table, or one without frequent words, gives no rows. Other columns play no part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daycast.llm.common import col, stage_table, text_slices

#: Runs of letters in a text whose A-Z are lowered.
RUN = re.compile("[a-zÀ-ÿ]+")
END = "$"
LONG = 64
MODULUS, BASE = (1 << 127) - 1, 0x5DEECE66D
_HELD = 1 << 17


def misspelt(doc_id: object, run: str, one_in: int) -> str:
    """The run, or where ``one_in`` divides the crc32 of "<doc_id>:<run>", without the code
    point at that hash modulo the run's length."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % one_in:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def runs(raw: bytes) -> Iterator[tuple[str, int]]:
    """The distinct runs of a text and how often each occurs; a long text is counted in parts."""
    text = raw.lower().decode("utf-8", "replace")  # bytes: only A-Z are lowered
    if len(text) <= 1 << 20:
        yield from Counter(RUN.findall(text)).items()
        return
    counts: Counter = Counter()
    for m in RUN.finditer(text):
        counts[m.group()] += 1
        if len(counts) > _HELD:
            yield from counts.items()
            counts.clear()
    yield from counts.items()


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_in: int = 97, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """(word, n) of the words of at least ``min_length`` code points that occur ``min_count`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return made

        for batch in batches:
            for part in text_slices(batch, "text"):
                for doc_id, raw in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    for word, n in runs(raw or b""):
                        if len(word) < min_length:
                            continue  # a deletion only makes it shorter
                        if not zlib.crc32(word.encode(), head) % one_in:
                            word = misspelt(doc_id, word, one_in)
                            if len(word) < min_length:
                                continue
                        counts[word] += n
                if len(counts) > _HELD:
                    yield out()
        if counts:
            yield out()

    texts = docs.select(col(id_col).cast("string").alias("id"), col(text_col).cast("string").cast("binary").alias("text"))
    found = texts.mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").cast("long").alias("n")).where(F.col("n") >= min_count)


def rotations(word: str) -> Iterator[tuple[str, str, bool]]:
    """(prefix, the character that follows it in a rotation, whether an indel counts here).

    For every rotation of the marked word: once with its last character skipped, and once as
    the whole prefix, followed by nothing. The rotation that ends in the terminator has no
    character to skip."""
    size = len(word)
    if size < LONG:
        for i in range(size):
            yield word[i + 1:] + END + word[:i], word[i], not i or word[i - 1] != word[i]
            yield word[i:] + END + word[:i], "", False
        yield END + word, "", False
        return
    # sums[i]: the hash of word[:i]; a prefix b $ a has hash(b $) * BASE^len(a) + hash(a)
    sums, powers = [0], [1]
    for c in word:
        sums.append((sums[-1] * BASE + ord(c)) % MODULUS)
        powers.append(powers[-1] * BASE % MODULUS)

    def key(start: int, stop: int) -> str:
        """word[start:] $ word[:stop], by its hash and length where it is long."""
        n = size - start + 1 + stop
        if n <= LONG:
            return word[start:] + END + word[:stop]
        rest = (sums[size] - sums[start] * powers[size - start]) * BASE + ord(END)
        return f"{END}{END}{n}:{(rest * powers[stop] + sums[stop]) % MODULUS:x}"

    for i in range(size):
        yield key(i + 1, i), word[i], not i or word[i - 1] != word[i]
        yield key(i, i), "", False
    yield key(size, size), "", False


def _entries(words: DataFrame) -> DataFrame:
    """(prefix, skipped, first, id, n): the rows of every word's rotations."""
    size = 1 << 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["prefix", "skipped", "first", "id", "n"]
        rows: list[list] = [[], [], [], [], []]

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, (pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64()), strict=True)], names)
            for v in rows:
                v.clear()
            return made

        for batch in batches:
            for part in text_slices(batch, "word"):
                for word, id_, n in zip(part.column("word").to_pylist(), part.column("id").to_pylist(), part.column("n").to_pylist(), strict=True):
                    for prefix, skipped, first in rotations(word):
                        for v, x in zip(rows, (prefix, skipped, first, id_, n), strict=True):
                            v.append(x)
                        if len(rows[0]) >= size:
                            yield out()
        if rows[0]:
            yield out()

    return words.select("id", "word", "n").mapInArrow(run, "prefix string, skipped string, first boolean, id long, n long")


def neighbours(words: DataFrame) -> DataFrame:
    """(id, n_near, best_n, best_id) of the ``words`` (id, word, n) that have a near word."""
    ranged = Window.partitionBy("prefix")
    ranked = ranged.orderBy(F.desc("n"), "id")
    whole = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    member = F.struct(F.col("n"), F.col("id"))
    scanned = _entries(words).select(
        "id", "skipped", "first", F.row_number().over(ranked).alias("place"), F.first(member).over(whole).alias("one"), F.nth_value(member, 2).over(whole).alias("two"),
        F.count_if(F.col("skipped") != "").over(whole).alias("n_skipped"), F.count_if("first").over(whole).alias("n_first"),
        F.count_if(F.col("skipped") == "").over(whole).alias("n_whole")).where(F.col("two").isNotNull())
    near = F.when(F.col("skipped") == "", F.col("n_first")).otherwise(F.col("n_skipped") - 1 + F.when(F.col("first"), F.col("n_whole")).otherwise(0))
    best = F.when(F.col("place") == 1, F.col("two")).otherwise(F.col("one"))
    by_word = scanned.select("id", near.alias("near"), best["n"].alias("best_n"), best["id"].alias("best_id")).groupBy("id").agg(
        F.sum("near").alias("n_near"), F.max(F.struct(F.col("best_n"), -F.col("best_id"))).alias("best"))
    return by_word.select("id", F.col("n_near").cast("long").alias("n_near"), F.col("best.best_n").alias("best_n"), (-F.col("best.col2")).alias("best_id"))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) from (id, form): the last of each chain, by pointer doubling. A word is the
    form of at most as many words as it has near ones, so no key of these joins is hot."""
    steps = stage_table(forms.select("id", F.col("form").alias("root")))
    while True:
        onward = steps.select(F.col("id").alias("root"), F.col("root").alias("next"))
        moved = stage_table(steps.join(onward, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not moved.where("moved").limit(1).collect():
            return moved.select("id", "root")
        steps = moved.select("id", "root")


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_in: int = 97, min_length: int = 5, min_count: int = 3,
                   factor: int = 2) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every frequent word; ``one_in``: the share of
    runs that lose a letter, planted so that variants exist (see ``misspelt``)."""
    counted = stage_table(count_words(docs, id_col, text_col, one_in, min_length, min_count))
    spark = counted.sparkSession
    # sorted by range once: a row's number rises with its word
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = stage_table(counted.repartitionByRange(parts, "word").sortWithinPartitions("word").withColumn("id", F.monotonically_increasing_id()))
    near = stage_table(neighbours(words))
    forms = near.join(words.select("id", "n"), "id").where(F.col("best_n") >= factor * F.col("n")).select("id", F.col("best_id").alias("form"), F.col("best_n").alias("form_n"))
    forms = stage_table(forms)
    known = words.join(near.select("id", "n_near"), "id", "left").join(forms, "id", "left").join(roots(forms), "id", "left")
    names = words.select(F.col("id"), F.col("word"))
    named = known.join(names.toDF("form", "form_word"), "form", "left").join(names.toDF("root", "root_word"), "root", "left")
    return named.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("form_word").alias("form"), "form_n",
                        F.coalesce("root_word", "word").alias("root"))
