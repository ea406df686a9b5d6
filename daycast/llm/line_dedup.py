"""Line de-duplication: explode normalised lines, hash, count the distinct documents of
each hash, drop the lines of hashes over the threshold, reassemble by position.

The hashes travel, not the lines: one 16-byte digest with the document's id and the
line's position, written once as a stage table. Counting is a two-level aggregate (first (hash, document), then hash),
both combined before their shuffle, so a line that every document holds is no hot task;
the way back to the lines is a join salted by document. The texts are shuffled once, to
meet the positions they lose.

Defined cases
- Null or empty text: one empty line, which is kept; the text returned is empty.
- Rows that repeat a document id are the same document: none of them is another holder
  of the line, and each row keeps or loses its own lines by that document's standing.
- A null document id: the row is kept whole and is no holder of its lines.
- A line that is empty or shorter than ``min_chars`` after normalisation is always kept.
- A document all of whose lines go stays as a row with an empty text.
- Input columns named like an output are replaced by it; all others are carried through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycast.llm.common import ASCII_SPACE, ascii_lower, col, others, stage_table, text_of

SALTS = 8


def line_key(line: Column) -> Column:
    """The form in which lines are compared: ASCII space stripped at both ends, A-Z lowered."""
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                min_docs: int = 2) -> DataFrame:
    """Drop every line whose key has at least ``min_chars`` code points and is found in at
    least ``min_docs`` documents, except in the smallest document id that holds it.

    Returns the input's columns with ``text_col`` rewritten, and ``n_lines`` (before
    dropping) and ``n_dropped`` as longs.
    """
    base = docs.select(
        *others(docs, [text_col, "n_lines", "n_dropped"]),
        F.split(text_of(text_col), "\n").alias("__lines"), F.xxhash64(text_of(text_col)).alias("__version"))
    lines = (base.where(col(id_col).isNotNull())
             .select(col(id_col).alias("id"), F.col("__version").alias("version"), F.posexplode("__lines").alias("pos", "line"))
             .select("id", "version", "pos", line_key(F.col("line")).alias("key"))
             .where(F.char_length("key") >= min_chars)
             .select("id", "version", "pos", F.unhex(F.md5(F.col("key").cast("binary"))).alias("hash")))
    lines = stage_table(lines)  # read twice below; far smaller than the texts they come from
    shared = (lines.groupBy("hash").agg(F.count_distinct("id").alias("n_docs"), F.min("id").alias("first_id"))
              .where(F.col("n_docs") >= min_docs)
              .select("hash", "first_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    dropped = (lines.withColumn("salt", F.pmod(F.xxhash64("id", "pos"), F.lit(SALTS)).cast("int"))
               .join(shared, ["hash", "salt"]).where(F.col("id") != F.col("first_id"))
               .groupBy("id", "version").agg(F.collect_set("pos").alias("__dropped"))
               .select(F.col("id").alias("__id"), F.col("version").alias("__drop_version"), "__dropped"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__dropped"))
    joined = base.join(dropped, (col(id_col) == F.col("__id")) & (F.col("__version") == F.col("__drop_version")), "left")
    out = {
        text_col: F.when(F.col("__dropped").isNull(), F.array_join("__lines", "\n"))
        .otherwise(F.array_join(F.transform(kept, lambda i: F.get("__lines", i)), "\n")),
        "n_lines": F.size("__lines").cast("long"),
        "n_dropped": F.coalesce(F.size("__dropped"), F.lit(0)).cast("long"),
    }
    order = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")] + ["n_lines", "n_dropped"]
    by_name = {k.lower(): v for k, v in out.items()}
    return joined.select(*[by_name[c.lower()].alias(c) if c.lower() in by_name else col(c) for c in order])
