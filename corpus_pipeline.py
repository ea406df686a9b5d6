"""A training corpus from ``documents``: language, lines, near copies, mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every
stage's rows as Parquet in the shared checkpoint folder and rereads them as the next
one's documents. All stages but the last return the columns of ``documents``, with
``text`` and ``n_chars`` as they then are.

Defined cases (each operator's docstring has its own)
- Null or letterless texts go with the first stage, as do texts of too narrow a margin.
- A document whose lines all went stays, with an empty text, for the near-copy stage, which
  keeps one of those.
- Rows without a doc_id go with the near-copy stage; of repeated ones it keeps one.
- The mix repeats or leaves out whole documents by their rate; rows that repeat a doc_id
  share the smallest of its rates. A document that is most likely clean stays, at least once,
  whatever its rate, so the others' shares can end above their targets.
- Empty tables give empty results; further columns of ``documents`` are not carried.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.llm.common import on_workers, stage_table
from daycast.llm.language_id import identify_language
from daycast.llm.line_dedup import dedup_lines
from daycast.llm.mixing import copies_of, mix_to_targets
from daycast.llm.packing import pack
from daycast.llm.queries import MIX_TARGETS, labelled_domains, learned_languages, table
from daycast.llm.simhash_dedup import dedup_simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def python_stage(spark: SparkSession) -> None:
    """Ready the session for a stage with Python steps: workers find the package, and Arrow
    batches hold at most 1000 rows, since a batch of whole texts is held outside the heap."""
    on_workers(spark)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= 1000:
        spark.conf.set(rows, "1000")


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with some margin."""
    python_stage(spark)
    return identify_language(docs.select(*COLUMNS), learned_languages(docs)).where(~F.col("rejected")).select(*COLUMNS)


def dedup_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a smaller doc_id holds."""
    kept = dedup_lines(docs.select("doc_id", "text", "lang", "source"))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    python_stage(spark)
    return dedup_simhash(docs.select(*COLUMNS), words_per_shingle=3, max_bits=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate for the target mix says, those most likely clean at least once."""
    rates = mix_to_targets(docs.select("doc_id", "text"), labelled_domains(table(spark, sf_dir, "labels")), MIX_TARGETS, keep="clean")
    clean = F.get("posterior", F.lit(sorted(MIX_TARGETS).index("clean"))) >= F.array_max("posterior")
    times = rates.groupBy("doc_id").agg(F.min("rate").alias("rate"), F.max(clean.cast("long")).alias("least"))
    times = times.select("doc_id", F.greatest(copies_of(F.col("rate"), F.col("doc_id")), F.col("least")).alias("copies")).where("copies > 0")
    return docs.select(*COLUMNS).join(times, "doc_id").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048."""
    python_stage(spark)
    packed = pack(docs, public_tokenizers.path("byte_bpe_50k.json"), max_len=2048, end_id=1)
    return packed.withColumn("ids_crc32", F.crc32("token_bytes"))


STAGES = [
    ("language_id", identify),
    ("line_dedup", dedup_shared_lines),
    ("simhash_dedup", dedup_near_copies),
    ("mixing", mix),
    ("packing", pack_sequences),
]

#: The first stage compresses texts, which SQL can't express; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
