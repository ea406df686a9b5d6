"""Language identification by compression: a text is in the language whose dictionary
lets zstandard encode it in the fewest bytes.

Texts are lower-cased first. Each language's dictionary is raw content: a bounded sample of
whole texts labelled with it (those of at most ``sample_bytes`` bytes first, then by their hash, so the
sample does not depend on row order or partitions). A whole text is encoded in chunks of ``chunk_bytes``, each against every
dictionary, since only the start of a long frame would profit from a dictionary. The
result is the language of the smallest total (short matches count, so the encoder looks
for matches of 4 bytes on; at the fast levels' longer ones a short text's sizes tie); the margin is the saving against the
second smallest, as a share of it, and a text with a margin under ``min_margin`` is
rejected. The dictionaries are the only thing sent to the tasks: at most
``max_languages`` times ``sample_texts`` texts, of at most ``sample_bytes`` bytes each
wherever a language has so many texts of that size.

Defined cases
- Null text, or no letter in it: language ``und``, score 0, rejected.
- Equal sizes: the alphabetically first language, margin 0.
- No labelled text at all: every text is ``und`` and rejected; one language: margin 1.
- Labelled rows with a null or blank text or a null language teach nothing; repeats of a
  text count once per language.
- Input columns named like an output are replaced by it; all others are carried through.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.llm.common import col, text_slices

UNKNOWN = "und"
OUTPUTS = ["lang_pred", "score", "rejected"]


def learn_dictionaries(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_texts: int = 64,
                       sample_bytes: int = 4096, max_languages: int = 64) -> dict[str, bytes]:
    """Raw-content dictionaries by language, from at most ``sample_texts`` whole texts each;
    longer ones than ``sample_bytes`` only where a language has too few others."""
    from pyspark.sql import Window

    rows = labelled.select(col(lang_col).cast("string").alias("lang"), col(text_col).cast("string").alias("text")).where(
        "lang IS NOT NULL AND trim(text) <> ''").withColumn("hash", F.xxhash64("text")).withColumn("long", F.octet_length("text") > sample_bytes)
    # in two steps, the first of them salted: one language may have nearly all rows
    part = rows.select("lang", "long", "hash", F.pmod("hash", F.lit(64)).alias("salt")).distinct()
    for by in (["lang", "salt"], ["lang"]):
        part = part.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy("long", "hash"))).where(F.col("rank") <= sample_texts)
    chosen = part.groupBy("lang").agg(F.max(F.struct("long", "hash")).alias("last"))
    limits = chosen.limit(max_languages + 1).collect()
    if len(limits) > max_languages:
        raise ValueError(f"the labelled texts name more than {max_languages} languages")
    if not limits:
        return {}
    taken = F.lit(False)
    for r in limits:
        within = F.col("hash") <= r["last"]["hash"]
        taken = taken | ((F.col("lang") == r.lang) & ((F.col("long") & within | ~F.col("long")) if r["last"]["long"] else (~F.col("long") & within)))
    found = rows.where(taken).groupBy("lang", "long", "hash").agg(F.min("text").alias("text")).orderBy("lang", "long", "hash").collect()
    out: dict[str, list[str]] = {}
    for r in found:
        out.setdefault(r.lang, []).append(r.text)
    return {k: "\n".join(v).lower().encode() for k, v in sorted(out.items())}


class Encoder:
    """Sizes of a text under each language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], chunk_bytes: int = 4096) -> None:
        self.languages = sorted(dictionaries)
        self.chunk_bytes = chunk_bytes
        self.encoders = []
        rules = zstandard.ZstdCompressionParameters(window_log=19, chain_log=16, hash_log=17, search_log=3, min_match=4, strategy=zstandard.STRATEGY_LAZY,
                                                    write_content_size=0, write_checksum=0, write_dict_id=0)
        for name in self.languages:
            content = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=rules)
            self.encoders.append(zstandard.ZstdCompressor(dict_data=content, compression_params=rules))

    def sizes(self, raw: bytes) -> list[int]:
        step = self.chunk_bytes
        chunks = [raw[k:k + step] for k in range(0, len(raw), step)]
        return [sum(len(e.compress(c)) for c in chunks) for e in self.encoders]

    def judge(self, text: str | None) -> tuple[str, float]:
        """(language, margin) of one text."""
        if text is None or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        sizes = self.sizes(text.lower().encode())
        if len(sizes) == 1:
            return self.languages[0], 1.0
        best, second = sorted(sizes)[:2]
        return self.languages[sizes.index(best)], (second - best) / second


def identify_language(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", min_margin: float = 0.001,
                      chunk_bytes: int = 4096) -> DataFrame:
    """The input's columns with ``lang_pred``, ``score`` (the margin, 0 to 1) and ``rejected``
    (unknown language, or a margin under ``min_margin``)."""
    names = [c for c in docs.columns if c.lower() not in OUTPUTS]
    kept = [f"__in{i}" for i in range(len(names))]  # Python steps can't name columns with dots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(dictionaries, chunk_bytes)
        for part in (part for batch in batches for part in text_slices(batch, "__text")):
            judged = [encoder.judge(t) for t in part.column("__text").to_pylist()]
            names, scores = [x[0] for x in judged], [x[1] for x in judged]
            rejected = [n == UNKNOWN or s < min_margin for n, s in judged]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in kept), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                [*kept, *OUTPUTS])

    rows = docs.select(*[col(c).alias(k) for c, k in zip(names, kept, strict=True)], col(text_col).cast("string").alias("__text"))
    schema = rows.drop("__text").schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return rows.mapInArrow(run, schema).toDF(*names, *OUTPUTS)
