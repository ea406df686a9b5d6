"""The registered queries of the training-data operators, with DuckDB SQL where it can say the same.

Each query applies its operator to the whole table and derives its contract's columns."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.llm.common import on_workers
from daycast.llm.hard_negatives import mine_hard_negatives
from daycast.llm.language_id import identify_language, learn_dictionaries
from daycast.llm.license_scan import scan_licenses
from daycast.llm.line_dedup import dedup_lines
from daycast.llm.mixing import copies_of, fit_mix
from daycast.llm.packing import pack
from daycast.llm.simhash_dedup import simhash_groups
from daycast.llm.spelling_variants import group_variants
from daycast.llm.substring_dedup import dedup_substrings
from daycast.llm.token_counts import count_tokens
from daycast.llm.topk_search import search_top_k
from daycast.llm.url_filter import filter_urls
from daycast.llm.vector_dedup import dedup_vectors

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            on_workers(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256_of(text) -> F.Column:
    return F.sha2(text.cast("binary"), 256)


LINE_DEDUP_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(range(len(parts))) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
shared AS (
  SELECT k, min(doc_id) AS holder FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
judged AS (
  SELECT keyed.*, coalesce(keyed.doc_id <> shared.holder, false) AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@register("op1_line_dedup", LINE_DEDUP_SQL)
def op1_line_dedup(spark, sf_dir):
    """Lines of at least 10 code points found in two documents stay only in the smallest doc_id."""
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", sha256_of(F.col("text")).alias("kept_sha256"))


URL_RULES = """SELECT * FROM VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
('org', '/fr/', 'allow') AS rules(host, path, verdict)"""

URL_FILTER_SQL = """
WITH rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
urls AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
fits AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(rule_verdict, length(rule_host || rule_path)) AS verdict
  FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN fits USING (page_id)
"""


@register("op2_url_filter", URL_FILTER_SQL)
def op2_url_filter(spark, sf_dir):
    """Every page's url judged by four host and path rules."""
    judged = filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), spark.sql(URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def held_out(id_col: str = "doc_id") -> F.Column:
    """The share of documents that no language is learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def learned_languages(docs: DataFrame) -> dict[str, bytes]:
    return learn_dictionaries(docs.where(~held_out() & F.col("lang").isNotNull()))


@register("op10_language_id")
def op10_language_id(spark, sf_dir):
    """The language of every whole text, learned from three quarters of the labelled documents."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return identify_language(rows, learned_languages(docs)).select("doc_id", "held_out", "lang_pred", "score", "rejected")


@register("op9_simhash_dedup")
def op9_simhash_dedup(spark, sf_dir):
    """Groups of documents by 3-word shingle SimHash within 3 differing bits."""
    return simhash_groups(table(spark, sf_dir, "documents"), words_per_shingle=3, max_bits=3)


#: Shares of the tokens that the mix should have, by the domain of the labels; those of low and toxic
#: are limits, and a table that has less of them keeps its own shares.
MIX_TARGETS = {"clean": 0.92, "low": 0.06, "toxic": 0.02}


def labelled_domains(labels: DataFrame) -> DataFrame:
    """The domain of each label: toxic, else low (quality 0) or clean."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "clean").alias("domain"))


@register("op3_mixing")
def op3_mixing(spark, sf_dir):
    """Rates at which the documents' expected tokens by domain have the target shares, or the
    table's own of low and toxic where those are smaller; each row names the targets fitted
    and the shares reached."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    mix = fit_mix(docs, labelled_domains(table(spark, sf_dir, "labels")), MIX_TARGETS, keep="clean")
    shares = [F.get("posterior", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(sorted(MIX_TARGETS))]
    fitted = [F.lit(x).alias(f"{kind}_{d}") for kind, by in (("target", mix.targets), ("reached", mix.reached)) for d, x in by.items()]
    return mix.rates.select("doc_id", "n_tokens", *shares, "rate", copies_of(F.col("rate"), F.col("doc_id")).alias("copies"), *fitted)


SUBSTRING_DEDUP_SQL = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS pos FROM texts WHERE len(words) >= 20),
later AS (
  SELECT doc_id, pos FROM starts
  QUALIFY row_number() OVER (PARTITION BY array_to_string(words[pos:pos + 19], ' ') ORDER BY doc_id, pos) > 1),
every AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS pos, unnest(words) AS word FROM texts),
judged AS (
  SELECT every.doc_id, every.pos, word, max(coalesce(later.pos, -100)) OVER (PARTITION BY every.doc_id ORDER BY every.pos) > every.pos - 20 AS gone
  FROM every LEFT JOIN later ON later.doc_id = every.doc_id AND later.pos = every.pos)
SELECT doc_id, count(word) AS n_words, count(word) FILTER (WHERE gone) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM texts LEFT JOIN judged USING (doc_id) GROUP BY doc_id
"""


@register("op4_substring_dedup", SUBSTRING_DEDUP_SQL)
def op4_substring_dedup(spark, sf_dir):
    """Words of 20-word windows that also start earlier are removed."""
    kept = dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"), window=20)
    return kept.select("doc_id", "n_words", "n_removed", sha256_of(F.col("text")).alias("kept_sha256"))


EMBEDDING_DEDUP_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS one, b.vec_id AS other FROM good a JOIN good b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.vec_id, links.other FROM reach JOIN links ON reach.other = links.one)
SELECT vec_id, (SELECT count(*) FROM links WHERE one = vec_id) AS n_links, min(other) AS component_id, vec_id = min(other) AS kept
FROM reach GROUP BY vec_id
"""


@register("op5_embedding_dedup", EMBEDDING_DEDUP_SQL)
def op5_embedding_dedup(spark, sf_dir):
    """Vectors linked at a cosine of at least 0.95, and their components."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return dedup_vectors(vectors, min_cosine=0.95).select("vec_id", "n_links", "component_id", "kept")


@register("op6_packing")
def op6_packing(spark, sf_dir):
    """All documents' tokens in sequences of at most 2048."""
    packed = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), max_len=2048, end_id=1)
    return packed.select("doc_id", "start", "length", F.crc32("token_bytes").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@register("op7_token_counts")
def op7_token_counts(spark, sf_dir):
    """Tokens of every whole text, and the longest prefix within 1024 of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), budget=1024, store=False)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"), "fitting_chars")


TOP_K_SQL = """
WITH rows AS (
  SELECT vec_id, [floor(CAST(x AS DOUBLE) * 256) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM rows q JOIN rows c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""


@register("op8_topk_search", TOP_K_SQL)
def op8_topk_search(spark, sf_dir):
    """The five best inner products of every fiftieth vector."""
    return search_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


@register("op11_spelling_variants")
def op11_spelling_variants(spark, sf_dir):
    """Frequent words with their near words, forms and roots; one run in 97 loses a letter."""
    return group_variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


HARD_NEGATIVES_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(CAST(x AS DOUBLE) * 256) FOR x IN embedding] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM rows a JOIN rows c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
best AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
fitting AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score
  FROM best JOIN scored USING (anchor_id) WHERE NOT same AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) AS INTEGER) AS rank,
       negative_id, positive_score, negative_score
FROM fitting QUALIFY rank <= 3
"""


@register("op12_hard_negatives", HARD_NEGATIVES_SQL)
def op12_hard_negatives(spark, sf_dir):
    """Three hard negatives for each of the five best positives of every fiftieth vector; every
    seventh vector's label is moved on by one first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label, positives=5, negatives=3, low=50, high=95, scale=256.0)


@register("op13_license_scan")
def op13_license_scan(spark, sf_dir):
    """Places of three license phrases in every whole text, and the labels of all signature rules."""
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@register("pipeline")
def pipeline(spark, sf_dir):
    """The five stages of corpus_pipeline over ``documents``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
