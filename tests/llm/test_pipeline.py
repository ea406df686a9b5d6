import pytest

import corpus_pipeline as P
from tests.llm import brute
from tests.llm.conftest import SF
from tests.llm.test_line_dedup import plain as plain_lines


def test_stages_are_the_five_in_order():
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "simhash_dedup", "mixing", "packing"]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows of every stage over the smallest tables, each from its predecessor's."""
    from daycast.llm.common import stage_table
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for _, stage in P.STAGES:
        out.append(stage_table(stage(spark, out[-1], SF)))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_all_but_the_last_return_documents(stages):
    for df in stages[1:-1]:
        assert df.columns == P.COLUMNS and df.dtypes == stages[0].dtypes
        assert all(r.n_chars == len(r.text) for r in df.select("text", "n_chars").collect())


def test_language_stage_keeps_clean_documents(stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert after.items() <= before.items() and len(after) >= 0.97 * len(before)
    assert all(len(brute.split_words(before[d])) < 60 or len(set(before[d].split())) < 40 for d in before.keys() - after.keys())


def test_line_stage_matches_plain(stages):
    before, after = texts(stages[1]), texts(stages[2])
    want = plain_lines(list(before.items()))
    assert after == {d: want[d, t][0] for d, t in before.items()}


def test_near_copy_stage_matches_plain(stages):
    before, after = texts(stages[2]), texts(stages[3])
    want = brute.simhash_components(before)
    assert after == {d: before[d] for d, (_, c) in want.items() if c == d}


def test_mix_stage_repeats_whole_documents(stages):
    before = texts(stages[3])
    rows = [(r.doc_id, r.text) for r in stages[4].select("doc_id", "text").collect()]
    assert {t == before[d] for d, t in rows} == {True}
    assert len({d for d, _ in rows}) >= 0.8 * len(before) and 0.8 * len(before) < len(rows) < 1.6 * len(before)


def test_mix_stage_keeps_documents_that_are_most_likely_clean(spark, stages):
    """And follows the rates for the others: of an input with many unwanted texts only such ones go."""
    from collections import Counter

    from daycast.llm.mixing import mix_to_targets
    from daycast.llm.queries import MIX_TARGETS, labelled_domains
    domains, labels = sorted(MIX_TARGETS), labelled_domains(spark.read.parquet(f"{SF}/labels.parquet"))
    unwanted = labels.where("domain != 'clean'").select("doc_id")
    docs = stages[0].join(unwanted, "doc_id", "left_semi").union(stages[0].sample(0.3, 7)).dropDuplicates(["doc_id"])
    rates = mix_to_targets(docs.select("doc_id", "text"), labels, MIX_TARGETS, keep="clean").collect()
    copies = Counter(r.doc_id for r in P.mix(spark, docs, SF).collect())
    likely = {r.doc_id for r in rates if domains[max(range(3), key=lambda k: r.posterior[k])] == "clean"}
    assert likely <= copies.keys() and any(r.rate < 1 for r in rates if r.doc_id in likely)
    gone = {r.doc_id for r in rates} - copies.keys()
    assert gone and not gone & likely
    for r in rates:
        assert copies[r.doc_id] in {int(r.rate), int(r.rate) + 1} or (r.doc_id in likely and copies[r.doc_id] == 1)


def test_pack_stage_holds_every_copy(stages):
    from collections import Counter
    copies = Counter(r.doc_id for r in stages[4].collect())
    pieces = stages[5].collect()
    tokens = Counter()
    for p in pieces:
        tokens[p.doc_id] += p.length
        assert p.length * 4 == len(p.token_bytes)
    assert tokens == Counter({p.doc_id: p.doc_tokens * copies[p.doc_id] for p in pieces}) and set(tokens) == set(copies)


def test_run_is_the_stages(spark, stages):
    got = P.run(spark, SF).select("doc_id", "start", "length", "ids_crc32").collect()
    assert sorted(got) == sorted(stages[5].select("doc_id", "start", "length", "ids_crc32").collect())


def test_odd_documents(spark, tmp_path):
    """Nulls in every column, repeated rows, no rows at all."""
    rows = [(1, None, None, None, None), (None, "the text without an id stands here", "en", "s", 34), (2, "", "en", None, 0), (3, "12 34", "en", "s", 5)]
    rows += [(10 + i, f"sentence number {i} of the plain text, with the words of it", "en", "s", 1) for i in range(12)]
    rows += [(40 + i, f"satz nummer {i} des einfachen textes, mit den wörtern darin", "de", "s", 1) for i in range(12)] + [(10, rows[4][1], "en", "s", 1)] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.selectExpr("*", "1 AS pos").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(10, 1, 0), (11, 0, 0), (None, 1, None), (12, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    ids = {r.doc_id for r in P.run(spark, str(tmp_path)).collect()}
    assert ids and not ids & {None, 1, 2, 3}
    none = tmp_path / "none"
    frame.limit(0).write.parquet(f"{none}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{none}/labels.parquet")
    assert P.run(spark, str(none)).count() == 0
