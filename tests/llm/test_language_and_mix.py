import math
import random

import pytest
from pyspark.sql import functions as F

from daycast.llm import language_id as L
from daycast.llm import mixing as M
from tests.llm import brute
from tests.llm.conftest import SF

WORDS = {"aa": ["the", "house", "stands", "on", "green", "hills", "with", "birds"], "bb": ["das", "haus", "steht", "auf", "grünen", "hügeln", "mit", "vögeln"],
         "cc": ["la", "maison", "est", "sur", "les", "collines", "vertes", "où"]}


def sentences(lang, n, seed):
    rng = random.Random(seed)
    return [" ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(4, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def learned(spark):
    rows = [(t, k) for k in WORDS for t in sentences(k, 30, 1)] + [(None, "aa"), ("text", None), ("", "cc"), ("  ", "dd")]
    return L.learn_dictionaries(spark.createDataFrame(rows, "text string, lang string"))


def test_languages_are_told_apart(spark, docs, learned):
    assert sorted(learned) == ["aa", "bb", "cc"]
    rows = [(100 * i + j, t) for i, k in enumerate(WORDS) for j, t in enumerate(sentences(k, 25, 2))]
    out = L.identify_language(docs(rows), learned).collect()
    right = sum(r.lang_pred == list(WORDS)[r.doc_id // 100] for r in out)
    assert right >= 0.97 * len(rows) and all(0 <= r.score <= 1 for r in out) and not any(r.rejected for r in out if r.score > 0.01)
    assert out[0]["a.b"] == "x" and out[0].version == 6


def test_edges(spark, docs, learned):
    texts = [None, "", " \n", "123 !? 456", "é", "THE HOUSE STANDS ON GREEN HILLS", " ".join(sentences("bb", 4000, 3)), "x"]
    out = {r.doc_id: r for r in L.identify_language(docs([*enumerate(texts), (None, "the house")]), learned).collect()}
    assert [out[i].lang_pred for i in range(4)] == ["und"] * 4 and all(out[i].rejected and out[i].score == 0 for i in range(4))
    assert out[4].lang_pred in learned and out[5].lang_pred == "aa" and out[6].lang_pred == "bb" and None in out
    assert L.identify_language(docs([]), learned).count() == 0


def test_none_or_one_language(spark, docs):
    empty = spark.createDataFrame([], "text string, lang string")
    assert L.learn_dictionaries(empty) == {}
    assert L.identify_language(docs([(1, "a b")]), {}).first().lang_pred == "und"
    one = L.identify_language(docs([(1, "a b")]), {"aa": b"the house"}).first()
    assert (one.lang_pred, one.score, one.rejected) == ("aa", 1.0, False)


def test_sample_is_bounded_in_rows_of_whole_texts(spark):
    """Short texts first, long ones whole where there are too few others."""
    long, short = [f"text number {i} " * 400 for i in range(50)], [f"a short text {i}" for i in range(5)]
    df = spark.createDataFrame([(t, "aa") for t in long + short] + [("the same copy", "bb")] * 40, "text string, lang string")
    found = L.learn_dictionaries(df, sample_texts=8, sample_bytes=100)
    parts = found["aa"].decode().split("\n")
    assert sorted(parts[:5]) == short and len(parts) == 8 and set(parts[5:]) < set(long) and found["bb"] == b"the same copy"
    assert found == L.learn_dictionaries(df.repartition(7), sample_texts=8, sample_bytes=100)
    assert len(L.learn_dictionaries(df, sample_texts=3, sample_bytes=100)["aa"].decode().split("\n")) == 3
    with pytest.raises(ValueError):
        L.learn_dictionaries(df, max_languages=1)


def test_matches_plain_compressors(spark, docs, learned):
    """One compressor a language, its dictionary loaded anew for every chunk, smallest sum of sizes."""
    import zstandard
    rules = zstandard.ZstdCompressionParameters(window_log=19, chain_log=16, hash_log=17, search_log=3, min_match=4, strategy=zstandard.STRATEGY_LAZY,
                                                write_content_size=0, write_checksum=0, write_dict_id=0)

    def size(text, lang):
        raw, total = text.lower().encode(), 0
        for at in range(0, len(raw), 4096):
            one = zstandard.ZstdCompressionDict(learned[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            one.precompute_compress(compression_params=rules)
            total += len(zstandard.ZstdCompressor(dict_data=one, compression_params=rules).compress(raw[at:at + 4096]))
        return total

    texts = [t for i, k in enumerate(WORDS) for t in sentences(k, 12, 20 + i)] + [" ".join(sentences("cc", 900, 5)), "ÉTÉ", "the haus est", "a" * 9000]
    rows = list(enumerate(texts))
    for r in L.identify_language(docs(rows), learned).collect():
        sizes = sorted((size(texts[r.doc_id], k), k) for k in learned)
        assert r.lang_pred == sizes[0][1] and r.score == pytest.approx((sizes[1][0] - sizes[0][0]) / sizes[1][0], abs=1e-12)


def test_batches_are_sliced_by_bytes(spark, docs):
    """200 texts of 1 MB: no more than 4 of them are held at once; one longer text is a slice of its own."""
    import pyarrow as pa

    from daycast.llm.common import text_slices
    texts = ["x" * (1 << 20)] * 200 + [None, "", "y" * (9 << 20), "z"]
    sizes = [(p.num_rows, sum(len(t or "") for t in p.column("t").to_pylist())) for p in text_slices(pa.RecordBatch.from_pydict({"t": texts}), "t")]
    assert sum(n for n, _ in sizes) == 204 and all(b <= 4 << 20 or n == 1 for n, b in sizes) and len(sizes) <= 54
    assert [p.num_rows for p in text_slices(pa.RecordBatch.from_pydict({"t": ["a"] * 2500}).slice(200, 2100), "t")] == [1000, 1000, 100]
    assert list(text_slices(pa.RecordBatch.from_pydict({"t": pa.array([], pa.string())}), "t")) == []
    rows = [(i, "the house stands on green hills " * 1000) for i in range(60)]
    assert {r.lang_pred for r in L.identify_language(docs(rows), {"aa": b"the house stands", "bb": b"das haus steht"}).collect()} == {"aa"}


def test_held_out_accuracy(spark):
    """The registered query on documents it did not learn from."""
    from daycast.llm.queries import QUERIES
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = QUERIES["op10_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == brute.held_out(r.doc_id) for r in out) and len(out) == docs.count()
    held = [r for r in out if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert sum(r.rejected for r in out) <= 0.03 * len(out)


def plain_posterior(rows, labels, domains, buckets, temperature, hashes):
    """Naive Bayes by hand; ``hashes`` maps words to Spark's bucket."""
    counts = {d: [1.0] * buckets for d in domains}
    share = dict.fromkeys(domains, 0)
    for i, d in labels.items():
        share[d] += 1
        for w in brute.split_words(rows[i].lower()):
            counts[d][hashes[w]] += 1
    out = {}
    for i, t in rows.items():
        words = brute.split_words((t or "").lower())
        scale = temperature * math.sqrt(max(len(words), 1))
        logs = [math.log(share[d] / len(labels)) + sum(math.log(counts[d][hashes[w]] / sum(counts[d])) for w in words) / scale for d in domains]
        e = [math.exp(x - max(logs)) for x in logs]
        out[i] = [x / sum(e) for x in e]
    return out


def test_sample_is_of_whole_documents_in_the_table(spark, docs):
    """Labels without a document don't use up the sample, and what ends a long text teaches."""
    told = spark.createDataFrame([(0, "clean"), (1, "toxic"), (2, "clean"), *((i, "toxic") for i in range(100, 400))], "doc_id long, domain string")
    rows = [(0, "fine " * 3000), (1, "fine " * 2990 + "bad " * 300), (2, "fine words"), (3, "bad bad bad")]
    prior, likelihood = M.fit_domains(docs(rows), told, ["clean", "toxic"], "doc_id", "text", 3, buckets=64)
    assert [math.exp(x) for x in prior] == pytest.approx([2 / 3, 1 / 3])
    bad = spark.sql("SELECT 'bad' AS w").select(M._bucket(F.col("w"), 64)).first()[0]
    assert math.exp(likelihood["toxic"][bad]) == pytest.approx(301 / (64 + 3290))
    got = {r.doc_id: r.posterior for r in M.posteriors(docs(rows), told, ["clean", "toxic"], sample_docs=3).collect()}
    assert got[3][1] > 0.9 > 0.5 > got[2][1]


def mix_rows(seed=1, n=60):
    rng = random.Random(seed)
    kinds = {"clean": ["alpha", "beta", "gamma"], "low": ["junk", "spam", "beta"], "toxic": ["bad", "worse", "alpha"]}
    rows, labels = {}, {}
    for i in range(n):
        d = rng.choice(list(kinds))
        rows[i] = " ".join(rng.choice(kinds[d]) for _ in range(rng.randint(1, 60)))
        if i % 2:
            labels[i] = d
    return rows, labels


def test_posteriors_match_plain_bayes(spark, docs):
    rows, labels = mix_rows()
    rows |= {100: None, 101: " ", 102: "unseen words only"}
    told = spark.createDataFrame(list(labels.items()), "doc_id long, domain string")
    domains = ["clean", "low", "toxic"]
    got = {r.doc_id: r for r in M.posteriors(docs(list(rows.items())), told, domains, buckets=64, temperature=0.5).collect()}
    words = sorted({w for t in rows.values() for w in brute.split_words((t or "").lower())})
    hashes = {r.w: r.b for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", M._bucket(F.col("w"), 64).alias("b")).collect()}
    want = plain_posterior(rows, labels, domains, 64, 0.5, hashes)
    for i in rows:
        assert got[i].posterior == pytest.approx(want[i], abs=1e-9) and got[i].n_tokens == len(brute.split_words(rows[i]))
    assert got[0]["a.b"] == "x"


def test_rates_meet_the_targets(spark, docs):
    rows, labels = mix_rows(2, 200)
    told = spark.createDataFrame(list(labels.items()), "doc_id long, domain string")
    for targets in ({"clean": 6, "low": 2, "toxic": 2}, {"clean": 0.9, "low": 0.1, "toxic": 0.0}):
        out = M.mix_to_targets(docs(list(rows.items())), told, targets, max_steps=20).collect()
        total = sum(r.n_tokens for r in out)
        shares = [sum(r.rate * r.n_tokens * r.posterior[k] for r in out) / total for k in range(3)]
        want = [targets[d] / sum(targets.values()) for d in sorted(targets)]
        assert all(r.rate >= 0 for r in out)
        if targets["toxic"]:
            assert shares == pytest.approx(want, abs=1e-6)
        else:  # soft members bring some of what is not wanted; no rate is better by projected gradient
            assert abs(shares[2]) < 0.03 and shares[0] == pytest.approx(want[0], abs=0.03)


def test_fit_is_a_least_squares_minimum(spark):
    """Against a long plain projected gradient, where the targets can't be met."""
    import numpy as np
    rng = np.random.default_rng(0)
    p = rng.dirichlet([1, 1, 1], 80)
    n = rng.integers(1, 50, 80)
    target = np.array([0.95, 0.05, 0.0])
    rows = [(int(a), [float(x) for x in b]) for a, b in zip(n, p, strict=True)]
    steps, shares = M.fit_rates(spark.createDataFrame(rows, "n_tokens long, posterior array<double>"), target.tolist(), max_steps=40)
    w = n / n.sum()
    gram = (p * w[:, None]).T @ p
    inverse = np.linalg.inv(gram)
    r = np.ones(80)
    for _ in range(5000):
        r = np.maximum(0, r - p @ (inverse @ (p.T @ (w * r) - target)))
    best = p.T @ (w * r) - target
    mine = np.array(shares) - target
    assert mine @ inverse @ mine <= best @ inverse @ best * 1.02 + 1e-9


def test_common_unwanted_class_is_fitted_to_the_end(spark):
    """Nearly all toxic, where plain projected gradient needs thousands of steps."""
    import numpy as np
    rng = np.random.default_rng(4)
    p = np.concatenate([rng.dirichlet([1, 1, 30], 150), rng.dirichlet([20, 1, 1], 10), rng.dirichlet([1, 8, 2], 5)])
    n = rng.integers(1, 50, len(p))
    w, target = n / n.sum(), np.array([0.92, 0.06, 0.02])
    inverse = np.linalg.inv((p * w[:, None]).T @ p)
    r, after = np.ones(len(p)), {}
    for k in range(200001):
        off = p.T @ (w * r) - target
        after[k] = off @ inverse @ off
        r = np.maximum(0, r - p @ (inverse @ off))
    rows = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p, strict=True)], "n_tokens long, posterior array<double>")
    steps, shares = M.fit_rates(rows, target.tolist(), max_steps=20)  # the rest by proximal steps
    off = np.array(shares) - target
    assert off @ inverse @ off <= after[200000] + 1e-9 < after[30] / 2
    rates = np.array([x.r for x in rows.select(M._rate(steps, F.col("posterior")).alias("r")).collect()])
    assert rates.min() >= 0 and p.T @ (w * rates) == pytest.approx(shares, abs=1e-9)
    with pytest.raises(RuntimeError):
        M.fit_rates(rows, target.tolist(), max_steps=1, finish_steps=1)


def test_steps_are_accelerated_projected_gradient(spark, docs):
    """Step for step as in numpy, with the targets and the shares reached in the result."""
    import numpy as np
    rng = np.random.default_rng(2)
    p, n = rng.dirichlet([3, 0.5, 0.5], 120), rng.integers(0, 50, 120)
    w, target = n / n.sum(), np.array([0.9, 0.06, 0.04])
    inverse = np.linalg.inv((p * w[:, None]).T @ p)
    before = rate = np.ones(120)
    age, push, plain = 1.0, 0.0, []
    while True:
        y = rate + push * (rate - before)
        u = inverse @ (p.T @ (w * y) - target)
        new = np.maximum(0, y - p @ u)
        plain.append([push, *u])
        if w @ abs(new - y) <= 1e-9:
            break
        age = 1.0 if w @ ((y - new) * (new - rate)) > 0 else age
        older, age = age, (1 + math.sqrt(1 + 4 * age * age)) / 2
        push, before, rate = (older - 1) / age, rate, new
    rows = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p, strict=True)], "n_tokens long, posterior array<double>")
    steps, shares = M.fit_rates(rows, target.tolist())
    assert len(steps) == len(plain) > 1
    assert np.array(steps) == pytest.approx(np.array(plain), abs=1e-6) and shares == pytest.approx(p.T @ (w * new), abs=1e-8)
    rates = [x.r for x in rows.select(M._rate(steps, F.col("posterior")).alias("r")).collect()]
    assert rates == pytest.approx(new.tolist(), abs=1e-6)
    texts, labels = mix_rows(3, 200)
    told = spark.createDataFrame(list(labels.items()), "doc_id long, domain string")
    mix = M.fit_mix(docs(list(texts.items())), told, {"clean": 0.8, "low": 0.15, "toxic": 0.05}, keep="clean")
    assert mix.reached == pytest.approx(mix.targets, abs=1e-6) and sum(mix.targets.values()) == pytest.approx(1)


def test_kept_domain_is_not_thinned(spark, docs):
    """Whatever the table is made of: with less of the others than their limits every rate is 1."""
    rows, labels = mix_rows(3, 200)
    told = spark.createDataFrame(list(labels.items()), "doc_id long, domain string")
    for domains in (["clean"], ["clean", "low", "toxic"]):
        some = {i: t for i, t in rows.items() if i not in labels or labels[i] in domains}
        out = M.mix_to_targets(docs(list(some.items())), told, {"clean": 0.0, "low": 0.5, "toxic": 0.5}, keep="clean").collect()
        assert min(r.rate for r in out) >= 1 - 1e-6 and max(r.rate for r in out) <= 1 + 1e-6
    out = M.mix_to_targets(docs(list(rows.items())), told, {"clean": 0.8, "low": 0.15, "toxic": 0.05}, keep="clean").collect()
    total = sum(r.n_tokens for r in out)
    assert [sum(r.rate * r.n_tokens * r.posterior[k] for r in out) / total for k in range(3)] == pytest.approx([0.8, 0.15, 0.05], abs=1e-6)
    assert all(r.rate >= 1 for r in out if r.posterior[0] > 0.99)


def test_mix_edges(spark, docs):
    none = spark.createDataFrame([], "doc_id long, domain string")
    out = M.mix_to_targets(docs([(1, "a b"), (2, None)]), none, {"x": 1, "y": 1}).collect()
    assert {tuple(r.posterior) for r in out} == {(0.5, 0.5)} and {r.rate for r in out} == {1.0}
    assert M.mix_to_targets(docs([]), none, {"x": 1}).count() == 0
    assert {r.rate for r in M.mix_to_targets(docs([(1, None), (2, " ")]), none, {"x": 1}).collect()} == {1.0}
    odd = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (None, "x"), (7, "x"), (2, None), (2, "z")], "doc_id long, domain string")
    out = {r.doc_id: r for r in M.mix_to_targets(docs([(1, "a b"), (2, "c d"), (None, "a b")]), odd, {"x": 1, "y": 1}).collect()}
    assert out[1].posterior == [1.0, 0.0] and len(out) == 3
    for bad in ({}, {"x": 0}, {"x": -1, "y": 2}):
        with pytest.raises(ValueError):
            M.mix_to_targets(docs([(1, "a")]), none, bad)


def test_copies_average_to_the_rate(spark):
    rows = spark.range(20000).select(M.copies_of(F.lit(1.3), F.col("id")).alias("c"))
    got = rows.agg(F.avg("c"), F.min("c"), F.max("c")).first()
    assert abs(got[0] - 1.3) < 0.02 and got[1:] == (1, 2)
    assert spark.range(5).select(M.copies_of(F.lit(2.0), F.col("id")).alias("c")).distinct().first().c == 2


def test_main_path_is_native(spark):
    told = spark.sql("SELECT 1L AS doc_id, 'x' AS domain")
    plan = M.posteriors(spark.sql("SELECT 1L AS doc_id, 'a b' AS text"), told, ["x"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
