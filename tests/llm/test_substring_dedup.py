import random

import numpy as np
import pyarrow as pa

from daycast.llm import substring_dedup as D
from tests.llm import brute


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"word{i}" for i in range(50)] + ["é", "ö" * 70, "x" * 90]
    passages = [[rng.choice(vocab) for _ in range(rng.choice([19, 20, 21, 40, 75]))] for _ in range(6)]
    rows = []
    for d in range(40):
        words = []
        for _ in range(rng.randint(0, 6)):
            words += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(vocab) for _ in range(rng.randint(0, 30))]
        rows.append((d * 3, rng.choice([" ", "\n", " \t"]).join(words)))
    return rows


def check(docs, rows, window=20):
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in D.dedup_substrings(docs(rows), window=window).collect()}
    assert got == brute.repeated_words(dict(rows), window)


def test_matches_brute_force(docs):
    for seed in range(3):
        check(docs, corpus(seed))


def test_other_windows(docs):
    check(docs, corpus(7), 13)
    check(docs, corpus(8), 33)


def test_edges(docs):
    a = " ".join(f"a{i}" for i in range(25))
    rows = [(1, a), (2, a), (3, None), (4, ""), (5, " \n\t "), (6, "same " * 60), (7, "same " * 20), (8, "same " * 19), (9, a + " " + a),
            (10, "\x0b" + a.replace(" ", "\f")), (11, a.replace("a0", "A0")), (12, a.replace(" ", "\xa0")), (13, a[:-1])]
    check(docs, rows)


def test_null_ids_versions_and_repeated_rows(docs):
    a = " ".join(f"a{i}" for i in range(30))
    b = " ".join(f"b{i}" for i in range(30))
    rows = [(None, a), (None, None), (1, a), (1, a), (2, b), (2, b + " " + a), (3, b)]
    got = sorted(((r.doc_id or 0), r.n_words, r.n_removed) for r in D.dedup_substrings(docs(rows)).collect())
    # equal rows start at the same place: neither is earlier; document 2's second version repeats document 1
    assert got == [(0, 0, 0), (0, 30, 0), (1, 30, 0), (1, 30, 0), (2, 30, 0), (2, 60, 30), (3, 30, 30)]


def test_exact_copies_are_dealt_over_all_groups():
    """Places of 1,000 copies of one text (one version), in both shuffles that gather them."""
    places = D._Places(np.arange(1000), np.full(1000, -7), np.zeros(1000, np.int64))
    none = np.zeros(0, np.int64)
    first = list(D._rows(none, none, places, none, np.arange(1000), 16))
    told = pa.table({"known": [r[1] for r in first], "hashes": [r[2] for r in first], "places": [r[3] for r in first]})
    second = D._repeats(np.dtype("<u4"), D._twice, 16)(told).to_pylist()
    for found in ([(b, x) for b, _, _, x in first], [(r["bucket"], r["places"]) for r in second]):
        sizes = {b: len(D._Places.unpack([x]).ids) for b, x in found}
        assert len(sizes) == 16 and sum(sizes.values()) == 1000 and max(sizes.values()) < 125


def test_columns_and_empty_table(docs):
    row = D.dedup_substrings(docs([(1, "x y")])).first().asDict()
    assert row["a.b"] == "x" and row["version"] == 6 and row["n_words"] == 2
    assert D.dedup_substrings(docs([])).count() == 0


def test_very_long_text(docs):
    long = " ".join(str(i) for i in range(500_000))
    piece = " ".join(str(i) for i in range(400_000, 400_030))
    got = {r.doc_id: (r.n_words, r.n_removed) for r in D.dedup_substrings(docs([(1, long), (2, piece), (3, "z " + piece)])).collect()}
    assert got == {1: (500_000, 0), 2: (30, 30), 3: (31, 30)}


def test_word_hashes_are_of_words_alone(monkeypatch):
    """A word's hash does not depend on its place, nor on where the bytes are cut."""
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("abé") for _ in range(rng.choice([1, 3, 100]))) for _ in range(rng.randint(0, 40))) + rng.choice(["", " ", "\n"]) for _ in range(50)]
    batch = pa.array([*texts, None, ""])
    data, offsets = D._text_buffers(batch)
    whole, counts = D.word_hashes(data, offsets)
    assert counts.tolist() == [len(brute.split_words(t)) for t in [*texts, "", ""]]
    known = {}
    for w, h in zip([w for t in texts for w in brute.split_words(t)], whole.tolist(), strict=True):
        assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)
    monkeypatch.setattr(D, "BYTES", 37)
    again, counts_again = D.word_hashes(data, offsets)
    assert (again == whole).all() and (counts == counts_again).all()


def test_cover_has_every_difference():
    assert {(a - b) % D.PERIOD for a in D.COVER for b in D.COVER} == set(range(D.PERIOD))
    assert np.dtype(D.WINDOW).itemsize == 12


def test_query_matches_sql(spark):
    from daycast.llm.queries import ORACLE_SQL, QUERIES
    from tests.llm.conftest import SF
    from tools.oracle_check import duck, rows
    got = QUERIES["op4_substring_dedup"](spark, SF).toArrow()
    assert rows(got) == rows(duck(SF).sql(ORACLE_SQL["op4_substring_dedup"]).to_arrow_table())
