import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from daycast.llm import packing as K
from daycast.llm import token_counts as C
from daycast.llm.byte_bpe import Encoder, load

PATH = public_tokenizers.path("byte_bpe_50k.json")
EDGES = ["", " ", "a", "it's don't we'll I've they're 'tis 'l 're x!'ll", "  two  spaces\n\n\nlines \t\t tabs nbsp", "ends with space   ", "   starts",
         "<|endoftext|>", "a<|endoftext|>b", "a <|endoftext|><|endoftext|> ", "<|endof", "!<|endoftext", "日本語 テスト 한국어 Привет", "😀😀 é ՘႔0",
         "naïve café ÉÈ", "1234567 8 90", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "=" * 70 + "-" * 33, "x" * 3000, "\x00\x1c\x85  ﻿"]


@pytest.fixture(scope="module")
def counter():
    return C.PrefixCounter(load(PATH))


def library(text):
    return load(PATH).library.encode(text, add_special_tokens=False).ids


def test_counts_of_all_prefixes(counter):
    for text in EDGES:
        n, deltas = counter.text(text)
        found = C.counts(deltas).tolist()
        assert n == found[-1] == len(library(text)), text
        for i in range(0, len(text) + 1, 1 if len(text) < 200 else 97):
            assert found[i] == len(library(text[:i])), (text, i)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sdlrevtm!?-.ab<|>"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_counts_of_random_prefixes(text):
    counter = C.PrefixCounter(load(PATH))
    found = C.counts(counter.text(text)[1]).tolist()
    assert found == [len(library(text[:i])) for i in range(len(text) + 1)]


def test_ids_equal_the_library_for_any_sign():
    bpe = Encoder(PATH)
    signs = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(signs), 5000):
        text = "".join(f"a{c}1 {c}{c}b" for c in signs[k:k + 5000])
        assert K.encode(bpe, text, 1).tolist() == [*library(text), 1]


def test_sure_signs_are_cut_as_the_library_does(counter):
    """No sign that is counted by the pattern is classed otherwise by the library."""
    sure = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and C._UNSURE.search(chr(c)) is None]
    assert len(sure) > 20000
    text = "".join(f"a{c}1 {c}{c}b" for c in sure)
    pre = counter.bpe.library.pre_tokenizer.pre_tokenize_str(text)
    assert counter.bpe.pattern.findall(text) == [text[s:e] for _, (s, e) in pre]


def test_long_texts_and_small_memory(counter, monkeypatch):
    rng = random.Random(1)
    text = " ".join(rng.choice(["alpha", "beta,", "gamma's\n", "  x"]) + str(rng.randint(0, 999)) for _ in range(5000))
    whole = counter.text(text)
    assert whole[0] == len(library(text))
    monkeypatch.setattr(C, "PIECE", 1000)
    monkeypatch.setattr(C, "MEMO", 50)
    assert C.PrefixCounter(load(PATH)).text(text) == whole


def test_many_special_strings(counter):
    for part in ("<|endoftext|>", "a <|endoftext|>", "it's  <|endoftext|> \n\n", "<|endof<|endoftext|>"):
        text = part * 3000 + "end  "
        n, deltas = counter.text(text)
        found = C.counts(deltas)
        assert n == found[-1] == len(library(text)) and len(found) == len(text) + 1
        for i in (1, 5, len(part), 2 * len(part) + 3, 2500 * len(part), 2500 * len(part) + 4, len(text) - 1):
            assert found[i] == len(library(text[:i])), (part, i)


def test_operator_columns_and_stored_form(spark, docs):
    rows = list(enumerate([*EDGES, None, EDGES[3]])) + [(None, "no id")]
    out = C.count_tokens(docs(rows), PATH, budget=3).collect()
    assert len(out) == len(rows)
    for r in out:
        text = (dict(rows)[r.doc_id] if r.doc_id is not None else "no id") or ""
        assert (r.n_tokens, r.n_bytes) == (len(library(text)), len(text.encode())) and r["a.b"] == "x"
        assert C.longest_prefix(r.prefix_counts, 3) == r.fitting_chars
        assert len(library(text[:r.fitting_chars])) <= 3
        assert C.count_in_prefix(r.prefix_counts, len(text)) == r.n_tokens
        assert len(zstandard.decompress(r.prefix_counts)) == 2 * len(text)
    assert C.count_tokens(docs([]), PATH).count() == 0


def repack(rows, pieces, max_len=2048):
    """Checks that the pieces are the documents' ids, once each, in gapless sequences; the padding's share."""
    ids = {d: np.array([*library(t or ""), 1], "<u4") for d, t in rows}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        assert p.doc_tokens == len(ids[p.doc_id]) and p.length > 0
        assert bytes(p.token_bytes) == ids[p.doc_id][p.start:p.start + p.length].tobytes()
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length, p.sequence_tokens, p.padded_tokens))
    assert set(by_doc) == set(ids)
    for d, found in by_doc.items():
        at = 0
        for start, length in sorted(found):
            assert start == at
            at += length
        assert at == len(ids[d])
    padding = 0
    for found in by_sequence.values():
        at = 0
        for offset, length, _, _ in sorted(found):
            assert offset == at
            at += length
        assert at <= max_len and {(x[2], x[3]) for x in found} == {(at, at if at & (at - 1) == 0 else max_len)}
        padding += found[0][3] - at
    total = sum(map(len, ids.values()))
    return padding / (total + padding)


def prose(n, seed=0):
    rng = random.Random(seed)
    words = ["some", "words", "of", "a", "text", "that", "goes", "on"]
    return [(i, ". ".join(" ".join(rng.choice(words) for _ in range(rng.randint(3, 20))) for _ in range(rng.randint(0, 60)))) for i in range(n)]


def test_pieces_rebuild_the_documents(docs):
    rows = prose(150) + [(900 + i, t) for i, t in enumerate([None, "", "z" * 9000, "word " * 5000, "<|endoftext|> x", "."])]
    assert repack(rows, K.pack(docs(rows), PATH).collect()) < 0.02
    for max_len, run in ((64, 500), (100, 1 << 20), (1, 50)):
        small = rows[:40] + rows[-6:]
        repack(small, K.pack(docs(small), PATH, max_len=max_len, run_tokens=run).collect(), max_len)


def test_very_long_space_runs():
    bpe = Encoder(PATH)
    for text in ("a" + " " * 1_000_000 + "word. b", "a.\n" + "\n" * 1_000_000 + "word"):
        with pytest.raises(ValueError):  # what the fast encoder does with them
            bpe.encoding.encode_to_numpy(text, disallowed_special=())
        assert K.encode(bpe, text, 1).tolist() == [*library(text), 1]


def test_repeated_rows_and_empty_table(docs):
    rows = [(1, "twice"), (1, "twice"), (None, "no id")]
    out = K.pack(docs(rows), PATH).collect()
    assert sum(r.length for r in out if r.doc_id == 1) == 2 * (len(library("twice")) + 1)
    assert sum(r.length for r in out if r.doc_id is None) == len(library("no id")) + 1
    assert K.pack(docs([]), PATH).count() == 0


def test_cuts_are_the_cheapest():
    rng = random.Random(6)
    for _ in range(60):
        at = [0]
        while len(at) < 12:
            at.append(at[-1] + rng.randint(1, 9))
        cost = [0.0, *[rng.choice([0.0, 2.0, 5.0]) for _ in at[1:-1]], 0.0]
        best = [0.0]
        for j in range(1, len(at)):
            best.append(min(best[i] + 20 - (at[j] - at[i]) + cost[j] for i in range(j) if at[j] - at[i] <= 20))
        cuts = K.best_cuts(at, cost, 20)
        spent = sum(20 - (at[j] - at[i]) + cost[j] for i, j in zip(cuts, cuts[1:], strict=False))
        assert cuts[0] == 0 and cuts[-1] == len(at) - 1 and abs(spent - best[-1]) < 1e-9
        cuts = K.best_cuts(at, cost, 20, 3.0)
        spent = sum(20 - (at[j] - at[i]) + cost[j] for i, j in zip(cuts, cuts[1:-1], strict=False)) + 3 * (at[-1] - at[cuts[-2]]).bit_count()
        assert abs(spent - min(best[i] + 3 * (at[-1] - at[i]).bit_count() for i in range(len(at) - 1) if at[-1] - at[i] <= 20)) < 1e-9


def test_end_of_the_stream_is_cut_in_powers():
    assert K.in_powers(np.array([0, 2048, 2048 + 1500]), 2048, 16).tolist() == [0, 2048, 3072, 3328, 3456, 3520, 3536, 3544, 3548]
    assert K.in_powers(np.array([0, 512]), 2048, 16).tolist() == [0, 512]
    assert K.in_powers(np.array([0, 2040]), 2048, 16).tolist() == [0, 2040]


def test_query_digest_is_crc32(spark):
    from daycast.llm.queries import QUERIES
    row = QUERIES["op6_packing"](spark, "/root/testdata/sf0.001").orderBy("doc_id", "start").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(f"doc_id = {row.doc_id}").first().text
    ids = np.array([*library(text), 1], "<u4")
    assert row.ids_crc32 == zlib.crc32(ids[:row.length].tobytes())
