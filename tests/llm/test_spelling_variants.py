"""Spelling variants against a plain version that tries every edit of every word."""

import random
import re
import zlib
from collections import Counter

import pytest

from daycast.llm import spelling_variants as S
from tests.llm.conftest import SF

LETTERS = [*map(chr, range(97, 123)), *map(chr, range(0xC0, 0x100))]


def plain_words(rows, one_in=97, min_length=5, min_count=3):
    counts = Counter()
    for doc_id, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= min_count and len(w) >= min_length}


def edits(word):
    for i in range(len(word) + 1):
        yield from (word[:i] + c + word[i:] for c in LETTERS)
    for i in range(len(word)):
        yield word[:i] + word[i + 1:]
        yield from (word[:i] + c + word[i + 1:] for c in LETTERS)


def plain(rows, factor=2, **kw):
    words = plain_words(rows, **kw)
    near = {w: {e for e in edits(w) if e in words} - {w} for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= factor * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words.get(form[w]))
    return out


def found(df):
    rows = df.collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


def test_query_matches_plain(spark):
    from daycast.llm.queries import QUERIES
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = plain(docs)
    got = QUERIES["op11_spelling_variants"](spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"] and found(got) == want
    assert any(f for f, *_ in want.values()) and any(r != f for f, r, *_ in want.values() if f)


def test_random_words_with_runs_and_ties(spark, docs):
    rng = random.Random(3)
    rows = [(i, " ".join("".join(rng.choices("abé", k=rng.randint(4, 7))) for _ in range(60))) for i in range(60)]
    assert found(S.group_variants(docs(rows), one_in=5, min_count=2)) == plain(rows, one_in=5, min_count=2)


@pytest.mark.parametrize("size", [62, 63, 64, 65, 66, 130])
def test_long_words(spark, docs, size):
    """Words about the length from which prefixes are hashed, with every kind of edit, and equal letters side by side."""
    rng = random.Random(size)
    word = "".join(rng.choices("abc", k=size))
    near = [word[:-1], word[1:], "x" + word, word + word[-1], word[:40] + "ü" + word[41:], word[:10] + word[11:], word[:30] + word[29:], "y" + word[1:]]
    rows = [(i, " ".join([word] * 8 + near * 3 + [near[0]] * 2)) for i in range(3)]
    got, want = found(S.group_variants(docs(rows))), plain(rows)
    assert got == want and len(got) >= 5


def test_rotations_by_hash_and_by_text_agree(monkeypatch):
    """The hashed prefixes group the same entries as the plain ones."""
    words = ["banana", "bananas", "bandana", "anana", "canana", "bananna"]
    groups = []
    for limit in (64, 4):
        monkeypatch.setattr(S, "LONG", limit)
        by = {}
        for w in words:
            for prefix, skipped, first in S.rotations(w):
                by.setdefault(prefix, []).append((w, skipped, first))
        groups.append(sorted(map(sorted, by.values())))
    assert groups[0] == groups[1]


def test_a_word_of_many_letters_costs_rows_in_proportion():
    entries = list(S.rotations("ab" * 20_000))
    assert len(entries) == 80_001 and sum(len(p) for p, *_ in entries) < 60 * len(entries)


def test_defined_cases(spark, docs):
    rows = [(None, "hello hello hello"), (1, None), (2, ""), (3, "HELLO Hello hellos hellos hellos"), (3, "HELLO Hello hellos hellos hellos"), (4, "ab ab ab 12 İstanbul"),
            (5, "Éclair éclair éclair éclair Éclair Éclair"), (6, "word " * 300_000)]
    assert found(S.group_variants(docs(rows))) == plain(rows)
    assert S.group_variants(docs([(1, "x")])).count() == 0 and S.group_variants(docs([(1, "x")]).limit(0)).count() == 0


def test_chains_and_roots(spark, docs):
    rows = [(1, "abcde " * 3 + "abcdf " * 6 + "abcdg " * 12 + "abcgg " * 24 + "xbcgg " * 48)]
    want = plain(rows, one_in=1 << 40)
    assert want["abcde"][1] == "xbcgg" and found(S.group_variants(docs(rows), one_in=1 << 40)) == want


def test_long_texts_are_counted_in_parts(monkeypatch):
    monkeypatch.setattr(S, "_HELD", 10)
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(200_000)).encode()
    counts = Counter()
    for word, n in S.runs(text):
        counts[word] += n
    assert counts == Counter(re.findall("[a-z]+", text.decode()))
