"""License scans: base phrases against a plain version, rules against cases and an ungated scan."""

import re

import pytest

from daycast.llm import license_scan as L
from tests.llm.conftest import SF


def plain_base(text):
    """(n_words, n_base, first, last, labels) word by word."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", lowered)
    places, labels = [], set()
    for phrase, label in L.BASE_PHRASES:
        want = phrase.split()
        for i in range(len(words) - len(want) + 1):
            if words[i:i + len(want)] == want:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


SCANNER = L.Scanner([*L.base_rules(), *L.signature_rules()])


def labels(text):
    return L.scan(SCANNER, text.encode())["labels"]


def test_query_matches_plain_base(spark):
    from daycast.llm.queries import QUERIES
    got = {r.doc_id: r for r in QUERIES["op13_license_scan"](spark, SF).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert got.keys() == docs.keys() and any(r.n_base for r in got.values())
    for d, r in got.items():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_base(docs[d])
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert r.labels == ",".join(sorted(set(r.labels.split(",")))) and (r.score > 0) == bool(r.labels)


def test_there_are_hundreds_of_rules_and_each_names_keywords():
    rules = L.signature_rules()
    assert len(rules) >= 400 and all(r.keywords and all(r.keywords) for r in rules) and len({r.label for r in rules}) >= 90


CASES = [
    ("SPDX-License-Identifier: Apache-2.0", "apache-2"), ("// SPDX-License-Identifier: GPL-2.0-only OR MIT", "gpl-2-only,mit"),
    ("Licensed under the BSD 3-Clause License.", "bsd-3-clause"), ("a BSD-style license", "bsd"), ("GNU Lesser General Public License v2.1", "lgpl-2.1"),
    ("GNU General Public License", "gpl"), ("GPLv3", "gpl-3"), ("the GNU Affero General Public License, version 3", "agpl-3"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0.", "mpl-2"), ("https://creativecommons.org/licenses/by-sa/3.0/", "cc-by-sa"),
    ("CC BY-NC-ND 4.0", "cc-by-nc,cc-by-nc-nd"), ("Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"), ("Unlicense", "unlicense"),
    ("Apache License, Version 2.0", "apache-2"), ("released under the Boost Software License", "boost-1"), ("All rights reserved.", "all-rights-reserved"),
    ("the mitten and the commit were submitted", ""), ("an apache helicopter", ""), ("by the license of the poet", ""),
]


@pytest.mark.parametrize("text,want", CASES)
def test_cases(text, want):
    assert labels(text) == want


def example(parsed) -> str:
    """A shortest text that a parsed pattern matches: first branches, fewest repeats."""
    out = ""
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            out += chr(value)
        elif name == "ANY":
            out += "x"
        elif name == "IN":
            first, what = value[0]
            out += chr(what if str(first) == "LITERAL" else what[0])
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            out += example(value[2]) * value[0]
        elif name == "BRANCH":
            out += example(value[1][0])
        elif name == "SUBPATTERN":
            out += example(value[3])
        else:
            raise AssertionError(name)
    return out


def test_gating_loses_nothing():
    """With every rule run, keywords or not, the same rules match: over the cases, and over a shortest text of every rule."""
    texts = [t for t, _ in CASES] + [example(re._parser.parse(r.pattern)) for r in L.signature_rules()]
    hits = 0
    for t in texts:
        words, n = L.words_text(t.encode())
        every = [(i, m.start()) for i in range(len(SCANNER.rules)) for m in SCANNER.patterns[i].finditer(words)]
        assert {i for i, _ in every} == {d.order for d in SCANNER.found(words)}, t
        hits += bool(every)
    assert hits >= 0.9 * len(texts)


def plain_kept(found):
    kept = [d for d in found if d.level == 0]
    for level in range(1, len(L.LEVELS)):
        own = [d for d in found if d.level == level]
        inside = lambda d, e: e.start <= d.start and d.end <= e.end
        better = lambda d, e: (e.end - e.start, -e.order) > (d.end - d.start, -d.order)
        kept += [d for d in own if not any(inside(d, e) for e in kept) and not any(e is not d and inside(d, e) and better(d, e) for e in own)]
    return kept


def test_containment_matches_plain():
    import random
    rng = random.Random(5)
    for _ in range(300):
        found = []
        for i in range(rng.randint(0, 14)):
            s = rng.randint(0, 20)
            found.append(L.Detection("l", "r", rng.randint(0, 5), i, s, s + rng.randint(1, 9)))
        assert set(SCANNER.kept(found)) == set(plain_kept(found))


def test_overlapping_base_places_all_count():
    scanner = L.Scanner(L.base_rules([("a b a", "x"), ("b a", "y")]))
    r = L.scan(scanner, b"A-b a b. a")
    assert (r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (4, 0, 3, "x,y")


def test_defined_cases(spark, docs):
    long = "filler words, " * 400_000 + "under the MIT license"
    rows = [(1, None), (2, ""), (3, " .,\x00 "), (None, "cc-by-nc"), (4, "CC BY NC cc by nc"), (4, "CC BY NC cc by nc"), (5, long), (6, "été under the mit licenseé")]
    got = L.scan_licenses(docs(rows))
    assert set(got.columns) >= {"doc_id", "hash", "a.b", *L.OUTPUTS} and got.columns.count("score") == 1
    found = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got.collect()]
    assert sorted(found, key=str) == sorted([(d, *plain_base(t)) for d, t in rows], key=str)
    detections = {r.doc_id: r.detections for r in got.collect()}
    assert [(d.label, d.first_word, d.n_words) for d in detections[5]] == [("mit", 800_000, 4)]
    assert L.scan_licenses(docs(rows).limit(0)).count() == 0
