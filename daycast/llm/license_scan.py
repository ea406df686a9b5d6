"""License scans by ordered signature rules.

A text is reduced to its words (ASCII letters and digits, and everything beyond ASCII; A-Z
lowered) with one space between them, so that line breaks, comment signs and punctuation
play no part. Over that stand hundreds of regular expressions, each with a label, a level
and keywords:

- Prefilter: one Aho-Corasick pass finds which keywords occur; only rules of which one does
  are run. Most texts run none.
- Priority: levels go from contract phrases over tags, full texts, notices and addresses to
  bare names; within a level, rules are in order.
- Containment: a detection that lies within one of a better level, or within a longer one
  (or an equal one of an earlier rule) of its own level, is dropped: the "bsd license" of
  "bsd 3 clause license" is no detection of its own. Detections that merely overlap stay.
  Base phrases are never dropped, and each of their places counts, overlapping ones too.

The score is the largest weight of the detections kept: 1 for tags and full texts, less for
notices, addresses and names, 0 for none.

Every text is judged by itself, whole, without a shuffle; a batch is taken in slices bounded
by bytes. Patterns have no nested repeats, so a scan is linear in the text.

Defined cases
- Null or empty text: no words, no places (first and last null), no labels (empty strings),
  score 0.
- Repeated rows are judged again; an empty table gives no rows.
- Input columns named like an output are replaced by it; all others are carried through.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from daycast.llm.common import col, text_slices

OUTPUTS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
DETECTIONS = "array<struct<label: string, rule: string, first_word: bigint, n_words: bigint>>"

#: Levels of the rules, best first, and the weight of a detection.
LEVELS = {"base": 0.9, "tag": 1.0, "text": 1.0, "notice": 0.9, "address": 0.8, "name": 0.6}

#: Byte by byte: A-Z lowered, digits, a-z and bytes beyond ASCII kept, all else a space.
_KEPT = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass(frozen=True)
class Rule:
    """A pattern over words (separated by one space); any match holds one of ``keywords``, each
    from the start of a word on. A group named ``own`` is the part that is the detection."""

    name: str
    label: str
    level: str
    pattern: str
    keywords: tuple[str, ...]


#: The contract's phrases and labels.
BASE_PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

_V = r"(?: version| v)? ?"
_LIC = r"(?: public)? licen[cs]e"
#: label | identifier in tags | keyword | name in running text | address, if it has one
_LICENSES = rf"""
mit | mit | mit | mit(?: expat)? licen[cs]e | opensource org licenses mit
mit-0 | mit 0 | mit | mit no attribution(?: licen[cs]e)? |
x11 | x11 | x11 | x11 licen[cs]e |
isc | isc | isc | isc licen[cs]e | opensource org licenses isc
0bsd | 0bsd | bsd,0bsd | (?:0bsd|(?:zero clause|0 clause) bsd)(?: licen[cs]e)? |
bsd-2-clause | bsd 2 clause | bsd | (?:(?:simplified|freebsd|2 clause|two clause) bsd|bsd (?:2|two) clause)(?: licen[cs]e)? | opensource org licenses bsd 2 clause
bsd-3-clause | bsd 3 clause | bsd | (?:(?:new|modified|revised|3 clause|three clause) bsd|bsd (?:3|three) clause)(?: licen[cs]e)? | opensource org licenses bsd 3 clause
bsd-4-clause | bsd 4 clause | bsd | (?:(?:original|old|4 clause|four clause) bsd|bsd (?:4|four) clause)(?: licen[cs]e)? |
bsd | bsd | bsd | bsd(?: style)? licen[cs]e |
apache-1 | apache 1 0 | apache | apache (?:software )?licen[cs]e{_V}1 0 |
apache-1.1 | apache 1 1 | apache | apache (?:software )?licen[cs]e{_V}1 1 |
apache-2 | apache 2 0 | apache | apache (?:software )?(?:licen[cs]e )?(?:version |v)?2(?: 0)?(?: licen[cs]e)? | apache org licenses license 2 0
apache | apache | apache | apache (?:software )?licen[cs]e |
gpl-1 | gpl 1 0(?: only| or later)? | gpl | gnu (?:gpl|general public licen[cs]e){_V}1(?: 0)? |
gpl-2-only | gpl 2 0 only | gpl | (?:gnu )?gpl ?v?2 only |
gpl-2 | gpl 2 0(?: or later)? | gpl,general public | (?:(?:gnu )?gpl|gnu general public licen[cs]e) ?(?:version |v)?2(?: 0)? | gnu org licenses (?:old licenses )?gpl 2 0
gpl-3-only | gpl 3 0 only | gpl | (?:gnu )?gpl ?v?3 only |
gpl-3 | gpl 3 0(?: or later)? | gpl,general public | (?:(?:gnu )?gpl|gnu general public licen[cs]e) ?(?:version |v)?3(?: 0)? | gnu org licenses gpl 3 0
gpl | gpl | general public | gnu general public licen[cs]e | gnu org licenses gpl
lgpl-2 | lgpl 2 0(?: only| or later)? | lgpl,general public | (?:(?:gnu )?lgpl|gnu (?:lesser|library) general public licen[cs]e) ?(?:version |v)?2(?: 0)? |
lgpl-2.1 | lgpl 2 1(?: only| or later)? | lgpl,general public | (?:(?:gnu )?lgpl|gnu (?:lesser|library) general public licen[cs]e) ?(?:version |v)?2 1 | gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-3 | lgpl 3 0(?: only| or later)? | lgpl,general public | (?:(?:gnu )?lgpl|gnu (?:lesser|library) general public licen[cs]e) ?(?:version |v)?3(?: 0)? | gnu org licenses lgpl 3 0
lgpl | lgpl | general public | gnu (?:lesser|library) general public licen[cs]e | gnu org licenses lgpl
agpl-3 | agpl 3 0(?: only| or later)? | agpl,general public | (?:(?:gnu )?agpl|gnu affero general public licen[cs]e) ?(?:version |v)?3(?: 0)? | gnu org licenses agpl 3 0
agpl | agpl | general public | gnu affero general public licen[cs]e | gnu org licenses agpl
gfdl-1.1 | gfdl 1 1(?: only| or later)? | documentation | gnu free documentation licen[cs]e{_V}1 1 |
gfdl-1.2 | gfdl 1 2(?: only| or later)? | documentation | gnu free documentation licen[cs]e{_V}1 2 |
gfdl-1.3 | gfdl 1 3(?: only| or later)? | documentation | gnu free documentation licen[cs]e{_V}1 3 |
gfdl | gfdl | documentation | gnu free documentation licen[cs]e | gnu org licenses fdl
mpl-1 | mpl 1 0 | mozilla | mozilla{_LIC}{_V}1 0 |
mpl-1.1 | mpl 1 1 | mozilla | mozilla{_LIC}{_V}1 1 | mozilla org mpl mpl 1 1
mpl-2 | mpl 2 0 | mozilla | mozilla{_LIC}{_V}2(?: 0)? | mozilla org mpl 2 0
mpl | mpl | mozilla | mozilla{_LIC} | mozilla org mpl
epl-1 | epl 1 0 | eclipse | eclipse{_LIC}{_V}1(?: 0)? | eclipse org legal epl v10
epl-2 | epl 2 0 | eclipse | eclipse{_LIC}{_V}2(?: 0)? | eclipse org legal epl (?:v20|2 0)
epl | epl | eclipse | eclipse{_LIC} |
edl-1 | edl 1 0 | eclipse | eclipse distribution licen[cs]e{_V}1(?: 0)? | eclipse org org documents edl v10
cddl-1 | cddl 1 0 | common development | common development and distribution licen[cs]e{_V}1(?: 0)? |
cddl-1.1 | cddl 1 1 | common development | common development and distribution licen[cs]e{_V}1 1 |
cddl | cddl | common development | common development and distribution licen[cs]e |
cpl-1 | cpl 1 0 | common public | common public licen[cs]e(?:{_V}1 0)? |
cpal-1 | cpal 1 0 | common public | common public attribution licen[cs]e(?:{_V}1 0)? |
ipl-1 | ipl 1 0 | ibm | ibm public licen[cs]e(?:{_V}1 0)? |
eupl-1.1 | eupl 1 1 | european union | european union public licen[cs]e{_V}1 1 |
eupl-1.2 | eupl 1 2 | european union | european union public licen[cs]e{_V}1 2 | joinup ec europa eu .{{0,40}}eupl 1 2
eupl | eupl | european union | european union public licen[cs]e |
artistic-1 | artistic 1 0 | artistic | artistic licen[cs]e{_V}1(?: 0)? |
artistic-2 | artistic 2 0 | artistic | artistic licen[cs]e{_V}2(?: 0)? | opensource org licenses artistic license 2 0
artistic | artistic | artistic | artistic licen[cs]e |
zlib | zlib | zlib | zlib(?: libpng)? licen[cs]e | opensource org licenses zlib
libpng | libpng(?: 2 0)? | libpng | libpng licen[cs]e |
unlicense | unlicense | unlicense | (?:the )?unlicense | unlicense org
wtfpl | wtfpl | want to public | do what the (?:fuck|f) you want to public licen[cs]e | wtfpl net
boost-1 | bsl 1 0 | boost | boost software licen[cs]e(?:{_V}1 0)? | boost org license 1 0
postgresql | postgresql | postgresql | postgresql licen[cs]e |
openssl | openssl | openssl | openssl licen[cs]e |
python-2 | (?:psf|python) 2 0 | python | (?:python software foundation|psf|python) licen[cs]e(?:{_V}2)? |
ruby | ruby | ruby | ruby s? ?licen[cs]e |
php-3 | php 3 0 | php | php licen[cs]e{_V}3 0 |
php-3.01 | php 3 01 | php | php licen[cs]e(?:{_V}3 01)? | php net license 3 01
ofl-1.1 | ofl 1 1(?: rfn| no rfn)? | open font | (?:sil )?open font licen[cs]e(?:{_V}1 1)? | scripts sil org ofl
ncsa | ncsa | ncsa | (?:university of illinois )?ncsa(?: open source)? licen[cs]e |
curl | curl | curl | curl licen[cs]e |
vim | vim | vim | vim licen[cs]e |
tcl | tcl | tcl | tcl (?:tk )?licen[cs]e |
w3c | w3c | w3c | w3c (?:software )?(?:notice and )?licen[cs]e | w3 org consortium legal
zpl-2.1 | zpl 2 1 | zope | zope public licen[cs]e(?:{_V}2 1)? |
sleepycat | sleepycat | sleepycat | sleepycat licen[cs]e |
beerware | beerware | beer | beer ?ware licen[cs]e |
ms-pl | ms pl | microsoft | microsoft public licen[cs]e |
ms-rl | ms rl | microsoft | microsoft reciprocal licen[cs]e |
afl-3 | afl 3 0 | academic free | academic free licen[cs]e(?:{_V}3 0)? |
osl-3 | osl 3 0 | open software | open software licen[cs]e(?:{_V}3 0)? |
ecl-2 | ecl 2 0 | educational | educational community licen[cs]e(?:{_V}2 0)? |
upl-1 | upl 1 0 | universal permissive | universal permissive licen[cs]e(?:{_V}1 0)? | oss oracle com licenses upl
apsl-2 | apsl 2 0 | apple | apple public source licen[cs]e(?:{_V}2 0)? |
mulan-2 | mulanpsl 2 0 | mulan | mulan (?:psl|permissive software licen[cs]e)(?:{_V}2)? | license coscl org cn mulanpsl2
sspl-1 | sspl 1 0 | server side | server side public licen[cs]e(?:{_V}1)? |
busl-1.1 | busl 1 1 | business source | business source licen[cs]e(?:{_V}1 1)? | mariadb com bsl11
elastic-2 | elastic 2 0 | elastic | elastic licen[cs]e(?:{_V}2(?: 0)?)? | elastic co licensing elastic license
polyform-nc-1 | polyform noncommercial 1 0 0 | polyform | polyform noncommercial licen[cs]e(?:{_V}1 0 0)? | polyformproject org licenses noncommercial
cc0-1 | cc0 1 0 | cc0 | cc0(?: 1 0)?(?: universal)?(?: public domain dedication)? | creativecommons org publicdomain zero
cc-pdm-1 | cc pdm 1 0 | public domain | public domain mark(?: 1 0)? | creativecommons org publicdomain mark
odbl-1 | odbl 1 0 | database | open(?: data commons)? (?:open )?database licen[cs]e(?:{_V}1 0)? | opendatacommons org licenses odbl
odc-by-1 | odc by 1 0 | data commons | open data commons attribution licen[cs]e(?:{_V}1 0)? | opendatacommons org licenses by
pddl-1 | pddl 1 0 | data commons | open data commons public domain dedication(?: and)? licen[cs]e(?:{_V}1 0)? | opendatacommons org licenses pddl
ogl-uk-3 | ogl uk 3 0 | open government | open government licen[cs]e(?:{_V}3 0)? | nationalarchives gov uk doc open government licence
"""

#: label | keyword | words of a license's own text that no other license has
_TEXTS = r"""
mit | hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | sell copies | use copy modify merge publish distribute sublicense and or sell copies of the software
isc | hereby granted | permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted
apache-2 | apache | licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
bsd | redistribution | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd-3-clause | endorse | neither the name of .{1,120} nor the names of its contributors may be used to endorse or promote products derived from this software
bsd-4-clause | advertising | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
gpl-2 | published by the free | it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-3 | published by the free | it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl-2-only | published by the free | gnu general public license version 2 (?:only )?as published by the free software foundation
lgpl-2.1 | published by the free | gnu lesser general public license as published by the free software foundation either version 2 1 of the license
lgpl-3 | published by the free | gnu lesser general public license as published by the free software foundation either version 3 of the license
lgpl-2 | published by the free | gnu library general public license as published by the free software foundation either version 2 of the license
agpl-3 | affero | gnu affero general public license as published by the free software foundation either version 3 of the license
gpl | warranty of | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details
lgpl | warranty of | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu lesser general public license for more details
mpl-2 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1 | mozilla | the contents of this file are subject to the mozilla public license version 1 1
epl-1 | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
epl-2 | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public license 2 0
cddl-1 | common development | the contents of this file are subject to the terms of the common development and distribution license
zlib | altered source | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
unlicense | unencumbered | this is free and unencumbered software released into the public domain
wtfpl | want to | you just do what the (?:fuck|f) you want to
boost-1 | hereby granted | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
ofl-1.1 | font software | the font software may be sold as part of a larger software package
cc0-1 | dedicated the work | the person who associated a work with this deed has dedicated the work to the public domain
artistic-2 | artistic | everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed (?:.{0,80} )?artistic
beerware | beer | as long as you retain this notice you can do whatever you want with this stuff .{0,120}buy me a beer
postgresql | written agreement | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
sspl-1 | making the functionality | making the functionality of the program or modified version available to third parties as a service
gfdl | invariant | with no invariant sections no front cover texts and no back cover texts
all-rights-reserved | rights reserved | (?:copyright .{0,80})?all rights reserved
"""

#: The Creative Commons family: label's end | words | short words
_CC = (("by", "attribution", "by"), ("by-sa", "attribution share ?alike", "by sa"), ("by-nd", "attribution no ?deriv(?:ative)?s?(?:tives)?", "by nd"),
       ("by-nc", "attribution non ?commercial", "by nc"), ("by-nc-sa", "attribution non ?commercial share ?alike", "by nc sa"),
       ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?:tives)?", "by nc nd"))
_CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
_UNDER = r"(?:licen[cs]ed|released|distributed|available|provided|published|redistributed|shared|covered|governed)(?: to you)? (?:under|by) (?:the )?(?:terms (?:of|and conditions of) (?:the )?)?"


def base_rules(phrases: Sequence[tuple[str, str]] = BASE_PHRASES) -> list[Rule]:
    return [Rule(f"base {label}", label, "base", re.escape(words).replace("\\ ", " "), (words,)) for words, label in phrases]


@functools.cache
def signature_rules() -> tuple[Rule, ...]:
    """The method's own rules, in order."""
    rules = []
    for line in _LICENSES.strip().splitlines():
        label, tag, keyword, name, address = _split(line)
        rules.append(Rule(f"tag {label}", label, "tag", f"spdx license identifier (?:[a-z0-9 ]{{1,30}}? (?:or|and) ){{0,3}}?(?P<own>{tag})", ("spdx license identifier",)))
        rules.append(Rule(f"notice {label}", label, "notice", f"{_UNDER}{name}", tuple(keyword.split(","))))
        rules.append(Rule(f"name {label}", label, "name", name, tuple(keyword.split(","))))
        if address:
            rules.append(Rule(f"address {label}", label, "address", address, (_longest_word(address),)))
    for line in _TEXTS.strip().splitlines():
        label, keyword, words = (x.strip() for x in line.split(" | ", 2))
        rules.append(Rule(f"text {label}", label, "text", words, (keyword,)))
    for end, words, short in _CC:
        for version in _CC_VERSIONS:
            rules.append(Rule(f"tag cc-{end} {version}", f"cc-{end}", "tag", f"spdx license identifier (?:[a-z0-9 ]{{1,30}}? (?:or|and) ){{0,3}}?(?P<own>cc {short} {version})", ("spdx license identifier",)))
            rules.append(Rule(f"notice cc-{end} {version}", f"cc-{end}", "notice", f"{_UNDER}(?:an? )?creative commons {words}(?: {version})?(?: international| unported| generic)? licen[cs]e", ("creative commons",)))
            rules.append(Rule(f"address cc-{end} {version}", f"cc-{end}", "address", f"creativecommons org licenses {short} {version}", ("creativecommons org licenses",)))
            rules.append(Rule(f"name cc-{end} {version}", f"cc-{end}", "name", f"cc {short} {version}", (f"cc {short}",)))
        rules.append(Rule(f"name cc-{end} long", f"cc-{end}", "name", f"creative commons {words}", ("creative commons",)))
        rules.append(Rule(f"name cc-{end}", f"cc-{end}", "name", f"cc {short}(?: licen[cs]e)?", (f"cc {short}",)))
    return tuple(rules)


def _split(line: str) -> list[str]:
    """The five fields of a line; a bar within brackets is part of its field."""
    fields, depth = [""], 0
    for sign in line:
        depth += (sign == "(") - (sign == ")")
        if sign == "|" and not depth:
            fields.append("")
        else:
            fields[-1] += sign
    return [f.strip() for f in fields]


def _longest_word(address: str) -> str:
    return max(re.sub(r"\(.*?\)\??|\.\{.*?\}", " | ", address).split("|"), key=len).strip()


@dataclass(frozen=True)
class Detection:
    label: str
    rule: str
    level: int
    order: int
    start: int  # in the words' text
    end: int


class Scanner:
    """The rules made ready: one automaton of their keywords, one pattern each."""

    def __init__(self, rules: Sequence[Rule]) -> None:
        self.rules = list(rules)
        levels = list(LEVELS)
        self.level = [levels.index(r.level) for r in self.rules]
        # a lookahead for base phrases, so that places which overlap are all found
        self.patterns = [re.compile(f"(?<= )(?=({r.pattern}) )" if r.level == "base" else f"(?<= )({r.pattern})(?= )") for r in self.rules]
        self.gates = ahocorasick.Automaton()
        by_keyword: dict[str, list[int]] = {}
        for i, r in enumerate(self.rules):
            for k in r.keywords:
                by_keyword.setdefault(f" {k}", []).append(i)  # at the start of a word
        for k, which in by_keyword.items():
            self.gates.add_word(k, tuple(which))
        self.gates.make_automaton()

    def gated(self, text: str) -> list[int]:
        """The rules of which a keyword occurs, in order."""
        return sorted({i for which in {w for _, w in self.gates.iter(text)} for i in which})

    def found(self, text: str) -> list[Detection]:
        """All matches in a text of words that starts and ends with a space."""
        out = []
        for i in self.gated(text) if self.rules else []:
            r = self.rules[i]
            own = "own" if "own" in self.patterns[i].groupindex else 1
            out += [Detection(r.label, r.name, self.level[i], i, *m.span(own)) for m in self.patterns[i].finditer(text)]
        return out

    def kept(self, found: list[Detection]) -> list[Detection]:
        """Without those contained in better ones; base detections all stay."""
        starts: list[int] = []
        ends: list[int] = []  # the furthest end of the kept ones that start up to here
        kept: list[Detection] = []
        for level in range(len(LEVELS)):
            last, new = -1, []
            for d in sorted((d for d in found if d.level == level), key=lambda d: (d.start, -d.end, d.order)):
                at = bisect_right(starts, d.start)
                if level == 0 or (d.end > last and not (at and ends[at - 1] >= d.end)):
                    new.append(d)
                last = max(last, d.end)
            kept += new
            starts, ends, furthest = [], [], -1
            for d in sorted(kept, key=lambda d: d.start):
                furthest = max(furthest, d.end)
                starts.append(d.start)
                ends.append(furthest)
        return sorted(kept, key=lambda d: (d.start, d.level, d.order))


def words_text(raw: bytes) -> tuple[str, int]:
    """(the words with a space before, between and after them, byte for byte; their number)."""
    spaced = raw.translate(_KEPT)
    if len(spaced) <= 4 << 20:
        words = spaced.split()
        return f" {b' '.join(words).decode('latin-1')} ", len(words)
    spaced = re.sub(rb" +", b" ", b" " + spaced + b" ")
    return spaced.decode("latin-1"), spaced.count(b" ") - 1


def scan(scanner: Scanner, raw: bytes) -> dict:
    """The outputs for one text."""
    text, n = words_text(raw)
    kept = scanner.kept(scanner.found(text)) if n else []
    base = [d for d in kept if d.level == 0]
    spaces = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32) if kept else np.zeros(0, np.int64)
    word = lambda place: int(np.searchsorted(spaces, place)) - 1
    weights = list(LEVELS.values())
    return {
        "n_words": n, "n_base": len(base),
        "first_word": word(min(d.start for d in base)) if base else None, "last_word": word(max(d.start for d in base)) if base else None,
        "base_labels": ",".join(sorted({d.label for d in base})), "labels": ",".join(sorted({d.label for d in kept})),
        "score": max((weights[d.level] for d in kept), default=0.0),
        "detections": [{"label": d.label, "rule": d.rule, "first_word": word(d.start), "n_words": text.count(" ", d.start, d.end) + 1} for d in kept],
    }


def scan_licenses(docs: DataFrame, text_col: str = "text", phrases: Sequence[tuple[str, str]] = BASE_PHRASES,
                  rules: Sequence[Rule] | None = None) -> DataFrame:
    """The input's columns with ``n_words``; ``n_base``, ``first_word``, ``last_word`` (places
    of the base phrases, in words from 0) and ``base_labels``; ``labels`` (those and the
    rules' own; sorted, joined by commas), ``score`` and ``detections``."""
    every = [*base_rules(phrases), *(signature_rules() if rules is None else rules)]
    names = [c for c in docs.columns if c.lower() not in OUTPUTS]
    kept = [f"__in{i}" for i in range(len(names))]  # Python steps can't name columns with dots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(every)
        kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(),
                                    pa.list_(pa.struct([("label", pa.string()), ("rule", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())]))]
        for batch in batches:
            for part in text_slices(batch, "__text"):
                found = [scan(scanner, raw or b"") for raw in part.column("__text").to_pylist()]
                made = [pa.array([f[o] for f in found], kind) for o, kind in zip(OUTPUTS, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *made], [*kept, *OUTPUTS])

    rows = docs.select(*[col(c).alias(k) for c, k in zip(names, kept, strict=True)], col(text_col).cast("string").cast("binary").alias("__text"))
    made = StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in zip(OUTPUTS, ["long"] * 4 + ["string", "string", "double", DETECTIONS], strict=True)))
    schema = StructType([*rows.drop("__text").schema.fields, *made.fields])
    return rows.mapInArrow(run, schema).toDF(*names, *OUTPUTS)
