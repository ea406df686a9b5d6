"""Token counts of whole texts and of all their prefixes, by dynamic programming.

Byte-pair encoding has a local rule: a sequence of tokens is the encoding of its bytes
exactly when each two neighbours are the encoding of theirs, and the prefix of an encoding
that ends with one of its tokens is that prefix's encoding. So the encoding of every
prefix follows from shorter ones: its last token t is the one suffix in the vocabulary
that stands the rule with the last token before it, and count[i] = count[i - len(t)] + 1.
One pass over the bytes of a pre-token (a word with its space) gives the counts of all
its prefixes; pre-tokens are independent, so a text's counts are theirs strung together.
Pre-tokens that were met before are looked up (a bounded table in each task).

The stored form is one 16-bit difference per character: their running sum is the number of
tokens in each prefix. From it a truncation or a budget is answered without encoding again
(``count_in_prefix``, ``longest_prefix``).

The counts are those of the vocabulary's library: its special strings count one token
each, also inside a text; no begin or end tokens, no truncation. Where a prefix ends
inside space or a contraction, or within a special string, it is cut into pre-tokens as
it stands, not as the longer text is.

Defined cases
- Null text: counted as empty (0 bytes, 0 tokens).
- Very long texts are taken in pieces cut where a pre-token starts; a very long pre-token
  is one pass over its bytes.
- Repeated rows get the same counts; a null id is carried through.
- Input columns named like an output are replaced by it; all others are carried through.
"""

from __future__ import annotations

import functools
from array import array
from collections.abc import Iterator
from operator import sub

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame

from daycast.llm.byte_bpe import ByteBpe, load
from daycast.llm.common import col, others

PIECE = 1 << 20
MEMO = 150_000
LONG = 64
#: Signs outside these ranges may be classed otherwise by another Unicode version; their
#: texts are cut into pre-tokens by the vocabulary's library itself.
_UNSURE = regex.compile(r"[^\x00-\u052F\u2010-\u2027\u3041-\u3096\u30A1-\u30FA\u4E00-\u9FA5\uAC00-\uD7A3]")
_GAP = regex.compile(r"(?<=\S) (?=\S)")
_SPACES = regex.compile(r"\s\s")


NEVER = 1 << 60


class PrefixCounter:
    """Prefix token counts of texts under one vocabulary."""

    def __init__(self, bpe: ByteBpe) -> None:
        self.bpe = bpe
        self.special = regex.compile("|".join(map(regex.escape, sorted(bpe.special)))) if bpe.special else None
        # the tokens from their last byte backwards: (node, byte) -> node, and the token that ends there
        self.next: dict[int, int] = {}
        self.token = [-1]
        for raw, token in bpe.ids.items():
            node = 0
            for byte in reversed(raw):
                step = node << 8 | byte
                node = self.next.get(step, 0)
                if not node:
                    node = self.next[step] = len(self.token)
                    self.token.append(-1)
            self.token[node] = token
        self.edges: tuple[dict[int, list], dict[int, list]] = {}, {}
        self.stands_memo: dict[int, bool] = {}
        self.memo: dict[str, tuple[int, bytes]] = {}
        self.older: dict[str, tuple[int, bytes]] = {}

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens at the left (0) or right (1) edge of a token while it is merged, from a
        byte to itself, each with the place of the merge that takes it in."""
        found = self.edges[side].get(token)
        if found is None:
            found, at, taken = [], token, NEVER
            while True:
                found.append((at, taken))
                if at not in self.bpe.halves:
                    break
                halves = self.bpe.halves[at]
                at, taken = halves[side], halves[2]
            found.reverse()
            self.edges[side][token] = found
        return found

    def stands(self, left: int, right: int) -> bool:
        """Whether two tokens side by side are the encoding of their bytes: whether no merge
        across their border is due before the merges within them take its two sides in."""
        key = left << 32 | right
        known = self.stands_memo.get(key)
        if known is None:
            ranks, lefts, rights = self.bpe.ranks, self.edge(left, 1), self.edge(right, 0)
            i = j = 0
            known = True
            while True:
                (x, x_taken), (y, y_taken) = lefts[i], rights[j]
                across = ranks.get(x << 32 | y, NEVER)
                if across < x_taken and across <= y_taken and across < NEVER:  # of equal merges the left one comes first
                    known = False
                    break
                if x_taken <= y_taken:
                    i += 1
                else:
                    j += 1
                if i == len(lefts) or j == len(rights):
                    break
            if len(self.stands_memo) >= 4 * MEMO:
                self.stands_memo.clear()
            self.stands_memo[key] = known
        return known

    def byte_counts(self, raw: bytes) -> list[int]:
        """count[i]: tokens of the first i bytes of one pre-token."""
        follow, tokens, known, stands = self.next.get, self.token, self.stands_memo.get, self.stands
        count, last = [0], [-1]
        for i in range(len(raw)):
            node, k = 0, i
            while k >= 0:
                node = follow(node << 8 | raw[k])
                if node is None:
                    raise ValueError(f"no encoding of {raw[:i + 1]!r}")
                token = tokens[node]
                if token >= 0:
                    if not k:
                        break
                    before = last[k]
                    ok = known(before << 32 | token)
                    if ok or ok is None and stands(before, token):
                        break
                k -= 1
            count.append(count[k] + 1)
            last.append(token)
        return count

    def deltas(self, word: str) -> tuple[int, bytes]:
        """(tokens, 16-bit differences of the counts after each character) of a pre-token."""
        found = self.older.get(word)
        if found is None:
            raw = word.encode()
            count = self.byte_counts(raw)
            if len(raw) == len(word):
                ends = count
            else:
                ends = [0, *(count[i] for i in range(1, len(raw) + 1) if i == len(raw) or raw[i] & 0xC0 != 0x80)]
            if len(word) == 3 and word[0] == "'":  # cut after two signs, it is no contraction
                ends[2] = sum(self.byte_counts(p.encode())[-1] for p in self.bpe.pattern.findall(word[:2]))
            found = count[-1], array("h", map(sub, ends[1:], ends)).tobytes()
        if len(word) <= LONG:
            if len(self.memo) >= MEMO:
                self.memo, self.older = {}, self.memo
            self.memo[word] = found
        return found

    def words(self, text: str) -> list[str]:
        """The pre-tokens of a text."""
        if _UNSURE.search(text) is None:
            return self.bpe.pattern.findall(text)
        return [text[s:e] for _, (s, e) in self.bpe.library.pre_tokenizer.pre_tokenize_str(text)]

    def ordinary(self, text: str) -> tuple[int, bytes]:
        """The same for a text without special strings."""
        total, out = 0, []
        for piece in _pieces(text):
            words = self.words(piece)
            known, deltas = self.memo.get, self.deltas
            told = [known(w) or deltas(w) for w in words]
            total += sum([t[0] for t in told])
            strung = b"".join([t[1] for t in told])
            if _SPACES.search(piece):
                strung = self._space_runs(words, told, strung)
            out.append(strung)
        return total, b"".join(out)

    def _space_runs(self, words: list[str], told: list[tuple[int, bytes]], strung: bytes) -> bytes:
        """A run of spaces gives its last one to what follows, but a prefix that ends there
        has the whole run as one pre-token."""
        differences = np.frombuffer(strung, "<i2").copy()
        at = 0
        for k, w in enumerate(words):
            after = words[k + 1] if k + 1 < len(words) else ""
            at += len(w)
            if after and w.isspace() and after[0].isspace():
                step = self.byte_counts((w + after[0]).encode())[-1] - told[k][0] - int(np.frombuffer(told[k + 1][1], "<i2", 1)[0])
                differences[at] += step
                if at + 1 < len(differences):
                    differences[at + 1] -= step
        return differences.tobytes()

    def text(self, text: str) -> tuple[int, bytes]:
        """(tokens, differences) of a whole text, special strings counting one each."""
        total, at, out = 0, 0, []
        for found in self.special.finditer(text) if self.special else ():
            # inside the special string a prefix is ordinary text
            chars = found.start() - at
            inside = np.frombuffer(self.ordinary(text[at:found.end() - 1])[1], "<i2")
            before = int(inside[:chars].sum(dtype=np.int64))
            out += [inside.tobytes(), np.array([1 - int(inside[chars:].sum(dtype=np.int64))], "<i2").tobytes()]
            total, at = total + before + 1, found.end()
        if at < len(text) or not out:
            rest, deltas = self.ordinary(text[at:] if at else text)
            total += rest
            out.append(deltas)
        return total, b"".join(out)


@functools.lru_cache(maxsize=2)
def counter_for(path: str) -> PrefixCounter:
    """The counter of a vocabulary file, kept with what it knows by a worker's later tasks."""
    return PrefixCounter(load(path))


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces cut at single spaces between words, where a pre-token starts anyway."""
    at = 0
    while len(text) - at > PIECE:
        gap = _GAP.search(text, at + PIECE)
        if gap is None:
            break
        yield text[at:gap.start()]
        at = gap.start()
    yield text[at:] if at else text


def counts(deltas: bytes) -> np.ndarray:
    """Tokens of each prefix, by its number of characters (from 0)."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(deltas, "<i2"), dtype=np.int64)])


def count_in_prefix(stored: bytes, chars: int) -> int:
    """Tokens of the first ``chars`` characters of a text with this stored form."""
    return int(counts(zstandard.decompress(stored))[chars])


def longest_prefix(stored: bytes, budget: int) -> int:
    """Characters of the longest prefix that takes at most ``budget`` tokens."""
    return int(np.flatnonzero(counts(zstandard.decompress(stored)) <= budget)[-1])


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", budget: int | None = None, store: bool = True) -> DataFrame:
    """The input's columns but the text, with ``n_bytes`` and ``n_tokens`` (longs); with
    ``budget`` also ``fitting_chars`` (long: the longest prefix of at most so many tokens),
    and with ``store`` the stored form ``prefix_counts`` (binary)."""
    outputs = ["n_bytes", "n_tokens", *(["fitting_chars"] if budget is not None else []), *(["prefix_counts"] if store else [])]
    names = [c for c in docs.columns if c.lower() not in [o.lower() for o in [text_col, *outputs]]]
    carried = [f"__in{i}" for i in range(len(names))]  # Python steps can't name columns with dots
    rest = [c.alias(n) for n, c in zip(carried, others(docs, [text_col, *outputs]), strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_for(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [t or "" for t in part.column("__text").to_pylist()]
                n_bytes, n_tokens, fitting, stored = [], [], [], []
                for text in texts:
                    n, deltas = counter.text(text)
                    n_bytes.append(len(text.encode()))
                    n_tokens.append(n)
                    if budget is not None:
                        fitting.append(int(np.flatnonzero(counts(deltas) <= budget)[-1]) if n > budget else len(text))
                    if store:
                        stored.append(zstandard.compress(deltas, 1))
                made = [pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())]
                made += [pa.array(fitting, pa.int64())] if budget is not None else []
                made += [pa.array(stored, pa.binary())] if store else []
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carried), *made], [*carried, *outputs])

    schema = docs.select(*rest).schema
    for name in outputs:
        schema = schema.add(name, "binary" if name == "prefix_counts" else "long")
    return docs.select(*rest, col(text_col).cast("string").alias("__text")).mapInArrow(run, schema).toDF(*names, *outputs)
