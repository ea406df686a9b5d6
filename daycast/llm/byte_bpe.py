"""A byte-level BPE vocabulary file (tokenizers' JSON) as byte strings, loaded once per process."""

from __future__ import annotations

import functools
import json
from dataclasses import dataclass

import regex
import tiktoken
from tokenizers import Tokenizer

#: The byte-level pre-tokenizer's pattern: contractions, letters, digits, other signs, space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same in the form that the encoder's own definition of this vocabulary uses, for speed.
QUICK = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


def _byte_signs() -> dict[str, int]:
    """The sign by which the file writes each byte: itself where printable, else from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class ByteBpe:
    """Token ids by bytes, the merges, special strings, and fast and plain encoders.

    ``ranks`` has a merge's place by its two ids (``left << 32 | right``); ``halves`` the two
    ids that a token is merged from, and its merge's place.
    """

    ids: dict[bytes, int]
    ranks: dict[int, int]
    halves: dict[int, tuple[int, int, int]]
    special: tuple[str, ...]
    encoding: tiktoken.Encoding
    library: Tokenizer
    pattern: regex.Pattern


def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec["pre_tokenizer"], spec["model"]
    if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or model["type"] != "BPE" or model["ignore_merges"]:
        raise ValueError(f"{path} is not a plain byte-level BPE")
    return spec


class Encoder:
    """Only what encoding takes: ids by bytes, special strings, the fast encoder, and the library
    from when a text first needs it. A task makes one and drops it at its end."""

    def __init__(self, path: str) -> None:
        self.path = path
        spec = _spec(path)
        sign = _byte_signs()
        self.special = tuple(t["content"] for t in spec["added_tokens"])
        self.ids = {bytes(sign[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        del spec
        self.encoding = tiktoken.Encoding("file", pat_str=QUICK, mergeable_ranks=self.ids, special_tokens={})

    @functools.cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)


@functools.lru_cache(maxsize=4)
def load(path: str) -> ByteBpe:
    """Read the file at ``path``; refuses files whose rules this module does not cover."""
    spec = _spec(path)
    model = spec["model"]
    sign = _byte_signs()
    raw = lambda token: bytes(sign[c] for c in token)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ids = {raw(t): i for t, i in model["vocab"].items() if t not in special}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merges = [(raw(a), raw(b)) for a, b in pairs]
    made = [ids[a + b] for a, b in merges]
    if made != sorted(set(made)) or len(made) + 256 != len(ids):
        raise ValueError(f"the merges of {path} do not make its tokens one by one, in the order of their ids")
    ranks = {ids[a] << 32 | ids[b]: i for i, (a, b) in enumerate(merges)}
    halves = {ids[a + b]: (ids[a], ids[b], i) for i, (a, b) in enumerate(merges)}
    encoding = tiktoken.Encoding("file", pat_str=QUICK, mergeable_ranks=ids, special_tokens={})
    return ByteBpe(ids, ranks, halves, tuple(special), encoding, Tokenizer.from_file(path), regex.compile(QUICK))
