"""Pack token sequences in order, cutting where it costs least.

The documents of a partition are one stream of tokens, in row order; a window is a piece
of it of at most ``max_len`` tokens. A window may end at a document's end (free), at a
sentence's end inside one (``sentence_cost``), or, where none does for ``plain_gap`` tokens, at a
plain place (``plain_cost``). The cuts are those of least padding plus costs. With c[j]
the least cost of the stream up to place b[j]:

    c[j] = cost[j] + max_len - b[j] + min(c[i] + b[i])   over b[j] - max_len <= b[i] < b[j]

The minimum over the sliding range comes from a queue kept monotone, so the whole is linear
in the number of places. The stream is decided in runs of about ``run_tokens`` tokens; a
run's last window is reopened in the next run, so memory is bounded. The partition's last
window is cut into powers of two, which need no padding. Neither counts as padded, else
the slack of the last window would only be spread over the others.

Rows are packed where they are, without a shuffle: the order kept is that of each input
partition. For an order over the table, sort it by range first.

Defined cases
- Null or empty text: only the end token. Null ids are carried through.
- A text longer than a window takes several; every token is in exactly one piece.
- Repeated rows are packed again; an empty table gives no piece.
- Only the id and the text are read; other columns, under any name, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from daycast.llm.byte_bpe import Encoder
from daycast.llm.common import col, text_slices

SENTENCE_SIGNS = b".!?\n"


@dataclass
class Part:
    """What is left of a document: its tokens from ``start`` on; ``ends``: where sentences end in them."""

    doc: object
    total: int
    start: int
    ids: np.ndarray
    ends: np.ndarray


def encode(bpe: Encoder, text: str, end_id: int) -> np.ndarray:
    """The library's ids of a text, and the end id. Special strings go through the library
    itself, and so do texts that the fast encoder's pattern refuses (very long runs of space)."""
    ids = None
    if not any(s in text for s in bpe.special):
        try:
            ids = bpe.encoding.encode_to_numpy(text, disallowed_special=())
        except ValueError:
            pass
    if ids is None:
        ids = np.array(bpe.library.encode(text, add_special_tokens=False).ids, np.uint32)
    return np.append(ids.astype("<u4"), np.uint32(end_id)).astype("<u4")


def places(parts: list[Part], plain_gap: int, sentence_cost: float, plain_cost: float) -> tuple[np.ndarray, np.ndarray]:
    """(places where the stream may be cut, what a cut there costs), from 0 to its end; no
    two neighbours are further apart than ``plain_gap`` tokens."""
    sizes = np.array([len(p.ids) for p in parts])
    ends = np.cumsum(sizes)
    kind = np.zeros(int(ends[-1]) + 1, np.uint8)  # 1: a sentence ends, 2: plain, 3: a document ends
    kind[np.concatenate([p.ends + f for p, f in zip(parts, ends - sizes, strict=True)])] = 1
    kind[0] = 3
    kind[ends] = 3
    found = np.flatnonzero(kind)
    more = (np.diff(found) - 1) // plain_gap
    nth = np.arange(int(more.sum())) - np.repeat(np.cumsum(more) - more, more) + 1
    kind[np.repeat(found[:-1], more) + nth * plain_gap] = 2
    at = np.flatnonzero(kind)
    return at, np.array([0.0, sentence_cost, plain_cost, 0.0])[kind[at]]


def best_cuts(at: list[int], cost: list[float], max_len: int, piece_cost: float | None = None) -> list[int]:
    """Indexes of the places at which windows start and end, of least padding plus costs.
    With ``piece_cost`` the last window is not padded but costs so much for each power of
    two in its length (it is cut into those, or decided again)."""
    n = len(at)
    before = [0] * n
    keys = [0.0] * n  # c[i] + b[i]
    queue = [0] * n  # indexes, keys rising
    head, tail = 0, 1
    for j in range(1, n):
        b = at[j]
        low = b - max_len
        while at[queue[head]] < low:
            head += 1
        i = queue[head]
        before[j] = i
        key = keys[j] = keys[i] + cost[j] + max_len
        while tail > head and keys[queue[tail - 1]] >= key:
            tail -= 1
        queue[tail] = j
        tail += 1
    if piece_cost is not None:
        i, end, least = n - 2, at[-1], float("inf")
        while i >= 0 and end - at[i] <= max_len:
            spent = keys[i] - at[i] + piece_cost * (end - at[i]).bit_count()
            if spent < least:
                before[n - 1], least = i, spent
            i -= 1
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(before[cuts[-1]])
    return cuts[::-1]


def in_powers(bounds: np.ndarray, max_len: int, plain_cost: float) -> np.ndarray:
    """Cut the last window into powers of two, which need no padding, while that costs less."""
    start, end = int(bounds[-2]), int(bounds[-1])
    cuts = []
    while (n := end - start) & (n - 1) and max_len - n > plain_cost:
        start += 1 << (n.bit_length() - 1)
        cuts.append(start)
    return np.concatenate([bounds[:-1], np.array(cuts, bounds.dtype), bounds[-1:]])


PIECES = "doc_id long, start long, length long, token_bytes binary, doc_tokens long, sequence_id long, offset long, sequence_tokens long, padded_tokens long"


def padded(n: np.ndarray, max_len: int) -> np.ndarray:
    """Lengths after padding: a power of two stays, everything else is filled up."""
    return np.where((n & (n - 1)) == 0, n, max_len)


def pieces(parts: list[Part], bounds: np.ndarray, first_sequence: int, max_len: int) -> pa.RecordBatch:
    """The pieces of the windows between ``bounds`` (places in the stream)."""
    sizes = np.array([len(p.ids) for p in parts])
    firsts = np.cumsum(sizes) - sizes
    stream = np.concatenate([p.ids for p in parts])
    start = np.union1d(bounds[:-1], firsts[firsts < bounds[-1]])
    stop = np.append(start[1:], bounds[-1])
    doc = np.searchsorted(firsts, start, "right") - 1
    window = np.searchsorted(bounds, start, "right") - 1
    raw = memoryview(stream.tobytes())
    sent = np.diff(bounds)[window]
    in_doc = np.array([p.start for p in parts])[doc] + start - firsts[doc]
    return pa.RecordBatch.from_arrays([
        pa.array([parts[d].doc for d in doc.tolist()], pa.int64()), pa.array(in_doc, pa.int64()), pa.array(stop - start, pa.int64()),
        pa.array([bytes(raw[4 * s:4 * e]) for s, e in zip(start.tolist(), stop.tolist(), strict=True)], pa.binary()),
        pa.array(np.array([p.total for p in parts])[doc], pa.int64()), pa.array(first_sequence + window, pa.int64()), pa.array(start - bounds[window], pa.int64()),
        pa.array(sent, pa.int64()), pa.array(padded(sent, max_len), pa.int64()),
    ], ["doc_id", "start", "length", "token_bytes", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "padded_tokens"])


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", max_len: int = 2048, end_id: int = 1,
         sentence_cost: float = 4.0, plain_cost: float = 16.0, plain_gap: int = 16, run_tokens: int = 1 << 18) -> DataFrame:
    """Pieces of the documents' tokens (by the vocabulary file at ``path``, then ``end_id``):
    ``doc_id``, ``start`` (in its document), ``length``, ``token_bytes`` (little-endian 32-bit
    ids), ``doc_tokens``, ``sequence_id``, ``offset`` (in its sequence), and the sequence's
    ``sequence_tokens`` and ``padded_tokens``."""
    plain_gap = min(plain_gap, max_len)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Encoder(path)
        ends_sentence = np.zeros(max(max(bpe.ids.values()), end_id) + len(bpe.special) + 1, bool)
        for token, i in bpe.ids.items():
            ends_sentence[i] = any(s in token for s in SENTENCE_SIGNS)
        sequence = TaskContext.get().partitionId() << 33
        parts: list[Part] = []
        held = 0

        def decide(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal parts, held, sequence
            at, cost = places(parts, plain_gap, sentence_cost, plain_cost)
            cuts = best_cuts(at.tolist(), cost.tolist(), max_len, plain_cost if final else 0.0)
            bounds = at[cuts]
            if final:
                bounds = in_powers(bounds, max_len, plain_cost)
            else:
                bounds = bounds[:-1]  # the last window is decided again with what follows
            if len(bounds) > 1:
                yield pieces(parts, bounds, sequence, max_len)
                sequence += len(bounds) - 1
            rest, at_doc = [], 0
            for p in parts if not final else []:
                skip = int(bounds[-1]) - at_doc
                at_doc += len(p.ids)
                if skip < len(p.ids):
                    skip = max(skip, 0)
                    rest.append(Part(p.doc, p.total, p.start + skip, p.ids[skip:], p.ends[p.ends > skip] - skip))
            parts, held = rest, sum(len(p.ids) for p in rest)

        for part in (part for batch in batches for part in text_slices(batch, "text")):
            for doc, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                ids = encode(bpe, text or "", end_id)
                ends = np.flatnonzero(ends_sentence[ids[:-2]]) + 1
                parts.append(Part(doc, len(ids), 0, ids, ends))
                held += len(ids)
                if held >= run_tokens:
                    yield from decide(False)
        if parts:
            yield from decide(True)

    rows = docs.select(col(id_col).cast("long").alias("id"), col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES)
