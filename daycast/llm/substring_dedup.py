"""Substring de-duplication: remove the words of every run of ``window`` words that also
starts earlier, found through difference-cover anchors.

A difference cover D modulo v has, for any two positions, a shift below v that takes both
into D. So two equal windows of L words share an aligned anchor: a run of L - v + 1 words
that starts, in both texts at the same shift below v, at a position whose remainder
modulo v is in D. With v = 13 and D = {0, 1, 3, 9}, four in thirteen positions are hashed
(anchors of L - 12 words), instead of every one.

1. Anchors: every text's anchors are hashed. Within a task, anchors seen twice are known
   to repeat; each distinct hash goes once per task, packed in binary rows by bucket, to
   find repeats between tasks. A passage that any share of the documents holds is thus
   one record a task. A false repeat (hashes travel with 32 bits within the bucket) only
   costs a comparison later.
2. Windows: texts with repeated anchors meet them again; each window that has a repeated
   anchor is extended to its ``window`` words and hashed with 96 bits within its bucket.
   Per task the earliest start of a window is sent, the later ones are known repeats; the
   earliest of all tasks stays, the others are repeats too.
3. Removal: the union of the repeats' words is removed from each text.

Both passes read the same shuffle of the texts by document. Hashes come from numpy over
whole Arrow buffers; nothing is compared pair by pair.

Defined cases
- Null text, or one without words: no words, nothing removed, the kept text is empty.
- Ids are integers (long).
- Rows of the same id are versions of one document: of equal windows that start at the
  same place none is earlier, and each version loses its own words.
- A null id: the row's words are kept whole, and it makes nothing else a repeat.
- Words are compared unchanged; the kept words are joined by one space.
- Input columns named like an output are replaced by it; all others are carried through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.llm.common import col, others

PERIOD = 13
COVER = (0, 1, 3, 9)  # every difference modulo 13 is that of two of these
BYTES = 2 << 20  # of text hashed at a time
WORDS = 1 << 21  # held by a task before its packed rows go out
BUCKET_WORDS = 1 << 23
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (multiply and shift rounds)."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_NEAR = 64
with np.errstate(over="ignore"):
    #: A random number for each (place in the word, byte), for the first places.
    _TABLE = _mix(np.arange(1, _NEAR * 256 + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


def _piece_hashes(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word of ``data``; a text starts at each of ``breaks``."""
    word = ~_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    inner = breaks[(breaks > 0) & (breaks < len(data))]
    first[inner] = word[inner]
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    at = np.flatnonzero(word)
    owner = np.cumsum(first[at]) - 1
    place = at - starts[owner]
    byte = data[at].astype(np.int64)
    near = place < _NEAR
    if near.all():
        value = _TABLE[place * 256 + byte]
    else:
        value = np.empty(len(at), np.uint64)
        value[near] = _TABLE[place[near] * 256 + byte[near]]
        far = (place[~near] * 256 + byte[~near] + 1).astype(np.uint64)
        value[~near] = _mix(far * _U(0x9E3779B97F4A7C15))
    lengths = np.diff(np.append(np.flatnonzero(first[at]), len(at))).astype(np.uint64)
    return starts, _mix(np.add.reduceat(value, np.flatnonzero(first[at])) + lengths)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, words of each text) for texts of bytes data[offsets[i]:offsets[i + 1]].

    The bytes are taken in pieces, cut between texts or at a space."""
    found, counts = [], np.zeros(len(offsets) - 1, np.int64)
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        to = min(end, at + BYTES)
        if to < end:
            k = int(np.searchsorted(offsets, to, "right")) - 1
            if offsets[k] > at:
                to = int(offsets[k])
            else:  # one text longer than a piece: go on to its next space
                stop = int(offsets[k + 1])
                while to < stop:
                    gap = np.flatnonzero(_SPACE[data[to:min(stop, to + 4096)]])
                    if len(gap):
                        to += int(gap[0])
                        break
                    to = min(stop, to + 4096)
        starts, hashes = _piece_hashes(data[at:to], offsets - at)
        found.append(hashes)
        owner = np.searchsorted(offsets, starts + at, "right") - 1
        counts += np.bincount(owner, minlength=len(counts))
        at = to
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), counts


def _text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its texts; nulls are empty."""
    column = pa.compute.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    return (np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)), offsets


def run_hashes(words: np.ndarray, starts: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Hashes of the runs of ``length`` words at ``starts``: a polynomial of the word hashes, scrambled."""
    value = np.zeros(len(starts), np.uint64)
    factor = _U((0x9E3779B97F4A7C15 + 0x632BE59BD9B4E018 * seed + 2 * seed) % (1 << 64) | 1)
    for k in range(length):
        value = value * factor + words[starts + k]
        if k % 4 == 3:
            value = value ^ (value >> _U(29))
    return _mix(value)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, start of each run of equal keys in it) ."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, int)


class _Texts:
    """The word hashes of some texts, with where each text starts among them."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        data, offsets = _text_buffers(batch.column("text"))
        self.words, self.counts = word_hashes(data, offsets)
        self.first = np.concatenate([[0], np.cumsum(self.counts)[:-1]]).astype(np.int64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most about ``WORDS`` words (of 6 bytes), or one row."""
    for batch in batches:
        size = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_numpy()
        piece = np.cumsum(size) // (6 * WORDS)
        cut = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for s, e in zip(cut, cut[1:], strict=False):
            if e > s:
                yield batch.slice(s, e - s)


PACKED = "bucket int, known boolean, hashes binary, places binary"


class _Places:
    """Where records start: (document, version, word). Packed by runs of one document."""

    def __init__(self, ids: np.ndarray, versions: np.ndarray, spots: np.ndarray) -> None:
        self.ids, self.versions, self.spots = ids, versions, spots

    def __getitem__(self, which: np.ndarray) -> _Places:
        return _Places(self.ids[which], self.versions[which], self.spots[which])

    def starts(self) -> np.ndarray:
        if not len(self.ids):
            return np.zeros(0, int)
        new = (self.ids[1:] != self.ids[:-1]) | (self.versions[1:] != self.versions[:-1])
        return np.flatnonzero(np.concatenate([[True], new]))

    def pack(self) -> bytes:
        cut = self.starts()
        sizes = np.diff(np.append(cut, len(self.ids)))
        parts = [np.array([len(cut)], "<i8"), self.ids[cut].astype("<i8"), self.versions[cut].astype("<i8"), sizes.astype("<i4"), self.spots.astype("<i4")]
        return zstandard.compress(b"".join(x.tobytes() for x in parts), 1)

    @staticmethod
    def unpack(packed: list[bytes]) -> _Places:
        found = []
        for raw in map(zstandard.decompress, packed):
            n = int(np.frombuffer(raw, "<i8", 1)[0])
            sizes = np.frombuffer(raw, "<i4", n, 8 + 16 * n)
            found.append((np.repeat(np.frombuffer(raw, "<i8", n, 8), sizes), np.repeat(np.frombuffer(raw, "<i8", n, 8 + 8 * n), sizes),
                          np.frombuffer(raw, "<i4", -1, 8 + 20 * n)))
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))
        return _Places(*(np.concatenate(x) for x in zip(empty, *found, strict=True)))


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["bucket", "known", "hashes", "places"])


def _pieces(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, its records) of each bucket that has any."""
    order = np.argsort(bucket, kind="stable")
    found, cut = np.unique(bucket[order], return_index=True)
    for b, s, e in zip(found.tolist(), cut, np.append(cut, len(order))[1:], strict=True):
        yield b, order[s:e]


def _rows(bucket: np.ndarray, hashes: np.ndarray, places: _Places, sent: np.ndarray, known: np.ndarray, n_buckets: int) -> Iterator[tuple]:
    """Packed rows: the records to send, each to its hash's bucket, and the places already
    known to repeat, dealt over the buckets by document."""
    for b, i in _pieces(bucket[sent]):
        yield b, False, hashes[sent][i].tobytes(), places[sent[i]].pack()
    for b, i in _pieces(_group_of(places.ids[known], places.versions[known], n_buckets)):
        yield b, True, b"", places[known[i]].pack()


def _anchor_rows(length: int, n_buckets: int):
    """Step 1, in the tasks that read the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts = _Texts(batch)
            n = len(texts.words)
            doc = np.repeat(np.arange(batch.num_rows), texts.counts)
            spot = np.arange(n) - texts.first[doc]
            cover = np.zeros(PERIOD, bool)
            cover[list(COVER)] = True
            at = np.flatnonzero(cover[spot % PERIOD] & (spot + length <= texts.counts[doc]))
            if not len(at):
                continue
            hashes = run_hashes(texts.words, at, length, 1)
            order, cut = _runs(hashes)
            size = np.diff(np.append(cut, len(order)))
            # an anchor seen again here is known to repeat; one of each hash goes to the others
            again = np.empty(len(at), bool)
            again[order] = np.repeat(size > 1, size)
            sent = np.sort(order[cut])
            ids, versions = batch.column("id").to_numpy(), batch.column("version").to_numpy()
            bucket = (hashes % _U(n_buckets)).astype(np.int64)
            low = (hashes // _U(n_buckets)).astype("<u4")
            places = _Places(ids[doc[at]], versions[doc[at]], spot[at])
            yield _packed(list(_rows(bucket, low, places, sent, np.flatnonzero(again), n_buckets)))

    return run


def _group_of(ids: np.ndarray, versions: np.ndarray, n_buckets: int) -> np.ndarray:
    """The group of documents that a document's places are gathered in. Exact copies have
    one version, so the id takes part: no group holds them all."""
    return (_mix(_mix(ids.astype(np.int64).view(np.uint64)) ^ versions.astype(np.int64).view(np.uint64)) % _U(n_buckets)).astype(np.int64)


def _repeats(record: np.dtype, judge, n_buckets: int):
    """The tasks that get whole buckets: repeats of each bucket, and the known ones, packed
    by group of documents (a row per document here would be many more at scale)."""

    def run(table: pa.Table) -> pa.Table:
        known = table.column("known").to_numpy()
        hashes, places = table.column("hashes").to_pylist(), table.column("places").to_pylist()
        sent = _Places.unpack([x for x, k in zip(places, known, strict=True) if not k])
        told = _Places.unpack([x for x, k in zip(places, known, strict=True) if k])
        again = sent[judge(np.frombuffer(b"".join(hashes), record), sent)]
        both = _Places(*(np.concatenate([getattr(x, k) for x in (again, told)]) for k in ("ids", "versions", "spots")))
        rows = [(b, both[i].pack()) for b, i in _pieces(_group_of(both.ids, both.versions, n_buckets))]
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "places": pa.array([r[1] for r in rows], pa.binary())})

    return run


def _by_document(table: pa.Table) -> pa.Table:
    """One row for each document of a group: all its spots, packed."""
    places = _Places.unpack(table.column("places").to_pylist())
    places = places[np.lexsort((places.spots, places.versions, places.ids))]
    cut = places.starts()
    packed = [np.unique(places.spots[s:e]).astype("<i4").tobytes() for s, e in zip(cut, np.append(cut, len(places.ids))[1:], strict=True)]
    return pa.table({"id": pa.array(places.ids[cut], pa.int64()), "version": pa.array(places.versions[cut], pa.int64()), "spots": pa.array(packed, pa.binary())})


def _twice(hashes: np.ndarray, places: _Places) -> np.ndarray:
    """The records whose hash is there more than once."""
    order, cut = _runs(hashes)
    size = np.diff(np.append(cut, len(order)))
    again = np.zeros(len(hashes), bool)
    again[order] = np.repeat(size > 1, size)
    return again


WINDOW = np.dtype([("high", "<u8"), ("low", "<u4")])


def _later(hashes: np.ndarray, places: _Places) -> np.ndarray:
    """Of the records of each hash, those that start after its earliest."""
    order = np.lexsort((places.spots, places.ids, hashes["low"], hashes["high"]))
    h, i, s = hashes[order], places.ids[order], places.spots[order]
    later = np.zeros(len(order), bool)
    if len(order):
        new = np.concatenate([[True], (h["high"][1:] != h["high"][:-1]) | (h["low"][1:] != h["low"][:-1])])
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        later[order] = (i != i[lead]) | (s != s[lead])
    return later


def _window_rows(length: int, window: int, n_buckets: int):
    """Step 2, in the tasks that have texts and their repeated anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(b.filter(b.column("spots").is_valid()) for b in batches):
            texts = _Texts(batch)
            mark = np.zeros(len(texts.words) + 1, np.int64)
            for k, packed in enumerate(batch.column("spots").to_pylist()):
                if texts.counts[k] >= window:
                    spots = np.frombuffer(packed, "<i4").astype(np.int64)
                    low = np.maximum(spots - (window - length), 0)
                    high = np.minimum(spots, texts.counts[k] - window)
                    ok = low <= high
                    np.add.at(mark, texts.first[k] + low[ok], 1)
                    np.add.at(mark, texts.first[k] + high[ok] + 1, -1)
            at = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
            if not len(at):
                continue
            doc = np.repeat(np.arange(batch.num_rows), texts.counts)[at]
            hashes = np.empty(len(at), WINDOW)
            hashes["high"] = run_hashes(texts.words, at, window, 2)
            hashes["low"] = (run_hashes(texts.words, at, window, 3) >> _U(32)).astype("<u4")
            ids, versions = batch.column("id").to_numpy(), batch.column("version").to_numpy()
            places = _Places(ids[doc], versions[doc], at - texts.first[doc])
            known = _later(hashes, places)
            # of the rest one of each hash is enough, but for versions that tie
            bucket = (hashes["high"] % _U(n_buckets)).astype(np.int64)
            yield _packed(list(_rows(bucket, hashes, places, np.flatnonzero(~known), np.flatnonzero(known), n_buckets)))

    return run


def repeated_spots(texts: DataFrame, window: int = 20, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """(id, version, spots): for each text with a repeat, packed little-endian 32-bit starts
    of the windows that also start earlier. ``texts`` has id, version and text."""
    length = window - PERIOD + 1
    if length < 1:
        raise ValueError(f"a window needs at least {PERIOD} words")
    spark = texts.sparkSession
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_bytes / 6 / bucket_words))
    anchors = texts.where("id IS NOT NULL").select("id", "version", "text").mapInArrow(_anchor_rows(length, n_buckets), PACKED)
    # a left join, as the removal's: both then read one shuffle of the texts
    near = _with(texts, _gathered(anchors, np.dtype("<u4"), _twice, n_buckets))
    windows = near.select("id", "version", "text", "spots").mapInArrow(_window_rows(length, window, n_buckets), PACKED)
    return _gathered(windows, WINDOW, _later, n_buckets)


def _gathered(records: DataFrame, record: np.dtype, judge, n_buckets: int) -> DataFrame:
    """(id, version, spots) of the records that ``judge`` picks within their bucket."""
    picked = records.groupBy("bucket").applyInArrow(_repeats(record, judge, n_buckets), "bucket int, places binary")
    return picked.groupBy("bucket").applyInArrow(_by_document, "id long, version long, spots binary")


def _with(texts: DataFrame, told: DataFrame) -> DataFrame:
    told = told.withColumnsRenamed({"id": "__id", "version": "__version"})
    return texts.join(told, (F.col("id") == F.col("__id")) & (F.col("version") == F.col("__version")), "left").drop("__id", "__version")


def kept_words(raw: bytes, spots: bytes | None, window: int) -> tuple[int, int, bytes]:
    """(words, removed words, kept words joined by a space)."""
    words = raw.split()
    n = len(words)
    if not spots:
        return n, 0, b" ".join(words)
    mark = np.zeros(n + 1, np.int64)
    starts = np.frombuffer(spots, "<i4").astype(np.int64)
    mark[starts] += 1
    mark[starts + window] -= 1
    gone = np.cumsum(mark[:-1]) > 0
    return n, int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """Remove each word covered by a window of ``window`` words that also starts earlier
    (smaller id, or the same document further up), judged on the input.

    Returns the input's columns with ``text_col`` rewritten, and ``n_words`` (before) and
    ``n_removed`` as longs.
    """
    outputs = [id_col, text_col, "n_words", "n_removed"]
    names = [c for c in docs.columns if c.lower() not in [o.lower() for o in outputs]]
    carried = [f"__in{i}" for i in range(len(names))]
    base = docs.select(*[c.alias(n) for n, c in zip(carried, others(docs, outputs), strict=True)], col(id_col).cast("long").alias("id"),
                       col(text_col).cast("string").alias("text")).withColumn("version", F.xxhash64("text"))
    joined = _with(base, repeated_spots(base, window)).select(*carried, "id", "text", "spots")
    carried.append("id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            told = [kept_words(t or b"", x, window) for t, x in zip(texts, batch.column("spots").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried), pa.array([t[2] for t in told], pa.binary()).cast(pa.string()),
                 pa.array([t[0] for t in told], pa.int64()), pa.array([t[1] for t in told], pa.int64())], [*carried, "__text", "n_words", "n_removed"])

    schema = joined.select(*carried).schema.add("__text", "string").add("n_words", "long").add("n_removed", "long")
    done = joined.mapInArrow(run, schema)
    by_name = {id_col.lower(): "id", text_col.lower(): "__text"} | {n.lower(): c for n, c in zip(names, carried, strict=False)}
    order = [c for c in docs.columns if c.lower() not in ("n_words", "n_removed")]
    return done.select(*[F.col(by_name[c.lower()]).alias(c) for c in order], "n_words", "n_removed")
