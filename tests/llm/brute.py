"""Plain versions of the operators, for small inputs."""

import zlib
from collections import defaultdict

import numpy as np
import xxhash

SPACE = " \t\n\x0b\f\r"


def split_words(text):
    out, word = [], []
    for c in text or "":
        if c in SPACE:
            if word:
                out.append("".join(word))
            word = []
        else:
            word.append(c)
    return out + (["".join(word)] if word else [])


def smallest_reachable(ids, links):
    """Component of each id: the smallest id reachable over links."""
    label = {i: i for i in ids}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def simhash(text, words_per_shingle=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = split_words(lower)
    if not w:
        return 0
    n = words_per_shingle
    shingles = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(docs, max_bits=3):
    """{doc_id: (hex fingerprint, component)} of {doc_id: text}."""
    prints = {d: simhash(t) for d, t in docs.items()}
    ids = sorted(docs)
    array = np.array([prints[d] for d in ids], np.uint64)
    links = []
    for k, d in enumerate(ids):
        links += [(d, ids[j]) for j in np.flatnonzero(np.bitwise_count(array ^ array[k]) <= max_bits) if j > k]
    part = smallest_reachable(ids, links)
    return {d: (f"{prints[d]:016x}", part[d]) for d in ids}


def repeated_words(docs, window=20):
    """{doc_id: (words, removed, kept text)}: words of windows that also start earlier go."""
    seen, out = set(), {}
    for d in sorted(docs):
        w = split_words(docs[d])
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if key in seen:
                gone[i:i + window] = [True] * window
            seen.add(key)
        out[d] = len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)
    return out


def vector_links(vectors, least=0.95):
    """{vec_id: (links, component)} of {vec_id: list}."""
    good = {}
    for i, v in vectors.items():
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, float) / max(map(abs, v))
    links, count = [], defaultdict(int)
    ids = sorted(good)
    for a in ids:
        for b in ids:
            if a < b and len(good[a]) == len(good[b]):
                x, y = good[a], good[b]
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    links.append((a, b))
                    count[a] += 1
                    count[b] += 1
    part = smallest_reachable(sorted(vectors), links)
    return {i: (count[i], part[i]) for i in vectors}


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2
