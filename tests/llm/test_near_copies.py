import itertools
import random

import numpy as np

from daycast.llm import simhash_dedup as S
from daycast.llm.components import components
from tests.llm import brute


def noisy_copies(seed=5, groups=12):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    texts = []
    for g in range(groups):
        words = [rng.choice(vocab) for _ in range(rng.choice([5, 60, 400]))]
        for _ in range(rng.randint(1, 6)):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 2])):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return texts


def test_groups_match_brute_force(spark, docs):
    texts = noisy_copies() + [None, "", " \t\n", "one", "ONE", "one two", "One\ttwo", "É é É", "é é é", "a b c", "A B\x0bC", "x " * 50, "a b c"]
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.simhash_groups(docs(rows)).collect()}
    assert got == brute.simhash_components(dict(rows))


def test_other_distances_and_shingles(spark, docs):
    rows = list(enumerate(noisy_copies(8, 25)))
    for bits in (0, 1, 2, 5):
        got = {r.doc_id: r.component_id for r in S.simhash_groups(docs(rows), max_bits=bits).collect()}
        assert got == {d: c for d, (_, c) in brute.simhash_components(dict(rows), bits).items()}, bits


def test_near_links_miss_nothing(spark):
    """Random fingerprints with planted neighbours at 0 to 4 bits."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = [b ^ np.uint64(sum(1 << int(x) for x in rng.choice(64, k, replace=False))) for b in base for k in (1, 3, 4)]
    fps = np.unique(np.concatenate([base, np.array(near, np.uint64)])).view(np.int64)
    records = spark.createDataFrame([(int(x),) for x in fps], "fp long")
    got = {r.node: r.component for r in components(S.near_links(records, 3, chunk=16)).collect()}
    links = [(int(a), int(b)) for i, a in enumerate(fps) for b in fps[i + 1:] if bin((int(a) ^ int(b)) & (1 << 64) - 1).count("1") <= 3]
    want = brute.smallest_reachable([int(x) for x in fps], links)
    assert {k: v for k, v in want.items() if k in got} == got
    assert all(want[k] == k for k in want if k not in got)


def test_hot_bucket_is_split(spark):
    """A bucket of many members in chunks of 8 gives the same components."""
    fps = [int(np.int64(i)) for i in range(200)]
    records = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = {r.component for r in components(S.near_links(records, 3, chunk=8)).collect()}
    assert got == {0}


def test_allocation_is_the_cheapest():
    rng = random.Random(3)
    for _ in range(50):
        costs = [[0, *[rng.randint(1, 99) for _ in range(4)]] for _ in range(rng.randint(1, 4))]
        total = 3 - len(costs) + 1
        options = itertools.product(range(-1, 4), repeat=len(costs))
        best = min(sum(c[x + 1] for c, x in zip(costs, t, strict=True)) for t in options if sum(t) == total)
        t = S.allocate(costs, total)
        assert sum(t) == total and sum(c[x + 1] for c, x in zip(costs, t, strict=True)) == best


def test_dedup_keeps_one_of_each_group(spark, docs):
    texts = noisy_copies(9, 6)
    rows = list(enumerate(texts)) + [(0, texts[0]), (1, "an other version of one"), (None, texts[0]), (None, "nobody else has this text")]
    kept = S.dedup_simhash(docs(rows)).collect()
    ids = [r.doc_id for r in kept]
    assert len(ids) == len(set(ids)) and None not in ids
    want = brute.simhash_components(dict(enumerate(texts)))
    assert set(ids) == {d for d, (_, c) in want.items() if c == d} | {1}
    assert kept[0]["a.b"] == "x" and kept[0].fingerprint == "f"


def test_null_ids_and_empty_table(spark, docs):
    got = S.simhash_groups(docs([(None, "a b c d"), (4, "a b c d"), (None, "only here it is said")])).collect()
    assert sorted(str(r.component_id) for r in got) == ["4", "4", "None"]
    assert S.simhash_groups(docs([])).count() == 0 and S.dedup_simhash(docs([])).count() == 0


def test_long_text_in_pieces():
    words = [f"w{i % 1000}" for i in range(1_200_000)]
    text = " ".join(words)
    assert len(text) > 4 << 20
    pieces = S.fingerprint_batch([text.encode(), b"y " + b"x" * (5 << 20), b"a  b"])
    import xxhash
    hashes = np.array([xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(len(words) - 2)], np.uint64)
    bits = [2 * int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) > len(hashes) for b in range(64)]
    assert int(pieces[0]) == sum(1 << b for b, x in enumerate(bits) if x)
    assert int(pieces[1]) == xxhash.xxh64_intdigest(b"y " + b"x" * (5 << 20), 42) and int(pieces[2]) == xxhash.xxh64_intdigest(b"a b", 42)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (None, 3), (3, None)]
    links += [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    clean = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    want = brute.smallest_reachable(sorted({x for p in clean for x in p}), clean)
    assert got == want
    assert components(df.limit(0)).count() == 0
