"""SimHash against a plain comparison of all pairs."""

import random

import numpy as np
from xxhash import xxh64_intdigest

from terravane.llm import simhash
from terravane.llm.components import components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    k = min(4, len(words))
    if not k:
        return 0
    hs = [xxh64_intdigest(b" ".join(words[i : i + k]), seed=42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps, radius=4):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in ids:
            if j < i and (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_against_all_pairs(documents, corpus):
    got = {r["doc_id"]: (r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash.near_duplicates(documents).collect()}
    fps = {i: plain_fingerprint(t) for i, t in corpus}
    roots = plain_components(fps)
    assert got == {i: (fps[i], roots[i]) for i in fps}


def test_small_tiles_lose_no_link(spark):
    rng = random.Random(1)
    fps = set()
    for _ in range(60):
        x = rng.getrandbits(64)
        for _ in range(6):
            fps.add(x)
            for _ in range(rng.randrange(1, 6)):
                x ^= 1 << rng.randrange(64)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps], "fp long")
    edges = [(r["u"] & (2**64 - 1), r["v"] & (2**64 - 1)) for r in simhash.links(df, 4, tile=3).collect()]
    assert all((u ^ v).bit_count() for u, v in edges)
    want = plain_components({x: x for x in fps})
    root = {x: x for x in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for u, v in edges:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    assert {x: find(x) for x in fps} == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 90), (90, 95), (7, 7)] + [(200, 200 + i) for i in range(1, 300)] + [(3, 2)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 90: 90, 95: 90, 100: 90, **{200 + i: 200 for i in range(300)}}


def test_nulls_ties_and_repeats(spark, empty):
    rows = [(None, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (2, None), (None, "quite another text than this"), (1, "")]
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(None, 5), (5, 5), (5, 5), (2, 1), (None, None), (1, 1)], key=str)
    assert simhash.near_duplicates(empty).count() == 0


def test_one_of_each(documents, corpus):
    kept = simhash.one_of_each(documents)
    roots = plain_components({i: plain_fingerprint(t) for i, t in corpus})
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(roots.values()))
    assert kept.columns == documents.columns


def test_one_of_each_with_repeated_and_null_ids(spark):
    near, other, third = (" ".join(f"{w}{i}" for i in range(60)) for w in "abc")
    # Id 7 has a copy of document 3 and a text of its own; document 3 stands there twice; two copies have no id at all.
    rows = [(3, near), (3, near), (7, near), (7, other), (None, third), (None, third), (None, near), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = simhash.one_of_each(docs)
    assert got.columns == ["doc_id", "text"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(3, near), (7, other), (None, third), (9, None)], key=str)
