"""Packing: the pieces come back whole, and the number of sequences is near the least possible."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from terravane.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, size):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for xs in by.values():
        at = 0
        for o, n in sorted(xs):
            assert o == at
            at += n
        assert at <= size
    return len(by)


def test_round_trip(documents, corpus):
    rows = packing.pack(documents, PATH).collect()
    t = Tokenizer.from_file(PATH)
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    assert set(by) == {i for i, _ in corpus}
    for i, text in corpus:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        got = sorted(by[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in got] == list(range(len(got)))
        assert len(got) == -(-len(ids) // 1024)
        at = 0
        for r in got:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids) and all(r["length"] == 1024 for r in got[1:])
    n = check(rows, 1024)
    assert n <= 1 + 1.03 * sum(r["length"] for r in rows) / 1024


def plain_best_fit(lengths, size):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            g = min(fit)
            gaps.remove(g)
        else:
            g = size
        gaps.append(g - n)
    return len(gaps)


def test_pairs_are_successors():
    rng = random.Random(4)
    for _ in range(300):
        is_gap = np.array([rng.random() < 0.5 for _ in range(rng.randint(1, 40))])
        stack, want = [], []
        for i, g in enumerate(is_gap):
            if not g:
                stack.append(i)
            elif stack:
                want.append((stack.pop(), i))
        mine, theirs = packing.pair(is_gap)
        assert sorted(zip(mine.tolist(), theirs.tolist())) == sorted(want)
        # The same over partitions: what they leave free meets by ranks.
        cuts = sorted({0, len(is_gap), *(rng.randrange(len(is_gap)) for _ in range(3))})
        pairs, free, ranks = [], [], {}
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            x, y = packing.pair(is_gap[a:b])
            pairs += zip((x + a).tolist(), (y + a).tolist())
            alone = [i for i in range(a, b) if i - a not in {*x.tolist(), *y.tolist()}]
            gaps, rest = [i for i in alone if is_gap[i]], [i for i in alone if not is_gap[i]]
            ranks |= {(p, True, k): i for k, i in enumerate(gaps)} | {(p, False, k): i for k, i in enumerate(rest)}
            free.append((p, len(gaps), len(rest)))
        for gap_part, first, part, last, n in packing.between(free):
            pairs += [(ranks[part, False, last - k], ranks[gap_part, True, first + k]) for k in range(n)]
        assert sorted(pairs) == sorted(want)


def test_nearly_as_few_sequences_as_best_fit_decreasing(spark):
    rng = random.Random(3)
    cases = [
        (100, [rng.randint(1, 100) for _ in range(3000)]),
        (100, [3] * 2000),
        (64, [rng.choice([1, 2, 31, 32, 33, 64]) for _ in range(2000)]),
        (1024, [min(1024, int(rng.expovariate(1 / 150)) + 1) for _ in range(3000)]),
        (50, [50, 26, 26, 25]),
    ]
    for size, lengths in cases:
        rows = [(i, 0, 0, n, i) for i, n in enumerate(lengths)]
        got = packing.place(spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(4), size).collect()
        assert sorted((r["doc_id"], r["length"]) for r in got) == [(i, n) for i, n in enumerate(lengths)]
        assert check(got, size) <= 1.02 * plain_best_fit(lengths, size) + 1


def test_odd_texts(spark, empty):
    rows = [(None, None), (1, "same"), (1, "same"), (2, " " * 5000), (3, "a" * 30_000), (4, "<|endoftext|> in a text"), (5, "x" + " " * 2_000_000 + "\n" * 5000 + "y <|endoftext|>")]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()
    check(got, 1024)
    assert sum(r["piece"] == 0 for r in got) == len(rows)
    t = Tokenizer.from_file(PATH)
    for i, text in rows[3:]:
        assert sum(r["length"] for r in got if r["doc_id"] == i) == 1 + len(t.encode(text, add_special_tokens=False).ids)
    assert packing.pack(empty, PATH).count() == 0


def test_added_tokens_have_their_ids(spark):
    t = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x\n<|endoftext|>  ", " <|endoftext| > <|ENDOFTEXT|>", "w <|endoftext|>" * 700]
    assert 50256 in t.encode(texts[0], add_special_tokens=False).ids
    got = defaultdict(list)
    for r in packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PATH).collect():
        got[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"]))
    for i, text in enumerate(texts):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert sorted(got[i]) == [(a, n, zlib.crc32(ids[a : a + n].tobytes())) for a, n in packing.cut(len(ids))]
