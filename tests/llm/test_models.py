"""Language, quality and compression models: plain versions and held-out accuracy."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from terravane.llm import language, ppm, quality_model

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n if i is not None else -1


def plain_ppm(train, texts, order):
    """Prediction by partial matching with exclusion, symbol by symbol."""
    c = defaultdict(Counter)
    seq = lambda t: (255,) * order + (*lower(t).encode(), 255)
    for t in train:
        s = seq(t)
        for i in range(order, len(s)):
            for k in range(order + 1):
                c[s[i - k : i]][s[i]] += 1
    out = []
    for t in texts:
        s, total = seq(t), 0.0
        for i in range(order, len(s)):
            gone, p = set(), 1.0
            for k in range(order, -1, -1):
                seen = c.get(s[i - k : i], {})
                left = {x: n for x, n in seen.items() if x not in gone}
                n, d = sum(left.values()), len(left)
                if s[i] in left:
                    p *= left[s[i]] / (n + d)
                    break
                p *= d / (n + d) if d else 1
                gone |= set(left)
            else:
                p /= 256 - len(gone)
            total += math.log10(p)
        out.append(total)
    return out


@pytest.mark.parametrize(("frequent", "listed", "order"), [(65_536, 1 << 18, 4), (50, 200, 3), (0, 0, 2)])
def test_scores(spark, documents, corpus, frequent, listed, order):
    got = {r["doc_id"]: r for r in ppm.score(documents, order=order, frequent=frequent, listed=listed).collect()}
    train = [(i, t) for i, t in corpus if crc(i, 7) != 2]
    count = Counter(w for _, t in train for w in WORD.findall(lower(t)))
    total, kinds, end = sum(count.values()) + len(train), len(count) + 1, len(train)
    for i, t in corpus:
        w = WORD.findall(lower(t))
        r = got[i]
        base = sum(math.log10((count[x] + 1) / (total + kinds + 1)) for x in w) + math.log10((end + 1) / (total + kinds + 1))
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (crc(i, 7) == 2, len(w) + 1, sum(count[x] > 0 for x in w) + 1, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    some = [(i, t) for i, t in corpus if i % 9 == 0 or i >= 10_000]
    for (i, _), want in zip(some, plain_ppm([t for _, t in train], [t for _, t in some], order), strict=True):
        assert got[i]["score"] == pytest.approx(want, rel=1e-9)


def test_probabilities_sum_to_one(spark):
    order = 3
    code, n = np.unique(np.concatenate([c for c, _ in ppm.codes(pa.array(["abracadabra", None, "", "Abba Écran"]), order)]), return_counts=True)
    seen = dict(zip(code.tolist(), n.tolist(), strict=True))
    contexts = {c >> 8 for c in seen} | {0, 97, 97 << 8 | 98}
    rows = [(c << 8 | x, seen.get(c << 8 | x, 0)) for c in contexts for x in range(256)]
    got = ppm.log_table(spark.createDataFrame(rows, "code long, n long"), order).collect()
    sums = Counter()
    for r in got:
        sums[r["code"] >> 8] += 10 ** r["lp"]
    assert set(sums) == contexts and all(abs(x - 1) < 1e-9 for x in sums.values())


def test_words_of_equal_polynomials_differ():
    """Words made of one pattern and its complement, which meet where a hash is a polynomial modulo a power of two."""
    for k in (10, 11, 12):
        bits = [bin(i).count("1") % 2 for i in range(1 << k)]
        pair = ["".join("ab"[b ^ x] for b in bits) for x in (0, 1)]
        h, _, n = ppm._tokens(pa.array(pair))
        assert n.tolist() == [1, 1] and h[0] != h[1]


def test_a_huge_word_has_the_hash_of_its_bytes():
    from terravane.llm import words as W

    for n in (8, 16, 18, W.HUGE, W.HUGE + 2, 2 * W.PIECE + 6):
        texts = pa.array([f"x {'ab' * (n // 2)} y", "ab" * (n // 2), "ab" * (n // 2 - 1) + "ba"])
        h, doc, _ = ppm._tokens(texts)
        assert h[1] == h[3] != h[4] and doc.tolist() == [0, 0, 0, 1, 2]


def test_score_nulls_repeats_and_empty(spark, empty):
    rows = [(None, "a b"), (3, "a b c"), (3, "a b c"), (4, None), (3, "other")]
    got = ppm.score(spark.createDataFrame(rows, "doc_id long, text string"), frequent=0, listed=3).collect()
    assert sorted(((r["doc_id"] or 0), r["n_tokens"], r["n_known"]) for r in got) == [(0, 3, 3), (3, 2, 2), (3, 4, 4), (3, 4, 4), (4, 1, 1)]
    assert ppm.score(empty).count() == 0


def test_language(spark, documents, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learned = language.learn(docs.where(~language.held_out("doc_id")))
    assert sorted(x for x, _ in learned) == ["de", "en", "es", "fr"]
    r = language.identify(docs, learned).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(x["lang"] == x["lang_pred"] for x in r) / len(r) > 0.97
    assert all(0 <= x["score"] <= 1 for x in r)
    odd = {r["doc_id"]: r for r in language.identify(documents, learned).collect()}
    assert [odd[i]["lang_pred"] for i in (10_000, 10_001, 10_002)] == ["und"] * 3
    assert odd[10_003]["lang_pred"] != "und"
    assert language.identify(empty, learned).count() == 0
    assert language.learn(empty) == []
    assert {r["lang_pred"] for r in language.identify(documents, []).collect()} == {"und"}
    assert all(odd[i]["held_out"] == (crc(i, 3) == 1) for i in odd)


def test_quality(spark, documents, empty):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality_model.learn(docs, labels)
    r = quality_model.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    assert sum(x["quality"] == x["predicted"] for x in r) / len(r) > 0.95
    odd = quality_model.score(documents, model).collect()
    assert all(0 <= x["score"] <= 1 and x["predicted"] == (x["score"] >= 0.5) for x in odd)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {x["score"] for x in quality_model.score(documents, quality_model.learn(documents, none)).collect()} == {0.5}
    assert quality_model.score(empty, quality_model.learn(empty, none)).count() == 0


def test_dictionaries_are_learned_from_whole_texts(spark):
    head = " ".join(f"licence{i}" for i in range(80))
    bodies = [" ".join(f"word{k}x{i}" for i in range(900)) for k in range(40)]
    rows = [(k, f"{head} {body}", "en") for k, body in enumerate(bodies)] + [(100 + k, f"{head} {bodies[0]}", "en") for k in range(40)]
    ((lang, content),) = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    parts = content.decode().split("\n")
    assert lang == "en" and len(parts) == len(set(parts)) == 40 and all(len(p) == language.EXCERPT for p in parts)
    # Few excerpts touch what all documents share.
    assert sum("licence" in p for p in parts) < 15
