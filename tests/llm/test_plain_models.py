"""Chosen languages, measurements of quality and the positive-unlabelled risk against plain versions of each."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
import zstandard

from terravane.llm import language
from terravane.llm import quality_model as Q


def words_of(text):
    out, now = [], bytearray()
    for b in (text or "").encode():
        if b == 32 or 9 <= b <= 13:
            if now:
                out.append(bytes(now))
            now = bytearray()
        else:
            now.append(b)
    return out + [bytes(now)] if now else out


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def plain_dictionaries(rows, docs_per_language, excerpt):
    parts, counts = defaultdict(dict), Counter()
    for i, text, lang in rows:
        if i is None or text is None or lang is None:
            continue
        counts[lang] += 1
        begin = signed(xxhash.xxh64(text.encode(), seed=42).intdigest()) % (max(len(text) - excerpt, 0) + 1)
        key = (signed(xxhash.xxh64(str(i).encode(), seed=42).intdigest()), i)
        part = text[begin : begin + excerpt]
        parts[lang][part] = min(key, parts[lang].get(part, key))
    chosen = {x: sorted(p, key=p.get)[:docs_per_language] for x, p in parts.items()}
    return [(x, "\n".join(chosen[x]).lower().encode()) for x in sorted(chosen, key=lambda x: (-counts[x], x))]


def plain_choice(text, learned):
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0
    best, sizes = None, []
    for lang, content in learned:
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(language.LEVEL)
        c = zstandard.ZstdCompressor(level=language.LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
        sizes.append(len(c.compress(text.lower().encode())))
        if best is None or sizes[-1] < best[1]:
            best = (lang, sizes[-1])
    return best[0], 1 / sum(2.0 ** -min(60, s - best[1]) for s in sizes)


def test_language_equals_a_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    extra = spark.createDataFrame([(None, "no id here", "en"), (90_001, None, "en"), (90_002, "", "fr"), (90_003, "sin idioma", None), (90_004, "12 34", "es")], docs.schema)
    docs = docs.unionByName(extra)
    train = docs.where(~language.held_out("doc_id"))
    learned = language.learn(train, docs_per_language=20, excerpt=200)
    assert learned == plain_dictionaries([tuple(r) for r in train.collect()], 20, 200)
    texts = docs.collect()
    got = Counter((r.doc_id, r.lang_pred, round(r.score, 12)) for r in language.identify(docs, learned).collect())
    want = Counter((r.doc_id, lang, round(score, 12)) for r in texts for lang, score in [plain_choice(r.text, learned)])
    assert got == want


def plain_measures(text):
    data = (text or "").encode()
    w = words_of(text)
    n, b = max(len(w), 1), max(len(data), 1)
    of = lambda chars: sum(x in chars for x in data) / n
    windows = Counter(zip(w, w[1:], w[2:]))  # noqa: B905
    return {
        "log_words": math.log(1 + len(w)),
        "word_length": len(data) / n,
        "upper": sum(65 <= x <= 90 for x in data) / b,
        "digits": of(b"0123456789"),
        "symbols": of(b"#*$%&<>"),
        "pipes": of(b"|"),
        "exclamations": of(b"!"),
        "stops": of(b".?"),
        "commas": of(b",;:"),
        "other_punctuation": of(b"\"'()-/=@[\\]^_`{}~+"),
        "beyond_ascii": sum(x >= 192 for x in data) / n,
        "lines": of(b"\n"),
        "distinct": len(set(w)) / n,
        "commonest": max(Counter(w).values(), default=0) / n,
        "same_neighbour": sum(x == y for x, y in zip(w, w[1:])) / n,  # noqa: B905
        "repeated_windows": sum(c - 1 for c in windows.values()) / n,
        "capitals": sum(65 <= x[0] <= 90 for x in w) / n,
        "long_words": sum(len(x) > 20 for x in w) / n,
    }


def test_measures_equal_plain_counts(corpus):
    texts = [t for _, t in corpus]
    got = Q.measure(pa.array(texts, pa.string()))
    assert got.shape == (len(texts), len(Q.FEATURES))
    for row, text in zip(got, texts, strict=True):
        want = plain_measures(text)
        assert np.allclose(row, [want[k] for k in Q.FEATURES], rtol=0, atol=1e-9), text and text[:60]


def plain_risk(model, positive, unlabelled, weights, decay=1e-4):
    def loss(x, sign):
        return sum(math.log1p(math.exp(-sign * float(np.dot(r, weights)))) for r in model.expanded(x)) / len(x)

    rest = loss(unlabelled, -1) - model.prior * loss(positive, -1)
    return model.prior * loss(positive, 1) + max(0.0, rest) + decay / 2 * float(weights @ weights), rest


def test_fit_is_at_the_least_risk():
    rng = np.random.default_rng(3)
    good, bad = rng.normal(0.4, 1, (400, len(Q.FEATURES))), rng.normal(-0.4, 1, (600, len(Q.FEATURES)))
    positive, unlabelled = good[:150], np.concatenate([good[150:], bad])
    prior = 250 / 850
    model = Q.fit(positive, unlabelled, prior)
    least, rest = plain_risk(model, positive, unlabelled, model.weights)
    assert rest >= -0.01
    start = np.zeros_like(model.weights)
    start[-1] = math.log(prior / (1 - prior))
    assert least < plain_risk(model, positive, unlabelled, start)[0]
    # No small step along a weight, or in any of some directions, leads to a much lower risk.
    steps = [*np.eye(len(start)), *rng.normal(size=(10, len(start)))]
    for step in steps:
        for sign in (0.02, -0.02):
            assert plain_risk(model, positive, unlabelled, model.weights + sign * step / np.linalg.norm(step))[0] > least - 1e-3
    score = model.score(unlabelled)
    assert np.mean((score >= 0.5)[:250]) > 0.7 and np.mean((score < 0.5)[250:]) > 0.85


def test_prior_of_a_mixture():
    """From positives and unlabelled rows alone, within 0.05 of the share that was mixed in."""
    rng = np.random.default_rng(5)
    d = len(Q.FEATURES)
    for share in (0.2, 0.5, 0.8):
        n = int(share * 8_000)
        unlabelled = np.concatenate([rng.standard_normal((n, d)) + 0.7, rng.standard_normal((8_000 - n, d)) - 0.7])
        assert abs(Q.estimated_prior(rng.standard_normal((4_000, d)) + 0.7, unlabelled) - share) < 0.05


def test_copies_do_not_reach_the_driver(spark):
    """However often an id is repeated, at most `sample` texts of either role are drawn, and both roles get some."""
    from pyspark.sql import functions as F

    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1]
    docs = spark.range(20_000).select(F.lit(ids[0]).cast("long").alias("doc_id"), F.lit("the same again").alias("text"))
    docs = docs.union(spark.createDataFrame([(i, f"text number {i}") for i in ids[1:]], "doc_id long, text string"))
    labels = spark.createDataFrame([(i, 1) for i in ids[:20]] + [(ids[0], 1)], "doc_id long, quality int")
    for sample in (4, 1_000):
        got = Q.drawn(docs, labels, sample=sample).groupBy("role").count().collect()
        assert {r["role"]: r["count"] for r in got} == {1: min(sample, 20), 2: min(sample, len(ids))}


def test_labels_other_than_one_are_not_used(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    a, b = Q.learn(docs, labels), Q.learn(docs, labels.where("quality = 1"))
    assert a.prior == b.prior and np.array_equal(a.weights, b.weights)
