"""Duplicate spans against a plain index of all windows."""

import hashlib
import random
import re

from terravane.llm import substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(rows, n=20):
    first = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = WORD.findall(t or "")
        for k in range(len(w) - n + 1):
            first.setdefault(tuple(w[k : k + n]), (i, k))
    out = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = {j for k in range(len(w) - n + 1) if first[tuple(w[k : k + n])] < (i, k) for j in range(k, k + n)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


def got(df):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"], r["kept_text"]) for r in df.collect()}


def test_corpus(documents, corpus):
    assert got(substrings.remove_duplicates(documents)) == expected(corpus)


def test_mosaics(spark):
    """Texts put together from pieces of others, so that factors meet and overlap, and short periods."""
    rng = random.Random(8)
    base = [[f"{rng.choice('abc')}{rng.randrange(30)}" for _ in range(120)] for _ in range(6)]
    rows = []
    for i in range(120):
        w = []
        while len(w) < rng.randrange(10, 200):
            b = rng.choice(base)
            a = rng.randrange(100)
            w += b[a : a + rng.randrange(5, 60)]
        rows.append((i * 7 % 120, rng.choice([" ", "\n", "  "]).join(w)))
    rows += [(200, "a " * 100), (201, "b " * 60 + "a " * 45), (202, "x y z " * 30), (203, "\x00 \x01 " * 30), (204, "\x01 \x01 " * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got(substrings.remove_duplicates(df)) == expected(rows)


def test_null_ids_repeats_and_empty(spark, empty):
    p = " ".join(f"w{i}" for i in range(30))
    rows = [(None, p), (3, p), (3, p), (5, "z " + p), (6, None)]
    r = substrings.remove_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(x["doc_id"]), x["n_removed"]) for x in r) == [("3", 30), ("3", 30), ("5", 30), ("6", 0), ("None", 0)]
    assert substrings.remove_duplicates(empty).count() == 0


def test_one_id_for_two_texts(spark):
    p = " ".join(f"w{i}" for i in range(30))
    rows = [(1, "a b " + p), (2, p), (2, "c " + p), (2, "d e f")]
    r = substrings.remove_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((x["doc_id"], x["n_words"], x["n_removed"]) for x in r) == [(1, 32, 0), (2, 3, 0), (2, 30, 30), (2, 31, 30)]


def test_windows_that_meet_in_the_hash_are_found(documents):
    from terravane.llm import substrings

    assert substrings._contradicted(substrings._parse(documents, "doc_id", "text", 20, False, 0, bits=6))
    assert not substrings._contradicted(substrings._parse(documents, "doc_id", "text", 20, False, 1))


def test_many_rows_without_an_id(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [(None, f"{k} {passage}") for k in range(20)] + [(None, None), (5, f"x {passage}"), (5, f"y {passage}"), (6, passage)]
    from terravane.llm import substrings

    got = substrings.remove_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # Rows without an id stand at one place: none of them is earlier than another at the same start.
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in got) == [(0, 0, 0)] + [(0, 31, 0)] * 20 + [(5, 31, 30)] * 2 + [(6, 30, 30)]
