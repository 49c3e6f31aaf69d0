"""The rule ledger against a plain measurement."""

import re
from collections import Counter

from terravane.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measure(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(windows)
    covered = {j for i, x in enumerate(windows) if n[x] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def fails(m):
    return [
        m["n_words"] < 10,
        100 * m["n_repeat_words"] > 20 * m["n_words"],
        10 * m["n_symbols"] > 4 * m["n_words"],
        m["n_lines"] > 3 and 2 * m["n_dup_lines"] > m["n_lines"],
        m["word_chars"] < 2 * m["n_words"] or m["word_chars"] > 40 * m["n_words"],
    ]


def test_ledger_policy_and_ablations(documents, corpus):
    led = Q.ledger(documents).cache()
    got = {r["doc_id"]: r for r in Q.apply_policy(led).collect()}
    bits = []
    for i, text in corpus:
        m = measure(text)
        f = fails(m)
        bits.append(sum(x << k for k, x in enumerate(f)))
        assert {k: got[i][k] for k in m} == m, (i, text)
        assert got[i]["fail_bits"] == bits[-1]
        assert got[i]["kept"] == (not any(f))
    for r in Q.ablations(led).collect():
        k = [x.name for x in Q.RULES].index(r["rule"])
        assert (r["n_docs"], r["n_failed"], r["n_only"]) == (len(bits), sum(b >> k & 1 for b in bits), sum(b == 1 << k for b in bits))
    kept = Q.keep_good(documents)
    assert kept.columns == documents.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for (i, _), b in zip(corpus, bits, strict=True) if not b)


def test_empty_table(empty):
    assert Q.ledger(empty).count() == 0 and Q.keep_good(empty).count() == 0
