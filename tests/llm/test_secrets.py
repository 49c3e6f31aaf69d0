"""Secret spans against Python's regular expressions, and the linking against all pairs."""

import hashlib
import re

from terravane.llm import secrets

ASSIGN = re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def weak(text):
    text = text or ""
    out = []
    for k, (_, _, is_weak, pattern, _, least) in enumerate(secrets.KINDS):
        if is_weak:
            out += [(m.start(), k, m.end()) for m in re.finditer(pattern.replace("(?i:", "(?ai:"), text) if len(m[0]) >= least]
    return out


def linked(text, scope=200):
    strong, soft = base(text), weak(text)
    role = [x[1] for x in secrets.KINDS]
    out = list(strong)
    for s, k, e in soft:
        if any(a < e and s < b for a, _, b in strong):
            continue
        near = {role[q] for a, q, b in strong + soft if (a, q) != (s, k) and a - e <= scope and s - b <= scope and not (a < e and s < b and (a, q, b) in strong)}
        if (role[k] == "secret" and near & {"identifier", "endpoint"}) or (role[k] == "identifier" and "secret" in near) or (role[k] == "endpoint" and {"identifier", "secret"} <= near):
            out.append((s, k, e))
    return sorted(out)


def said(spans):
    return ",".join(f"{secrets.NAMES[k]}:{s}:{e}" for s, k, e in spans)


def test_against_plain_search(documents, corpus):
    got = {r["doc_id"]: r for r in secrets.digest(secrets.scan(documents)).collect()}
    assert len(got) == len(corpus)
    for i, text in corpus:
        r, want = got[i], base(text)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(x[1] == k for x in want) for k in range(3)], (i, text)
        assert r["base_sha256"] == hashlib.sha256(said(want).encode()).hexdigest()
        assert r["spans"] == said(linked(text)), (i, text)
    assert got[10_013]["spans"].count("key40") == 1 and got[10_013]["spans"].count("endpoint") == 1
    assert got[10_014]["spans"] == got[10_015]["spans"] == ""
    assert "key40" not in got[10_016]["spans"]


def test_redact(documents, corpus):
    out = secrets.redact(documents)
    assert out.columns == documents.columns
    got = {r["doc_id"]: r for r in out.collect()}
    for i, text in corpus:
        want, at = "", 0
        cuts = []
        for s, _, e in linked(text):
            if cuts and s < cuts[-1][1]:
                cuts[-1][1] = max(cuts[-1][1], e)
            else:
                cuts.append([s, e])
        for s, e in cuts:
            want, at = want + (text or "")[at:s] + "[secret]", e
        want = text if not cuts else want + text[at:]
        assert got[i]["text"] == want
        if cuts:
            assert got[i]["n_chars"] == len(want)


def test_nulls_repeats_and_empty(spark, empty):
    rows = [(None, "token=abcdefgh"), (3, "token=abcdefgh"), (3, "token=abcdefgh"), (4, None)]
    got = secrets.digest(secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    assert sorted(r["n_assign"] for r in got) == [0, 1, 1, 1]
    assert secrets.digest(secrets.scan(empty)).count() == 0
    assert secrets.redact(empty).count() == 0


def test_long_words_take_linear_time(spark):
    import time

    word = "ab" * 500_000
    text = f"{word} https://db.example.org/x token=abcdefgh " + "a1" * 200_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.perf_counter()
    got = secrets.digest(secrets.scan(docs)).first()
    assert got["n_assign"] == 1 and got["spans"] == said(linked(text))
    assert secrets.redact(docs).first()["text"].count("[secret]") == len(linked(text))
    assert time.perf_counter() - start < 60


def test_names_of_other_columns(spark):
    rows = [(1, "token=abcdefgh", "p", 5, 7), (2, "nothing", "q", 6, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, parts string, row int, spans int")
    assert [r["n_assign"] for r in secrets.digest(secrets.scan(docs)).orderBy("doc_id").collect()] == [1, 0]
    got = secrets.redact(docs).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(1, "[secret]", "p", 5, 7), (2, "nothing", "q", 6, 8)]
