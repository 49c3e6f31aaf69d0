"""The operators on vectors against plain versions, and their edge cases."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from terravane.llm import vector_codes, vector_dups, whitening

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def frame(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(3)


@pytest.fixture(scope="module")
def table(spark):
    """The smallest test table with odd rows, and columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    some = rows[7][1]
    bad = [None, some[:63] + [None], [NAN] + some[1:], some[:1] + [-INF] + some[2:]]
    rows += [(1_000 + i, x, 3) for i, x in enumerate(bad)]
    rows += [(2_000, some, rows[7][2]), (2_000, some, rows[7][2]), (2_001, some, None), (None, some, rows[7][2]), (2_002, [0.0] * 64, 3)]
    df = frame(spark, rows)
    return df.withColumns({c: F.lit("clash") for c in ("code", "error", "v", "x", "c", "n", "node", "h1", "places", "item")}), rows


def good(x):
    return x is not None and all(c is not None and math.isfinite(c) for c in x)


def plain_codes(rows, parts=4, entries=256, rounds=4):
    kept = sorted(([r[0], r[2], [math.floor(1024 * c) for c in r[1]]] for r in rows if good(r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    k = len(kept[0][2]) // parts
    cut = [[r[2][p * k : (p + 1) * k] for p in range(parts)] for r in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def assign():
        return [[min((far(c[p], e), i) for i, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            own = defaultdict(list)
            for c, g in zip(cut, got, strict=True):
                own[g[p][1]].append(c[p])
            for i, members in own.items():
                books[p][i] = [sum(v) // len(members) for v in zip(*members, strict=True)]
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    out = [(r[0], "".join(f"{i:02x}" for _, i in g), sum(d for d, _ in g), r[1]) for r, g in zip(kept, assign(), strict=True)]
    sums = defaultdict(int)
    for _, _, e, label in out:
        sums[label] += e
    return sorted(((i, code, e, sums[label], sha) for i, code, e, label in out), key=repr)


def codes(df, **more):
    return sorted((tuple(r) for r in vector_codes.encode(df, **more).collect()), key=repr)


def test_codes_equal_a_plain_version(spark, table):
    df, rows = table
    rows = rows[:120] + rows[-9:]
    df = frame(spark, rows)
    assert codes(df, entries=16) == plain_codes(rows, entries=16)


def test_codes_with_ties_few_rows_and_unused_entries(spark):
    rows = [(i, [float(x) for x in v], None if i % 2 else 1) for i, v in enumerate([[0, 0, 0, 0], [2, 2, 2, 2], [1, 1, 1, 1], [1, 1, 1, 1], [0, 0, 0, 0], [-3, -0.5, -0.1, 9]])]
    assert codes(frame(spark, rows)) == plain_codes(rows)
    assert codes(frame(spark, rows), entries=2, rounds=3) == plain_codes(rows, entries=2, rounds=3)


def test_codes_of_very_large_components_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.integers(-(2**40), 2**40, 8) / 4).tolist(), 0) for i in range(40)]
    got, want = codes(frame(spark, rows), entries=5), plain_codes(rows, entries=5)
    assert [r[:2] + r[4:] for r in got] == [r[:2] + r[4:] for r in want]
    assert all(r[2] is None or r[2] == w[2] for r, w in zip(got, want, strict=True))


def test_codes_of_odd_rows(spark):
    rows = [(i, [float(i + k) for k in range(8)], i % 2) for i in range(10)]
    odd = [(20, [1.0] * 4, 0), (21, [], 0), (22, [1e300] * 8, 7), (None, [5.0] * 8, 1)]
    got = {r[0]: r for r in codes(frame(spark, rows + odd))}
    assert len(got) == 14
    assert all(got[i][1] is None and got[i][2] is None for i in (20, 21, 22)) and got[22][3] is None
    assert got[None][1] is not None and got[20][3] == got[0][3]
    assert codes(frame(spark, [])) == []
    assert [r[1:4] for r in codes(frame(spark, [(1, [1.0, 2.0, 3.0], 0)]))] == [(None, None, None)]


def test_label_sums_by_shuffle_are_the_same(table, monkeypatch):
    df, _ = table
    want = codes(df, entries=4, rounds=1)
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 0)
    assert codes(df, entries=4, rounds=1) == want


def plain_dups(rows, cosine=0.98):
    n = len(rows)
    ok = [good(r[1]) and any(r[1]) and r[2] is not None for r in rows]
    unit = {i: np.array(rows[i][1]) / np.linalg.norm(rows[i][1]) for i in range(n) if ok[i]}
    near = {i: {j for j in unit if j != i and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= cosine} for i in unit}
    out = []
    for i in range(n):
        seen, front = {i}, [i]
        while front:
            front = [j for f in front for j in near.get(f, ()) if j not in seen and not seen.add(j)]
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(near.get(i, ())), least, rows[i][0] == least))
    return sorted(out, key=repr)


def dups(df, **more):
    return sorted((tuple(r) for r in vector_dups.near_duplicates(df, **more).collect()), key=repr)


def test_dups_on_the_test_table(table):
    df, rows = table
    assert dups(df) == plain_dups(rows)


@pytest.fixture(scope="module")
def crowd(spark):
    """Chains and balls of near vectors around the threshold, in three labels."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(60):
        at = rng.standard_normal(16)
        for s in range(1 + k % 12):
            at = at + rng.standard_normal(16) * 0.12 * (s % 3)
            rows.append((len(rows) * 3 % 997, (at * rng.uniform(0.1, 9)).tolist(), k % 3))
    return frame(spark, rows), rows


def test_dups_find_chains(crowd):
    df, rows = crowd
    got, want = dups(df), plain_dups(rows)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert there > 200 and found <= there and found >= 0.98 * there


def test_dups_with_small_tiles_and_leads_link_the_same(crowd):
    """Cells of leading directions and cuts change where pairs meet, hardly what is found."""
    df, rows = crowd
    there = sum(r[1] for r in plain_dups(rows))
    for tile, leads in ((8, 6), (16, 0), (3, 2)):
        got = dups(df, tile=tile, leads=leads)
        assert len(got) == len(rows)
        assert 0.98 * there <= sum(r[1] for r in got) <= there


def test_dups_never_link_below_the_threshold(spark):
    """Pairs of plane vectors just above and just below; the cosine alone decides."""
    rows = []
    for k, c in enumerate([0.98 + 1e-9, 0.98 - 1e-9, 0.985, 0.97, 1.0]):
        rows += [(2 * k, [1.0, 0.0], k), (2 * k + 1, [c, math.sqrt(1 - c * c)], k)]
    got = {r[0]: r[1] for r in dups(frame(spark, rows))}
    assert got == {0: 1, 1: 1, 2: 0, 3: 0, 4: 1, 5: 1, 6: 0, 7: 0, 8: 1, 9: 1}


def test_dups_of_huge_tiny_and_unequal_vectors(spark):
    rows = [(1, [1e200, 1e200], 0), (2, [1e-200, 1e-200], 0), (3, [1.0, 1.0, 1.0], 0), (4, [1.0, 1.0], 0), (4, [1.0, 1.0], 0), (5, [-0.0, 0.0], 0), (6, [], 0), (7, [1.0, 1.0], None)]
    assert dups(frame(spark, rows)) == sorted([(1, 3, 1, True), (2, 3, 1, False), (3, 0, 3, True), (4, 3, 1, False), (4, 3, 1, False), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True)], key=repr)
    assert dups(frame(spark, [])) == []
    assert dups(frame(spark, [(None, [1.0], 1), (None, [2.0], 1), (None, None, 1)])) == [(None, 0, None, True), (None, 1, None, True), (None, 1, None, True)]


def test_needed_count_is_the_binomial_one():
    rng = np.random.default_rng(1)
    need = vector_dups.needed()
    hits = (np.abs(rng.standard_normal((400_000, vector_dups.PROJECTIONS))) <= vector_dups.WINDOW).sum(axis=1)
    assert (hits >= need).mean() >= vector_dups.RECALL - 2e-4 and (hits >= need + 1).mean() < vector_dups.RECALL


def plain_whitening(rows, components=4):
    x = np.array([[math.floor(256 * c) for c in r[1]] for r in rows if good(r[1])], object)
    fit = np.unique(np.array(x, np.int64), axis=0).astype(object)
    n, s = len(fit), fit.sum(axis=0)
    mean = np.array([float(v) / n for v in s])
    c = fit.astype(float) - mean
    v = (c[:, :, None] * c[:, None, :]).mean(axis=0)
    values, vectors = np.linalg.eigh(v)
    top = np.argsort(values)[::-1][:components]
    deviation = ((n * x - s) ** 2).sum(axis=1)
    white = (x.astype(float) - mean) @ vectors[:, top] / np.sqrt(values[top])
    return n, deviation.tolist(), white, values[top] / np.trace(v)


def test_whitening_equals_a_plain_version(table):
    df, rows = table
    got = whitening.whiten(df).orderBy("vec_id", "component").collect()
    kept = sorted((r for r in rows if good(r[1])), key=lambda r: (r[0] is not None, r[0]))
    n, deviation, white, shares = plain_whitening(kept)
    assert len(got) == 4 * len(kept) and {r["n"] for r in got} == {n}
    twice = [r for r in got if r["vec_id"] == 2_000]
    assert len(twice) == 8 and all(a == b for a, b in zip(twice[::2], twice[1::2], strict=True))
    once = [i for i, r in enumerate(kept) if r[0] != 2_000]
    got, deviation, white = [r for r in got if r["vec_id"] != 2_000], [deviation[i] for i in once], white[once]
    assert [r["deviation"] for r in got[::4]] == deviation
    mine = np.array([r["whitened"] for r in got]).reshape(-1, 4)
    turn = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine * turn - white).max() < 1e-8
    assert np.allclose([r["explained"] for r in got[:4]], shares, rtol=1e-10)
    assert 0 <= got[0]["identity_error"] < 1e-10 and len({r["identity_error"] for r in got}) == 1


def test_whitening_of_offset_values(spark):
    """A large offset costs no digits."""
    rng = np.random.default_rng(2)
    rows = [(i, (2.0**40 + rng.standard_normal(3)).tolist(), 0) for i in range(50)]
    near = [(i, [c - 2.0**40 for c in v], 0) for i, v, _ in rows]
    a, b = (whitening.whiten(frame(spark, r)).orderBy("vec_id", "component").collect() for r in (rows, near))
    assert len(a) == 150 and [r["deviation"] for r in a] == [r["deviation"] for r in b]
    assert np.allclose(np.abs([r["whitened"] for r in a]), np.abs([r["whitened"] for r in b]), atol=1e-9)


def test_whitening_of_odd_rows(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    one = whitening.whiten(frame(spark, [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0)])).collect()
    assert [tuple(r)[1:] for r in one] == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)] * 2
    flat = whitening.whiten(frame(spark, [(i, [float(i), 7.0, -float(i)], 0) for i in range(9)] + [(20, [1.0], 0), (21, [1e300, 0.0, 0.0], 0), (None, [1.0, 7.0, -1.0], 0)])).collect()
    assert len(flat) == 3 * 12
    by = {(r["vec_id"], r["component"]): r for r in flat}
    assert by[(3, 1)]["whitened"] is not None and by[(3, 3)]["whitened"] is None and by[(3, 1)]["explained"] == pytest.approx(1.0)
    assert by[(20, 1)]["deviation"] is None and by[(21, 1)]["whitened"] is None and by[(None, 1)]["deviation"] == by[(1, 1)]["deviation"]
    huge = whitening.whiten(frame(spark, [(i, [float(i) * 2.0**41], 0) for i in range(5)])).collect()
    assert all(r["whitened"] is not None for r in huge) and {r["deviation"] for r in huge} == {0, None}
