"""Lineages, states of paths and identities against plain versions."""

import itertools
import math
import random
import re
from difflib import SequenceMatcher

import pytest

from terravane.operators import identity as I
from terravane.operators import ledger as L


def test_planted_faults_are_named_once(spark):
    sound = [("a", None, "SOURCE_NATIVE", "SOURCE_NATIVE"), ("b", "a", "FULL", "DERIVED"), ("c", "b", "SIMPLIFIED", "DERIVED"), ("d", "c", "MVT", "DERIVED")]
    schema = "id string, parent string, state string, origin string"
    assert L.lineage_faults(spark.createDataFrame(sound, schema)).count() == 0
    assert L.lineage_faults(spark.createDataFrame([], schema)).count() == 0
    bad = [
        ("e", "c", "FULL", "DERIVED"), ("f", "d", "SIMPLIFIED", "DERIVED"), ("g", "x", "FULL", "DERIVED"), ("h", "h", "FULL", "DERIVED"), ("i", "j", "FULL", "DERIVED"), ("j", "i", "FULL", "DERIVED"), ("k", "j", "FULL", "DERIVED"),
        ("l", "a", "SOURCE_NATIVE", "SOURCE_NATIVE"), ("m", " ", "FULL", "DERIVED"), ("n", "a", "FULL", "SOURCE_NATIVE"), ("o", "a", "ODD", "DERIVED"), ("p", "a", "UNRESOLVED", "DERIVED"), ("q", "a", "FULL", "DERIVED"), ("q", "a", "FULL", "DERIVED"), (" ", "a", "FULL", "DERIVED"), ("r", "a", None, None),
    ]
    got = sorted(tuple(r) for r in L.lineage_faults(spark.createDataFrame(sound + bad, schema)).collect())
    want = [
        (" ", "EMPTY_ID", None), ("e", "LOSSY_AUTHORITY_REVERSAL", "c"), ("f", "MVT_AUTHORITY_REVERSAL", "d"), ("g", "PARENT_NOT_FOUND", "x"), ("h", "SELF_EDGE", None), ("i", "LINEAGE_CYCLE", None), ("j", "LINEAGE_CYCLE", None), ("k", "LINEAGE_CYCLE", None),
        ("l", "LOSSY_AUTHORITY_REVERSAL", "a"), ("l", "SOURCE_NATIVE_HAS_PARENT", "a"), ("m", "MISSING_PARENT", None), ("n", "ORIGIN_CONFLICT", "SOURCE_NATIVE"), ("o", "INVALID_STATE", "ODD"), ("p", "UNRESOLVED_LINEAGE", None), ("q", "DUPLICATE_ID", None), ("r", "INVALID_STATE", None),
    ]
    assert got == want


def test_ancestry_of_long_chains_and_cycles(spark):
    rows = [(i, i - 1 if i % 300 else None) for i in range(900)] + [(1000 + i, 1000 + (i + 1) % 7) for i in range(7)] + [(2000, 1003), (2001, 2000), (3000, 99_999)]
    got = {r["id"]: (r["root"], r["depth"]) for r in L.ancestry(spark.createDataFrame(rows, "id long, parent long")).collect()}
    assert all(got[i] == (i - i % 300, i % 300) for i in range(900))
    assert all(got[i] == (None, None) for i in (*range(1000, 1007), 2000, 2001)) and got[3000] == (3000, 0)


def test_levels_of_a_graph(spark):
    rng = random.Random(3)
    links = {(i, rng.randrange(i)) for i in range(1, 60) for _ in range(2)} | {(70, 71), (71, 70), (72, 70), (73, 72), (73, 5), (74, 500)}
    nodes = [(i,) for i in (*range(60), 70, 71, 72, 73, 74)]
    want = {0: 0}
    for i in range(1, 60):
        want[i] = 1 + max(want[p] for c, p in links if c == i)
    got = {r["id"]: r["level"] for r in L.levels(spark.createDataFrame(nodes, "id long"), spark.createDataFrame(sorted(links), "id long, parent long")).collect()}
    assert got == want | dict.fromkeys((70, 71, 72, 73, 74))


def plain_state(edges, start, goal, most):
    near = {}
    for u, v, c, k in edges:
        near.setdefault(u, []).append((v, c, k))
        near.setdefault(v, []).append((u, c, k))
    states, front = set(), [(start, (start,), ())]
    while front:
        at, seen, path = front.pop()
        if at == goal and path:
            classes, kinds = {c for c, _ in path}, {k for c, k in path if c == "VERIFIED" and k}
            states.add("CONTRADICTED" if "CONTRADICTED" in classes else "UNRESOLVED" if "UNRESOLVED" in classes else "HYPOTHETICAL" if classes != {"VERIFIED"} else "MIXED_KINDS" if len(kinds) > 1 else "VERIFIED")
            continue
        if len(path) < most:
            front += [(v, (*seen, v), (*path, (c, k))) for v, c, k in near.get(at, []) if v not in seen]
    return next((s for s in L.PATH_STATES if s in states), "NO_PATH")


@pytest.mark.parametrize("seed", range(3))
def test_path_states_equal_an_enumeration(spark, seed):
    rng = random.Random(seed)
    classes = ["VERIFIED"] * 5 + ["CONTEXT", "HYPOTHESIZED", "UNRESOLVED", "CONTRADICTED"]
    edges = [(u, v, rng.choice(classes), rng.choice([None, "water", "passage", "air"])) for u, v in (rng.sample(range(11), 2) for _ in range(17))]
    pairs = list(itertools.product(range(12), range(12)))
    for most in (1, 3, 6):
        got = {(r["start"], r["goal"]): r["state"] for r in L.path_states(spark.createDataFrame(pairs, "start long, goal long"), spark.createDataFrame(edges, "u long, v long, class string, kind string"), most).collect()}
        assert got == {p: plain_state(edges, *p, most) for p in pairs}


def test_path_states_stay_small_on_a_ladder(spark):
    """A ladder of 40 rungs has 2^40 paths from end to end."""
    edges = [(2 * i + a, 2 * i + 2 + b, "VERIFIED", "water" if a == b else "air") for i in range(40) for a in (0, 1) for b in (0, 1)]
    df = spark.createDataFrame(edges, "u long, v long, class string, kind string")
    assert [r["state"] for r in L.path_states(spark.createDataFrame([(0, 80), (0, 81), (0, 999)], "start long, goal long"), df, 40).orderBy("goal").collect()] == ["VERIFIED", "MIXED_KINDS", "NO_PATH"]


def test_states_of_given_paths(spark):
    rows = [(1, "VERIFIED", "water"), (1, "VERIFIED", None), (2, "VERIFIED", "water"), (2, "VERIFIED", "air"), (3, "VERIFIED", "air"), (3, "CONTEXT", None), (4, "UNRESOLVED", None), (4, "CONTRADICTED", None), (5, "VERIFIED", None)]
    got = {r[0]: tuple(r)[1:] for r in L.path_state(spark.createDataFrame(rows, "path long, class string, kind string")).collect()}
    assert got == {1: ("VERIFIED", "water", 2, 0), 2: ("MIXED_KINDS", None, 2, 0), 3: ("HYPOTHETICAL", None, 2, 1), 4: ("CONTRADICTED", None, 2, 2), 5: ("VERIFIED", None, 1, 0)}


RULES = [
    I.NumberRule("S", "M"),
    I.RepeatRule("S"),
    I.PlaceRule(("W",), ("U",), 60.0, ((60.0, 0.82), (20.0, 0.60)), 60.0),
    I.PlaceRule(("W",), ("M",), 90.0, ((90.0, 0.80),), 30.0),
]


def plain_key(name):
    low = re.sub(r"\b(well|pozo|spring|quarry|cantera|pr|puerto rico)\b", " ", (name or "").lower().replace("é", "e"))
    return re.sub("[^a-z0-9]+", " ", low).strip()


def plain_edges(rows):
    def ratio(a, b):
        a, b = plain_key(a), plain_key(b)
        return 0.0 if not a or not b else 1.0 if a == b else SequenceMatcher(None, a, b).ratio()

    def metres(a, b):
        if None in (a["lon"], a["lat"], b["lon"], b["lat"]):
            return None
        p, q = math.radians(b["lat"] - a["lat"]) / 2, math.radians(b["lon"] - a["lon"]) / 2
        return 2 * 6371008.8 * math.asin(min(1.0, math.sqrt(math.sin(p) ** 2 + math.cos(math.radians(a["lat"])) * math.cos(math.radians(b["lat"])) * math.sin(q) ** 2)))

    by, out = {}, []
    for r in sorted(rows, key=lambda r: (r["ord"], r["id"])):
        by.setdefault(r["source"], []).append(r)
    number = {r["number"].strip(): r for r in by["M"] if (r["number"] or "").strip()}
    groups = {}
    for s in by["S"]:
        if (s["number"] or "").strip():
            groups.setdefault(s["number"].strip(), []).append(s)
            if m := number.get(s["number"].strip()):
                out.append((s["id"], m["id"], "AUTHORITATIVE_ID", True, "DIRECT", metres(s, m), ratio(s["name"], m["name"])))
    for first, *others in groups.values():
        out += [(first["id"], o["id"], "DUPLICATE_SOURCE_ROW", True, "DIRECT", metres(first, o), 1.0) for o in others]
    for right, most, binds, loose in (("U", 60.0, ((60.0, 0.82), (20.0, 0.60)), 60.0), ("M", 90.0, ((90.0, 0.80),), 30.0)):
        for a, b in itertools.product(by["W"], by[right]):
            d = metres(a, b)
            if d is None or d > most:
                continue
            s = ratio(a["name"], b["name"])
            bound = any(d <= m and s >= x for m, x in binds)
            if bound or d <= loose:
                out.append((a["id"], b["id"], "GEOMETRY_NAME" if bound else "PROXIMITY_CANDIDATE", bound, "SUPPORTING" if bound else "CANDIDATE", d, s))
    return out


@pytest.fixture(scope="module")
def records(spark):
    rng = random.Random(11)
    names = ["Pozo Arenas", "Arenas Well 2", "La Joya", "La  Joyá PR", "Joya Norte", "Río Béisbol", "rio beisbol", "", None, "Cantera Sur", "Well", "Sur 12"]
    names = [n.replace("á", "é").replace("í", "é") if n else n for n in names]
    rows = []
    for i in range(2_000):
        spot = rng.randrange(250)
        near = rng.random() < 0.95
        rows.append(
            {"id": i, "source": rng.choice("WUMS"), "name": rng.choice(names), "number": rng.choice([None, "", f" {rng.randrange(300)} "]), "lon": -66.5 + spot * 0.004 + rng.uniform(0, 0.0006) if near else None, "lat": 18.2 + rng.uniform(0, 0.0006), "ord": rng.randrange(1_500)}
        )
    return rows, spark.createDataFrame(rows, "id long, source string, name string, number string, lon double, lat double, ord long")


def test_identity_edges_equal_a_plain_version(records):
    rows, df = records
    got = sorted((tuple(r) for r in I.identity_edges(df, RULES, salts=3).collect()), key=repr)
    want = sorted(plain_edges(rows), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want] and {w[2] for w in want} == {"AUTHORITATIVE_ID", "DUPLICATE_SOURCE_ROW", "GEOMETRY_NAME", "PROXIMITY_CANDIDATE"}
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], abs=1e-6) and g[6] == pytest.approx(w[6], abs=1e-12)


def test_assets_equal_a_plain_version(records):
    rows, df = records
    edges = plain_edges(rows)
    root = {r["id"]: r["id"] for r in rows}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b, _, bound, *_ in edges:
        if bound:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    groups = {}
    for r in rows:
        groups.setdefault(find(r["id"]), []).append(r["source"])
    direct = {find(e[0]) for e in edges if e[4] == "DIRECT"}
    want = set()
    for k, sources in groups.items():
        n = [sources.count(s) for s in set(sources)]
        relation = ("1:1" if len(sources) == 1 else "N:1_SOURCE_DUPLICATE") if len(n) == 1 else "1:1" if max(n) == 1 else "N:1" if sum(x > 1 for x in n) == 1 else "N:N"
        want.add((k, "WATER" if set(sources) & set("WUS") else "OTHER" if "M" in sources else "UNRESOLVED_TARGET", relation, len(sources), len(n), "DIRECT" if k in direct else "SUPPORTING" if len(sources) > 1 else "SOURCE_ONLY"))
    got = {tuple(r) for r in I.canonical_assets(df, I.identity_edges(df, RULES), {"WATER": ("W", "U", "S"), "OTHER": ("M",)}).collect()}
    assert got == want and len({w[2] for w in want}) == 4


def test_rules_are_needed(records):
    with pytest.raises(ValueError):
        I.identity_edges(records[1], [])
