"""Steps whose work grew faster than their tables: what they hold or send now is bounded by the input or the answer."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from terravane.functions import geo
from terravane.operators import contracts, copies, evidence, graph, grids, identity, intake, joins, ledger, linkage
from terravane.plans import layers


def saved_rows(monkeypatch, module):
    """How many rows each table that a module saves has."""
    seen, step = [], module.saved

    def run(df):
        out = step(df)
        seen.append(out.count())
        return out

    monkeypatch.setattr(module, "saved", run)
    return seen


def test_roots_travel_down_and_ancestors_are_not_listed(spark, monkeypatch):
    seen = saved_rows(monkeypatch, evidence)
    s = spark.range(30).select(F.col("id").alias("source"), F.when(F.col("id") < 2, F.concat(F.lit("r"), F.col("id").cast("string"))).alias("root"))
    p = spark.createDataFrame([(k, k - 1) for k in range(2, 30)] + [(28, 0), (7, 28), (5, None), (6, 99)], "source long, parent long")
    got = sorted(tuple(r) for r in evidence.lineage_roots(s, p).collect())
    # 7 to 29 lie on a cycle that both roots reach.
    assert got == sorted([(0, "r0"), *((k, "r1") for k in range(1, 30)), *((k, "r0") for k in range(7, 30))])
    assert max(seen) <= len(got)


def broadcasts(df):
    return df._jdf.queryExecution().toString().count("BroadcastHashJoin")


def test_levels_send_no_front_through_the_driver(spark, monkeypatch):
    sent, step = [], ledger.saved
    monkeypatch.setattr(ledger, "saved", lambda df: (sent.append(broadcasts(df)), step(df))[1])
    nodes = spark.range(1, 200)
    k = F.col("id")
    got = ledger.levels(nodes, nodes.where("id > 1").select("id", F.floor(k / 2).alias("parent")).union(nodes.where("id = 150").select("id", F.lit(150).cast("long"))))
    assert broadcasts(got) == 0 and sum(sent) == 0
    assert {r["id"]: r["level"] for r in got.collect()} == {k: None if k == 150 else k.bit_length() - 1 for k in range(1, 200)}


def test_quantiles_are_found_without_holding_a_group(spark):
    rng = random.Random(5)
    rows = [(g, rng.choice([0.0, None, *(rng.randint(1, 300) / 4 for _ in range(5))])) for g in ("a", "b", None) for _ in range(700)] + [("c", 2.5)]
    df = spark.createDataFrame(rows, "g string, amount double").repartition(3)
    out = contracts.profile(df, ["g"])
    assert "percentile" not in out._jdf.queryExecution().toString()
    got = {r["g"]: r for r in out.collect()}
    want = df.where("amount <> 0").groupBy("g").agg(F.count("*").alias("n"), F.sum(F.col("amount").cast("decimal(28,4)")).cast("double").alias("total"), F.max("amount").alias("most"), *(F.expr(f"percentile(amount, {x})").alias(k) for k, x in (("p50", 0.5), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99)))).collect()
    assert len(got) == len(want) == 4
    for w in want:
        assert [got[w["g"]][k] for k in w.asDict() if k != "g"] == pytest.approx([w[k] for k in w.asDict() if k != "g"], rel=1e-15)


def test_kinds_of_a_group_are_counted_without_repeating_its_rows(spark):
    rows = [(1, "a", "x", "", "T1", None), (1, "b", "x", None, "T6", 1), (1, "", "y", "f", "T6", 1), (2, None, None, None, None, None)]
    got = grids.group_scores(spark.createDataFrame(rows, "cluster long, role string, domain string, function string, tier string, contradictions int"))
    assert "Expand" not in got._jdf.queryExecution().toString()
    assert {r["cluster"]: (r["n"], r["n_roles"], r["n_domains"], r["n_functions"]) for r in got.collect()} == {1: (3, 2, 2, 1), 2: (1, 0, 0, 0)}
    assert dict(got.dtypes)["n_roles"] == "bigint"


def test_chains_of_near_points_list_no_pair_of_points(spark, monkeypatch):
    seen = saved_rows(monkeypatch, joins)
    rows = [(k, 0.01 * (k % 3) + (5.0 if k > 60 else 0.0), 0.0) for k in range(80)] + [(80, 9.0, 9.0), (81, None, 0.0)]
    p = spark.createDataFrame(rows, "id long, lon double, lat double")
    got = sorted(tuple(r) for r in joins.near_roots(p, 1_200.0).collect())
    assert max(seen) <= 81
    want = graph.components(joins.within_distance(p, p, 1_200.0).where("id < other_id").select(F.col("id").alias("u"), F.col("other_id").alias("v")))
    assert got == sorted(tuple(r) for r in want.collect()) and {r for _, r in got} == {0, 61}
    assert [(r["root"], r["n_nodes"], r["nodes"][:2]) for r in graph.members(joins.near_roots(p, 1_200.0).withColumnRenamed("id", "node")).orderBy("root").collect()] == [(0, 61, [0, 1]), (61, 19, [61, 62])]


def test_degrees_hold_no_edge_where_none_comes_twice(spark):
    e = spark.createDataFrame([(1, 2), (1, 3), (3, 2)], "u long, v long")
    aggregates = lambda df: df._jdf.queryExecution().sparkPlan().toString().count("HashAggregate")
    once = graph.degrees(e, repeated=False)
    assert aggregates(once) < aggregates(graph.degrees(e))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, graph.degrees(e.union(e)).collect())) == [(1, 2, 0), (2, 0, 2), (3, 1, 1)]


def test_equal_names_at_a_place_are_judged_once(spark, monkeypatch):
    seen = saved_rows(monkeypatch, identity)
    rows = [(k, "WELLS" if k % 2 else "UTILITY", f"Pozo norte {k // 40}", "7" if k == 90 else None, 0.01 * (k // 40), 0.0, k) for k in range(80)]
    rows += [(90, "SPRINGS", "x", "7", None, None, 1), (91, "MONITORING", "y", "7", 3.0, 3.0, 2), (92, "WELLS", "z", None, 4.0, 4.0, 3)]
    df = spark.createDataFrame(rows, "id long, source string, name string, number string, lon double, lat double, ord long")
    rules = [identity.NumberRule("SPRINGS", "MONITORING"), identity.PlaceRule(("WELLS",), ("UTILITY",), 1_200.0, ((1_200.0, 1.0),), 1_200.0)]
    edges = identity.identity_edges(df, rules)
    got = {(r["id"], r["other_id"]): (r["relation"], r["binding"]) for r in edges.collect()}
    odd, even = range(1, 80, 2), range(0, 80, 2)
    want = {(i, j): ("GEOMETRY_NAME", True) if i // 40 == j // 40 else ("PROXIMITY_CANDIDATE", False) for i in odd for j in even}
    assert got == want | {(90, 91): ("AUTHORITATIVE_ID", True)}
    members = identity.identity_members(df, rules)
    assert {tuple(r) for r in members.collect()} == {tuple(r) for r in identity.canonical_records(df, edges).collect()}
    assert max(seen) <= 4


def test_links_of_equal_names_are_spelled_out_in_blocks(spark, monkeypatch):
    sides, step = [], copies.spelled
    monkeypatch.setattr(copies, "spelled", lambda x, y, key: (sides.append(key), step(x, y, key))[1])
    monkeypatch.setattr(copies, "SIDE", 4)
    monkeypatch.setattr(copies, "TASK", 50)
    a = spark.createDataFrame([(k, "alpha beta gamma" if k < 20 else "delta") for k in range(22)], "id long, name string")
    b = spark.createDataFrame([(k, "beta alpha" if k < 20 else "omega") for k in range(25)], "id long, name string")
    got = [(r["id"], r["other_id"], round(r["similarity"], 6)) for r in linkage.similar_names(a, b, 0.5).collect()]
    assert sorted(got) == [(i, j, 0.666667) for i in range(20) for j in range(20)]
    assert sides == ["t2", "t"]


def test_corridors_between_copies_of_places_save_no_pair(spark, monkeypatch):
    seen = saved_rows(monkeypatch, intake)
    at = [(k / 16, 0.0) for k in range(12)]
    found = spark.createDataFrame([(k, *at[k % 12]) for k in range(36)], "id long, lon double, lat double")
    flights = spark.createDataFrame([(*p, *q) for p in at for q in at for _ in range(2)], "origin_lon double, origin_lat double, dest_lon double, dest_lat double")
    rows = intake.corridors(found, flights, 0.01).collect()
    # Between every two rows, four flights; two within one coordinate, each in both directions.
    assert len(rows) == 36 * 35 // 2 and {r["connecting"] for r in rows} == {4}
    assert len({(r["place_a"], r["place_b"]) for r in rows}) == len(rows) and all(r["place_a"] < r["place_b"] for r in rows)
    assert max(seen) <= 36
    plan = intake.corridors(found, flights, 0.01)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(b") < plan.index("FlatMapGroupsInArrow") < plan.index("Join")


def test_crowded_coordinates_are_dealt_in_parts(spark, monkeypatch):
    for name, value in (("GIVEN", 8), ("FLOWN", 3), ("PLACES", 4), ("END_POINTS", 2)):
        monkeypatch.setattr(intake, name, value)
    monkeypatch.setattr(copies, "SIDE", 3)
    at = [(0.0, 0.0), (0.05, 0.0), (1.0, 0.5)]
    found = spark.createDataFrame([(f"p{k:02}", *at[k % 3]) for k in range(33)], "id string, lon double, lat double")
    flown = [(*at[a], *at[b]) for a, b in ((0, 2), (0, 2), (2, 0), (1, 2), (0, 1), (1, 1))]
    flights = spark.createDataFrame(flown, "origin_lon double, origin_lat double, dest_lon double, dest_lat double")
    near = lambda x, y: [f"p{k:02}" for k in range(33) if abs(at[k % 3][0] - x) <= 0.1 and abs(at[k % 3][1] - y) <= 0.1]
    want = Counter((min(a, b), max(a, b)) for x, y, p, q in flown for a in near(x, y) for b in near(p, q) if a != b)
    want = {k: n for k, n in want.items() if n >= 2}
    assert {(r["place_a"], r["place_b"]): r["connecting"] for r in intake.corridors(found, flights).collect()} == want
    assert intake.corridors(found, flights).count() == len(want) == intake.corridor_classes(found, flights).agg(F.sum("n_pairs")).first()[0]


def test_nearest_fixed_points_take_columns_and_keep_nulls(spark):
    rows = [(-66.1, 18.4), (-67.0, 18.0), (None, 18.0), (-66.0, None), (float("nan"), 18.0)]
    some = [(18.4655, -66.1057), (18.0099, -66.6140), (18.4279, -66.7177)]
    got = spark.createDataFrame(rows, "lon double, lat double").select(geo.nearest_of(F.col("lon"), F.col("lat"), some).alias("d"))
    assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()
    d = [r["d"] for r in got.collect()]
    assert d[:2] == [min(math.sqrt((x - b) * (x - b) + (y - a) * (y - a)) for a, b in some) for x, y in rows[:2]]
    assert d[2:4] == [None, None] and math.isnan(d[4])


def test_corridors_are_judged_before_they_are_spelled_out(spark):
    plan = layers.intake(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(a") < plan.rindex("ArrowEvalPython")


def test_flights_of_two_blocks_stream_through_a_task(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(intake, "FLOWN", 50_000)
    names = ["side", "plon", "plat", "qlon", "qlat", "n", "own"]
    peak, start = [0], pa.total_allocated_bytes()

    def batch(side, lon, lat, qlon, n, own):
        size = len(lon)
        return pa.RecordBatch.from_arrays([pa.array([side] * size, pa.int32()), pa.array(lon), pa.array(lat), pa.array(qlon, pa.float64()), pa.array([0.0] * size), pa.array([n] * size), pa.array(own, pa.int64())], names)

    def batches():
        yield batch(0, [0.0, 5.0], [0.0, 5.0], [None] * 2, 1, [7, 8])
        yield batch(1, [1.0], [0.0], [None], 2, [9])
        for k in range(100):
            yield batch(2, [0.0] * 10_000, [0.0] * 10_000, [1.0 + 0.001 * k] * 10_000, 3, [None] * 10_000)
            peak[0] = max(peak[0], pa.total_allocated_bytes() - start)

    out = pa.Table.from_batches(intake._summed(0.2)((pa.scalar(0), pa.scalar(1)), batches())).to_pylist()
    assert out == [{"a": 7, "b": 9, "lon": 0.5, "lat": 0.0, "connecting": 3_000_000, "n_pairs": 2, "alone": False}]
    assert peak[0] < 16 << 20


def test_titles_and_names_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(copies, "TASK", 20)
    monkeypatch.setattr(copies, "SIDE", 4)
    projects = spark.createDataFrame([(k, f"Obras en Sitio {k % 9}", None if k % 2 else "M") for k in range(40)], "id long, name string, municipality string")
    references = spark.createDataFrame([(f"R{k}", k, "m", [f"sitio {k}"]) for k in range(12)], "ref_id string, ord long, municipality string, names array<string>")
    for keys in (100_000, 0):
        monkeypatch.setattr(copies, "KEYS", keys)
        got = linkage.contained_names(projects, references)
        plan = got._jdf.queryExecution().sparkPlan().toString()
        sides = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
        keyed = [line for line in sides if "[key" in line]
        assert bool(keyed) == (keys > 0) and all("BuildRight" in line for line in keyed) and not [line for line in sides if "[title" in line]
        assert sorted(tuple(r) for r in got.select("id", "ref_id").collect()) == [(k, f"R{k % 9}") for k in range(40)]


def test_ratios_of_many_names_equal_difflib_and_stop_where_letters_do_not_suffice():
    import pandas as pd
    from difflib import SequenceMatcher

    r = random.Random(9)
    word = lambda letters, n: "".join(r.choice(letters) for _ in range(r.randrange(n)))
    pairs = [(word(x, n), word(x, n)) for x, n in (("ab", 9), ("abc d", 30), ("0123456789", 12), ("añ€😀", 20), ("abc", 260)) for _ in range(200)] + [("same", "same"), ("", "")]
    left, right = (pd.Series(x) for x in zip(*pairs, strict=True))
    least = pd.Series([r.choice([0.0, 0.5, 0.8]) for _ in pairs])
    want = [0.0 if not a or not b else SequenceMatcher(None, a, b).ratio() for a, b in pairs]
    assert next(identity.matching_ratio.func(iter([(left, right)]))).tolist() == want
    some = next(identity.ratio_from.func(iter([(left, right, least)]))).tolist()
    assert all(g == w or (math.isnan(g) and w < x) for g, w, x in zip(some, want, least, strict=True)) and any(map(math.isnan, some))


def test_names_of_repeated_numbers_are_not_compared(spark, monkeypatch):
    seen, step = [], identity._ratios

    def run(pairs, *more):
        seen.append(pairs.count())
        return step(pairs, *more)

    monkeypatch.setattr(identity, "_ratios", run)
    rows = [(k, "S", f"n{k}", "7", 0.0, 0.0, k) for k in range(5)] + [(9, "W", "n9", "7", 0.0, 0.0, 9)]
    df = spark.createDataFrame(rows, "id long, source string, name string, number string, lon double, lat double, ord long")
    got = identity.identity_edges(df, [identity.RepeatRule("S"), identity.NumberRule("W", "S")]).collect()
    assert seen == [1] and sorted((r["id"], r["other_id"], r["similarity"]) for r in got) == [*((0, k, 1.0) for k in range(1, 5)), (9, 4, 0.5)]
