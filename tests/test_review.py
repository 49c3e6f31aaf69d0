"""Operators of review on odd inputs: nulls, empty tables, ties and repeats."""

import pytest
from pyspark.sql import functions as F

from terravane.operators import review as R


def test_permitted_needs_everything(spark):
    features = spark.createDataFrame([(1,), (1,), (2,), (3,)], "feature long")
    a = spark.createDataFrame(
        [
            (1, "EXISTENCE", "DIRECT", "ACCEPTED", "reviewer", ["s1"]),
            (1, "PHYSICAL_OPENING", "DIRECT", "ACCEPTED", "reviewer", ["s1"]),
            (2, "EXISTENCE", "DIRECT", "ACCEPTED", " maker ", ["s2", "gone"]),
            (2, "FORM", "CONTRADICTED", None, None, []),
        ],
        "feature long, dimension string, effective string, adjudication string, adjudicator string, source_ids array<string>",
    )
    cites = spark.createDataFrame([(1, 10), (1, 10), (2, 10), (2, 11)], "feature long, observation long")
    seen = spark.createDataFrame([(10, "s1", True)], "observation long, source string, located boolean")
    sources = spark.createDataFrame([("s1", "REGISTERED"), ("s2", "REFERENCED_ONLY")], "source string, provenance string")
    got = {r.feature: (r.status, r.blockers) for r in R.permitted(features, a, cites, seen, sources, "maker").collect()}
    assert got[1] == ("VERIFIED", [])
    assert got[2] == (
        "CANDIDATE",
        [
            "evidence reaches FEATURE; a verified access point needs a directly observed physical opening",
            "contradicted dimensions: FORM",
            "feature cites observations the registry does not hold",
            "EXISTENCE has no assertion accepted by a reviewer independent of the producer",
            "EXISTENCE cites source gone whose exact bytes are not registered",
            "EXISTENCE cites source s2 whose exact bytes are not registered",
        ],
    )
    assert got[3][0] == "PROVISIONAL_DISCOVERY" and len(got[3][1]) == 2
    with pytest.raises(ValueError):
        R.permitted(features, a, cites, seen, sources, " ")


def test_states_of_boxes(spark):
    rows = [(0, 0, 1, 1), (2, 2, 2, 2), (0, 1, 0, 1), (-1, 0, 1, 1), (-1, 0, 0, 1), (4, 5, 6, 6), (1, 1, 0, 2), (None, 1, 1, 1)]
    df = spark.createDataFrame([("DIRECT", None if i else ["Name_Only"], *map(lambda v: None if v is None else float(v), r)) for i, r in enumerate(rows)], "tier string, bases array<string>, x0 double, y0 double, x1 double, y1 double")
    got = R.adjudicated(df, (0, 0, 3, 3)).collect()
    assert [r.state for r in got] == ["FULLY_WITHIN", "FULLY_WITHIN", "TOUCH_ONLY", "PARTIAL", "TOUCH_ONLY", "OUTSIDE", "UNRESOLVED", "NULL_EMPTY"]
    assert [r.evidence_tier for r in got] == ["CANDIDATE", *["DIRECT"] * 5, "UNRESOLVED", "UNRESOLVED"]
    assert got[0].certification == "CANDIDATE_NOT_IDENTITY" and got[5].distance == pytest.approx(5**0.5) and got[7].distance is None


def test_empty_tables(spark):
    none = spark.createDataFrame([], "name string, geoid string")
    assert R.density_state(R.density(none.select("name"), none)).first().asDict() == {"total": 0, "matched": 0, "unmatched": 0, "state": "PASS"}
    keys = none.select(F.col("name").alias("key"))
    assert list(R.compared_keys(keys, keys).first()) == [0] * 5
    cells = spark.createDataFrame([], "value double, interpolated boolean")
    assert list(R.cell_accounting(cells).first()) == [0, 0, 0, None, None]


def test_unknown_measures_count_nothing(spark):
    one = spark.range(1)
    none = F.lit(None).cast("double")
    flags = F.lit(None).cast("array<string>")
    assert one.select(R.depression_score(none, F.lit(0.0), F.lit(0.0), none, F.lit(True), flags)).first()[0] == 0.0
    assert one.select(R.inherited_confidence(F.lit("corridor"), none, none, F.lit(None).cast("int"), none)).first()[0] == 0.0
    assert one.select(R.scale_ratio(none, F.lit(2.0))).first()[0] == 0.5
    box = [F.lit(v) for v in (0.0, 0.0, 1.0, 1.0)]
    assert one.select(R.covered_share(box, box, [none, *box[1:]])).first()[0] is None


def test_conditions_in_order(spark):
    df = spark.createDataFrame([(["a", "b"],), (["b"],), ([],), (None,)], "d array<string>")
    got = [r[0] for r in df.select(R.first_met(F.col("d"), [("none", ()), ("both", ("b", "a")), ("one", ("b",))])).collect()]
    assert got == ["both", "one", None, None]


def test_permitted_brings_a_feature_together_once(spark):
    features = spark.createDataFrame([(1,), (None,)], "feature long")
    a = spark.createDataFrame(
        [(1, "EXISTENCE", "SUPPORTING", "ACCEPTED", None, ["s9", "s2"]), (1, "EXISTENCE", "DIRECT", "ACCEPTED", "reviewer", ["s2"]), (None, "EXISTENCE", "DIRECT", "ACCEPTED", "reviewer", ["s2"]), (1, "EXISTENCE", None, None, None, None)],
        "feature long, dimension string, effective string, adjudication string, adjudicator string, source_ids array<string>",
    )
    cites = spark.createDataFrame([(1, 10), (None, 10), (1, 12)], "feature long, observation long")
    seen = spark.createDataFrame([(10, "s3", True), (12, None, None)], "observation long, source string, located boolean")
    sources = spark.createDataFrame([("s2", None), ("s3", "UNREGISTERED")], "source string, provenance string")
    found = R.permitted(features, a, cites, seen, sources, "maker")
    got = {r.feature: (r.status, r.blockers) for r in found.collect()}
    opening = "; a verified access point needs a directly observed physical opening"
    loose = [f"EXISTENCE cites source {s} whose exact bytes are not registered" for s in ("s2", "s9")]
    assert got[1] == ("CANDIDATE", ["evidence reaches FEATURE" + opening, *loose])
    assert got[None] == ("PROVISIONAL_DISCOVERY", ["evidence reaches ANOMALY" + opening, "no observation carries source-backed coordinates"])
    plan = R.permitted(features, a, cites, seen, sources, "maker")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(feature") == 1 and "ShuffledHashJoin" in plan
