"""Queries over what a reviewer sees: promotion, adjudication, pairs of scenes and routes, counts by place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import review as R
from ..sources.tables import table
from .common import POINTS, points, site_sql, sites
from .surfaces import _STATES, _WORTH, _worth

SQL: dict[str, str] = {}


def _of(values, k):
    return F.element_at(F.array(*map(F.lit, values)), (k % len(values) + 1).cast("int"))


def promotion(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as features, their lines as assertions that cite suppliers, and as citations of parts, the observations."""
    k = F.col("assertion")
    a = _worth(spark, sf).withColumns({"adjudication": F.when(k % 3 != 0, "ACCEPTED").otherwise("PENDING"), "adjudicator": F.when(k % 7 == 0, None).when(k % 5 == 0, "producer ").otherwise("reviewer")})
    cites = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("feature"), F.col("l_partkey").alias("observation"))
    seen = table(spark, sf, "part").where("p_partkey % 9 <> 0").select(F.col("p_partkey").alias("observation"), (F.col("p_partkey") % 50).alias("source"), (F.col("p_size") % 3 == 0).alias("located"))
    sources = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("source"), _of(_STATES, F.col("s_suppkey")).alias("provenance"))
    got = R.permitted(table(spark, sf, "orders").select(F.col("o_orderkey").alias("feature")), a, cites, seen, sources, "producer")
    return got.select("feature", "status", F.size("blockers").cast("long").alias("n_blockers"), F.array_join("blockers", "; ").alias("blockers"))


def _dimension_sql(d: str) -> str:
    return f"""CASE WHEN coalesce(h.has_{d},false) AND NOT h.own_{d} THEN ['{d} has no assertion accepted by a reviewer independent of the producer'] ELSE [] END || coalesce(l.loose_{d}, [])"""


_DIMS = ("EXISTENCE", "PHYSICAL_OPENING")
# Numbers of assertions may repeat, so the source is taken along and not joined again.
_CITING = _WORTH.replace("l_partkey AS p,", "l_partkey AS p, l_suppkey AS source,", 1)
SQL["promotion"] = f"""WITH {_CITING}, t AS (SELECT feature, dimension, max(r) AS r FROM worth GROUP BY 1, 2),
 g AS (SELECT feature, coalesce(bool_or(dimension='EXISTENCE' AND r IN (2,3)),false) AS a, coalesce(bool_or(dimension='PHYSICAL_OPENING' AND r=3),false) AS b, coalesce(bool_or(dimension='ACCESSIBILITY' AND r=3),false) AS c,
 coalesce(bool_or(dimension='CONNECTIVITY' AND r=3),false) AS d, string_agg(dimension, ', ' ORDER BY dimension) FILTER (r=4) AS contradicted FROM t GROUP BY 1),
 w AS (SELECT *, r IN (2,3) AS carrying, assertion%3<>0 AND assertion%7<>0 AND assertion%5<>0 AS own FROM worth),
 h AS (SELECT feature, {", ".join(f"bool_or(carrying AND dimension='{d}') AS has_{d}, bool_or(carrying AND dimension='{d}' AND own) AS own_{d}" for d in _DIMS)} FROM w GROUP BY 1),
 c AS (SELECT feature, dimension, carrying, source FROM w UNION ALL SELECT feature, dimension, carrying, -1 FROM w WHERE p%13=0),
 st AS (SELECT s_suppkey AS source, {_STATES}[s_suppkey%4+1] AS state FROM supplier),
 l AS (SELECT feature, {", ".join(f"list_sort(list(DISTINCT '{d} cites source ' || source || ' whose exact bytes are not registered') FILTER (carrying AND dimension='{d}' AND coalesce(state,'') <> 'REGISTERED')) AS loose_{d}" for d in _DIMS)} FROM c LEFT JOIN st USING (source) GROUP BY 1),
 o AS (SELECT l_orderkey AS feature, p_partkey IS NULL AS lost, p_partkey%50 AS source, coalesce(p_size%3=0,false) AS located FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_partkey%9<>0) ON l_partkey=p_partkey),
 og AS (SELECT feature, bool_or(lost) AS lost, bool_or(located) AS located FROM o GROUP BY 1),
 bk AS (SELECT feature, bool_or(state <> 'UNREGISTERED') AS backed FROM (SELECT feature, source FROM c UNION ALL SELECT feature, source FROM o WHERE source IS NOT NULL) JOIN st USING (source) GROUP BY 1),
 b AS (SELECT o_orderkey AS feature, coalesce(backed,false) AS backed, CASE WHEN coalesce(a AND b,false) THEN [] ELSE ['evidence reaches ' || CASE WHEN coalesce(a,false) THEN 'FEATURE' ELSE 'ANOMALY' END || '; a verified access point needs a directly observed physical opening'] END
 || CASE WHEN contradicted IS NULL THEN [] ELSE ['contradicted dimensions: ' || contradicted] END || CASE WHEN coalesce(lost,false) THEN ['feature cites observations the registry does not hold'] ELSE [] END
 || CASE WHEN coalesce(located,false) THEN [] ELSE ['no observation carries source-backed coordinates'] END || {" || ".join(_dimension_sql(d) for d in _DIMS)} AS bl
 FROM orders LEFT JOIN g ON g.feature=o_orderkey LEFT JOIN h ON h.feature=o_orderkey LEFT JOIN l ON l.feature=o_orderkey LEFT JOIN og ON og.feature=o_orderkey LEFT JOIN bk ON bk.feature=o_orderkey)
 SELECT feature, CASE WHEN NOT backed THEN 'PROVISIONAL_DISCOVERY' WHEN len(bl)=0 THEN 'VERIFIED' ELSE 'CANDIDATE' END AS status, len(bl)::BIGINT AS n_blockers, array_to_string(bl, '; ') AS blockers FROM b"""

#: The area that adjudication is about.
AREA = (-66.8, 18.0, -66.0, 18.4)
_TIERS = ("SUPPORTING", "DIRECT", "CANDIDATE", "UNRESOLVED")
_SAID = ("survey", "NAME_ONLY", "proximity_only", "record")


def adjudication(spark: SparkSession, sf: str) -> DataFrame:
    """Events as features: points, boxes, boxes that are no boxes, and some without a place."""
    k = F.col("point_id")
    wide = F.when(k % 4 == 0, 0.0).when(k % 4 == 3, -0.01).otherwise(0.1)
    r = points(spark, sf).select(k.alias("record"), _of(_TIERS, k).alias("tier"), F.array(_of(_SAID, F.col("alt_ft"))).alias("bases"), F.when(k % 17 != 0, F.col("lon")).alias("x0"), F.col("lat").alias("y0"), (F.col("lon") + wide).alias("x1"), (F.col("lat") + wide).alias("y1"))
    return R.adjudicated(r, AREA).select("record", "state", "evidence_tier", "certification", F.round("distance", 6).alias("distance"))


_A = dict(zip(("ax0", "ay0", "ax1", "ay1"), (f"({v}::DOUBLE)" for v in AREA), strict=True))
SQL["adjudication"] = """WITH {pts}, r AS (SELECT point_id AS record, {tiers}[point_id%4+1] AS tier, {said}[alt_ft%4+1] AS basis, CASE WHEN point_id%17<>0 THEN lon END AS x0, lat AS y0, point_id%4=0 AS pt,
 CASE point_id%4 WHEN 0 THEN 0.0::DOUBLE WHEN 3 THEN -0.01::DOUBLE ELSE 0.1::DOUBLE END AS w, lon+w AS x1, lat+w AS y1 FROM pts),
 s AS (SELECT *, CASE WHEN x0 IS NULL THEN 'NULL_EMPTY' WHEN w < 0 THEN 'UNRESOLVED' WHEN pt AND x0>{ax0} AND x0<{ax1} AND y0>{ay0} AND y0<{ay1} THEN 'FULLY_WITHIN'
 WHEN NOT pt AND x0>={ax0} AND x1<={ax1} AND y0>={ay0} AND y1<={ay1} THEN 'FULLY_WITHIN' WHEN NOT pt AND x0<{ax1} AND x1>{ax0} AND y0<{ay1} AND y1>{ay0} THEN 'PARTIAL'
 WHEN x0<={ax1} AND x1>={ax0} AND y0<={ay1} AND y1>={ay0} THEN 'TOUCH_ONLY' ELSE 'OUTSIDE' END AS state, greatest(0.0::DOUBLE, {ax0}-x1, x0-{ax1}) AS dx, greatest(0.0::DOUBLE, {ay0}-y1, y0-{ay1}) AS dy FROM r),
 e AS (SELECT *, CASE WHEN state IN ('NULL_EMPTY','UNRESOLVED') THEN 'UNRESOLVED' WHEN tier IN ('SUPPORTING','DIRECT') AND lower(basis) IN ('name_only','proximity_only') THEN 'CANDIDATE' ELSE tier END AS evidence_tier FROM s)
 SELECT record, state, evidence_tier, CASE evidence_tier WHEN 'CANDIDATE' THEN 'CANDIDATE_NOT_IDENTITY' WHEN 'UNRESOLVED' THEN 'UNRESOLVED' ELSE 'PROVISIONAL' END AS certification,
 CASE WHEN x0 IS NOT NULL THEN round(sqrt(dx*dx+dy*dy),6) END AS distance FROM e""".format(pts=POINTS, tiers=list(_TIERS), said=list(_SAID), **_A)

_FLAGS = ("SEAM_OVERLAP", "MOSTLY_INTERPOLATED", "PARTLY_INTERPOLATED", "ADJOINS_EDGE", "NESTED")


def depression_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as depressions."""
    k, z = F.col("p_partkey"), F.col("p_size").cast("double")
    flags = F.array_compact(F.array(*(F.when(k % (i + 3) == 0, f) for i, f in enumerate(_FLAGS))))
    score = R.depression_score(F.when(k % 5 != 0, z / 4.0), z / 100.0, (k % 11) / 11.0, F.when(k % 6 != 0, z), k % 6 == 0, flags)
    return table(spark, sf, "part").select(k.alias("id"), R.shape_tier(flags).alias("tier"), score.alias("score"), R.confidence_band(score).alias("band"))


_S = "35.0::DOUBLE*CASE WHEN k%5<>0 THEN least(z/4.0::DOUBLE/10.0::DOUBLE,1.0::DOUBLE) ELSE 0.0::DOUBLE END + 25.0::DOUBLE*least(z/100.0::DOUBLE/0.3::DOUBLE,1.0::DOUBLE) + 15.0::DOUBLE*(k%11/11.0::DOUBLE) + CASE WHEN k%6<>0 THEN 10.0::DOUBLE*least(z/35.0::DOUBLE,1.0::DOUBLE)+15.0::DOUBLE ELSE 0.0::DOUBLE END"
SQL["depression_scores"] = f"""WITH p AS (SELECT p_partkey AS k, p_size::DOUBLE AS z FROM part),
 s AS (SELECT k, round(greatest(0.0::DOUBLE, least(100.0::DOUBLE, ({_S}) * CASE WHEN k%3=0 THEN 0.25::DOUBLE ELSE 1.0::DOUBLE END * CASE WHEN k%4=0 THEN 0.25::DOUBLE WHEN k%5=0 THEN 0.75::DOUBLE ELSE 1.0::DOUBLE END)),2) AS score FROM p)
 SELECT k AS id, CASE WHEN k%3=0 OR k%4=0 THEN 'CANDIDATE' ELSE 'SUPPORTING' END AS tier, score, CASE WHEN score>=85 THEN 'high_confidence_change' WHEN score>=70 THEN 'corroborated_change' WHEN score>=50 THEN 'supported_candidate' WHEN score>=30 THEN 'candidate' ELSE 'weak_signal' END AS band FROM s"""


def route_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of orders as pairs of route designations."""
    o, n, p = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    side = lambda k, m: F.struct(F.when(k % 7 != 0, "CANDIDATE").otherwise("MIXED").alias("classification"), F.lit("USPS").alias("system"), F.when(k % 11 != 0, (m % 2).cast("string")).otherwise(" ").alias("authority"), F.when(k % 13 != 0, "s").alias("source"), F.lit("RR").alias("route_type"), F.when(k % 3 != 0, m % 3).alias("route_number"))
    return table(spark, sf, "lineitem").select(o.alias("order"), n.cast("long").alias("line"), R.reconcile(side(o, p), side(p, n)).alias("state"))


def _side(k: str) -> str:
    return f"({k}%7<>0 AND {k}%11<>0 AND {k}%13<>0)"


_NUMBER = "(CASE WHEN l_orderkey%3<>0 THEN l_partkey%3 END) IS NOT DISTINCT FROM (CASE WHEN l_partkey%3<>0 THEN l_linenumber%3 END)"
SQL["route_reconciliation"] = f"""SELECT l_orderkey AS "order", l_linenumber::BIGINT AS line, CASE WHEN NOT ({_side("l_orderkey")} AND {_side("l_partkey")}) THEN 'UNRESOLVED'
 WHEN l_partkey%2 = l_linenumber%2 AND {_NUMBER} THEN 'REVIEW' ELSE 'CONTRADICTION' END AS state FROM lineitem"""


def place_density(spark: SparkSession, sf: str) -> DataFrame:
    """Customers by the name of their market segment, of which all but one are places; and the state of the whole, for every row."""
    c = table(spark, sf, "customer").select(F.when(F.col("c_custkey") % 10 != 0, F.col("c_mktsegment")).otherwise("").alias("name"))
    places = table(spark, sf, "customer").where("c_mktsegment <> 'MACHINERY'").select(F.col("c_mktsegment").alias("name"), F.concat(F.lit("G"), F.substring("c_mktsegment", 1, 2)).alias("geoid")).distinct()
    counted = R.density(c, places)
    # The state is one row.
    return counted.crossJoin(F.broadcast(R.density_state(counted).withColumnRenamed("matched", "matched_total")))


SQL["place_density"] = """WITH c AS (SELECT CASE WHEN c_custkey%10<>0 THEN c_mktsegment END AS name FROM customer),
 d AS (SELECT CASE WHEN name IS NULL THEN '__NULL__' WHEN name = 'MACHINERY' THEN name ELSE 'G' || substr(name,1,2) END AS key, name IS NOT NULL AND name <> 'MACHINERY' AS matched, count(*) AS n FROM c GROUP BY 1, 2),
 s AS (SELECT coalesce(sum(n),0)::BIGINT AS total, coalesce(sum(n) FILTER (matched),0)::BIGINT AS m FROM d)
 SELECT key, d.matched, n, total, m AS matched_total, total-m AS unmatched, CASE WHEN total > 0 AND m = 0 THEN 'UNRESOLVED' WHEN total > m THEN 'CANDIDATE_NOT_IDENTITY' ELSE 'PASS' END AS state FROM d, s"""


def compared_keys(spark: SparkSession, sf: str) -> DataFrame:
    return R.compared_keys(table(spark, sf, "orders").select(F.col("o_custkey").alias("key")), table(spark, sf, "customer").select((F.col("c_custkey") * 2).alias("key")))


SQL["compared_keys"] = """WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT DISTINCT c_custkey*2 AS k FROM customer), j AS (SELECT a.k IS NOT NULL AS x, b.k IS NOT NULL AS y FROM a FULL JOIN b ON a.k = b.k)
 SELECT count(*) FILTER (x AND y) AS "both", count(*) FILTER (x AND NOT y) AS left_only, count(*) FILTER (y AND NOT x) AS right_only, count(*) AS "any", count(*) FILTER (x <> y) AS one_only FROM j"""

_KINDS = ("NAME_SIMILARITY", "STABLE_SOURCE_ID", "PROXIMITY", "AUTHORITATIVE_LINEAGE", "SAME_CATEGORY")


def promotable_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of orders as edges from order to part."""
    p, n = F.col("l_partkey"), F.col("l_linenumber")
    return R.promotable(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", F.array(_of(_KINDS, p), _of(_KINDS, p + n)).alias("kinds"))).select(F.col("l_orderkey").alias("feature"), F.col("l_partkey").alias("other"))


SQL["promotable_edges"] = "SELECT l_orderkey AS feature, l_partkey AS other FROM lineitem WHERE l_partkey%5 IN (1,3) OR (l_partkey+l_linenumber)%5 IN (1,3)"


def scene_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as sites with a chip around each and two scenes that are shifted."""
    k, x, y = F.col("id"), F.col("lon"), F.col("lat")
    box = lambda dx, dy, r: (x + dx - r, y + dy - r, x + dx + r, y + dy + r)
    shift = (k % 40) / 1000.0
    before, after = F.when(k % 6 != 0, (k % 30).cast("double")), (k % 7 + 1).cast("double")
    signals = F.create_map(F.lit("EXPANSION"), (k % 10) / 10.0, F.lit("VEGETATION_LOSS"), (k % 9) / 9.0)
    kept = R.at_resolution(signals, before)
    return sites(spark, sf).select("id", F.round(R.covered_share(box(F.lit(0.0), F.lit(0.0), 0.01), box(shift, F.lit(0.0), 0.02), box(F.lit(0.0), shift, 0.02)), 6).alias("covered"), F.round(R.scale_ratio(before, after), 6).alias("scale"), F.array_join(F.array_sort(F.map_keys(kept)), ",").alias("shown"))


_SIDE = "greatest(0.0::DOUBLE, {0}+0.01::DOUBLE-greatest({0}-0.01::DOUBLE, {0}+s-0.02::DOUBLE))"
SQL["scene_overlap"] = f"""WITH {site_sql()}, p AS (SELECT id, lon, lat, id%40/1000.0::DOUBLE AS s, CASE WHEN id%6<>0 THEN (id%30)::DOUBLE END AS b, (id%7+1)::DOUBLE AS a FROM sites)
 SELECT id, round(least(1.0::DOUBLE, {_SIDE.format("lon")}*{_SIDE.format("lat")}/(((lon+0.01::DOUBLE)-(lon-0.01::DOUBLE))*((lat+0.01::DOUBLE)-(lat-0.01::DOUBLE)))),6) AS covered,
 round(CASE WHEN b IS NULL OR b = 0 THEN 0.5::DOUBLE ELSE least(a,b)/greatest(a,b) END,6) AS scale, CASE WHEN b <= {fixed.COARSE_ABOVE_M} THEN 'EXPANSION,VEGETATION_LOSS' ELSE 'EXPANSION' END AS shown FROM p"""


def candidate_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as candidates of four kinds and none, some without coordinates: what they lack and the confidence they bring."""
    k = F.col("id")
    kind = F.element_at(F.array(F.lit("poi"), F.lit("ilap"), F.lit("corridor"), F.lit("aasb_edge"), F.lit(None)), (k % 5 + 1).cast("int"))
    value = F.when(k % 3 != 0, (k % 97) / 97.0)
    lacks = R.field_errors(F.when(k % 7 != 0, F.col("lat")), F.when(k % 11 != 0, F.col("lon")), kind)
    return sites(spark, sf).select("id", F.array_join(lacks, "; ").alias("errors"), F.round(R.inherited_confidence(kind, value, value / 2.0, k % 8, value / 4.0), 6).alias("confidence"))


SQL["candidate_fields"] = f"""WITH {site_sql()}, v AS (SELECT id, CASE WHEN id%3<>0 THEN id%97/97.0::DOUBLE END AS v FROM sites)
 SELECT id, concat_ws('; ', CASE WHEN id%7=0 THEN 'None value for: _lat' END, CASE WHEN id%11=0 THEN 'None value for: _lon' END, CASE WHEN id%5=4 THEN 'Missing field: _candidate_type' END) AS errors,
 round(coalesce(CASE id%5 WHEN 0 THEN v WHEN 1 THEN v/2.0::DOUBLE WHEN 2 THEN least(1.0::DOUBLE, id%8/5.0::DOUBLE) WHEN 3 THEN v/4.0::DOUBLE END, 0.0::DOUBLE),6) AS confidence FROM v"""


def run_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """Parts by size: how many, and the sum of their keys, as two reports."""
    p = table(spark, sf, "part")
    report = lambda df, v: df.groupBy(F.col("p_size").cast("string").alias("metric")).agg(F.sum(v).cast("double").alias("value"))
    return R.run_deltas(report(p.where("p_size > 5"), F.lit(1)), report(p.where("p_size < 45"), "p_partkey"))


SQL["run_deltas"] = """WITH a AS (SELECT p_size::VARCHAR AS metric, count(*)::DOUBLE AS v FROM part WHERE p_size > 5 GROUP BY 1), b AS (SELECT p_size::VARCHAR AS metric, sum(p_partkey)::DOUBLE AS v FROM part WHERE p_size < 45 GROUP BY 1)
 SELECT metric, round(b.v-a.v,6) AS delta FROM a FULL JOIN b USING (metric)"""


def cell_accounting(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    return R.cell_accounting(table(spark, sf, "events").select(F.when(k % 5 == 0, None).when(k % 7 == 0, float("nan")).otherwise(k.cast("double")).alias("value"), F.when(k % 2 == 0, k % 3 == 0).alias("interpolated")))


SQL["cell_accounting"] = """WITH e AS (SELECT event_id%5<>0 AND event_id%7<>0 AS ok, event_id%6=0 AS i FROM events)
 SELECT count(*) AS total, count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS no_data, count(*) FILTER (ok AND i) AS interpolated, count(*) FILTER (ok AND NOT i) AS measured FROM e"""

#: Conditions of routing in their order, each with the domains that it needs.
CONDITIONS = [("water and road", ("water", "road")), ("any coast", ("coast",)), ("road and power", ("road", "power"))]
_DOMAINS = ("water", "road", "coast", "power")


def met_conditions(spark: SparkSession, sf: str) -> DataFrame:
    """Parts with the domains whose divisor (2 to 5) their key has."""
    k = F.col("p_partkey")
    domains = F.array_compact(F.array(*(F.when(k % (i + 2) == 0, d) for i, d in enumerate(_DOMAINS))))
    return table(spark, sf, "part").select(k.alias("id"), R.first_met(domains, CONDITIONS).alias("condition"))


SQL["met_conditions"] = "SELECT p_partkey AS id, CASE WHEN p_partkey%6=0 THEN 'water and road' WHEN p_partkey%4=0 THEN 'any coast' WHEN p_partkey%15=0 THEN 'road and power' END AS condition FROM part"

QUERIES = {
    f.__name__: f
    for f in (
        promotion, adjudication, depression_scores, route_reconciliation, place_density, compared_keys,
        promotable_edges, scene_overlap, candidate_fields, run_deltas, cell_accounting, met_conditions,
    )
}
