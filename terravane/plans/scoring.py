"""Queries over scores of candidates, cells and flights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import scoring as S
from ..sources.tables import table
from .common import FLIGHTS, POINTS, flights, points

SQL: dict[str, str] = {}

_TILES = ("land", "coast", "water")


def candidate_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as candidates of review: their share of the highest price as score."""
    k = F.col("o_orderkey")
    c = table(spark, sf, "orders").select(k.alias("id"), ((k * 7 % 100) / 100.0).alias("max_score"), (k * 13 % 100).cast("double").alias("mean_risk"), (k % 30).alias("node_count"), F.element_at(F.array(*map(F.lit, _TILES)), (k % 3 + 1).cast("int")).alias("tile"))
    r = S.ranked(c)
    return r.select("id", "rank_score", "terrain_filtered", F.col("rank").cast("long").alias("rank"), F.round(S.in_context(F.col("max_score") * 1.5, F.col("tile")), 6).alias("context_score"), F.round(S.seam_in_context(F.col("max_score"), F.col("tile"), F.col("node_count") < 5), 6).alias("seam_score"))


SQL["candidate_ranks"] = """WITH c AS (SELECT o_orderkey AS id, (o_orderkey*7%100)/100.0::DOUBLE AS s, (o_orderkey*13%100)::DOUBLE AS r, o_orderkey%30 AS n, ['land','coast','water'][o_orderkey%3+1] AS tile FROM orders),
 f AS (SELECT *, round(0.5::DOUBLE*s + 0.3::DOUBLE*(r/100.0::DOUBLE) + 0.2::DOUBLE*least(n/20.0::DOUBLE, 1.0::DOUBLE), 4) AS raw FROM c WHERE s >= 0.3 AND n >= 1),
 g AS (SELECT *, CASE WHEN tile = 'water' THEN round(raw*0.5::DOUBLE, 4) ELSE raw END AS rank_score, CASE tile WHEN 'water' THEN 0.6::DOUBLE WHEN 'coast' THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END AS w FROM f)
 SELECT id, rank_score, tile = 'water' AS terrain_filtered, row_number() OVER (ORDER BY rank_score DESC, id) AS rank, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, s*1.5::DOUBLE*w)),6) AS context_score,
 round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, s*w)) * CASE WHEN n < 5 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END,6) AS seam_score FROM g"""


def top_score_ties(spark: SparkSession, sf: str) -> DataFrame:
    return S.top_ties(table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") > 3, F.col("p_size").cast("double")).alias("score"))).select("id", "score", "tied")


SQL["top_score_ties"] = """WITH r AS (SELECT p_partkey AS id, CASE WHEN p_size > 3 THEN p_size::DOUBLE END AS score FROM part), m AS (SELECT max(score) AS top FROM r), t AS (SELECT count(DISTINCT id) > 1 AS many FROM r, m WHERE score = top)
 SELECT id, score, coalesce(score = top AND many, false) AS tied FROM r, m, t"""

_KINDS = ("cave", "groundwater", "mine", "industrial", "utility", "history", "other")


def relevance_zones(spark: SparkSession, sf: str) -> DataFrame:
    """Events as evidence in cells of a fiftieth of a degree."""
    k = F.col("event_id")
    e = points(spark, sf).select(F.col("point_id").alias("event_id"), "lon", "lat").select("lon", "lat", F.element_at(F.array(*map(F.lit, _KINDS)), (k * k % 7 + 1).cast("int")).alias("kind"), (k % 5).alias("source"), (k % 97 == 0).alias("opening"))
    return S.zones(e, -3365, 895, 90, 35).select("col", "row", "cave", "groundwater", "mine", "industrial", "utility", "history", "n_sources", "openings", "score", "relevance", "tier")


_HITS = f"""{POINTS}, e AS (SELECT lon/0.02::DOUBLE AS x, lat/0.02::DOUBLE AS y, ['{"','".join(_KINDS)}'][point_id*point_id%7+1] AS kind, point_id%5 AS source, point_id%97=0 AS opening FROM pts),
 h AS (SELECT CAST(floor(x) AS BIGINT)+3365-i AS col, CAST(floor(y) AS BIGINT)-895-j AS row, kind, source, opening FROM e, range(0,2) a(i), range(0,2) b(j) WHERE kind <> 'other' AND (i = 0 OR x = floor(x)) AND (j = 0 OR y = floor(y)))"""
SQL["relevance_zones"] = f"""WITH {_HITS}, n AS (SELECT col, row, {", ".join(f"count(*) FILTER (kind = '{k}') AS {k}" for k in _KINDS[:6])}, count(DISTINCT source) AS n_sources, count(*) FILTER (opening) AS openings FROM h GROUP BY 1, 2),
 z AS (SELECT c.i AS col, r.i AS row, {", ".join(f"coalesce({k},0) AS {k}" for k in (*_KINDS[:6], "n_sources", "openings"))} FROM range(0,90) c(i) CROSS JOIN range(0,35) r(i) LEFT JOIN n ON n.col = c.i AND n.row = r.i),
 s AS (SELECT *, round(least(10.0::DOUBLE, least(3.0::DOUBLE, cave*3.0::DOUBLE) + least(2.5::DOUBLE, ln(1+groundwater)*0.75::DOUBLE) + least(2.0::DOUBLE, ln(1+mine)*0.9::DOUBLE) + least(0.75::DOUBLE, ln(1+industrial)*0.25::DOUBLE)
 + least(0.5::DOUBLE, ln(1+utility)*0.08::DOUBLE) + least(0.25::DOUBLE, ln(1+history)*0.05::DOUBLE) + CASE WHEN n_sources >= 3 THEN least(1.0::DOUBLE, (n_sources-2)*0.15::DOUBLE) ELSE 0.0::DOUBLE END), 3) AS score FROM z)
 SELECT *, CASE WHEN score >= 7.0 THEN 'HIGH' WHEN score >= 4.0 THEN 'MODERATE' WHEN score >= 1.5 THEN 'LOW' ELSE 'VERY_LOW' END AS relevance,
 CASE WHEN cave > 0 OR openings > 0 THEN 'DIRECT' WHEN score >= 4.0 AND n_sources >= 3 THEN 'SUPPORTING' WHEN score > 0 THEN 'CANDIDATE' ELSE 'UNRESOLVED' END AS tier FROM s"""


def aircraft_activity(spark: SparkSession, sf: str) -> DataFrame:
    return S.activity(flights(spark, sf))


SQL["aircraft_activity"] = f"""WITH {FLIGHTS} SELECT callsign, count(*) AS total_flights, min(takeoff) AS first_seen, max(takeoff) AS last_seen FROM flights WHERE callsign <> '' GROUP BY callsign"""

#: Example profiles: name, altitudes, speeds, minutes, shares of hover, corridor and search, kinds of features, hours, operators.
PROFILES = [
    ("survey", 500, 2500, 60, 120, 30, 180, 0.1, 0.9, 0.1, ["RAIL", "TRUCK"], "daytime", ["N1"]),
    ("rescue", 100, 1500, 20, 140, 60, 300, 0.6, 0.2, 0.9, ["SHIP"], "24/7", ["N7", "N99"]),
    ("transit", 3000, 9000, 100, 200, 20, 120, 0.0, 0.8, 0.0, ["AIR", "MAIL"], "any", ["N42"]),
]
_MODES = ("RAIL", "TRUCK", "SHIP", "AIR", "MAIL")
_PROFILE = "profile string, alt_low int, alt_high int, speed_low int, speed_high int, min_low int, min_high int, hover_share double, corridor_share double, search_share double, near_types array<string>, hours string, operators array<string>"


def mission_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as flights near what their lines name, against three example profiles; the mission is that of the history."""
    lines = table(spark, sf, "lineitem")
    near = lines.select(F.col("l_orderkey").alias("flight_id"), F.element_at(F.array(*map(F.lit, _MODES)), (F.col("l_linenumber") % 5 + 1).cast("int")).alias("type"), (F.col("l_quantity").cast("double") / 5.0).alias("distance_nm"))
    corridors = lines.where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("flight_id")).agg(F.count(F.lit(1)).alias("n_corridors"))
    f = flights(spark, sf).join(corridors, "flight_id", "left")
    k = F.col("flight_id")
    f = f.select("flight_id", "callsign", F.lit("").alias("operator"), (500 + k * 97 % 9000).alias("max_alt"), (k * 13 % 200).alias("avg_speed"), "minutes", F.timestamp_add("MINUTE", (F.col("price") % 1440).cast("int"), F.col("takeoff").cast("timestamp_ntz")).alias("takeoff"), F.coalesce("n_corridors", F.lit(0)).alias("n_corridors"), "mission")
    name = F.element_at(F.array(*(F.lit(p[0]) for p in PROFILES)), (F.substring("mission", 1, 1).cast("int") % 3 + 1))
    return S.profile_scores(f, points(spark, sf), near, f.select("callsign", name.alias("profile")), spark.createDataFrame(PROFILES, _PROFILE)).withColumn("rank", F.col("rank").cast("long"))


def _fall(x: str, low: str, high: str, below: int, above: int) -> str:
    return f"CASE WHEN {x} BETWEEN {low} AND {high} THEN 1.0::DOUBLE WHEN {x} < {low} THEN greatest(0.0::DOUBLE, 1.0::DOUBLE-({low}-{x})/{below}.0::DOUBLE) ELSE greatest(0.0::DOUBLE, 1.0::DOUBLE-({x}-{high})/{above}.0::DOUBLE) END"


_ROWS = ", ".join("(" + ", ".join(repr(x) for x in p) + ")" for p in PROFILES)
SQL["mission_scores"] = f"""WITH {FLIGHTS}, {POINTS}, p(profile, a0, a1, s0, s1, m0, m1, hv, co, se, near_types, hours, ops) AS (VALUES {_ROWS}),
 n AS (SELECT l_orderkey AS flight_id, ['{"','".join(_MODES)}'][l_linenumber%5+1] AS type, min(l_quantity::DOUBLE/5.0::DOUBLE) AS d FROM lineitem GROUP BY 1, 2), co AS (SELECT l_orderkey AS flight_id, count(*) AS n_co FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
 hv AS (SELECT flight_id, avg(CASE WHEN speed_mph < 20 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS h FROM pts GROUP BY 1),
 f AS (SELECT flight_id, callsign, 500 + flight_id*97%9000 AS alt, flight_id*13%200 AS speed, minutes, hour(CAST(takeoff AS TIMESTAMP) + to_minutes(price%1440)) AS hr, ['{"','".join(p[0] for p in PROFILES)}'][CAST(substr(mission,1,1) AS INT)%3+1] AS flown, coalesce(n_co,0) AS n_co, coalesce(h,0.0::DOUBLE) AS h
 FROM flights LEFT JOIN co USING (flight_id) LEFT JOIN hv USING (flight_id)),
 hist AS (SELECT callsign, flown AS profile, count(*) AS c FROM f GROUP BY 1, 2),
 nr AS (SELECT flight_id, profile, min(d) AS d FROM n JOIN p ON list_contains(near_types, type) GROUP BY 1, 2),
 s AS (SELECT f.flight_id, p.profile, round((CASE WHEN co > 0.7 AND n_co > 0 THEN 0.9::DOUBLE WHEN se > 0.7 AND n_co = 0 THEN 0.8::DOUBLE ELSE 0.4::DOUBLE END)*0.2::DOUBLE + coalesce(greatest(0.0::DOUBLE, 1.0::DOUBLE-nr.d/10.0::DOUBLE), 0.0::DOUBLE)*0.18::DOUBLE
 + ({_fall("alt", "a0", "a1", 2000, 3000)})*0.15::DOUBLE + (CASE WHEN abs(h-hv) < 0.2 THEN 0.9::DOUBLE WHEN abs(h-hv) < 0.4 THEN 0.6::DOUBLE ELSE 0.2::DOUBLE END)*0.12::DOUBLE
 + (CASE WHEN len(list_filter(ops, lambda o: contains(f.callsign, o))) > 0 THEN 1.0::DOUBLE ELSE 0.3::DOUBLE END)*0.1::DOUBLE + least(1.0::DOUBLE, coalesce(c,0)/10.0::DOUBLE)*0.08::DOUBLE
 + (CASE hours WHEN '24/7' THEN 0.8::DOUBLE WHEN 'daytime' THEN CASE WHEN hr BETWEEN 7 AND 18 THEN 1.0::DOUBLE WHEN hr BETWEEN 6 AND 20 THEN 0.6::DOUBLE ELSE 0.1::DOUBLE END ELSE 0.5::DOUBLE END)*0.08::DOUBLE
 + ({_fall("speed", "s0", "s1", 50, 50)})*0.06::DOUBLE + ({_fall("minutes", "m0", "m1", 60, 120)})*0.03::DOUBLE, 6) AS score
 FROM f CROSS JOIN p LEFT JOIN nr ON nr.flight_id = f.flight_id AND nr.profile = p.profile LEFT JOIN hist ON hist.callsign = f.callsign AND hist.profile = p.profile)
 SELECT *, CASE WHEN score >= 0.75 THEN 'HIGH' WHEN score >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END AS confidence, row_number() OVER (PARTITION BY flight_id ORDER BY score DESC, profile) AS rank FROM s"""

QUERIES = {f.__name__: f for f in (candidate_ranks, top_score_ties, relevance_zones, aircraft_activity, mission_scores)}
