"""Queries over tracks, flights and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import alerts as A
from ..operators import tracks as T
from .common import ALERTS, FLIGHTS, POINTS, alerts, flights, hav_sql, points, rounded

SQL: dict[str, str] = {}

_NM = hav_sql("plon", "plat", "lon", "lat", geo.EARTH_NM)


def _pairs_sql(order: str) -> str:
    return f"""WITH {POINTS}, p AS (SELECT *, lag(ts) OVER w AS pts, lag(lon) OVER w AS plon, lag(lat) OVER w AS plat, lag(alt_ft) OVER w AS palt,
 row_number() OVER w - 1 AS idx FROM pts WINDOW w AS (PARTITION BY flight_id ORDER BY {order})),
 d AS (SELECT *, CAST(epoch_us(ts) - epoch_us(pts) AS DOUBLE)/3.6e9*3600.0 AS dt FROM p WHERE idx > 0)"""


def _checks_sql(order: str) -> str:
    return f"""{_pairs_sql(order)}, c AS (
 SELECT flight_id, 'monotonic_time' AS check_type FROM d WHERE dt < 0 UNION ALL
 SELECT flight_id, 'speed' FROM d WHERE dt > 0 AND lat<>0 AND lon<>0 AND plat<>0 AND plon<>0 AND {_NM}*1.15078/(dt/3600.0) > 180.0 UNION ALL
 SELECT flight_id, 'climb_rate' FROM d WHERE dt > 0 AND alt_ft<>0 AND palt<>0 AND abs(alt_ft-palt)/(dt/60.0) > 1500.0)
 SELECT flight_id, check_type, count(*) AS n_failed FROM c GROUP BY ALL"""


def track_violations(spark: SparkSession, sf: str) -> DataFrame:
    return T.violations(points(spark, sf))


SQL["track_violations"] = _checks_sql("ts, point_id")


def track_violations_by_arrival(spark: SparkSession, sf: str) -> DataFrame:
    """The same checks in the order of arrival, where clocks run backward."""
    checks = T.validate(points(spark, sf), Window.partitionBy("flight_id").orderBy("point_id"))
    return checks.where(~F.col("passed")).groupBy("flight_id", "check_type").agg(F.count(F.lit(1)).alias("n_failed"))


SQL["track_violations_by_arrival"] = _checks_sql("point_id")


def track_segments(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(T.segments(points(spark, sf)), "horizontal_m", "vertical_m", "slant_m", "speed_m_s", places=4).withColumn("elapsed_s", F.round("elapsed_s", 6)).withColumn("idx", F.col("idx").cast("long"))


_H = hav_sql("plon", "plat", "lon", "lat", geo.EARTH_M)
SQL["track_segments"] = f"""{_pairs_sql("ts, point_id")}, s AS (SELECT flight_id, idx, {_H} AS h, (alt_ft-palt)*0.3048::DOUBLE AS v, dt FROM d)
 SELECT flight_id, idx, round(h,4) AS horizontal_m, round(v,4) AS vertical_m, round(sqrt(h*h+v*v),4) AS slant_m, round(dt,6) AS elapsed_s,
 CASE WHEN dt > 0 THEN round(sqrt(h*h+v*v)/dt,4) END AS speed_m_s FROM s"""


def track_shape(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(T.shape(points(spark, sf)), "linearity", "coverage", "hover_share")


SQL["track_shape"] = f"""WITH {POINTS}, s AS (SELECT *, {hav_sql("lag(lon) OVER w", "lag(lat) OVER w", "lon", "lat", geo.EARTH_NM)} AS step FROM pts WINDOW w AS (PARTITION BY flight_id ORDER BY ts, point_id)),
 g AS (SELECT flight_id, count(*) AS n_points, sum(step) AS t, arg_min(lon,(ts,point_id)) AS alon, arg_min(lat,(ts,point_id)) AS alat, arg_max(lon,(ts,point_id)) AS blon,
 arg_max(lat,(ts,point_id)) AS blat, max(lat)-min(lat) AS dy, max(lon)-min(lon) AS dx, avg(CASE WHEN speed_mph <> 0 AND speed_mph < 20 THEN 1.0 ELSE 0.0 END) AS hover FROM s GROUP BY flight_id)
 SELECT flight_id, n_points, CASE WHEN n_points < 2 OR coalesce(t,0) <= 0 THEN 0.0::DOUBLE ELSE round(least(1.0, {hav_sql("alon", "alat", "blon", "blat", geo.EARTH_NM)}/t),6) END AS linearity,
 round(least(1.0, dy*dx/(0.75::DOUBLE*0.65)),6) AS coverage, round(hover,6) AS hover_share FROM g"""


def markov_transitions(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(T.transitions(flights(spark, sf)), "probability")


SQL["markov_transitions"] = f"""WITH {FLIGHTS}, l AS (SELECT *, lag(mission) OVER (PARTITION BY callsign ORDER BY takeoff, flight_id) AS last FROM flights),
 s AS (SELECT callsign || '|' || CAST(hour(takeoff)//3 AS VARCHAR) || '|' || CAST(isodow(takeoff)-1 AS VARCHAR) || '|' || last AS state_key, mission AS next_mission, count(*) AS n
 FROM l WHERE last IS NOT NULL GROUP BY ALL)
 SELECT state_key, next_mission, n, round(CAST(n AS DOUBLE)/sum(n) OVER (PARTITION BY state_key),6) AS probability FROM s"""


def heatmap(spark: SparkSession, sf: str) -> DataFrame:
    return T.heatmap(points(spark, sf))


_HEAT = f"""WITH {POINTS}, h AS (SELECT CAST(round_even(lat/0.1,0) AS BIGINT) AS lat_cell, CAST(round_even(lon/0.1,0) AS BIGINT) AS lon_cell, count(*) AS n_points FROM pts GROUP BY ALL)"""
SQL["heatmap"] = f"""{_HEAT} SELECT lat_cell, lon_cell, n_points, least(1.0::DOUBLE, n_points/10.0::DOUBLE) AS intensity,
 CASE WHEN n_points/10.0 > 0.7 THEN 'red' WHEN n_points/10.0 > 0.4 THEN 'orange' ELSE 'yellow' END AS colour FROM h"""


def density_stats(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(T.density(T.heatmap(points(spark, sf))), "mean")


SQL["density_stats"] = f"""{_HEAT}, t AS (SELECT * FROM h ORDER BY n_points DESC, lat_cell, lon_cell LIMIT 1), a AS (SELECT count(*) AS n_cells, max(n_points) AS most, min(n_points) AS least, round(avg(n_points),6) AS mean FROM h)
 SELECT n_cells, most, least, mean, lat_cell, lon_cell FROM a, t"""


def revisit_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(T.gaps(points(spark, sf).withColumnRenamed("flight_id", "site")), "min_days", "median_days", "max_days")


SQL["revisit_gaps"] = f"""WITH {POINTS}, g AS (SELECT flight_id AS site, CAST(epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY flight_id ORDER BY ts)) AS DOUBLE)/3.6e9/24.0 AS gap FROM pts)
 SELECT site, count(*) AS n_gaps, round(min(gap),6) AS min_days, round(quantile_cont(gap,0.5),6) AS median_days, round(max(gap),6) AS max_days FROM g WHERE gap IS NOT NULL GROUP BY site"""


def consensus_vote(spark: SparkSession, sf: str) -> DataFrame:
    from ..sources.tables import table

    frames = table(spark, sf, "events").select(F.col("user_id").alias("callsign"), "event_type", (F.col("event_id") % 7).alias("band"), ((F.col("event_id") % 100) / 100.0).alias("confidence"))
    return rounded(T.consensus(frames, ["event_type", "band"]), "agreement")


SQL["consensus_vote"] = """WITH f AS (SELECT user_id AS callsign, event_type, event_id%7 AS band, (event_id%100)/100.0::DOUBLE AS confidence FROM events),
 e AS (SELECT callsign, confidence, 'event_type' AS field, event_type AS value FROM f UNION ALL SELECT callsign, confidence, 'band', CAST(band AS VARCHAR) FROM f),
 v AS (SELECT callsign, field, value, count(*) AS n_votes, avg(confidence) AS m FROM e WHERE value <> '' GROUP BY ALL),
 r AS (SELECT *, row_number() OVER (PARTITION BY callsign, field ORDER BY n_votes DESC, m DESC, value) AS r, sum(n_votes) OVER (PARTITION BY callsign, field) AS t FROM v)
 SELECT callsign, field, value, n_votes, round(CAST(n_votes AS DOUBLE)/t,6) AS agreement FROM r WHERE r = 1"""


def track_hypotheses(spark: SparkSession, sf: str) -> DataFrame:
    """Stateful, so without SQL; tests/test_operators.py holds it against a plain loop."""
    return T.hypotheses(points(spark, sf).withColumn("arrival", F.col("point_id")))


def alert_rules(spark: SparkSession, sf: str) -> DataFrame:
    f = flights(spark, sf)
    failed = T.violations(points(spark, sf)).groupBy("flight_id").agg(F.sum("n_failed").alias("n_failed"))
    near = points(spark, sf).groupBy("flight_id").agg(F.count_if(F.col("speed_mph") < 2).alias("n_restricted"), F.min(F.col("alt_ft") / 1000.0).alias("min_nm"))
    return A.evaluate(f, failed, near, ["N1", "N22"], ["N3"])


SQL["alert_rules"] = f"""WITH {FLIGHTS}, failed AS (SELECT flight_id, sum(n_failed) AS n_failed FROM ({SQL["track_violations"]}) GROUP BY 1), {POINTS},
 near AS (SELECT flight_id, count(*) FILTER (speed_mph < 2) AS nr, min(alt_ft/1000.0) AS nm FROM pts GROUP BY 1),
 f AS (SELECT x.*, count(*) OVER (PARTITION BY callsign) AS nf, coalesce(n_failed,0) AS bad, coalesce(nr,0) AS nr, coalesce(nm,99.0) AS nm FROM flights x LEFT JOIN failed USING (flight_id) LEFT JOIN near USING (flight_id))
 SELECT flight_id, callsign, prefix || '_' || CAST(flight_id AS VARCHAR) AS alert_id, category, severity FROM (
 SELECT flight_id, callsign, 'RESTR' AS prefix, 'RESTRICTED_AIRSPACE' AS category, 'HIGH' AS severity FROM f WHERE nr > 0 UNION ALL
 SELECT flight_id, callsign, 'UNKN', 'UNKNOWN_AIRCRAFT', 'MEDIUM' FROM f WHERE NOT (contains(callsign,'N1') OR contains(callsign,'N22')) UNION ALL
 SELECT flight_id, callsign, 'NIGHT', 'NIGHT_OPERATION', 'LOW' FROM f WHERE contains(callsign,'N3') AND NOT hour(takeoff) BETWEEN 7 AND 19 UNION ALL
 SELECT flight_id, callsign, 'EXTD', 'EXTENDED_OPERATION', 'MEDIUM' FROM f WHERE minutes > 360 UNION ALL
 SELECT flight_id, callsign, 'INFRA', 'INFRASTRUCTURE_PROX', 'MEDIUM' FROM f WHERE nm < 1.0 UNION ALL
 SELECT flight_id, callsign, 'PHYS', 'TEMPORAL_ANOMALY', 'LOW' FROM f WHERE bad > 0 UNION ALL
 SELECT flight_id, callsign, 'NEW', 'NEW_AIRCRAFT', 'INFO' FROM f WHERE nf <= 1)"""


def active_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return A.active(alerts(spark, sf)).select("alert_id", "callsign", "severity")


_RANK = "CASE severity WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 3 ELSE 4 END"
SQL["active_alerts"] = f"WITH {ALERTS} SELECT alert_id, callsign, severity FROM alerts WHERE NOT acknowledged AND NOT resolved ORDER BY {_RANK}, ts DESC, alert_id LIMIT 50"


def alert_dedup_24h(spark: SparkSession, sf: str) -> DataFrame:
    return A.without_repeats(alerts(spark, sf)).select("alert_id", "callsign", "category")


SQL["alert_dedup_24h"] = f"""WITH {ALERTS} SELECT alert_id, callsign, category FROM alerts QUALIFY coalesce(ts - lag(ts) OVER (PARTITION BY callsign, category ORDER BY ts, alert_id) > INTERVAL 24 HOURS, true)"""


def alert_stats(spark: SparkSession, sf: str) -> DataFrame:
    return A.stats(alerts(spark, sf))


_ST = "count(*) AS n, count(*) FILTER (acknowledged) AS n_acknowledged, count(*) FILTER (resolved) AS n_resolved FROM alerts"
SQL["alert_stats"] = f"""WITH {ALERTS} SELECT 'total' AS kind, '' AS name, {_ST} UNION ALL SELECT 'severity', severity, {_ST} GROUP BY severity UNION ALL SELECT 'category', category, {_ST} GROUP BY category"""


def severity_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return A.by(alerts(spark, sf), "severity", F.lit("2024-01-15").cast("timestamp_ntz"))


SQL["severity_breakdown"] = f"WITH {ALERTS} SELECT severity, count(*) AS n FROM alerts WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY severity"


def top_callsigns(spark: SparkSession, sf: str) -> DataFrame:
    return A.top(alerts(spark, sf), "callsign", 10)


SQL["top_callsigns"] = f"WITH {ALERTS} SELECT callsign, count(*) AS n FROM alerts GROUP BY callsign ORDER BY n DESC, callsign LIMIT 10"


def _report(f: DataFrame, start: str, end: str) -> DataFrame:
    day = f.where((F.col("takeoff") >= F.lit(start).cast("timestamp_ntz")) & (F.col("takeoff") < F.lit(end).cast("timestamp_ntz")))
    return day.groupBy("callsign").agg(F.count(F.lit(1)).alias("n_flights"), F.sum("minutes").alias("minutes"), F.max("minutes").alias("longest"))


def daily_report(spark: SparkSession, sf: str) -> DataFrame:
    return _report(flights(spark, sf), "1996-03-01", "1996-03-02")


def weekly_report(spark: SparkSession, sf: str) -> DataFrame:
    return _report(flights(spark, sf), "1996-03-01", "1996-03-08")


for _name, _end in (("daily_report", "1996-03-02"), ("weekly_report", "1996-03-08")):
    SQL[_name] = f"""WITH {FLIGHTS} SELECT callsign, count(*) AS n_flights, CAST(sum(minutes) AS BIGINT) AS minutes, max(minutes) AS longest FROM flights
 WHERE takeoff >= TIMESTAMP '1996-03-01' AND takeoff < TIMESTAMP '{_end}' GROUP BY callsign"""


def profile_report(spark: SparkSession, sf: str) -> DataFrame:
    """Flights, first and last takeoff, mean minutes of each callsign."""
    f = flights(spark, sf)
    return f.groupBy("callsign").agg(F.count(F.lit(1)).alias("n_flights"), F.min("takeoff").alias("first_seen"), F.max("takeoff").alias("last_seen"), F.round(F.avg("minutes"), 6).alias("mean_minutes"), F.countDistinct("mission").alias("n_missions"))


SQL["profile_report"] = f"WITH {FLIGHTS} SELECT callsign, count(*) AS n_flights, min(takeoff) AS first_seen, max(takeoff) AS last_seen, round(avg(minutes),6) AS mean_minutes, count(DISTINCT mission) AS n_missions FROM flights GROUP BY callsign"

QUERIES = {
    f.__name__: f
    for f in (
        track_violations, track_violations_by_arrival, track_segments, track_shape, markov_transitions, heatmap, density_stats, revisit_gaps, consensus_vote, track_hypotheses,
        alert_rules, active_alerts, alert_dedup_24h, alert_stats, severity_breakdown, top_callsigns, daily_report, weekly_report, profile_report,
    )
}
