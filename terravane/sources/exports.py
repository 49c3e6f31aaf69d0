"""Exports of flights and what is known of them, each with fixed columns and the evidence that a row rests on.

An export is a list of columns with a type and a fallback; a column that the input lacks, or a null, gets the fallback. Rows
of a flight carry its first image (the least screenshot_id), found by one aggregation, never by a walk over images.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sinks import line_json, write_package, write_parquet

Spec = dict[str, tuple[str, object]]

# Columns of the exports with their types and fallbacks.
_TEXT, _LONG, _REAL = ("string", ""), ("long", 0), ("double", 0.0)
PROVENANCE: Spec = {
    "screenshot_id": _TEXT, "source_path": _TEXT, "sha256": _TEXT, "ocr_confidence": _REAL, "coordinate_method": ("string", "fixed_pr_bounds"), "coordinate_confidence": ("double", 0.65), "review_status": ("string", "pending"),
}
EVENTS: Spec = {
    "flight_id": _TEXT, "callsign": _TEXT, "aircraft_type": _TEXT, "operator": _TEXT, "origin_airport": _TEXT, "destination_airport": _TEXT, "takeoff_time": _TEXT, "landing_time": _TEXT,
    "flight_duration_minutes": _LONG, "max_altitude_ft": _LONG, "avg_speed_mph": _REAL, "mission_type": _TEXT, "origin_lat": _REAL, "origin_lon": _REAL, "dest_lat": _REAL, "dest_lon": _REAL, "num_screenshots": _LONG,
}
PROFILES: Spec = {"callsign": _TEXT, "aircraft_type": _TEXT, "operator": _TEXT, "primary_mission": _TEXT, "confidence_level": _REAL, "last_seen": _TEXT, "flight_count": _LONG}
TRACK_POINTS: Spec = {"id": _LONG, "flight_id": _TEXT, "timestamp": _TEXT, "latitude": _REAL, "longitude": _REAL, "altitude_ft": _LONG, "ground_speed_mph": _LONG}
EVIDENCE: Spec = {
    "screenshot_id": _TEXT, "image_path": _TEXT, "flight_id": _TEXT, "processed_at": _TEXT, "callsign": _TEXT, "altitude_ft": _LONG, "ground_speed_mph": _LONG, "latitude": _REAL, "longitude": _REAL, "timestamp": _TEXT, "ocr_confidence": _REAL, "sha256": _TEXT,
    "coordinate_method": ("string", "fixed_pr_bounds"), "coordinate_confidence": ("double", 0.65), "estimated_error_m": ("double", 1500.0), "review_status": ("string", "pending"),
}
INFERENCES: Spec = {"flight_id": _TEXT, "mission_type": _TEXT, "total_score": _REAL, "confidence_level": _REAL, "signal_scores": _TEXT, "explanation": _TEXT, "scored_at": _TEXT}
ANOMALIES: Spec = {"alert_id": _TEXT, "flight_id": _TEXT, "callsign": _TEXT, "category": _TEXT, "severity": _TEXT, "title": _TEXT, "description": _TEXT, "timestamp": _TEXT}


def _filled(df: DataFrame, spec: Spec, extra: tuple[str, ...] = ()) -> DataFrame:
    """The columns of spec; a zero confidence or error counts as not given where its fallback is not zero."""

    def column(name: str, kind: str, fallback: object) -> Column:
        if name not in df.columns:
            return F.lit(fallback).cast(kind).alias(name)
        value = F.col(name).cast(kind)
        value = F.nullif(value, F.lit(0.0)) if kind == "double" and fallback else value
        return F.coalesce(value, F.lit(fallback).cast(kind)).alias(name)

    return df.select(*(column(n, *t) for n, t in spec.items()), *extra)


def first_images(evidence: DataFrame) -> DataFrame:
    """flight_id, callsign and the provenance of each flight's first image."""
    rows = evidence.where("flight_id is not null and cast(flight_id as string) <> ''")
    sources = rows.withColumn("source_path", F.col("image_path") if "image_path" in rows.columns else F.lit(None).cast("string"))
    full = _filled(sources, PROVENANCE, (F.col("flight_id").cast("string").alias("of"), F.col("callsign").cast("string").alias("by") if "callsign" in rows.columns else F.lit("").alias("by")))
    return full.groupBy("of").agg(F.min(F.struct("screenshot_id", *(c for c in (*PROVENANCE, "by") if c != "screenshot_id"))).alias("p"))


def _with_images(rows: DataFrame, images: DataFrame, key: str) -> DataFrame:
    found = rows.join(images, rows[key] == images["of"], "left")
    filled = [F.coalesce(F.col(f"p.{n}"), F.lit(fallback).cast(kind)).alias(n) for n, (kind, fallback) in PROVENANCE.items()]
    return found.select(*(rows[c] for c in rows.columns), *filled)


def airspace_events(flights: DataFrame, evidence: DataFrame) -> DataFrame:
    return _with_images(_filled(flights, EVENTS), first_images(evidence), "flight_id")


def aircraft_profiles(profiles: DataFrame, evidence: DataFrame) -> DataFrame:
    """A profile carries the first image of its callsign."""
    by_sign = first_images(evidence).where("p.by <> ''").groupBy(F.col("p.by").alias("of")).agg(F.min("p").alias("p"))
    known = profiles.withColumn("flight_count", F.col("total_flights")) if "total_flights" in profiles.columns else profiles
    return _with_images(_filled(known, PROFILES), by_sign, "callsign")


def track_points(points: DataFrame, evidence: DataFrame) -> DataFrame:
    return _with_images(_filled(points, TRACK_POINTS), first_images(evidence), "flight_id")


def screenshot_evidence(evidence: DataFrame) -> DataFrame:
    return _filled(evidence, EVIDENCE)


def mission_inferences(scores: DataFrame, evidence: DataFrame) -> DataFrame:
    return _with_images(_filled(scores, INFERENCES), first_images(evidence), "flight_id")


def anomaly_index(alerts: DataFrame, evidence: DataFrame) -> DataFrame:
    return _with_images(_filled(alerts, ANOMALIES), first_images(evidence), "flight_id")


_IMAGE = ("screenshot_id", "sha256", "source_path")


def airports(flights: DataFrame, evidence: DataFrame) -> DataFrame:
    """feature_id, name, lon, lat and image of each airport, from the first flight by id that names it with a place; origins first."""
    ends = [F.struct(F.lit(k).alias("k"), F.lit(p).alias("prefix"), F.col(n).cast("string").alias("name"), F.col(f"{p}_lon").cast("double").alias("lon"), F.col(f"{p}_lat").cast("double").alias("lat")) for k, (p, n) in enumerate((("origin", "origin_airport"), ("dest", "destination_airport")))]
    rows = flights.select(F.col("flight_id").cast("string").alias("flight_id"), F.explode(F.array(*ends)).alias("e")).select("flight_id", "e.*").where("name <> '' and lon <> 0 and lat <> 0")
    first = rows.groupBy("name").agg(F.min(F.struct("flight_id", "k", "prefix", "lon", "lat")).alias("f")).select("name", "f.*")
    full = _with_images(first, first_images(evidence), "flight_id")
    return full.select(F.concat_ws("_", "prefix", "name").alias("feature_id"), "name", "lon", "lat", *_IMAGE)


def routes(flights: DataFrame, evidence: DataFrame) -> DataFrame:
    """flight_id, callsign, duration_min, points (two structs of lon and lat) and image of each flight with both ends."""
    full = _filled(flights, EVENTS).where("origin_lat <> 0 and origin_lon <> 0 and dest_lat <> 0 and dest_lon <> 0")
    end = lambda p: F.struct(F.col(f"{p}_lon").alias("lon"), F.col(f"{p}_lat").alias("lat"))
    lines = full.select("flight_id", "callsign", F.col("flight_duration_minutes").alias("duration_min"), F.array(end("origin"), end("dest")).alias("points"))
    return _with_images(lines, first_images(evidence), "flight_id").select("flight_id", "callsign", "duration_min", "points", *_IMAGE)


def export_all(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """All exports of flights, aircraft_profiles, track_points, screenshots, mission_scores and alerts below path.

    Tables become Parquet, features JSON lines of GeoJSON. The manifest of the features is returned.
    """
    images = tables["screenshots"]
    write_parquet(airspace_events(tables["flights"], images), f"{path}/airspace_events")
    write_parquet(aircraft_profiles(tables["aircraft_profiles"], images), f"{path}/aircraft_profiles")
    write_parquet(track_points(tables["track_points"], images), f"{path}/track_points")
    write_parquet(screenshot_evidence(images), f"{path}/screenshot_evidence")
    write_parquet(mission_inferences(tables["mission_scores"], images), f"{path}/mission_inferences")
    write_parquet(anomaly_index(tables["alerts"], images), f"{path}/anomaly_index")
    lines = routes(tables["flights"], images)
    streams = {"airports": airports(tables["flights"], images), "route_lines": lines.select(line_json(["flight_id", "callsign", "duration_min", *_IMAGE]).alias("feature"))}
    return write_package(streams, f"{path}/features")
