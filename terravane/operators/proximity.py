"""Tracks against zones, features and corridors, and flights that are out of the ordinary.

Zones and features are tables of any size and meet points through cell keys. Corridors are a short list of named lines
that the caller gives; they become expressions, so that a flight's points are read once and counted before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..sources.tables import saved
from . import joins

METRES_PER_NM = geo.EARTH_M / geo.EARTH_NM


def near_features(points: DataFrame, features: DataFrame, radius_nm: float, salts: int = 1) -> DataFrame:
    """id, feature_id and distance_nm of each point and each feature within a radius.

    Points and features have id, lon and lat; rows without coordinates are near nothing.
    """
    pairs = joins.within_distance(points, features, radius_nm * METRES_PER_NM * (1 + 1e-9), salts)
    return pairs.select("id", F.col("other_id").alias("feature_id"), (F.col("distance_m") / METRES_PER_NM).alias("distance_nm")).where(F.col("distance_nm") <= radius_nm)


def zone_entries(points: DataFrame, zones: DataFrame, most_nm: float, salts: int = 1) -> DataFrame:
    """Points inside circular zones, whose radius_nm is of their own but at most most_nm; the edge is inside.

    A zone wider than most_nm would be searched too near, so it raises in the task that meets it. A zone without a
    radius holds nothing.
    """
    fits = F.when(F.col("radius_nm") <= most_nm, F.col("radius_nm")).otherwise(F.raise_error(F.lit("a zone is wider than most_nm")))
    known = zones.where("radius_nm is not null").withColumn("radius_nm", fits)
    pairs = saved(joins.place_pairs(points, known, most_nm * METRES_PER_NM * (1 + 1e-9), salts).withColumn("distance_nm", F.col("distance_m") / METRES_PER_NM).where(F.col("distance_nm") <= most_nm))
    met = joins.spelled_places(pairs, points.select("id", "lon", "lat"), known.select("id", "lon", "lat", "radius_nm"))
    return met.where("distance_nm <= radius_nm").select("id", F.col("other_id").alias("feature_id"), "distance_nm")


def line_distance_nm(lon: Column, lat: Column, line: Sequence[float], axes_as_given: bool = False) -> Column:
    """Distance from a point to the nearest point of a segment (lon, lat, lon, lat), the latter found in degrees.

    The established rule measures with longitude in the place of latitude, which shortens distances along the
    meridian; results are kept comparable by doing the same. With axes_as_given it is measured as one would expect.
    """
    x1, y1, x2, y2 = line
    long = (x2 - x1) ** 2 + (y2 - y1) ** 2
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((lon - x1) * (x2 - x1) + (lat - y1) * (y2 - y1)) / long)) if long else F.lit(0.0)
    x, y = x1 + t * (x2 - x1), y1 + t * (y2 - y1)
    return geo.haversine(lon, lat, x, y, geo.EARTH_NM) if axes_as_given else geo.haversine(lat, lon, y, x, geo.EARTH_NM)


def corridors_flown(points: DataFrame, corridors: Sequence[tuple[str, Sequence[float], float]], least: float = 0.3, tolerance_nm: float = 1.0) -> DataFrame:
    """flight_id, corridor, n_inside and n_points where more than a share of a flight's points lies in a corridor.

    corridors: (name, segment, width in nm), few. Points without coordinates count as points outside.
    """
    inside = lambda c: F.coalesce(line_distance_nm(F.col("lon"), F.col("lat"), c[1]) <= c[2] / 2 + tolerance_nm, F.lit(False))
    counts = points.groupBy("flight_id").agg(F.count(F.lit(1)).alias("n_points"), *(F.count_if(inside(c)).alias(f"c{k}") for k, c in enumerate(corridors)))
    each = F.array(*(F.struct(F.lit(c[0]).alias("corridor"), F.col(f"c{k}").alias("n_inside")) for k, c in enumerate(corridors)))
    return counts.select("flight_id", "n_points", F.inline(each)).where(F.col("n_inside") > F.col("n_points") * least)


def unusual(flights: DataFrame) -> DataFrame:
    """flight_id, kind and severity, a row for each thing unusual about a flight.

    flights: flight_id, operator, takeoff (text), minutes, aircraft_type, n_images. A takeoff that is no time is
    reported; an absent one is not. A value not known raises nothing.
    """
    at = F.try_to_timestamp(F.nullif(F.col("takeoff"), F.lit("")))
    power = F.col("operator") == "PREPA"
    # The hour as the text says it, whatever the zone of the session.
    hour = F.coalesce(F.nullif(F.regexp_extract("takeoff", r"^\d{4}-\d{2}-\d{2}[T ](\d{2})", 1), F.lit("")).cast("int"), F.lit(0))
    checks = [
        (power & at.isNotNull() & ((hour < 7) | (hour > 18)), "unusual_time", "low"),
        (power & (F.col("takeoff") != "") & at.isNull(), "unparseable_takeoff_time", "low"),
        ((F.col("aircraft_type") == "H125") & (F.col("minutes") / 60 > 8), "unusual_duration", "medium"),
        (F.col("n_images") > 100, "potential_clustering_error", "low"),
    ]
    found = F.array_compact(F.array(*(F.when(c, F.struct(F.lit(k).alias("kind"), F.lit(s).alias("severity"))) for c, k, s in checks)))
    return flights.select("flight_id", F.inline(found))
