"""Streaming forms of the track checks and of repeated alerts.

Both run on any streaming DataFrame with the batch columns. State is kept for each flight or alert key and is bounded:
a flight's state is one point and goes when the watermark is `forget` past it; alert keys go with the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions import geo
from ..operators.tracks import MAX_CLIMB_FT_MIN, MAX_SPEED_MPH

CHECK = "flight_id long, point_id long, check_type string, passed boolean, measure double"
STATE = "ts timestamp, lon double, lat double, alt_ft double"


def _miles(lon1: float, lat1: float, lon2: float, lat2: float) -> float:
    import math

    p, q = math.sin(math.radians(lat2 - lat1) / 2), math.sin(math.radians(lon2 - lon1) / 2)
    a = p * p + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * q * q
    return 2 * geo.EARTH_NM * math.asin(min(1.0, math.sqrt(a))) * geo.MILES_PER_NM


def _validator(forget_ms: int):
    def step(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get if state.exists else None
        rows = pd.concat(list(batches)).sort_values(["ts", "point_id"])
        out = []
        for r in rows.itertuples(index=False):
            if last is not None:
                dt = (r.ts - pd.Timestamp(last[0])).total_seconds()
                if dt < 0:
                    # A point behind what was seen before: reported, and the state stays at the later point.
                    out.append((r.flight_id, r.point_id, "monotonic_time", False, -dt))
                    continue
                if dt > 0:
                    if r.lon and r.lat and last[1] and last[2]:
                        speed = _miles(last[1], last[2], r.lon, r.lat) / (dt / 3600.0)
                        out.append((r.flight_id, r.point_id, "speed", speed <= MAX_SPEED_MPH, speed))
                    if r.alt_ft and last[3] and (climb := abs(r.alt_ft - last[3]) / (dt / 60.0)) > MAX_CLIMB_FT_MIN:
                        out.append((r.flight_id, r.point_id, "climb_rate", False, climb))
            last = (r.ts.to_pydatetime(), float(r.lon), float(r.lat), float(r.alt_ft))
        if last is not None:
            state.update(last)
        # The watermark may already be past a quiet flight's last point.
        due = int(last[0].timestamp() * 1000) + forget_ms if last is not None else forget_ms
        state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["flight_id", "point_id", "check_type", "passed", "measure"])

    return step


def validate(points: DataFrame, forget_ms: int = 6 * 3600 * 1000, late: str = "1 hour") -> DataFrame:
    """The checks of `operators.tracks.validate` over a stream, each point against the last one before it.

    Points more than `late` behind the newest time seen are left out by the watermark.
    """
    cols = points.select("flight_id", "point_id", F.col("ts").cast("timestamp").alias("ts"), "lon", "lat", F.col("alt_ft").cast("double").alias("alt_ft")).withWatermark("ts", late)
    return cols.groupBy("flight_id").applyInPandasWithState(_validator(forget_ms), CHECK, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def without_repeats(alerts: DataFrame, within: str = "24 hours") -> DataFrame:
    """Alerts whose callsign and category did not come within the watermark's delay before."""
    return alerts.withWatermark("ts", within).dropDuplicatesWithinWatermark(["callsign", "category"])


def counts(points: DataFrame, width: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Points and flights (approximate) of each time window; what is later than `late` is left out by the watermark."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    g = points.withWatermark("ts", late).groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("n_points"), F.approx_count_distinct("flight_id").alias("n_flights"))
    return g.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n_points", "n_flights")
