"""Coordinates as people type them, and the conformal conic projection, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .texts import once

# The box (west, south, east, north) that tells which of two numbers is the latitude, and the longest text read.
REGION = (-68.5, 17.5, -64.5, 19.0)
LONGEST = 64
_PART = r"(\d{1,3})[°d](?:(\d{1,2}(?:\.\d{1,6})?)['′m])?(?:(\d{1,2}(?:\.\d{1,6})?)(?:\"|″|''|s))?([NSEWnsew])"
_DMS = rf"^{_PART}[,;]?{_PART}$"
_DECIMAL = r"[+-]?\d{1,3}(?:\.\d{1,12})?"


def parse_coordinates(text: Column, region: tuple[float, float, float, float] = REGION) -> Column:
    """A struct of lon and lat, or null.

    Two decimal numbers are latitude and longitude, unless only the other order lies in the region; where neither does,
    the first order that is a place on the globe counts. Degrees, minutes and seconds need a letter for the hemisphere and
    come in either order.
    """
    place = lambda lon, lat: F.struct(lon.alias("lon"), lat.alias("lat"))
    valid = lambda p: p["lon"].between(-180, 180) & p["lat"].between(-90, 90)
    within = lambda p: p["lon"].between(region[0], region[2]) & p["lat"].between(region[1], region[3])

    def decimal(t: Column) -> Column:
        a, b = (F.element_at(t, k).cast("double") for k in (1, 2))
        first, second = place(b, a), place(a, b)
        ok, ok2 = valid(first), valid(second)
        return F.when(ok & within(first), first).when(ok2 & within(second), second).when(ok, first).when(ok2, second)

    def dms(t: Column) -> Column:
        def value(k: int) -> Column:
            number = lambda i: F.coalesce(F.nullif(F.regexp_extract(t, _DMS, k + i), F.lit("")).cast("double"), F.lit(0.0))
            plain = number(0) + number(1) / 60 + number(2) / 3600
            return F.when(F.upper(F.regexp_extract(t, _DMS, k + 3)).isin("S", "W"), -plain).otherwise(plain)

        north = lambda k: F.upper(F.regexp_extract(t, _DMS, k + 3)).isin("N", "S")
        p = F.when(north(1) & ~north(5), place(value(5), value(1))).when(~north(1) & north(5), place(value(1), value(5)))
        return once(p, lambda q: F.when(valid(q), q))

    trimmed = F.regexp_replace(text, r"^\s+|\s+$", "")
    tokens = F.filter(F.split(trimmed, r"[\s,;]+"), lambda x: x != "")
    is_pair = (F.size(tokens) == 2) & F.forall(tokens, lambda x: x.rlike(f"^{_DECIMAL}$"))
    packed = F.regexp_replace(trimmed, r"\s+", "")
    known = (F.char_length(trimmed) > 0) & (F.char_length(trimmed) <= LONGEST)
    return F.when(known & is_pair, decimal(tokens)).when(known & packed.rlike(_DMS), dms(packed))


class ConformalConic:
    """Lambert's conformal conic with two standard parallels, both ways; angles in degrees, lengths in metres.

    The formulas are the published ones of the projection (EPSG method 9802). Defaults are the fixed values of EPSG:32161 and
    EPSG:6566: the GRS80 ellipsoid, parallels 18 02' and 18 26' N, origin 17 50' N and 66 26' W, 200 km false east and north.
    """

    def __init__(self, south: float = 18 + 2 / 60, north: float = 18 + 26 / 60, lat0: float = 17 + 50 / 60, lon0: float = -(66 + 26 / 60), x0: float = 200_000.0, y0: float = 200_000.0, a: float = 6_378_137.0, inverse_flattening: float = 298.257222101):
        f = 1 / inverse_flattening
        self.a, self.e = a, math.sqrt(f * (2 - f))
        m = lambda p: math.cos(p) / math.sqrt(1 - (self.e * math.sin(p)) ** 2)
        t = lambda p: math.tan(math.pi / 4 - p / 2) / ((1 - self.e * math.sin(p)) / (1 + self.e * math.sin(p))) ** (self.e / 2)
        p1, p2, p0 = (math.radians(x) for x in (south, north, lat0))
        self.n = math.log(m(p1) / m(p2)) / math.log(t(p1) / t(p2)) if south != north else math.sin(p1)
        self.f = m(p1) / (self.n * t(p1) ** self.n)
        self.r0 = a * self.f * t(p0) ** self.n
        self.lon0, self.x0, self.y0 = lon0, x0, y0

    def forward(self, lon: Column, lat: Column) -> Column:
        """A struct of x and y."""
        p = F.radians(lat)
        es = F.sin(p) * self.e
        t = F.tan(F.lit(math.pi / 4) - p / 2) / F.pow((F.lit(1.0) - es) / (F.lit(1.0) + es), F.lit(self.e / 2))
        r = F.pow(t, F.lit(self.n)) * (self.a * self.f)
        theta = F.radians(lon - self.lon0) * self.n
        return F.struct((self.x0 + r * F.sin(theta)).alias("x"), (self.y0 + self.r0 - r * F.cos(theta)).alias("y"))

    def inverse(self, x: Column, y: Column, rounds: int = 6) -> Column:
        """A struct of lon and lat. Each round of the latitude's series gains more than two digits."""
        dx, dy = x - self.x0, F.lit(self.r0) - (y - self.y0)
        sign = 1.0 if self.n > 0 else -1.0
        t = F.pow(F.sqrt(dx * dx + dy * dy) / (self.a * self.f), F.lit(1 / self.n))
        lon = F.degrees(F.atan2(dx * sign, dy * sign) / self.n) + self.lon0

        def better(p: Column, t: Column) -> Column:
            es = F.sin(p) * self.e
            return F.lit(math.pi / 2) - 2 * F.atan(t * F.pow((F.lit(1.0) - es) / (F.lit(1.0) + es), F.lit(self.e / 2)))

        start = F.lit(math.pi / 2) - 2 * F.atan(t)
        lat = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, lambda p, _: better(p, t))
        return F.struct(lon.alias("lon"), F.degrees(lat).alias("lat"))


def snapped(value: Column, origin: float, step: float, tolerance: float) -> Column:
    """A struct of value and snap: moved to the nearest line of a grid if that is within the tolerance."""
    line = F.lit(origin) + F.bround((value - origin) / step) * step
    near = F.abs(value - line) <= tolerance
    return F.struct(F.when(near, line).otherwise(value).alias("value"), near.alias("snap"))
