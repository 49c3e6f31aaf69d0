"""Vector tiles of features, in the published Mapbox encoding (version 2).

A feature goes to the tiles that its box touches. There its geometry is clipped to the tile and a margin, brought to whole
steps of the tile's grid and encoded, in Arrow tasks over rows; what does not reach the tile itself is left out. Of each
tile the features with the least ids stay, up to a limit, and a last step puts the encoded features of a tile together.

Defined results: points are whole places, so a point on the edge of two tiles is in both. Parts of a line or ring
that vanish on the grid are left out, and so is a feature of which nothing stays. Null coordinates make a part
absent. Latitudes end where the square map does. Null properties are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Steps of a tile's grid, the margin, features of a tile at most, and the greatest latitude of the map.
EXTENT, MARGIN, LIMIT = 4096, 64, 100_000
TOP_LATITUDE = 85.0511287798066
_KINDS = {"point": 1, "line": 2, "polygon": 3}


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, payload: bytes) -> bytes:
    return varint(number << 3 | 2) + varint(len(payload)) + payload


def clipped_line(path: np.ndarray, low: float, high: float) -> list[np.ndarray]:
    """The stretches of a path that lie in the square from low to high on both axes."""
    out: list[list[np.ndarray]] = []
    for a, b in zip(path, path[1:], strict=False):
        t0, t1, d = 0.0, 1.0, b - a
        for k in (0, 1):
            if d[k] == 0:
                if not low <= a[k] <= high:
                    t0, t1 = 1.0, 0.0
            else:
                s, e = sorted(((low - a[k]) / d[k], (high - a[k]) / d[k]))
                t0, t1 = max(t0, s), min(t1, e)
        if t0 > t1:
            continue
        if out and t0 == 0.0 and np.array_equal(out[-1][-1], a):
            out[-1].append(a + t1 * d)
        else:
            out.append([a + t0 * d, a + t1 * d])
    return [np.array(x) for x in out]


def clipped_ring(ring: np.ndarray, low: float, high: float) -> np.ndarray:
    """A ring (first place not repeated) cut at the four sides of the square, one side after the other."""
    for axis, bound, sign in ((0, low, 1.0), (0, high, -1.0), (1, low, 1.0), (1, high, -1.0)):
        if not len(ring):
            return ring
        out = []
        inside = (ring[:, axis] - bound) * sign >= 0
        for k in range(len(ring)):
            a, b = ring[k - 1], ring[k]
            if inside[k - 1] != inside[k]:
                out.append(a + (bound - a[axis]) / (b[axis] - a[axis]) * (b - a))
            if inside[k]:
                out.append(b)
        ring = np.array(out).reshape(-1, 2)
    return ring


def _whole(path: np.ndarray, closed: bool) -> np.ndarray:
    """On the grid, without places that follow themselves."""
    p = np.rint(path).astype(np.int64)
    keep = np.ones(len(p), bool)
    keep[1:] = (p[1:] != p[:-1]).any(axis=1)
    p = p[keep]
    return p[:-1] if closed and len(p) > 1 and np.array_equal(p[0], p[-1]) else p


def _area(p: np.ndarray) -> int:
    x, y = p[:, 0], p[:, 1]
    return int((x * np.roll(y, -1) - np.roll(x, -1) * y).sum())


def geometry(kind: str, parts: list[np.ndarray], extent: int = EXTENT, margin: int = MARGIN) -> bytes:
    """The encoded commands of a geometry in steps of a tile; empty if none of it reaches the tile."""
    low, high = float(-margin), float(extent + margin)
    code, at = bytearray(), np.zeros(2, np.int64)

    def put(p: np.ndarray, close: bool = False) -> None:
        nonlocal at
        steps = np.diff(np.vstack([at, p]), axis=0)
        zig = ((steps << 1) ^ (steps >> 63)).tolist()
        first = len(p) if kind == "point" else 1
        code.extend(varint(first << 3 | 1))
        for k, pair in enumerate(zig):
            if k == first:
                code.extend(varint((len(p) - first) << 3 | 2))
            for v in pair:
                code.extend(varint(v))
        if close:
            code.extend(varint(15))
        at = p[-1]

    if kind == "point":
        every = np.vstack(parts) if parts else np.zeros((0, 2))
        if len(own := every[((every >= 0) & (every <= extent)).all(axis=1)]):
            put(np.rint(own).astype(np.int64))
        return bytes(code)
    if kind == "line":
        if any(clipped_line(p, 0.0, float(extent)) for p in parts):
            for p in parts:
                for stretch in clipped_line(p, low, high):
                    if len(w := _whole(stretch, False)) > 1:
                        put(w)
        return bytes(code)
    rings = [p[:-1] if len(p) > 1 and np.array_equal(p[0], p[-1]) else p for p in parts]
    if not rings or not len(clipped_ring(rings[0], 0.0, float(extent))):
        return b""
    for k, ring in enumerate(rings):
        w = _whole(clipped_ring(ring, low, high), True)
        area = _area(w) if len(w) > 2 else 0
        if not area:
            if k == 0:
                return b""
            continue
        # Outer rings have a positive area on a grid whose rows grow downwards, holes a negative one.
        put(w if (area > 0) == (k == 0) else w[::-1], close=True)
    return bytes(code)


def _unit(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Places on the square map, 0 to 1."""
    r = F.radians(F.greatest(F.lit(-TOP_LATITUDE), F.least(F.lit(TOP_LATITUDE), lat)))
    return (lon + 180.0) / 360.0, (F.lit(1.0) - F.asinh(F.tan(r)) / math.pi) / 2.0


def _encoded(zoom: int, extent: int, margin: int):
    side = float(1 << zoom)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            made = []
            for kind, places, sizes, x, y in zip(f["kind"], f["places"], f["sizes"], f["x"], f["y"], strict=True):
                on_tile = (np.asarray(places, float).reshape(-1, 2) * side - (x, y)) * extent
                made.append(geometry(kind, np.split(on_tile, np.cumsum(sizes)[:-1]), extent, margin))
            out = f[["x", "y", "feature_id", "kind", "properties"]].assign(geometry=made)
            yield out[[len(g) > 0 for g in made]]

    return run


def _tile(layer: str, extent: int):
    def run(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        keys: dict[str, int] = {}
        values: dict[str, int] = {}
        body = bytearray(_field(1, layer.encode()))
        for i, kind, said, code in zip(*(f.sort_values("feature_id")[c] for c in ("feature_id", "kind", "properties", "geometry")), strict=True):
            tags = b"".join(varint(keys.setdefault(k, len(keys))) + varint(values.setdefault(v, len(values))) for k, v in sorted(dict(said or {}).items()) if v is not None)
            body += _field(2, varint(1 << 3) + varint(int(i) & (1 << 64) - 1) + (_field(2, tags) if tags else b"") + varint(3 << 3) + varint(_KINDS[kind]) + _field(4, code))
        for k in keys:
            body += _field(3, k.encode())
        for v in values:
            body += _field(4, _field(1, v.encode()))
        body += varint(5 << 3) + varint(extent) + varint(15 << 3) + varint(2)
        return pd.DataFrame({"x": [key[0]], "y": [key[1]], "n_features": [len(f)], "mvt": [_field(3, bytes(body))]})

    return run


def tiles(features: DataFrame, zoom: int, layer: str = "features", extent: int = EXTENT, margin: int = MARGIN, limit: int = LIMIT) -> DataFrame:
    """x, y, n_features and mvt (bytes) of every tile of a zoom that a feature reaches.

    features: feature_id (long, distinct), kind (point, line or polygon), parts (arrays of structs lon, lat: places, paths, or
    the outer ring and its holes) and properties (a map of texts).
    """
    sound = F.filter(F.coalesce("parts", F.array()), lambda part: F.forall(part, lambda p: p["lon"].isNotNull() & p["lat"].isNotNull()) & (F.size(part) > 0))
    known = features.where(F.col("kind").isin(*_KINDS) & F.col("feature_id").isNotNull()).select("feature_id", "kind", "properties", sound.alias("parts")).where(F.size("parts") > 0)
    # Places as one run of numbers, x and y in turn, and how many places each part has.
    run = F.flatten(F.transform(F.flatten("parts"), lambda p: F.array(*_unit(p["lon"], p["lat"]))))
    known = known.select("feature_id", "kind", "properties", run.alias("places"), F.transform("parts", lambda part: F.size(part)).alias("sizes"))
    last = (1 << zoom) - 1

    def span(axis: int) -> Column:
        # A place on the edge of two tiles belongs to both.
        v = F.transform(F.filter("places", lambda _, i: i % 2 == axis), lambda p: p * float(1 << zoom))
        to = lambda x: F.greatest(F.lit(0), F.least(F.lit(last), x)).cast("long")
        return F.sequence(to(F.ceil(F.array_min(v)) - 1), to(F.floor(F.array_max(v))))

    placed = known.select("*", F.explode(span(0)).alias("x"), span(1).alias("ys")).select("feature_id", "kind", "properties", "places", "sizes", "x", F.explode("ys").alias("y"))
    coded = placed.mapInPandas(_encoded(zoom, extent, margin), "x long, y long, feature_id long, kind string, properties map<string,string>, geometry binary")
    first = coded.withColumn("k", F.row_number().over(Window.partitionBy("x", "y").orderBy("feature_id"))).where(F.col("k") <= limit).drop("k")
    return first.groupBy("x", "y").applyInPandas(_tile(layer, extent), "x long, y long, n_features long, mvt binary")
