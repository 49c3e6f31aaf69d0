"""Vector tiles, decoded again."""

import math

import numpy as np
import pytest

from terravane.operators import vectortiles as V


def read_varint(b, at):
    n = shift = 0
    while True:
        n |= (b[at] & 127) << shift
        shift += 7
        at += 1
        if b[at - 1] < 128:
            return n, at


def fields(b):
    at, out = 0, []
    while at < len(b):
        key, at = read_varint(b, at)
        if key & 7 == 2:
            size, at = read_varint(b, at)
            out.append((key >> 3, b[at : at + size]))
            at += size
        else:
            value, at = read_varint(b, at)
            out.append((key >> 3, value))
    return out


def packed(b):
    at, out = 0, []
    while at < len(b):
        n, at = read_varint(b, at)
        out.append(n)
    return out


def paths(code):
    at, here, out = 0, [0, 0], []
    while at < len(code):
        command, count = code[at] & 7, code[at] >> 3
        at += 1
        if command == 7:
            out[-1].append("close")
            continue
        for _ in range(count):
            here = [h + ((z >> 1) ^ -(z & 1)) for h, z in zip(here, code[at : at + 2], strict=True)]
            at += 2
            if command == 1:
                out.append([])
            out[-1].append(tuple(here))
    return out


def decoded(mvt):
    ((number, layer),) = fields(mvt)
    parts = fields(layer)
    keys, values = [v.decode() for k, v in parts if k == 3], [dict(fields(v))[1].decode() for k, v in parts if k == 4]
    assert number == 3 and dict(parts)[1] == b"features" and dict(parts)[5] == 4096 and dict(parts)[15] == 2
    out = {}
    for k, body in parts:
        if k == 2:
            f = dict(fields(body))
            tags = packed(f.get(2, b""))
            out[f[1]] = (f[3], {keys[a]: values[b] for a, b in zip(tags[::2], tags[1::2], strict=True)}, paths(packed(f[4])))
    return out


def lonlat(x, y, zoom=4):
    """The place at a position in tiles."""
    n = 1 << zoom
    return {"lon": x / n * 360 - 180, "lat": math.degrees(math.atan(math.sinh(math.pi * (1 - 2 * y / n))))}


SCHEMA = "feature_id long, kind string, parts array<array<struct<lon double, lat double>>>, properties map<string,string>"


def test_tiles_hold_the_clipped_features(spark):
    at = lambda *xy: [lonlat(*p) for p in xy]
    square = at((4.25, 5.25), (5.5, 5.25), (5.5, 5.75), (4.25, 5.75), (4.25, 5.25))
    hole = at((4.5, 5.5), (4.625, 5.5), (4.625, 5.625), (4.5, 5.5))
    rows = [
        (1, "point", [at((4.5, 5.5), (6.5, 5.5))], {"a": "x", "b": None}),
        (2, "line", [at((3.5, 5.5), (5.5, 5.5))], {"a": "x", "c": "y"}),
        (3, "polygon", [square, hole], None),
        (4, "line", [at((4.5, 3.5), (3.5, 4.5), (3.5, 5.5))], {}),
        (5, "odd", [at((4.5, 5.5))], {}),
        (6, "point", [[{"lon": None, "lat": 1.0}]], {}),
        (7, "line", [at((4.5, 5.5), (4.500001, 5.5))], {}),
        (8, "point", [at((5.0, 5.5))], {}),
    ]
    got = {(r["x"], r["y"]): r for r in V.tiles(spark.createDataFrame(rows, SCHEMA), 4).collect()}
    mid = decoded(got[4, 5]["mvt"])
    assert set(mid) == {1, 2, 3, 8} and got[4, 5]["n_features"] == 4
    assert mid[1] == (1, {"a": "x"}, [[(2048, 2048)]]) and mid[8][2] == [[(4096, 2048)]]
    assert mid[2] == (2, {"a": "x", "c": "y"}, [[(-64, 2048), (4160, 2048)]])
    outer, inner = mid[3][2]
    assert mid[3][0] == 3 and set(outer) == {(1024, 1024), (4160, 1024), (4160, 3072), (1024, 3072), "close"} and set(inner) == {(2048, 2048), (2560, 2048), (2560, 2560), "close"}
    assert V._area(np.array(outer[:-1])) > 0 > V._area(np.array(inner[:-1]))
    # The bent line's box covers a tile that the line itself does not reach.
    assert set(decoded(got[3, 5]["mvt"])) == {2, 4} and (6, 5) in got and set(decoded(got[5, 5]["mvt"])) == {2, 3, 8}
    assert 4 in decoded(got[3, 4]["mvt"]) and 4 in decoded(got[4, 3]["mvt"]) and (4, 4) not in got or 4 in decoded(got[4, 4]["mvt"])
    few = {(r["x"], r["y"]): r for r in V.tiles(spark.createDataFrame(rows, SCHEMA), 4, limit=2).collect()}
    assert set(decoded(few[4, 5]["mvt"])) == {1, 2}
    assert V.tiles(spark.createDataFrame([], SCHEMA), 4).count() == 0


@pytest.mark.parametrize("n", [0, 1, 127, 128, 300, 1 << 40])
def test_varints(n):
    assert read_varint(V.varint(n), 0) == (n, len(V.varint(n)))


def test_clipping_equals_sampling():
    rng = np.random.default_rng(3)
    for _ in range(200):
        path = rng.uniform(-3, 4, (4, 2))
        kept = V.clipped_line(path, 0.0, 1.0)
        long = sum(np.hypot(*np.diff(p, axis=0).T).sum() for p in kept)
        t = (np.arange(4000) + 0.5) / 4000
        inside = sum((((a + t[:, None] * (b - a)) >= 0) & ((a + t[:, None] * (b - a)) <= 1)).all(axis=1).mean() * np.hypot(*(b - a)) for a, b in zip(path, path[1:], strict=False))
        assert long == pytest.approx(inside, abs=0.02)
    ring = V.clipped_ring(np.array([(-1.0, -1.0), (2.0, -1.0), (2.0, 0.5), (-1.0, 0.5)]), 0.0, 1.0)
    assert abs(V._area((ring * 100).astype(int))) == 2 * 100 * 50
