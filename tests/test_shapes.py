"""Polygon pairs by six predicates, against a walk over the cells of a raster."""

import itertools

import pytest

from terravane.operators import shapes


def ring(*p):
    return list(zip(p, (*p[1:], p[0]), strict=True))


# Polygons with corners on whole numbers and edges along the axes, so that a raster of unit cells says all.
BLOCKS = {
    1: ring((0, 0), (4, 0), (4, 4), (0, 4)),
    2: ring((0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4)),
    3: ring((2, 2), (4, 2), (4, 4), (2, 4)),
    4: ring((0, 0), (6, 0), (6, 6), (0, 6)) + ring((1, 1), (1, 5), (5, 5), (5, 1)),
    5: ring((1, 1), (5, 1), (5, 5), (1, 5)),
    6: ring((2, 2), (3, 2), (3, 3), (2, 3)),
    7: ring((4, 4), (5, 4), (5, 5), (4, 5)),
    8: ring((9, 9), (10, 9), (10, 10), (9, 10)),
    9: ring((-1, 1), (7, 1), (7, 2), (-1, 2)),
    10: ring((0, 0), (1, 0), (1, 1), (0, 1)) + ring((3, 3), (4, 3), (4, 4), (3, 4)),
}


def covered(edges):
    def inside(x, y):
        return sum((a[1] > y) != (b[1] > y) and x < a[0] for a, b in edges) % 2 == 1

    return {(x, y) for x in range(-2, 12) for y in range(-2, 12) if inside(x + 0.5, y + 0.5)}


def by_raster(p, q):
    a, b = covered(p), covered(q)
    corners = lambda cells: {(x + i, y + j) for x, y in cells for i in (0, 1) for j in (0, 1)}
    both, meet = bool(a & b), bool(corners(a) & corners(b))
    if not meet:
        return None
    return (True, both and b <= a, both and a <= b, not both, False, bool(both and a - b and b - a))


def table(spark, shapes_by_id):
    rows = [(k, *map(float, (*a, *b)), "x") for k, e in shapes_by_id.items() for a, b in e]
    return spark.createDataFrame(rows, "polygon_id long, ax double, ay double, bx double, by double, side string")


@pytest.mark.parametrize("cell", [0.7, 3.0, 50.0])
def test_all_pairs(spark, cell):
    t = table(spark, BLOCKS)
    got = {(r.id, r.other_id): tuple(r[c] for c in shapes.PREDICATES) for r in shapes.relations(t, t.unionByName(t), cell).collect()}
    want = {(i, j): by_raster(BLOCKS[i], BLOCKS[j]) for i, j in itertools.product(BLOCKS, BLOCKS)}
    assert got == {k: v for k, v in want.items() if v}


def test_slanted(spark):
    diamond, square = ring((0, -2), (2, 0), (0, 2), (-2, 0)), ring((-1, -1), (1, -1), (1, 1), (-1, 1))
    tip, star = ring((2, 0), (3, -1), (3, 1)), ring((-3, -0.5), (3, -0.5), (3, 0.5), (-3, 0.5))
    edge = ring((0, 2), (2, 0), (2, 2))
    got = {(r.id, r.other_id): r for r in shapes.relations(table(spark, {1: diamond}), table(spark, {1: square, 2: tip, 3: star, 4: edge, 5: diamond}), 1.0).collect()}
    assert got[1, 1].contains and not got[1, 1].touches and not got[1, 1].overlaps
    assert got[1, 2].touches and got[1, 4].touches
    assert got[1, 3].overlaps
    assert got[1, 5].contains and got[1, 5].within


def test_nothing_and_nulls(spark):
    t = table(spark, BLOCKS)
    assert shapes.relations(t.limit(0), t).count() == 0
    gaps = t.unionByName(spark.createDataFrame([(None, 0.0, 0.0, 1.0, 1.0, "x"), (1, None, 0.0, 1.0, 1.0, "x"), (1, 2.0, 2.0, 2.0, 2.0, "x")], t.schema))
    one = t.where("polygon_id = 1")
    assert sorted(shapes.joined(gaps, one, "within", 3.0).collect()) == sorted(shapes.joined(t, one, "within", 3.0).collect())
    with pytest.raises(ValueError):
        shapes.joined(t, t, "near")
