import pytest
from pyspark.sql import functions as F

from stratamerge.functions import geometry as g
from stratamerge.functions.wkb import rings_to_wkb, wkb_to_rings
from stratamerge.operators.validity import validity

SHAPE = "k int, rings array<array<struct<x:double,y:double>>>, is_hole array<boolean>"


def ring(*points):
    return [(float(x), float(y)) for x, y in points]


HOLED = [ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0)), ring((1, 1), (2, 1), (2, 2), (1, 2), (1, 1))]
BOW = [ring((0, 0), (2, 2), (2, 0), (0, 2), (0, 0))]
OPEN = [ring((0, 0), (1, 0), (1, 1), (0, 1))]
HOLE_OUT = [ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0)), ring((9, 9), (10, 9), (10, 10), (9, 9))]


@pytest.fixture(scope="module")
def shapes(spark):
    return spark.createDataFrame([(1, HOLED, [False, True]), (2, BOW, [False]), (3, OPEN, [False]), (4, HOLE_OUT, [False, True])], SHAPE)


def test_measures_of_a_square_with_a_hole(shapes):
    rings, holes = F.col("rings"), F.col("is_hole")
    row = shapes.where("k = 1").select(g.st_area(rings, holes), g.st_npoints(rings), g.st_centroid(rings, holes), g.st_bounds(rings), g.st_geometry_type(holes)).first()
    assert row[0] == 15 and row[1] == 10 and row[4] == "POLYGON"
    assert row[2]["x"] == pytest.approx((16 * 2 - 1.5) / 15) and row[2]["y"] == pytest.approx((16 * 2 - 1.5) / 15)
    assert tuple(row[3]) == (0, 0, 4, 4)


def test_within_excludes_edges_and_holes(spark, shapes):
    points = spark.createDataFrame([(3.0, 3.0), (1.5, 1.5), (5.0, 1.0), (0.5, 0.5), (0.0, 2.0)], "px double, py double")
    both = points.join(shapes.where("k = 1"))
    got = {(r[0], r[1]): r[2] for r in both.select("px", "py", g.st_within(F.col("px"), F.col("py"), g.all_edges(F.col("rings")))).collect()}
    assert got == {(3, 3): True, (1.5, 1.5): False, (5, 1): False, (0.5, 0.5): True, (0, 2): False}


def test_validity(shapes):
    assert dict(validity(shapes, "k").collect()) == {1: True, 2: False, 3: False, 4: False}


def test_validity_of_spikes_and_parts(spark):
    square, small = ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0)), ring((1, 1), (2, 1), (2, 2), (1, 2), (1, 1))
    cases = {
        1: ([ring((0, 0), (4, 0), (4, 4), (4, 8), (4, 4), (0, 4), (0, 0))], [False], False),  # a spike
        2: ([ring((0, 0), (4, 0), (2, 2), (4, 4), (0, 4), (2, 2), (0, 0))], [False], False),  # touches itself
        3: ([ring((0, 0), (4, 0), (8, 0), (0, 0))], [False], False),  # no area
        4: ([square, square], [False, True], False), 5: ([square, square], [False, False], False),
        6: ([square, small], [False, False], False), 7: ([square, small], [False, True], True),
        8: ([square, ring((4, 4), (8, 4), (8, 8), (4, 8), (4, 4))], [False, False], True),  # parts that touch in a point
        9: ([square, ring((4, 0), (8, 0), (8, 4), (4, 4), (4, 0))], [False, False], False),  # parts with an edge in common
        10: ([square, ring((3, 3), (8, 3), (8, 8), (3, 8), (3, 3))], [False, False], False),
    }
    df = spark.createDataFrame([(k, r, h) for k, (r, h, _) in cases.items()], SHAPE)
    assert dict(validity(df, "k").collect()) == {k: ok for k, (_, _, ok) in cases.items()}


def test_wkb_round_trip(shapes):
    back = wkb_to_rings(rings_to_wkb(shapes))
    assert sorted(back.select("k", "rings", "is_hole").collect()) == sorted(shapes.select("k", "rings", "is_hole").collect())
