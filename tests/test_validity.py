"""Validity of shapes, in any position, direction and from any first corner."""

import math

import pyarrow as pa

from stratamerge.operators import validity as by_edges
from stratamerge.operators.validity import Forest, validity

SHAPE = "k int, rings array<array<struct<x:double,y:double>>>, is_hole array<boolean>"


def box(x, y, w):
    return [(x, y), (x + w, y), (x + w, y + w), (x, y + w)]


BIG, DIAMOND = box(0, 0, 8), [(0, 4), (4, 2), (8, 4), (4, 6)]
LEFT, RIGHT = [(0, 4), (2, 2), (4, 4), (2, 6)], [(4, 4), (6, 2), (8, 4), (6, 6)]
CASES = {
    "square": ([BIG], "F", True),
    "hole that touches once": ([BIG, [(0, 4), (4, 2), (4, 6)]], "FT", True),
    "hole in a corner": ([BIG, [(0, 0), (4, 2), (2, 4)]], "FT", True),
    "part in a part": ([BIG, box(2, 2, 2)], "FF", False),
    "island in a lake": ([BIG, box(1, 1, 6), box(2, 2, 2)], "FTF", True),
    "island with a pond": ([BIG, box(1, 1, 6), box(2, 2, 4), box(3, 3, 1)], "FTFT", True),
    "pond of the wrong part": ([BIG, box(1, 1, 6), box(3, 3, 1), box(2, 2, 4)], "FTTF", False),
    "hole in a hole": ([BIG, box(1, 1, 6), box(2, 2, 2)], "FTT", False),
    "hole that cuts": ([BIG, DIAMOND], "FT", False),
    "inscribed part": ([BIG, [(0, 4), (4, 0), (8, 4), (4, 8)]], "FF", False),
    "inscribed hole": ([BIG, [(0, 4), (4, 0), (8, 4), (4, 8)]], "FT", False),
    "holes that cut": ([BIG, LEFT, RIGHT], "FTT", False),
    "chain of holes": ([BIG, LEFT, [(4, 4), (6, 2), (7, 4), (6, 6)]], "FTT", True),
    "three holes at a point": ([BIG, [(4, 4), (2, 1), (6, 1)], [(4, 4), (7, 2), (7, 6)], [(4, 4), (1, 2), (1, 6)]], "FTTT", True),
    "holes that touch twice": ([BIG, [(2, 2), (6, 2), (4, 1)], [(2, 2), (6, 2), (4, 6)]], "FTT", False),
    "two holes in a ring": ([BIG, [(1, 4), (4, 1), (3, 4)], [(4, 1), (7, 4), (5, 4)], [(7, 4), (4, 7), (1, 4), (4, 6)]], "FTTT", False),
    "hole of another part": ([BIG, box(12, 2, 2), box(10, 0, 8)], "FTF", False),
    "parts that touch": ([BIG, box(8, 8, 4)], "FF", True),
    "parts that share a side": ([BIG, box(8, 2, 4)], "FF", False),
    "repeated points": ([[(0, 0), (0, 0), (8, 0), (8, 8), (8, 8), (0, 8)]], "F", True),
    "only two points": ([[(0, 0), (0, 0), (8, 0)]], "F", False),
    "bow": ([[(0, 0), (8, 8), (8, 0), (0, 8)]], "F", False),
}


def closed(ring, first=0, back=False):
    ring = [*ring[first:], *ring[:first]]
    ring = ring[::-1] if back else ring
    return [(float(x), float(y)) for x, y in [*ring, ring[0]]]


def test_shapes_in_any_position(spark):
    moves = [lambda x, y: (x, y), lambda x, y: (y, x), lambda x, y: (-x, y + 0.5), lambda x, y: (x / 4 + 1000, -y * 8), lambda x, y: (x + 2 * y, y)]
    rows, want = [], {}
    for name, (rings, holes, ok) in CASES.items():
        for m, move in enumerate(moves):
            for first in (0, 1):
                want[len(rows)] = (name, m, first, ok)
                rows.append((len(rows), [closed([move(*p) for p in r], first, bool(m % 2)) for r in rings], [h == "T" for h in holes]))
    got = dict(validity(spark.createDataFrame(rows, SHAPE), "k").collect())
    assert {want[k] for k in got if got[k] != want[k][3]} == set() and len(got) == len(rows)


def test_odd_rows(spark):
    rows = [(1, None, None), (1, [closed(BIG)], [False]), (None, [closed(BIG)], [False]), (2, [], []), (3, [[]], [False]), (4, [closed(BIG)[:-1]], [False]), (5, [[(0.0, 0.0), (1.0, float("nan")), (1.0, 1.0), (0.0, 0.0)]], [False]), (6, [closed(BIG)], [])]
    got = sorted(validity(spark.createDataFrame(rows, SHAPE), "k").collect(), key=str)
    assert got == sorted([(1, False), (1, True), (None, True), (2, False), (3, False), (4, False), (5, False), (6, False)], key=str)
    assert validity(spark.createDataFrame([], SHAPE), "k").collect() == []


def test_shapes_of_many_vertices(spark):
    n = 4000
    circle = [(math.cos(2 * math.pi * i / n), math.sin(2 * math.pi * i / n)) for i in range(n)]
    comb = [(i, 1.0 + i % 2) for i in range(1000)] + [(999, 0), (0, 0)]  # a long side along all others
    holes = [box(-0.5 + 0.1 * i, -0.5 + 0.1 * j, 0.05) for i in range(10) for j in range(10)]
    rows = [(1, [closed(circle), *map(closed, holes)], [False] + [True] * 100), (2, [closed(comb)], [False]), (3, [closed(circle), *map(closed, [*holes, box(0.01, 0.01, 0.01)])], [False] + [True] * 101)]
    assert dict(validity(spark.createDataFrame(rows, SHAPE), "k").collect()) == {1: True, 2: True, 3: False}


def test_cycles():
    joins = lambda edges: [f.join(a, b) for f in [Forest()] for a, b in edges]
    assert all(joins([(1, "a"), (2, "a"), (3, "a"), (3, "b")])) and joins([(1, "a"), (2, "a"), (2, "b"), (1, "b")]) == [True, True, True, False]


def test_both_ways_agree_and_small_shapes_are_not_exploded(spark, monkeypatch):
    rows = [(i, [closed(r, back=bool(i % 2)) for r in rings], [h == "T" for h in holes]) for i, (rings, holes, _) in enumerate(CASES.values())] * 3
    df = spark.createDataFrame(rows, SHAPE)
    called, real = [], by_edges.lines_of
    monkeypatch.setattr(by_edges, "lines_of", lambda s: called.append(1) or real(s))
    few = sorted(validity(df, "k").collect())
    assert not called
    monkeypatch.setattr(by_edges, "FEW", 0)
    assert sorted(validity(df, "k").collect()) == few == sorted((i, ok) for i, (_, _, ok) in enumerate(CASES.values()) for _ in range(3)) and called


def test_pairs_in_pieces_cover_all(monkeypatch):
    shapes = pa.array([[[dict(zip("xy", p, strict=True)) for p in closed(r)] for r in rings] for rings, _, _ in CASES.values() if len(set(rings[0])) == len(rings[0])])
    holes = pa.array([[h == "T" for h in h] for rings, h, _ in CASES.values() if len(set(rings[0])) == len(rings[0])])
    wrong, touches = by_edges.judge(shapes, holes)
    monkeypatch.setattr(by_edges, "PAIRS", 7)
    again, pieces = by_edges.judge(shapes, holes)
    assert (wrong == again).all() and wrong.any() and all(sorted(a.tolist()) == sorted(b.tolist()) for a, b in zip(touches, pieces, strict=True))
