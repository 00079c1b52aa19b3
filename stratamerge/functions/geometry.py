"""Planar geometry as column expressions over ring arrays.

A shape is two columns: rings, array<array<struct<x,y>>>, and is_hole, array<boolean>,
one entry per ring; polygons and multipolygons alike. Edges of all rings together give
areas, centroids and containment.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RINGS = T.ArrayType(T.ArrayType(POINT))


def let(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def points(rings: Column) -> Column:
    return F.flatten(rings)


def st_bounds(rings: Column) -> Column:
    """struct<xmin,ymin,xmax,ymax>"""
    xs, ys = F.transform(points(rings), lambda p: p["x"]), F.transform(points(rings), lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


bbox_struct = st_bounds


def st_npoints(rings: Column) -> Column:
    """Vertices, closing points included."""
    return F.aggregate(rings, F.lit(0), lambda n, r: n + F.size(r))


def edges(ring: Column) -> Column:
    """array<struct<x1,y1,x2,y2>> of one closed ring"""

    def edge(p: Column, i: Column) -> Column:
        q = F.get(ring, i + 1)
        return F.struct(p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2"))

    return F.transform(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), edge)


def all_edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, edges))


def moments(ring: Column) -> Column:
    """struct<a,x,y,l,lx,ly>: twice the signed area, its first moments, and those of the length; about the ring's first vertex."""
    o = F.get(ring, F.lit(0))
    zero = F.struct(*[F.lit(0.0).alias(n) for n in ("a", "x", "y", "l", "lx", "ly")])

    def add(m: Column, e: Column) -> Column:
        x1, y1, x2, y2 = e["x1"] - o["x"], e["y1"] - o["y"], e["x2"] - o["x"], e["y2"] - o["y"]
        cross, length = x1 * y2 - x2 * y1, F.hypot(x2 - x1, y2 - y1)
        return F.struct(
            (m["a"] + cross).alias("a"), (m["x"] + (x1 + x2) * cross).alias("x"), (m["y"] + (y1 + y2) * cross).alias("y"),
            (m["l"] + length).alias("l"), (m["lx"] + (x1 + x2) / 2 * length).alias("lx"), (m["ly"] + (y1 + y2) / 2 * length).alias("ly"),
        )

    return F.aggregate(edges(ring), zero, add)


def st_area(rings: Column, is_hole: Column) -> Column:
    """Planar area, holes subtracted."""

    def signed(r: Column, i: Column) -> Column:
        return F.abs(moments(r)["a"]) / 2 * F.when(F.get(is_hole, i), -1.0).otherwise(1.0)

    return F.aggregate(F.transform(rings, signed), F.lit(0.0), lambda s, a: s + a)


def st_centroid(rings: Column, is_hole: Column) -> Column:
    """struct<x,y>: weighted by area, by length where the area is 0."""

    def part(r: Column, i: Column) -> Column:
        def of(m: Column) -> Column:
            o = F.get(r, F.lit(0))
            weight = F.abs(m["a"]) / 2 * F.when(F.get(is_hole, i), -1.0).otherwise(1.0)
            safe, length = F.when(m["a"] == 0, F.lit(1.0)).otherwise(m["a"]), F.when(m["l"] == 0, F.lit(1.0)).otherwise(m["l"])
            return F.struct(
                weight.alias("a"), (weight * (o["x"] + m["x"] / (3 * safe))).alias("x"), (weight * (o["y"] + m["y"] / (3 * safe))).alias("y"),
                m["l"].alias("l"), (m["l"] * (o["x"] + m["lx"] / length)).alias("lx"), (m["l"] * (o["y"] + m["ly"] / length)).alias("ly"),
            )

        return let(moments(r), of)

    names = ("a", "x", "y", "l", "lx", "ly")
    zero = F.struct(*[F.lit(0.0).alias(n) for n in names])
    total = F.aggregate(F.transform(rings, part), zero, lambda s, p: F.struct(*[(s[n] + p[n]).alias(n) for n in names]))
    return let(total, lambda t: F.struct(
        F.when(t["a"] != 0, t["x"] / F.nullif(t["a"], F.lit(0.0))).otherwise(t["lx"] / F.nullif(t["l"], F.lit(0.0))).alias("x"),
        F.when(t["a"] != 0, t["y"] / F.nullif(t["a"], F.lit(0.0))).otherwise(t["ly"] / F.nullif(t["l"], F.lit(0.0))).alias("y"),
    ))


def turn(e: Column, x: Column, y: Column) -> Column:
    """Positive left of the edge, negative right of it, 0 on its line."""
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])


def on_edge(x: Column, y: Column, e: Column) -> Column:
    same = (e["x2"] - e["x1"]) * (y - e["y1"]) == (e["y2"] - e["y1"]) * (x - e["x1"])
    return same & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))


def right_of(x: Column, y: Column, e: Column) -> Column:
    """Whether the ray from the point to the right crosses the edge."""
    rise = F.nullif(e["y2"] - e["y1"], F.lit(0.0))
    return ((e["y1"] > y) != (e["y2"] > y)) & F.coalesce(x < (e["x2"] - e["x1"]) * (y - e["y1"]) / rise + e["x1"], F.lit(False))


def st_within(x: Column, y: Column, edge_array: Column) -> Column:
    """Whether the point lies strictly inside: an odd number of edges to its right, and none it lies on."""
    return (F.size(F.filter(edge_array, lambda e: right_of(x, y, e))) % 2 == 1) & ~F.exists(edge_array, lambda e: on_edge(x, y, e))


NEAR = 1e-9  # of a cell's width: an edge so near to a cell counts as passing it


def cells_passed(e: Column, x0: Column, y0: Column, g: Column) -> Column:
    """array<struct<cx,cy>> of the grid cells of width g, from (x0, y0) on, that an edge passes: column by column, the rows between its heights there."""
    u1, u2, v1, v2 = (e["x1"] - x0) / g, (e["x2"] - x0) / g, (e["y1"] - y0) / g, (e["y2"] - y0) / g
    low, high = F.least(u1, u2), F.greatest(u1, u2)
    slope = F.when(u1 != u2, (v2 - v1) / F.nullif(u2 - u1, F.lit(0.0)))

    def rows(c: Column) -> Column:
        at = lambda u: F.least(F.greatest(v1 + (F.least(F.greatest(u, low), high) - u1) * slope, F.least(v1, v2)), F.greatest(v1, v2))
        a, b = F.when(u1 == u2, v1).otherwise(at(c - NEAR)), F.when(u1 == u2, v2).otherwise(at(c + 1 + NEAR))
        return F.transform(F.sequence(F.floor(F.least(a, b) - NEAR), F.floor(F.greatest(a, b) + NEAR)), lambda r: F.struct(c.alias("cx"), r.alias("cy")))

    return F.flatten(F.transform(F.sequence(F.floor(low - NEAR), F.floor(high + NEAR)), rows))


def st_geometry_type(is_hole: Column) -> Column:
    """POLYGON with one outer ring, else MULTIPOLYGON."""
    return F.when(F.size(F.filter(is_hole, lambda h: ~h)) == 1, "POLYGON").otherwise("MULTIPOLYGON")


def morton(x: Column, y: Column) -> Column:
    """Place of a point of the unit square on the Z-order curve through 2^16 x 2^16 cells; null coordinates give null."""

    def spread(v: Column) -> Column:
        """The 16 bits, one place apart."""
        v = F.least(F.greatest(F.floor(v * 65536), F.lit(0)), F.lit(65535))
        for by, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            v = let(v, lambda u: u.bitwiseOR(F.shiftleft(u, by)).bitwiseAND(F.lit(mask).cast("long")))  # noqa: B023  without let each step doubles the expression
        return v

    return F.when(x.isNotNull() & y.isNotNull(), spread(x).bitwiseOR(F.shiftleft(spread(y), 1)))
