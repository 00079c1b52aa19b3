"""Validity of polygons and multipolygons, as a job over their edges.

Shapes of few points, the most by far, are judged where they lie, a batch of them at a time
(`judged`), without a shuffle. Edges of a larger shape meet in grid cells that they pass, so
it isn't compared edge by edge. What the meeting finds are crossings, shared stretches and the points
at which rings touch. A point of each ring that touches no other ring is then cast against
the edges in its row of cells, which tells the rings around it: outer rings must lie at even
depth, holes right below the outer ring of their own part. The touching points join the
rings of a part into a graph; a cycle in it cuts the part's interior.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import cells_passed, edges, let, on_edge, st_bounds, st_npoints, turn
from ..functions.wkb import before, lengths
from ..sources.scratch import materialize_zstd

FEW = 64  # points of a shape that is judged by its pairs of edges
PAIRS = 400_000  # of edges, held at a time
ROWS = 20_000  # of a row group, so that the tables are read by as many tasks as there are cores


def finite(ring: Column) -> Column:
    inside = lambda v: F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False))
    return F.forall(ring, lambda p: inside(p["x"]) & inside(p["y"]))


def without_repeats(ring: Column) -> Column:
    """The ring with each run of equal points as one."""
    return F.filter(ring, lambda p, i: (i == 0) | ~p.eqNullSafe(F.get(ring, i - 1)))


def no_area(ring: Column) -> Column:
    """Whether the ring's signed area, about its first point, is 0."""
    o = F.get(ring, F.lit(0))
    cross = lambda e: (e["x1"] - o["x"]) * (e["y2"] - o["y"]) - (e["x2"] - o["x"]) * (e["y1"] - o["y"])
    return F.aggregate(edges(ring), F.lit(0.0), lambda s, e: s + cross(e)) == 0


def meetings(cells: DataFrame) -> DataFrame:
    """Pairs of a shape's edges that touch: their rings, parts and places, the points, and whether the shape is spoiled by them."""
    sides = [cells.select("_id", "cx", "cy", F.struct("ring", "part", "at", "n", "e").alias(c)) for c in ("v", "w")]
    v, w = F.col("v"), F.col("w")
    p, q = v["e"], w["e"]
    side = lambda e, x, y: F.signum(turn(e, x, y))
    crossing = (side(p, q["x1"], q["y1"]) * side(p, q["x2"], q["y2"]) < 0) & (side(q, p["x1"], p["y1"]) * side(q, p["x2"], p["y2"]) < 0)
    ends = [(q, "1", p), (q, "2", p), (p, "1", q), (p, "2", q)]
    points = F.array_distinct(F.array_compact(F.array(*[F.when(on_edge(a[f"x{i}"], a[f"y{i}"], b), F.struct(a[f"x{i}"].alias("x"), a[f"y{i}"].alias("y"))) for a, i, b in ends])))
    # a stretch in common: on one line, and more than a point of it
    low = lambda a: F.greatest(F.least(p[f"{a}1"], p[f"{a}2"]), F.least(q[f"{a}1"], q[f"{a}2"]))
    high = lambda a: F.least(F.greatest(p[f"{a}1"], p[f"{a}2"]), F.greatest(q[f"{a}1"], q[f"{a}2"]))
    straight = (turn(p, q["x1"], q["y1"]) == 0) & (turn(p, q["x2"], q["y2"]) == 0)
    stretch = straight & (low("x") <= high("x")) & (low("y") <= high("y")) & ((low("x") < high("x")) | (low("y") < high("y")))
    same = v["ring"] == w["ring"]
    beside = same & ((w["at"] - v["at"] == 1) | (v["at"] == 0) & (w["at"] == w["n"] - 1))
    later = (v["ring"] < w["ring"]) | same & (v["at"] < w["at"])
    near = (low("x") <= high("x")) & (low("y") <= high("y"))  # their boxes meet
    met = sides[0].join(sides[1], ["_id", "cx", "cy"]).where(later & near).select("_id", *[v[c].alias(f"{c}1") for c in ("ring", "part", "at")], *[w[c].alias(f"{c}2") for c in ("ring", "part", "at")], points.alias("points"), (crossing | stretch).alias("cut"), same.alias("same"), beside.alias("beside"))
    spoiled = F.col("cut") | F.col("same") & ~F.col("beside") & (F.size("points") > 0)
    return met.withColumn("spoiled", spoiled).where("spoiled OR NOT same AND size(points) > 0").drop("cut", "same", "beside").distinct()


def free_points(lines: DataFrame, met: DataFrame) -> DataFrame:
    """For each ring a point of its first edge that lies on no other ring: half way to the first point where one touches it."""
    first = lines.where("at = 0").select("_id", "ring", "part", "is_hole", "e")
    touched = met.select("_id", F.col("ring1").alias("ring"), F.col("at1").alias("at"), "points").union(met.select("_id", "ring2", "at2", "points")).where("at = 0")
    e = F.col("e")
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    along = ((F.col("p.x") - e["x1"]) * dx + (F.col("p.y") - e["y1"]) * dy) / (dx * dx + dy * dy)
    near = touched.select("_id", "ring", F.explode("points").alias("p")).join(first.select("_id", "ring", "e"), ["_id", "ring"]).withColumn("t", along).where("t > 0").groupBy("_id", "ring").agg(F.min("t").alias("t"))
    t = F.coalesce("t", F.lit(1.0)) / 2
    return first.join(near, ["_id", "ring"], "left").select("_id", "ring", "part", "is_hole", (e["x1"] + dx * t).alias("x"), (e["y1"] + dy * t).alias("y"))


def misplaced(lines: DataFrame, met: DataFrame) -> DataFrame:
    """(_id) of shapes with an outer ring at odd depth, or a hole that isn't right below its own outer ring."""
    row = lambda y: F.floor((y - F.col("box.ymin")) / F.col("g"))
    probes = free_points(lines, met).join(lines.where("at = 0").select("_id", "ring", "box", "g"), ["_id", "ring"]).withColumn("cy", row(F.col("y")))
    e = F.col("e")
    rows = lines.select("_id", F.col("ring").alias("other"), "e", F.explode(F.sequence(row(F.least(e["y1"], e["y2"])), row(F.greatest(e["y1"], e["y2"])))).alias("cy"))
    right = (e["y1"] > F.col("y")) != (e["y2"] > F.col("y"))
    right &= F.coalesce(F.col("x") < (e["x2"] - e["x1"]) * (F.col("y") - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"], F.lit(False))
    around = probes.join(rows, ["_id", "cy"]).where((F.col("ring") != F.col("other")) & right).groupBy("_id", "ring", "other").agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 1")
    around = around.groupBy("_id", "ring").agg(F.count(F.lit(1)).alias("depth"), F.collect_set("other").alias("others"))
    own = Window.partitionBy("_id", "part")
    placed = probes.select("_id", "ring", "part", "is_hole").join(around, ["_id", "ring"], "left").withColumn("depth", F.coalesce("depth", F.lit(0)))
    placed = placed.withColumn("shell", F.min("ring").over(own)).withColumn("above", F.min(F.when(~F.col("is_hole"), F.col("depth"))).over(own))
    wrong = F.when(F.col("is_hole"), ~F.coalesce(F.array_contains("others", F.col("shell")) & (F.col("depth") == F.col("above") + 1), F.lit(False))).otherwise(F.col("depth") % 2 == 1)
    return placed.where(wrong).select("_id")


class Forest:
    """Nodes joined by edges so far."""

    def __init__(self):
        self.up: dict = {}

    def top(self, x):
        while self.up.setdefault(x, x) != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b) -> bool:
        """False if the edge makes a cycle: its ends are joined already."""
        a, b = self.top(a), self.top(b)
        self.up[a] = b
        return a != b


def touching(met: DataFrame) -> DataFrame:
    """(_id, part, ring1, ring2, x, y): points in which rings of one part touch."""
    touch = met.where("part1 = part2 AND ring1 <> ring2").select("_id", F.col("part1").alias("part"), "ring1", "ring2", F.explode("points").alias("p"))
    return touch.select("_id", "part", "ring1", "ring2", "p.x", "p.y")


def parted(touch: DataFrame) -> DataFrame:
    """(_id) of shapes with a part whose rings touch in a cycle: rings and touching points are the graph's nodes."""
    rows = touch.select("_id", "part", F.explode(F.array("ring1", "ring2")).alias("ring"), "x", "y").distinct()

    def cycles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, forest = None, Forest()
        for batch in batches:
            found = set()
            for key, part, ring, x, y in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (key, part) != now:
                    now, forest = (key, part), Forest()
                if not forest.join(("ring", ring), (x, y)):
                    found.add(key)
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int64())], names=["_id"])

    return rows.repartition("_id", "part").sortWithinPartitions("_id", "part").mapInArrow(cycles, "_id long")


def lines_of(shapes: DataFrame) -> DataFrame:
    """A row an edge of the shapes, with the box of its shape and the width of the shape's grid cells."""
    r, box = F.col("rings"), F.col("box")
    part = lambda i: F.greatest(F.lit(1), F.size(F.filter(F.slice("holes", 1, i + 1), lambda h: ~h)))
    line = lambda ring, i: let(part(i), lambda p: F.transform(edges(ring), lambda e, j: F.struct(i.alias("ring"), p.alias("part"), F.get("holes", i).alias("is_hole"), j.alias("at"), (F.size(ring) - 1).alias("n"), e.alias("e"))))
    lines = shapes.select("_id", st_bounds(r).alias("box"), "points", F.explode(F.flatten(F.transform(r, line))).alias("l")).select("_id", "box", "points", "l.*")
    span = F.greatest(box["xmax"] - box["xmin"], box["ymax"] - box["ymin"])
    return materialize_zstd(lines.withColumn("g", span / F.sqrt(F.col("points").cast("double"))).drop("points"), row_group_rows=ROWS)  # read several times


def cells_of(lines: DataFrame) -> DataFrame:
    """The edges in each grid cell that they pass."""
    passed = cells_passed(F.col("e"), F.col("box.xmin"), F.col("box.ymin"), F.col("g"))
    return lines.select("_id", "ring", "part", "at", "n", "e", F.explode(passed).alias("c")).select("_id", "ring", "part", "at", "n", "e", "c.*")


def pairs(first: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) for each i and each j of first[i] .. first[i] + n[i] - 1, about PAIRS at a time."""
    total = np.cumsum(n)
    cuts = np.searchsorted(total, np.arange(PAIRS, total[-1] if len(n) else 0, PAIRS))
    for a, b in zip([0, *cuts], [*cuts, len(n)], strict=True):
        m = n[a:b]
        yield np.repeat(np.arange(a, b), m), np.repeat(first[a:b] - before(m), m) + np.arange(m.sum())


def judge(rings: pa.Array, is_hole: pa.Array) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """Of closed rings without repeats: which shapes have edges that meet wrongly or misplaced rings, and the points (shape, part, ring, ring, x, y) where rings of one part touch."""
    each, flat = lengths(rings), rings.flatten()
    hole, m = is_hole.flatten().to_numpy(zero_copy_only=False).astype(bool), lengths(flat)
    x, y = (c.to_numpy(zero_copy_only=False) for c in flat.flatten().flatten())
    shape = np.repeat(np.arange(len(each)), each)  # of each ring
    start = before(each)[shape]  # its shape's first ring
    outer = np.cumsum(~hole)
    part = np.maximum(1, outer - (outer - ~hole)[start])
    # edges: all points but the last of each ring
    begin = np.ones(len(x), bool)
    begin[np.cumsum(m) - 1] = False
    begin = np.flatnonzero(begin)
    ring, at = np.repeat(np.arange(len(m)), m - 1), np.arange(len(begin)) - np.repeat(before(m - 1), m - 1)
    x1, y1, x2, y2 = x[begin], y[begin], x[begin + 1], y[begin + 1]
    xa, xb, ya, yb = np.minimum(x1, x2), np.maximum(x1, x2), np.minimum(y1, y2), np.maximum(y1, y2)
    of = shape[ring]
    edges_of = np.bincount(of, minlength=len(each))
    end = np.cumsum(edges_of)
    wrong, nearest, touches = np.zeros(len(each), bool), np.ones(len(begin)), [[] for _ in range(5)]

    def sides(e: np.ndarray, px: np.ndarray, py: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Side of the edge on which a point lies, and whether it lies on the edge."""
        a, b = (x2[e] - x1[e]) * (py - y1[e]), (y2[e] - y1[e]) * (px - x1[e])
        return np.sign(a - b), (a == b) & (px >= xa[e]) & (px <= xb[e]) & (py >= ya[e]) & (py <= yb[e])

    for v, w in pairs(np.arange(1, len(begin) + 1), end[of] - np.arange(1, len(begin) + 1)):
        low, high = [np.maximum(c[v], c[w]) for c in (xa, ya)], [np.minimum(c[v], c[w]) for c in (xb, yb)]
        near = (low[0] <= high[0]) & (low[1] <= high[1])  # their boxes meet
        v, w, wide = v[near], w[near], ((low[0] < high[0]) | (low[1] < high[1]))[near]
        ends = [(w, v, x1, y1), (w, v, x2, y2), (v, w, x1, y1), (v, w, x2, y2)]
        (a1, on1), (a2, on2), (b1, on3), (b2, on4) = [sides(e, px[p], py[p]) for p, e, px, py in ends]
        same, on = ring[v] == ring[w], on1 | on2 | on3 | on4
        beside = same & ((at[w] - at[v] == 1) | (at[v] == 0) & (at[w] == m[ring[w]] - 2))
        spoiled = (a1 * a2 < 0) & (b1 * b2 < 0) | (a1 == 0) & (a2 == 0) & wide | same & ~beside & on
        wrong[of[v[spoiled]]] = True
        for (p, _, px, py), lies in zip(ends, (on1, on2, on3, on4), strict=True):
            some = np.flatnonzero(lies & ~same)
            if not len(some):
                continue
            tx, ty = px[p[some]], py[p[some]]
            for e in (v[some], w[some]):
                dx, dy = x2[e] - x1[e], y2[e] - y1[e]
                t = ((tx - x1[e]) * dx + (ty - y1[e]) * dy) / (dx * dx + dy * dy)
                np.minimum.at(nearest, e[t > 0], t[t > 0])
            for held, c in zip(touches, (ring[v[some]], ring[w[some]], part[ring[v[some]]] == part[ring[w[some]]], tx, ty), strict=True):
                held.append(c)
    # a point of each ring that lies on no other ring: half way along its first edge to the first point where one touches it
    probe = np.flatnonzero((each[shape] > 1) | hole)  # one outer ring alone can't be misplaced
    first = before(m - 1)[probe]
    half = nearest[first] / 2
    px, py = x1[first] + (x2[first] - x1[first]) * half, y1[first] + (y2[first] - y1[first]) * half
    depth, inside = np.zeros(len(m), np.int64), np.zeros(len(m), bool)
    group = start + part  # of a ring: its part, as a number of its own in all shapes
    shell = np.full(len(m) + 2, len(m))
    np.minimum.at(shell, group, np.arange(len(m)))
    for i, e in pairs((end - edges_of)[shape[probe]], edges_of[shape[probe]]):
        ok = (ring[e] != probe[i]) & ((y1[e] > py[i]) != (y2[e] > py[i]))
        i, e = i[ok], e[ok]
        right = px[i] < (x2[e] - x1[e]) * (py[i] - y1[e]) / (y2[e] - y1[e]) + x1[e]
        met, n = np.unique(probe[i[right]] * len(m) + ring[e[right]], return_counts=True)
        inner, other = np.divmod(met[n % 2 == 1], len(m))
        np.add.at(depth, inner, 1)
        inside[inner[shell[group[inner]] == other]] = True
    above = np.full(len(m) + 2, np.iinfo(np.int64).max - 1)
    np.minimum.at(above, group[~hole], depth[~hole])
    misplaced_ring = np.where(hole, ~(inside & (depth == above[group] + 1)), depth % 2 == 1)[probe]
    wrong[shape[probe[misplaced_ring]]] = True
    one, two, within, tx, ty = (np.concatenate(c) if c else np.zeros(0, int) for c in touches)
    use = within.astype(bool) & ~wrong[shape[one]]
    one, two = one[use], two[use]
    return wrong, (shape[one], part[one], one - start[one], two - start[one], tx[use], ty[use])


def judged(shapes: DataFrame) -> DataFrame:
    """(_id, part, ring1, ring2, x, y) of shapes (_id, rings, holes) of few points: a row without a part for each wrong one, and the points where rings of one part touch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wrong, (shape, *columns) = judge(batch.column(1), batch.column(2))
            wrong, ids = np.flatnonzero(wrong), batch.column(0)
            none = [pa.nulls(len(wrong), t) for t in (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64())]
            for rows, rest in ((wrong, none), (shape, [pa.array(c.astype(n.type.to_pandas_dtype())) for c, n in zip(columns, none, strict=True)])):
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), *rest], names=["_id", "part", "ring1", "ring2", "x", "y"])

    return shapes.mapInArrow(run, "_id long, part int, ring1 int, ring2 int, x double, y double")


def validity(df: DataFrame, key: str, rings: str = "rings", is_hole: str = "is_hole") -> DataFrame:
    """(key, is_valid) of every row: rings are closed, of 4 different points in a row at least, finite and of some area; no ring meets
    itself but in neighbours' corners; no two rings cross or share a stretch; holes lie in the outer ring before them and in no other hole;
    no part lies in another but in its hole; the interior of each part is connected. Rings may touch in points.

    A null shape, and one without rings, is invalid. Rows with the same key are shapes each.
    """
    # written, so that the numbers of rows stay what they are
    source = materialize_zstd(df.select(F.col(key).alias("_key"), F.col(rings).alias("rings"), F.col(is_hole).alias("holes")), row_group_rows=ROWS).withColumn("_id", F.monotonically_increasing_id())
    source = source.withColumn("rings", F.transform("rings", without_repeats))
    r = F.col("rings")
    shaped = F.forall(r, lambda ring: (F.size(ring) >= 4) & (F.get(ring, F.lit(0)) == F.element_at(ring, -1)) & finite(ring) & ~no_area(ring))
    ok = F.coalesce(shaped & (F.size(r) > 0) & (F.size("holes") == F.size(r)), F.lit(False))
    shapes = materialize_zstd(source.select("_key", "_id", ok.alias("ok"), "rings", "holes").withColumn("points", F.when(F.col("ok"), st_npoints(r))), row_group_rows=ROWS)
    small = materialize_zstd(judged(shapes.where(F.col("points") <= FEW).select("_id", "rings", "holes")))
    wrong, touch = small.where("part IS NULL").select("_id"), small.where("part IS NOT NULL")
    large = shapes.where(F.col("points") > FEW)
    if not large.isEmpty():
        lines = lines_of(large)
        met = materialize_zstd(meetings(cells_of(lines)))
        several = lines.where(F.col("is_hole") | (F.col("part") > 1)).select("_id").distinct()  # one ring alone can't be misplaced
        wrong = wrong.union(met.where("spoiled").select("_id")).union(misplaced(lines.join(several, "_id", "left_semi"), met))
        touch = touch.union(touching(met))
    wrong = wrong.union(parted(touch)).distinct().withColumn("wrong", F.lit(True))
    return shapes.select("_key", "_id", "ok").join(wrong, "_id", "left").select(F.col("_key").alias(key), (F.col("ok") & F.col("wrong").isNull()).alias("is_valid"))
