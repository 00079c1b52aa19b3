"""The point-in-area join against a plain test of every point with every area, and its plan and rows."""

import math
import random

from pyspark.sql import Observation
from pyspark.sql import functions as F

from stratamerge.functions.geometry import all_edges
from stratamerge.operators import merge, spatial
from stratamerge.plans import queries

AREA = "state string, rings array<array<struct<x:double,y:double>>>"


def inside(x, y, rings):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:], strict=True):
            if (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return False
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def star(n, cx, cy, size, step, rng):
    """A ring of n corners around a point, rounded to multiples of step, so that corners, borders of cells and points coincide."""
    at = sorted(rng.random() for _ in range(n))
    r = [size * (0.2 + 0.8 * rng.random()) for _ in range(n)]
    ring = [(round((cx + a * math.cos(2 * math.pi * t)) / step) * step, round((cy + a * math.sin(2 * math.pi * t)) / step) * step) for t, a in zip(at, r, strict=True)]
    return [*ring, ring[0]]


def test_join_against_plain_python(spark, monkeypatch):
    monkeypatch.setattr(spatial, "EDGES", 3)  # so that many cells have several rows
    rng = random.Random(4)
    areas = [(f"a{i}", [star(rng.choice([3, 4, 9, 60]), rng.uniform(-20, 20), rng.uniform(-20, 20), rng.choice([1, 5, 30]), rng.choice([1, 0.5, 0.1, 0.125]), rng)]) for i in range(40)]
    areas += [("frame", [[(-8.0, -8.0), (8.0, -8.0), (8.0, 8.0), (-8.0, 8.0), (-8.0, -8.0)], [(-4.0, -4.0), (4.0, -4.0), (4.0, 4.0), (-4.0, 4.0), (-4.0, -4.0)]]), ("point", [[(1.0, 1.0)] * 4]), ("line", [[(0.0, 0.0), (9.0, 9.0), (0.0, 0.0)]])]
    points = [(round(rng.uniform(-30, 30) / s) * s, round(rng.uniform(-30, 30) / s) * s) for s in (1, 0.5, 0.1, 1e-6) for _ in range(250)]
    points += [p for _, rings in areas for r in rings for p in r[:10]] + [((a + c) / 2, (b + d) / 2) for _, rings in areas for r in rings for (a, b), (c, d) in zip(r[:5], r[1:6], strict=False)]
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id int, x double, y double")
    shapes = spark.createDataFrame([(s, [[(float(x), float(y)) for x, y in r] for r in rings]) for s, rings in areas], AREA)
    got = {(r["id"], r["state"]) for r in spatial.spatial_left_join(df, shapes).collect()}
    want = {(i, s) for i, p in enumerate(points) for s, rings in areas if inside(*p, rings)}
    assert {x for x in got if x[1]} == want and {i for i, _ in got} == set(range(len(points)))


def test_rows_of_a_large_area_are_bounded(spark):
    n = 100_000
    ring = [(100 * math.cos(2 * math.pi * i / n), 100 * math.sin(2 * math.pi * i / n)) for i in range(n)]
    shape = spark.createDataFrame([("disc", [[*ring, ring[0]]])], AREA)
    edges = shape.select(F.lit(0).cast("long").alias("area"), F.lit(0).alias("level"), all_edges(F.col("rings")).alias("edges"))
    cells = spatial.area_cells(edges)
    most, n_rows = cells.agg(F.max(F.size("edges")), F.count(F.lit(1))).first()
    assert most <= spatial.EDGES and 31_000 < n_rows < 36_000  # 201 x 201 cells, the corners left out, some in several rows
    rng = random.Random(1)
    points = [(i, rng.uniform(-110, 110), rng.uniform(-110, 110)) for i in range(3000)]
    out = spatial.spatial_left_join(spark.createDataFrame(points, "id int, x double, y double"), shape)
    assert {r["id"] for r in out.where("state = 'disc'").collect()} == {i for i, x, y in points if math.hypot(x, y) < 100 * math.cos(math.pi / n)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_fill_reads_the_wide_table_once_and_observes(spark, sf_dir):
    zones = queries.zones(spark, sf_dir).withColumn("wide", F.lit("x"))
    path = queries.scratch(spark, "zones")
    zones.write.parquet(path)
    zones = spark.read.parquet(path)
    seen = Observation("seen")
    out = spatial.fill_admin(zones, queries.areas(spark), seen)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("wide#") and plan.count("Relation [") == 2  # the table and the lookup
    want = spatial.match_counts(spatial.admin_lookup(zones.where("state IS NULL"), queries.areas(spark))).first().asDict()
    assert seen.get == want and out.columns == zones.columns


def test_shared_slugs_do_not_double_features(spark):
    rows = [("S", "D-1", "T 1", "1.2"), ("S", "D 1", "T-1", "1.2"), ("S", "D", "T", None), ("S", "D", "T", None)]
    locations = spark.createDataFrame(rows, "state_name string, district_name string, tehsil_name string, `algorithm version` string")
    features = spark.createDataFrame([(1, "d_1_t_1"), (2, "d_t"), (3, "none")], "k int, slug string")
    assert sorted((r["k"], r["district"]) for r in merge.tag_location(features, locations).collect()) == [(1, "D 1"), (2, "D")]
    assert [tuple(r) for r in merge.shared_slugs(locations).collect()] == [("d_1_t_1", 2, "S / D 1 / T-1", "S / D-1 / T 1")]


def test_small_counts_bytes(spark):
    hinted = lambda df: "broadcast" in merge.small(df)._jdf.queryExecution().logical().toString().lower()
    row = spark.range(100).select("id", F.array(F.struct("id")).alias("a"), F.create_map("id", F.lit("x")).alias("m"))
    assert hinted(row) and not hinted(spark.range(40).select(F.repeat(F.lit("x"), 1 << 20).alias("t"))) and not hinted(spark.range(merge.SMALL_ROWS + 1))
