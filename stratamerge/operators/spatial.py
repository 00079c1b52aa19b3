"""Point-in-polygon joins by grid cells, and the fill of missing admin names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.geometry import all_edges, cells_passed, let, on_edge, right_of, st_bounds, st_centroid, turn
from ..functions.names import normalize_area_name, title_case
from ..sources.scratch import materialize_zstd
from .merge import KEYS

ADMIN = ("state", "district", "tehsil")
EDGES = 64  # edges in one row of a cell at most


def in_envelope(c: Column, xmin: float, ymin: float, xmax: float, ymax: float) -> Column:
    """Point struct strictly inside the rectangle."""
    return (c["x"] > xmin) & (c["x"] < xmax) & (c["y"] > ymin) & (c["y"] < ymax)


def centroid_in_envelopes(df: DataFrame, regions: dict[str, tuple[float, float, float, float]], digits: int = 9) -> DataFrame:
    """(region, n): how many shapes have their centroid, rounded, strictly inside each region (xmin, ymin, xmax, ymax)."""
    inside = lambda c: F.struct(*[in_envelope(c, *r).alias(n) for n, r in regions.items()])
    rounded = lambda c: F.struct(F.round(c["x"], digits).alias("x"), F.round(c["y"], digits).alias("y"))
    found = df.select(let(let(st_centroid(F.col("rings"), F.col("is_hole")), rounded), inside).alias("i"))
    return found.agg(*[F.count_if(F.col("i").getField(n)).alias(n) for n in regions]).unpivot([], list(regions), "region", "n")


def bbox_contained(bbox: str, xmin: float, ymin: float, xmax: float, ymax: float) -> Column:
    """Bounding box inside the rectangle, as plain comparisons on the struct's leaves (they reach the scan)."""
    return (F.col(f"{bbox}.xmin") >= xmin) & (F.col(f"{bbox}.xmax") <= xmax) & (F.col(f"{bbox}.ymin") >= ymin) & (F.col(f"{bbox}.ymax") <= ymax)


def beyond(x: Column, y: Column, e: Column) -> Column:
    """Of an edge that crosses height y (a hair above): whether it does so right of x."""
    side = F.when(e["y2"] > e["y1"], turn(e, x, y) > 0).otherwise(turn(e, x, y) < 0)
    return F.when(F.least(e["x1"], e["x2"]) > x, True).when(F.greatest(e["x1"], e["x2"]) <= x, False).otherwise(side)


def up_to(x: Column, y: Column, e: Column) -> Column:
    """Of an edge that crosses x (a hair to the right): whether it does so not above y. Decided by the same sign as `beyond`, so that both agree however numbers are rounded."""
    above = turn(e, x, y) * F.signum(e["x2"] - e["x1"])
    side = F.when((e["y2"] > e["y1"]) == (e["x2"] > e["x1"]), above > 0).otherwise(above >= 0)
    return F.when(F.greatest(e["y1"], e["y2"]) <= y, True).when(F.least(e["y1"], e["y2"]) > y, False).otherwise(side)


def area_cells(shapes: DataFrame) -> DataFrame:
    """(level, cx, cy, area, edges, odd, parts) of shapes (area, level, edges): the grid cells that each covers, of width 2^level.

    A cell holds the edges that pass it, EDGES of them in a row, and in its first row whether
    its lower right corner is inside. Cells wholly inside have one row without edges.
    """
    g = F.pow(F.lit(2.0), F.col("level"))
    e, none = F.col("e"), F.lit(0).cast("long")
    lines = materialize_zstd(shapes.select("area", "level", F.explode("edges").alias("e")))
    passed = lines.select("area", "level", "e", F.explode(cells_passed(e, F.lit(0.0), F.lit(0.0), g)).alias("c")).select("area", "level", "e", "c.*")
    turns = F.row_number().over(Window.partitionBy("area", "level", "cx", "cy").orderBy("e")) - 1
    rows = passed.withColumn("part", F.floor(turns / EDGES)).groupBy("area", "level", "cx", "cy", "part").agg(F.collect_list("e").alias("edges"))
    rows = materialize_zstd(rows)
    # where edges cross the lower sides of cells: the first cell whose right side isn't left of that
    crossed = lines.select("area", "level", "e", F.explode(F.sequence(F.ceil(F.least(e["y1"], e["y2"]) / g), F.greatest(F.ceil(F.greatest(e["y1"], e["y2"]) / g) - 1, F.ceil(F.least(e["y1"], e["y2"]) / g)))).alias("cy"))
    y = F.col("cy") * g
    crossed = crossed.where((e["y1"] > y) != (e["y2"] > y)).withColumn("c", F.floor(((e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]) / g))
    c = F.col("c")
    crossed = crossed.select("area", "level", "cy", F.when(~beyond(c * g, y, e), c - 1).when(~beyond((c + 1) * g, y, e), c).otherwise(c + 1).alias("cx"), F.lit(1).cast("long").alias("n"), F.lit(False).alias("held"))
    held = rows.where("part = 0").select("area", "level", "cy", "cx", none.alias("n"), F.lit(True).alias("held"))
    line = Window.partitionBy("area", "level", "cy")
    columns = crossed.union(held).groupBy("area", "level", "cy", "cx").agg(F.sum("n").alias("n"), F.max("held").alias("held"))
    columns = columns.withColumn("right", F.sum("n").over(line.orderBy(F.desc("cx")).rowsBetween(Window.unboundedPreceding, 0))).where("held").withColumn("last", F.lag("cx").over(line.orderBy("cx")))
    columns = materialize_zstd(columns)
    odd = columns.select("area", "level", "cx", "cy", ((F.col("right") - F.col("n")) % 2).alias("odd"))
    parts = rows.groupBy("area", "level", "cx", "cy").agg(F.count(F.lit(1)).alias("parts"))
    held = rows.join(odd.join(parts, ["area", "level", "cx", "cy"]), ["area", "level", "cx", "cy"]).withColumn("odd", F.when(F.col("part") == 0, F.col("odd")).otherwise(none)).drop("part")
    gaps = columns.where("right % 2 = 1 AND cx - last > 1").select("area", "level", F.explode(F.sequence(F.col("last") + 1, F.col("cx") - 1)).alias("cx"), "cy")
    inner = gaps.select("*", F.array().cast(rows.schema["edges"].dataType).alias("edges"), F.lit(1).cast("long").alias("odd"), F.lit(1).cast("long").alias("parts"))
    return materialize_zstd(held.unionByName(inner))


def spatial_left_join(points: DataFrame, areas: DataFrame, x: str = "x", y: str = "y", rings: str = "rings") -> DataFrame:
    """Points with the columns of every area they lie strictly within; nulls where there is none.

    Areas cover grid cells, of a width that fits their size and number of edges; a point probes
    one cell of each width in use. So the join is by equality of cells. A cell's row
    carries the edges that pass the cell only: what lies right of the point within it decides,
    together with the cell's corner; cells wholly inside need no test. Whether cells or
    attributes are broadcast is up to Spark, by the bytes of their written tables. Points
    with a null coordinate match nothing. Names that both sides have are an error.
    """
    attributes = [c for c in areas.columns if c not in (rings, "is_hole")]
    clash = set(attributes) & set(points.columns)
    if clash:
        raise ValueError(f"names on both sides: {sorted(clash)}")
    # written, so that the numbers of areas stay what they are
    source = materialize_zstd(areas.select(*attributes, F.col(rings).alias("_rings"))).withColumn("_area", F.monotonically_increasing_id())
    box = st_bounds(F.col("_rings"))
    span = F.greatest(box["xmax"] - box["xmin"], box["ymax"] - box["ymin"])
    shapes = source.select(F.col("_area").alias("area"), all_edges(F.col("_rings")).alias("edges"), span.alias("span")).where("span > 0 AND span < double('Infinity')")
    shapes = shapes.withColumn("level", F.ceil(F.log2(F.col("span") / F.sqrt(F.size("edges").cast("double")))).cast("int"))
    cells = area_cells(shapes)
    levels = [r[0] for r in cells.select("level").distinct().collect()]  # a few dozen at most: powers of two
    # places stand for the points, so no row numbers that a recomputation could change
    places = points.select(F.col(x).alias("_x"), F.col(y).alias("_y")).where("_x IS NOT NULL AND _y IS NOT NULL").distinct()
    g = F.pow(F.lit(2.0), F.col("level"))
    probes = places.withColumn("level", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>"))).withColumn("cx", F.floor(F.col("_x") / g)).withColumn("cy", F.floor(F.col("_y") / g))
    px, py, right, low = F.col("_x"), F.col("_y"), (F.col("cx") + 1) * g, F.col("cy") * g
    ahead = F.size(F.filter("edges", lambda e: right_of(px, py, e) & ~beyond(right, py, e)))
    down = F.size(F.filter("edges", lambda e: ((e["x1"] > right) != (e["x2"] > right)) & up_to(right, py, e) & ~up_to(right, low, e)))
    met = probes.join(cells, ["level", "cx", "cy"]).select("_x", "_y", "area", "parts", (ahead + down + F.col("odd")).alias("n"), F.exists("edges", lambda e: on_edge(px, py, e)).alias("on"))
    whole = met.where("parts = 1 AND n % 2 = 1 AND NOT on").select("_x", "_y", "area")
    split = met.where("parts > 1").groupBy("_x", "_y", "area").agg(F.sum("n").alias("n"), F.max("on").alias("on")).where("n % 2 = 1 AND NOT on").select("_x", "_y", "area")
    found = whole.union(split).join(source.select("_area", *attributes), F.col("area") == F.col("_area")).select("_x", "_y", *attributes)
    return points.join(found, (points[x] == found["_x"]) & (points[y] == found["_y"]), "left").drop("_x", "_y")


def admin_lookup(rows: DataFrame, areas: DataFrame) -> DataFrame:
    """(mws_id, version, state, district, tehsil): the admin area of each row's centroid, names normalised; every match."""
    # written, as the join reads the centres twice
    centres = rows.select(*KEYS, F.inline(F.array(st_centroid(F.col("rings"), F.col("is_hole")))))
    centres = materialize_zstd(centres)
    joined = spatial_left_join(centres, areas.select(*ADMIN, "rings"))
    return joined.select(*KEYS, normalize_area_name(F.col("state")).alias("state"), title_case(F.col("district")).alias("district"), title_case(F.col("tehsil")).alias("tehsil"))


def dedup_lookup(lookup: DataFrame, seen: Observation | None = None) -> DataFrame:
    """The first match by (state, district, tehsil) of each key. seen gets matched, unmatched and removed (see match_counts) once a job has read all of it."""
    one = lookup.groupBy(*KEYS).agg(F.min(F.struct(*ADMIN)).alias("a"), F.count("state").alias("m"), F.count(F.lit(1)).alias("n"))
    if seen is not None:
        one = one.observe(seen, *counts("m", "n"))
    return one.select(*KEYS, *[F.col(f"a.{c}").alias(c) for c in ADMIN])


def counts(m: str, n: str) -> list[Column]:
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return [total(F.col(m)).alias("matched"), total(F.col(n) - F.col(m)).alias("unmatched"), total(F.col(n) - 1).alias("removed")]


def match_counts(lookup: DataFrame) -> DataFrame:
    """One row: matched, unmatched, and rows beyond the first of a key."""
    return lookup.groupBy(*KEYS).agg(F.count("state").alias("m"), F.count(F.lit(1)).alias("n")).agg(*counts("m", "n"))


def join_admin_lookup(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """Rows with the lookup's admin columns in place of their own."""
    return rows.drop(*ADMIN).join(lookup, list(KEYS), "left")


def fill_admin(merged: DataFrame, areas: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Rows without a state get the admin area their centroid lies in; the others stay as they are.

    The lookup is made from keys and shapes, written, and joined to the one wide table.
    seen gets matched, unmatched and removed, without a pass of its own.
    """
    without = merged.where(F.col("state").isNull()).select(*KEYS, "rings", "is_hole")
    lookup = materialize_zstd(dedup_lookup(admin_lookup(without, areas), seen))
    lookup = lookup.select(*KEYS, *[F.col(c).alias(f"_{c}") for c in ADMIN])
    filled = {c: F.when(F.col("state").isNull(), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in ADMIN}
    return merged.join(lookup, list(KEYS), "left").select(*[filled.get(c, F.col(f"`{c}`")) for c in merged.columns])
