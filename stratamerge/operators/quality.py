"""Checks and reports over the merged table; related figures come from one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import st_area, st_bounds, st_npoints
from .merge import KEYS
from .validity import validity


def count_by(df: DataFrame, column: str) -> DataFrame:
    """Groups by size, largest first, ties by name."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_first(column))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def duplicate_keys(df: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def range_of(df: DataFrame, value, name: str) -> DataFrame:
    """min, mean and max of an expression."""
    return df.agg(F.min(value).alias(f"min_{name}"), F.avg(value).alias(f"avg_{name}"), F.max(value).alias(f"max_{name}"))


def geometry_area_stats(df: DataFrame) -> DataFrame:
    return range_of(df, st_area(F.col("rings"), F.col("is_hole")), "area")


def vertex_stats(df: DataFrame) -> DataFrame:
    return range_of(df, st_npoints(F.col("rings")), "vertices")


def global_bounds(df: DataFrame, bbox: str | None = None) -> DataFrame:
    """One row: bounds of all shapes, or of a bbox column."""
    b = df.select((F.col(bbox) if bbox else st_bounds(F.col("rings"))).alias("b"))
    return b.agg(F.min("b.xmin").alias("xmin"), F.min("b.ymin").alias("ymin"), F.max("b.xmax").alias("xmax"), F.max("b.ymax").alias("ymax"))


def bounds_within_extent(df: DataFrame, extent: tuple[float, float, float, float]) -> DataFrame:
    """Global bounds and whether they lie in the extent (xmin, ymin, xmax, ymax)."""
    x0, y0, x1, y1 = extent
    ok = (F.col("xmin") >= x0) & (F.col("ymin") >= y0) & (F.col("xmax") <= x1) & (F.col("ymax") <= y1)
    return global_bounds(df).withColumn("status", F.when(ok, "ok").otherwise("warning"))


def count_invalid_geometry(df: DataFrame, key: str) -> DataFrame:
    return validity(df, key).agg(F.count_if(~F.col("is_valid")).alias("n_invalid"))
