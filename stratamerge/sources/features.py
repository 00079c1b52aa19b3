"""Reading feature files, areas, locations, versions and the base."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reshape import harmonize_geometry_name
from .geojson import feature_texts
from .geoparquet import located
from .scratch import materialize_zstd

FEATURE = "type string, properties variant, geometry struct<type:string,coordinates:string>"
FILE_ROWS, FILE_BYTES = 10_000, 1 << 24  # about so much in a feature file at most
POSITIONS = "array<array<array<double>>>"


def rings_of(geometry: Column) -> tuple[Column, Column]:
    """Ring arrays and hole marks of a GeoJSON geometry struct (type, coordinates as text); null unless polygonal."""
    xy = lambda ring: F.transform(ring, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    one, many = F.from_json(geometry["coordinates"], POSITIONS), F.from_json(geometry["coordinates"], f"array<{POSITIONS}>")
    flat = F.when(geometry["type"] == "Polygon", one).when(geometry["type"] == "MultiPolygon", F.flatten(many))
    holes = lambda polygon: F.transform(polygon, lambda _, i: i > 0)
    marks = F.when(geometry["type"] == "Polygon", holes(one)).when(geometry["type"] == "MultiPolygon", F.flatten(F.transform(many, holes)))
    return F.transform(flat, xy), marks


def spark_type(variant_type: str) -> str:
    """Column type for an inferred property type: any number double or bigint, anything nested as text."""
    kind = variant_type.upper()
    if kind.startswith(("DECIMAL", "DOUBLE", "FLOAT")):
        return "double"
    return {"BIGINT": "bigint", "BOOLEAN": "boolean"}.get(kind, "string")


def read_features(spark: SparkSession, path: str | list[str], slug: str | None = "slug") -> DataFrame:
    """One row per feature of GeoJSON files, large ones read by many tasks: properties as columns (types from all files), rings, is_hole, and the file's name without its ending (and .part-N) as slug.

    Files without features give no rows. Property names must differ from the added ones.
    """
    slug_of = F.regexp_extract(F.substring_index("path", "/", -1), r"^(.*?)(\.part-\d+)?\.[^.]*$", 1)
    rows = feature_texts(spark, path).select(slug_of.alias("_slug"), F.from_json("feature", FEATURE).alias("f")).where("f.type = 'Feature'").select("_slug", "f.properties", "f.geometry")
    found = rows.agg(F.schema_of_variant_agg("properties")).first()[0] or "VOID"
    fields = []
    if found.upper().startswith("OBJECT<"):
        names = rows.select(F.explode(F.from_json(F.to_json("properties"), "map<string,variant>")).alias("k", "v")).groupBy("k").agg(F.schema_of_variant_agg("v")).collect()
        fields = [(k, spark_type(kind)) for k, kind in sorted(names)]
    quoted = lambda k: "$['" + k.replace("'", "\\'") + "']"
    rings, holes = rings_of(F.col("geometry"))
    columns = [F.try_variant_get("properties", quoted(k), kind).alias(k) for k, kind in fields]
    return rows.select(*columns, rings.alias("rings"), holes.alias("is_hole"), *([F.col("_slug").alias(slug)] if slug else []))


def read_layer_features(spark: SparkSession, folder: str, layer: str) -> DataFrame:
    """All {layer}_{district}_{tehsil}.geojson of one layer, with slug {district}_{tehsil}; no file at all is an error."""
    try:
        rows = read_features(spark, f"{folder}/{layer}_*.geojson")
    except AnalysisException as e:
        raise FileNotFoundError(f"no files for layer {layer} in {folder}") from e
    return rows.withColumn("slug", F.substring("slug", len(layer) + 2, 1 << 30))


def read_areas(spark: SparkSession, path: str) -> DataFrame:
    """Admin boundaries: STATE, District, TEHSIL and shape as state, district, tehsil, rings, is_hole."""
    rows = spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else read_features(spark, path, None)
    return rows.select(F.col("STATE").alias("state"), F.col("District").alias("district"), F.col("TEHSIL").alias("tehsil"), "rings", "is_hole")


LOCATIONS = "label string, state_id string, district array<struct<label:string,district_id:string,blocks:array<struct<label:string,tehsil_id:string>>>>"


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """The nested JSON array of active locations."""
    return spark.read.schema(LOCATIONS).json(path, multiLine=True)


def read_layer_versions(spark: SparkSession, path: str) -> DataFrame:
    """The CSV of layer versions, sorted by State."""
    return sort_versions(spark.read.csv(path, header=True, inferSchema=True))


def sort_versions(versions: DataFrame) -> DataFrame:
    return versions.orderBy("State")


def convert_features(spark: SparkSession, source: str, target: str) -> DataFrame:
    """GeoJSON to Snappy Parquet, all or nothing; refuses source == target and an input without features."""
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("source and target are the same")
    rows = harmonize_geometry_name(read_features(spark, source, None))
    if rows.isEmpty():
        raise ValueError(f"no features in {source}")
    rows.write.option("compression", "snappy").parquet(target)
    return spark.read.parquet(target)


def scan_base(spark: SparkSession, path: str, features: str | None = None) -> DataFrame:
    """The base Parquet; where it isn't there yet, converted from the feature file beside it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return convert_features(spark, features or path.removesuffix(".parquet") + ".geojson", path)


def write_features(df: DataFrame, folder: str, layer: str) -> int:
    """GeoJSON files {layer}_{slug}.geojson of a table with slug, rings, is_hole and properties; their number.

    One shape per feature, its rings as one polygon. A file holds one area's features; those of a
    large area are dealt over further files, {layer}_{slug}.part-N.geojson.
    """
    ring = F.transform("rings", lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    own = F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in ("slug", "rings", "is_hole")])
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), own.alias("properties"), F.struct(F.lit("Polygon").alias("type"), ring.alias("coordinates")).alias("geometry")))
    # numbered as they lie in files, so that equal features are dealt out too, and alike if a task runs again
    rows = materialize_zstd(df.select("slug", feature.alias("feature")))
    numbered = rows.withColumn("_n", F.monotonically_increasing_id())
    sizes = rows.groupBy(F.col("slug").alias("_slug")).agg(F.ceil(F.greatest(F.count(F.lit(1)) / FILE_ROWS, F.sum(F.octet_length("feature")) / FILE_BYTES)).alias("_parts"))
    dealt = numbered.join(sizes, F.col("slug").eqNullSafe(F.col("_slug"))).select("slug", F.pmod(F.xxhash64("_n"), "_parts").alias("part"), "feature")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, f, names = None, None, []
        for batch in batches:
            for slug, part, feature in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if f is None or now != (slug, part):
                    if f is not None:
                        f.write(b"]}")
                        f.close()
                    now = (slug, part)
                    store, root = located(folder)
                    store.create_dir(root, recursive=True)
                    f = store.open_output_stream(f"{root}/{layer}_{slug}{f'.part-{part}' if part else ''}.geojson")
                    f.write(b'{"type":"FeatureCollection","features":[')
                    names.append(slug)
                else:
                    f.write(b",")
                f.write(feature.encode())
        if f is not None:
            f.write(b"]}")
            f.close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["slug"])

    return dealt.repartition("slug", "part").sortWithinPartitions("slug", "part").mapInArrow(put, "slug string").count()
