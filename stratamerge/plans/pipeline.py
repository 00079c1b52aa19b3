"""The whole integration: feature files in, partitioned GeoParquet out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from ..functions.wkb import wkb_to_rings
from ..operators.merge import join_layer_versions, join_layers, missing_ids, prepare_base, shared_slugs, tag_location
from ..operators.reshape import explode_locations, harmonize_geometry_name, prefix_cols, rename_and_drop, split_range_cols, unnest_json_cols
from ..operators.spatial import fill_admin
from ..sources.features import read_areas, read_layer_features, read_layer_versions, read_locations, scan_base
from ..sources.geoparquet import write_geoparquet
from ..sources.scratch import materialize_zstd
from .config import Request


def layer_table(spark: SparkSession, request: Request, layer: str, folder: str, locations: DataFrame) -> DataFrame:
    """One layer, tagged, its ranges split, JSON unnested, columns prefixed; written once."""
    maps = request.column_map[layer]
    rows = rename_and_drop(read_layer_features(spark, folder, layer), maps.rename_columns, list(maps.drop_columns))
    rows = tag_location(rows, locations).drop("slug", "rings", "is_hole")
    return materialize_zstd(prefix_cols(unnest_json_cols(split_range_cols(rows)), layer))


@dataclass
class Integration:
    """The merged table and what came up on the way."""

    table: DataFrame
    uncovered: int  # base rows that no layer has
    uncovered_ids: list  # the first five of them
    matched: int  # rows without a location that got an area, those that got none, and further areas of a row
    unmatched: int
    removed: int
    shared_slugs: DataFrame  # file slugs that several locations have


def integrate(spark: SparkSession, request: Request, folder: str, locations_path: str, areas_path: str) -> Integration:
    """Runs a request over landed feature files and writes its output."""
    locations = join_layer_versions(explode_locations(read_locations(spark, locations_path)), read_layer_versions(spark, request.layer_version))
    raw = harmonize_geometry_name(scan_base(spark, request.base_layer[request.unit]))
    if "rings" not in raw.columns:  # a base that holds WKB
        raw = wkb_to_rings(raw)
    base = prepare_base(raw.drop("geometry").withColumnRenamed("rings", "geometry"))
    layers = {name: layer_table(spark, request, name, folder, locations) for name in request.layers}
    merged = materialize_zstd(join_layers(base, layers).withColumnRenamed("geometry", "rings"))
    missing = materialize_zstd(missing_ids(base, layers))
    uncovered, found = missing.count(), {"matched": 0, "unmatched": 0, "removed": 0}
    if uncovered:
        seen = Observation("fill")
        merged = fill_admin(merged, read_areas(spark, areas_path), seen)
        found = seen.get
    write_geoparquet(merged, request.output_path)
    first = [r[0] for r in missing.select("mws_id").orderBy("mws_id").limit(5).collect()]
    return Integration(merged, uncovered, first, found["matched"], found["unmatched"], found["removed"], shared_slugs(locations))
