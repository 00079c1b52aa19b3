"""Joining deduplicated layers onto the base table by (mws_id, version)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import clean_label, lenient_cast, lower_names
from .reshape import harmonize_geometry_name, rename_and_drop, union_relaxed

KEYS = ("mws_id", "version")
BASE_COLUMNS = ("mws_id", "geometry", "area_in_ha", "version")
BASE_VERSION = 1.2
NOT_JOINED = ("id", "tehsil", "district", "state", "geometry", "area_in_ha")
LOCATION = ("mws_id", "version", "tehsil", "district", "state")
#: Layers in the order in which locations are taken from them.
LOCATION_ORDER = ("terrain", "soge", "aquifer", "cropping_intensity", "deltaG_fortnight", "deltaG_well_depth")
SMALL_ROWS, SMALL_BYTES = 200_000, 1 << 25  # tables within both bounds are broadcast


def weight(value: Column, kind: T.DataType) -> Column:
    """About the bytes of a value."""
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.aggregate(value, F.lit(0).cast("long"), lambda n, x: n + weight(x, kind.elementType)), F.lit(0)) + 24
    if isinstance(kind, T.MapType):
        return weight(F.map_keys(value), T.ArrayType(kind.keyType)) + weight(F.map_values(value), T.ArrayType(kind.valueType))
    if isinstance(kind, T.StructType):
        return sum((weight(value[f.name], f.dataType) for f in kind.fields), F.lit(8))
    return F.lit(8)


def small(df: DataFrame) -> DataFrame:
    """df with a broadcast hint if its rows and their bytes are known to be few, by a look that stops at the bound."""
    size = sum((weight(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(8))
    n, total = df.limit(SMALL_ROWS + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if n <= SMALL_ROWS and total <= SMALL_BYTES else df


def prepare_base(raw: DataFrame, version: float = BASE_VERSION) -> DataFrame:
    """Base under its final names, with the version; missing columns are an error."""
    base = harmonize_geometry_name(rename_and_drop(raw, {"uid": "mws_id"})).withColumn("version", F.lit(version))
    missing = [c for c in BASE_COLUMNS if c not in base.columns]
    if missing:
        raise ValueError(f"base lacks {missing}")
    return base


def file_slug() -> Column:
    return F.concat_ws("_", clean_label(F.col("district_name")), clean_label(F.col("tehsil_name")))


def shared_slugs(locations: DataFrame) -> DataFrame:
    """(slug, n, first, last): file slugs that several locations have, how many, and the first and last of their names. Their features can't be told apart."""
    named = locations.select(file_slug().alias("slug"), F.concat_ws(" / ", "state_name", "district_name", "tehsil_name").alias("name")).distinct()
    return named.groupBy("slug").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("first"), F.max("name").alias("last")).where("n > 1")


def tag_location(features: DataFrame, locations: DataFrame, slug: str = "slug") -> DataFrame:
    """Each feature with version, tehsil, district and state of the location whose file slug it carries.

    Of locations with the same slug (see shared_slugs) the first by (state, district, tehsil,
    version) is taken, so no feature is doubled.
    """
    tags = F.struct(F.col("state_name").alias("state"), F.col("district_name").alias("district"), F.col("tehsil_name").alias("tehsil"), lenient_cast(F.col("algorithm version")).alias("version"))
    own = locations.groupBy(file_slug().alias(slug)).agg(F.min(tags).alias("t")).select(slug, *[F.col(f"t.{c}").alias(c) for c in ("version", "tehsil", "district", "state")])
    kept = [c for c in features.columns if c not in ("version", "tehsil", "district", "state")]
    return features.select(*[F.col(f"`{c}`") for c in kept]).join(small(own), slug)


def join_layer_versions(locations: DataFrame, versions: DataFrame) -> DataFrame:
    """Locations with the version row of their state, district and tehsil, where there is one."""
    locations, versions = lower_names(locations), lower_names(versions)
    v = versions.select([F.col(f"`{c}`").alias({"state": "_s", "district": "_d", "tehsil": "_t"}.get(c, c)) for c in versions.columns])
    on = (F.col("state_name") == F.col("_s")) & (F.col("district_name") == F.col("_d")) & (F.col("tehsil_name") == F.col("_t"))
    return locations.join(small(v), on, "left").drop("_s", "_d", "_t")


def dedup_layer(layer: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One row per key: the least of its rows, so that any order of input gives the same."""
    rest = [c for c in layer.columns if c not in keys]
    if not rest:
        return layer.distinct()
    return layer.groupBy(*keys).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_r")).select(*keys, *[F.col("_r").getField(c).alias(c) for c in rest])


def location_meta(layers: dict[str, DataFrame]) -> DataFrame:
    """Ids with their location, from the first layer (in LOCATION_ORDER, then as given) that has all the columns."""
    for name in [*LOCATION_ORDER, *[n for n in layers if n not in LOCATION_ORDER]]:
        if name in layers and all(c in layers[name].columns for c in LOCATION):
            return dedup_layer(layers[name].select(*LOCATION))
    raise ValueError(f"no layer has all of {LOCATION}")


def join_location_meta(base: DataFrame, meta: DataFrame) -> DataFrame:
    return base.join(meta, list(KEYS), "left")


def drop_before_join(layer: DataFrame) -> DataFrame:
    """Without what the base has already."""
    return layer.drop(*NOT_JOINED)


def join_layers(base: DataFrame, layers: dict[str, DataFrame]) -> DataFrame:
    """Base with its location and every layer's columns; as many rows as the base.

    A column name that is taken gets the suffix _<layer>. All sides are partitioned by the
    same two keys, so one exchange of each side serves all joins.
    """
    missing = [c for c in BASE_COLUMNS if c not in base.columns]
    if missing:
        raise ValueError(f"base lacks {missing}")
    out = join_location_meta(base, location_meta(layers))
    for name, layer in layers.items():
        layer = dedup_layer(drop_before_join(layer))
        taken = set(out.columns)
        layer = layer.select(*KEYS, *[F.col(f"`{c}`").alias(f"{c}_{name}" if c in taken else c) for c in layer.columns if c not in KEYS])
        out = out.join(layer, list(KEYS), "left")
    return out


def distinct_layer_ids(layers: dict[str, DataFrame]) -> DataFrame:
    return union_relaxed(*[df.select(*KEYS).distinct() for df in layers.values() if "mws_id" in df.columns]).distinct()


def missing_ids(base: DataFrame, layers: dict[str, DataFrame]) -> DataFrame:
    """Base ids that no layer has."""
    return base.select(*KEYS).join(distinct_layer_ids(layers), list(KEYS), "left_anti")
