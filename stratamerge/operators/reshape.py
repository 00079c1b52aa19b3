"""Reshaping layers: renames, prefixes, range and JSON columns, unions, nested locations."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import layer_prefix, lenient_cast, lower_names

#: Columns that keep their names in every layer.
COMMON = ("mws_id", "version", "geometry", "tehsil", "district", "state", "area_in_ha")

# A word before the number, the number, and a percent sign or a second number.
WORDS = r"[A-Za-z][A-Za-z\s]*"
FIGURE = r"\d+(?:\.\d+)?"
MARKER = rf"\s*(?:%|\s*(?:-|to)\s*{FIGURE}\s*%?)"
RANGE_MARKED = rf"^\s*(?:{WORDS})?{FIGURE}{MARKER}\s*$"
RANGE_OR_NUMBER = rf"^\s*(?:{WORDS})?{FIGURE}(?:{MARKER})?\s*$"

YEAR_NAME = re.compile(r"^(.*?_)?(\d{4}(?:[-_]\d{2,4}){0,2})$")


def rename_and_drop(df: DataFrame, rename: dict[str, str], drop: list[str] = ()) -> DataFrame:
    """Drops, then renames, then lower-cases; names that aren't there are passed over."""
    return lower_names(df.select([F.col(f"`{c}`").alias(rename.get(c, c)) for c in df.columns if c not in drop]))


def harmonize_geometry_name(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("geom", "geometry") if "geom" in df.columns and "geometry" not in df.columns else df


def prefix_cols(df: DataFrame, layer: str, common: tuple[str, ...] = COMMON) -> DataFrame:
    """Own columns first, prefixed by the layer; common ones last."""
    prefix, kept = layer_prefix(layer), [c for c in common if c in df.columns]
    return df.select(*[F.col(f"`{c}`").alias(prefix + c) for c in df.columns if c not in kept], *kept)


def exclude_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.select([c for c in df.columns if c not in names])


def project_key_cols(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """The key columns that are there, and those that aren't."""
    return df.select([k for k in keys if k in df.columns]), [k for k in keys if k not in df.columns]


def has_range_marker(c: Column) -> Column:
    return F.coalesce(c.rlike(RANGE_MARKED), F.lit(False))


def string_columns(df: DataFrame, but: tuple[str, ...] = COMMON) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in but]


def range_counts(df: DataFrame) -> DataFrame:
    """One row: for each own string column, how many values carry a range or percent sign."""
    return df.agg(*[F.count_if(has_range_marker(F.col(f"`{c}`"))).alias(c) for c in string_columns(df)])


def detect_range_cols(df: DataFrame) -> list[str]:
    """String columns with at least one such value, found in one pass. Common columns are never taken apart."""
    if not string_columns(df):
        return []
    return [c for c, n in range_counts(df).first().asDict().items() if n]


def range_bounds(c: Column) -> tuple[Column, Column]:
    """Lower and upper bound (double) of '30 - 200', 'upto 8%', '45'; null for anything else."""
    bare = F.regexp_replace(c, rf"^\s*{WORDS}", "")
    bare = F.regexp_replace(F.regexp_replace(bare, "%", ""), r"\s+", "")
    parts = F.split(F.regexp_replace(bare, r"(?i)^(.*?)to", "$1-"), "-")
    ok = c.rlike(RANGE_OR_NUMBER) & (c != "-")
    low, high = F.get(parts, F.lit(0)), F.coalesce(F.get(parts, F.lit(1)), F.get(parts, F.lit(0)))
    return F.when(ok, lenient_cast(low)), F.when(ok, lenient_cast(high))


def split_range_cols(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Each range column becomes <column>_min and <column>_max at the end."""
    columns = detect_range_cols(df) if columns is None else columns
    new = []
    for c in columns:
        low, high = range_bounds(F.col(f"`{c}`"))
        new += [low.alias(f"{c}_min"), high.alias(f"{c}_max")]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in columns], *new)


def year_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and YEAR_NAME.match(f.name)]


def first_non_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with a value of each column: the least that is a JSON object, or else the least that isn't null (so that it is repeatable)."""
    is_object = lambda c: F.coalesce(F.schema_of_variant(F.try_parse_json(c)).startswith("OBJECT<"), F.lit(False))
    return df.agg(*[F.coalesce(F.min(F.when(is_object(F.col(f"`{c}`")), F.col(f"`{c}`"))), F.min(f"`{c}`")).alias(c) for c in columns])


def sniff_json_schema(df: DataFrame) -> T.StructType | None:
    """Keys and types of the first year-named column whose sample is a JSON object: numbers and booleans double, all else text."""
    columns = year_columns(df)
    if not columns:
        return None
    samples = first_non_null(df, columns)
    found = samples.select([F.schema_of_variant(F.try_parse_json(F.col(f"`{c}`"))).alias(c) for c in columns]).first()
    for c in columns:
        if found[c] and found[c].startswith("OBJECT<"):
            keys = samples.select(F.explode(F.from_json(F.col(f"`{c}`"), "map<string,variant>")).alias("k", "v")).select("k", F.schema_of_variant("v")).collect()
            order = samples.select(F.json_object_keys(F.col(f"`{c}`"))).first()[0] or []
            number = {k for k, kind in keys if re.match("BIGINT|DOUBLE|DECIMAL|BOOLEAN|FLOAT", kind)}
            if order:
                return T.StructType([T.StructField(k, T.DoubleType() if k in number else T.StringType()) for k in order])
    return None


def json_decode(c: Column, schema: T.StructType) -> Column:
    """Struct of the schema; booleans under a double key are 1 and 0, bad JSON gives nulls."""
    raw = F.from_json(c, T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]))

    def field(f: T.StructField) -> Column:
        v = raw[f.name]
        if isinstance(f.dataType, T.DoubleType):
            v = F.when(v == "true", 1.0).when(v == "false", 0.0).otherwise(lenient_cast(v))
        return v.alias(f.name)

    return F.struct(*[field(f) for f in schema.fields])


def unnest_json_cols(df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """p_2019_2020 holding {"DeltaG": 1} becomes p_deltag_2019_2020, and so on for every key and year-named column."""
    schema, columns = schema or sniff_json_schema(df), year_columns(df)
    if schema is None or not columns:
        return df
    new = []
    for c in columns:
        prefix, suffix = YEAR_NAME.match(c).groups()
        body = json_decode(F.col(f"`{c}`"), schema)
        new += [body[f.name].alias(f"{prefix or ''}{f.name.lower()}_{suffix}") for f in schema.fields]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in columns], *new)


NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def supertype(a: T.DataType, b: T.DataType) -> T.DataType:
    """Text with anything is text; of two numbers the wider, of an integer and a fraction double."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, NUMBERS) and isinstance(b, NUMBERS):
        if isinstance(a, T.FloatType | T.DoubleType) or isinstance(b, T.FloatType | T.DoubleType):
            return T.DoubleType()
        return a if NUMBERS.index(type(a)) > NUMBERS.index(type(b)) else b
    return T.StringType()


def union_relaxed(*frames: DataFrame) -> DataFrame:
    """Union by name; missing columns null, differing types widened."""
    types: dict[str, T.DataType] = {}
    for df in frames:
        for f in df.schema.fields:
            types[f.name] = supertype(types[f.name], f.dataType) if f.name in types else f.dataType
    cast = [df.select([F.col(f"`{f.name}`").cast(types[f.name]).alias(f.name) for f in df.schema.fields]) for df in frames]
    out = cast[0]
    for df in cast[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def explode_locations(nested: DataFrame) -> DataFrame:
    """One row per block of each district of each state; a parent without children stays, with nulls."""
    districts = nested.select(F.col("label").alias("state_name"), *[c for c in nested.columns if c not in ("label", "district")], F.explode_outer("district").alias("d"))
    blocks = districts.withColumn("b", F.explode_outer("d.blocks"))
    kept = [c for c in districts.columns if c != "d"]
    return blocks.select(*kept, F.col("d.label").alias("district_name"), F.col("d.district_id").alias("district_id"), F.col("b.label").alias("tehsil_name"), F.col("b.tehsil_id").alias("tehsil_id"))
