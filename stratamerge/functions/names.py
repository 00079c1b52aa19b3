"""Names and other text: labels, area names, slugs, prefixes, lenient numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def clean_label(c: Column) -> Column:
    """Lower case; every run of other than a-z and 0-9 one underscore, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), F.lit("_"))


def title_case(c: Column) -> Column:
    """First letter of every alphanumeric run in upper case, the rest in lower case."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda x: F.concat(F.upper(F.left(x, F.lit(1))), F.substring(x, 2, 1 << 30))), "")


def replace_first(c: Column, pattern: str, by: str) -> Column:
    """Only the first match is replaced."""
    return F.regexp_replace(c, f"(?s)^(.*?)(?:{pattern})", f"$1{by}")


def replace_all(c: Column, pattern: str, by: str) -> Column:
    """Every match is replaced."""
    return F.regexp_replace(c, pattern, by)


def normalize_area_name(c: Column) -> Column:
    """Without '(disputed)', a leading 'disputed' and parentheses; in title case."""
    c = replace_first(c, r"(?i:\s*\(disputed\)\s*)", "")
    c = replace_all(c, r"(?i)^disputed\s*", "")
    return title_case(F.trim(F.translate(c, "()", "")))


def partition_slug(c: Column) -> Column:
    """Directory name of a state: blanks and slashes as underscores, null as 'unknown'."""
    return F.coalesce(F.translate(c, " /", "__"), F.lit("unknown"))


def layer_prefix(layer: str) -> str:
    """deltaG_well_depth -> dw_, water-balance -> wb_, aquifer -> aq_."""
    for mark in "_-":
        if mark in layer:
            parts = layer.split(mark)
            if not parts[0] or not parts[1]:
                raise ValueError(f"layer name has an empty part: {layer}")
            return f"{parts[0][0]}{parts[1][0]}_"
    return layer[:2] + "_"


def lenient_cast(c: Column) -> Column:
    """Double where the text is a plain number, else null."""
    return F.when(c.cast("string").rlike(NUMBER), c.cast("string").try_cast("double"))


def split_get(c: Column, mark: str, at: int) -> Column:
    """Part `at` of the text split at mark; null where there are fewer."""
    return F.get(F.split(c, mark), F.lit(at))


def value_in(c: Column, *values: str) -> Column:
    """Membership that is false, not null, for null and unlisted values."""
    return F.coalesce(c.isin(*values), F.lit(False))


def lower_names(df: DataFrame) -> DataFrame:
    names = [c.lower() for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"names clash in lower case: {df.columns}")
    return df.toDF(*names)
