"""Planning of feature file downloads as tables: what is expected, fetched and landed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import clean_label

MOST_LAYERS = 1000


def fetch_manifest(locations: DataFrame, layers: DataFrame) -> DataFrame:
    """One row per layer(layer, template) and location: its task key and URL ({state}, {district}, {tehsil} in the template).

    Each location takes the array of all layers (one short row each, by nature a handful) and explodes it.
    """
    slugged = locations.select(*[clean_label(F.col(f"{n}_name")).alias(n) for n in ("state", "district", "tehsil")])
    rows = [(r["layer"], r["template"]) for r in layers.select("layer", "template").limit(MOST_LAYERS + 1).collect()]
    if len(rows) > MOST_LAYERS:
        raise ValueError(f"more than {MOST_LAYERS} layers")
    known = F.array(*[F.struct(F.lit(a).alias("layer"), F.lit(b).alias("template")) for a, b in rows]).cast("array<struct<layer:string,template:string>>")
    both = slugged.withColumn("l", F.explode(known)).select("state", "district", "tehsil", "l.layer", "l.template")
    url = F.col("template")
    for n in ("state", "district", "tehsil"):
        url = F.replace(url, F.lit("{" + n + "}"), F.col(n))
    return both.select("layer", F.concat_ws("_", "layer", "district", "tehsil").alias("task_key"), url.alias("url"))


def fetch_ledger_status(ledger: DataFrame) -> DataFrame:
    """Per layer how many tasks are in which state, and whether none is left. Failures carry a return code and count as failed, not finished."""
    failed = (F.col("status") == "failed") | ((F.col("status") == "finished") & (F.coalesce("return_code", F.lit(0)) < 0))
    count = lambda name: F.count_if(F.col("status") == name).alias(name)
    out = ledger.groupBy("layer").agg(F.count_if((F.col("status") == "finished") & ~failed).alias("finished"), F.count_if(failed).alias("failed"), count("started"), count("queued"))
    return out.withColumn("done", (F.col("started") == 0) & (F.col("queued") == 0))


def landed_files_check(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Task keys whose file isn't among files(path)."""
    landed = files.select(F.regexp_extract("path", r"([^/]+)\.geojson$", 1).alias("task_key"))
    return manifest.select("layer", "task_key").join(landed, "task_key", "left_anti")
