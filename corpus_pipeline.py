"""The corpus pipeline: stages over documents, each written and read again by the next.

Toxic documents go; one document of each near-duplicate group stays; secrets are
replaced by their kinds; sources are mixed to tempered weights; what is left is packed
into length buckets. Every stage takes and returns whole tables; all but the last return
the columns they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamerge.llm import mixing, neardup, packing, secrets, toxicity
from stratamerge.llm.common import documents, unused, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents predicted toxic. Null and empty texts stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(toxicity.training_rows(docs).select("doc_id", "text"), labels)
    scored = toxicity.score_toxicity(docs, model)
    return scored.where(F.col("predicted") == 0).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of each group of near-duplicates.

    Documents without words are no one's duplicates. Rows that repeat an id and its text
    count once; rows without an id can't be named by a group and stay.
    """
    groups = neardup.near_duplicates(docs.select("doc_id", "text"))
    keep = groups.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    named = docs.where(F.col("doc_id").isNotNull()).join(keep, "doc_id", "left_semi")
    digest = unused("_text", docs.columns)
    named = named.withColumn(digest, F.xxhash64("text")).dropDuplicates(["doc_id", digest]).select(*docs.columns)
    return named.union(docs.where(F.col("doc_id").isNull()))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts replaced by their kinds, and n_chars brought up to date."""
    spans = unused("_secrets", docs.columns)
    out = secrets.scan_secrets(docs, out=spans, redacted="text")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources come in shares of the square roots of their sizes, in random order.

    Rows without a source are a source of their own. Rows that are equal are drawn alike, so
    ties give no order; no columns but those of docs are returned.
    """
    return mixing.mix(docs, mixing.rates(docs, mixing.tempered(docs))).select(*docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their length in words, bucket, batch and slot.

    Null and empty texts have no words and go to bucket 0. Ties of the order's hash are broken
    by the rows' values. Columns named like an output (n_words, bucket, bucket_len, batch, slot,
    padding) are replaced, others are passed on.
    """
    return packing.pack(docs.withColumn("n_words", packing.word_count(F.col("text"))), "n_words")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_documents),
]

#: A learned classifier comes first, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
