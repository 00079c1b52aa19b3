"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is (its target share) / (its share of the documents) times
the total rate. Each document gets a uniform number from a seeded hash of its id and
text, is counted by inverting the Poisson distribution of its source's rate, exploded
by that count and dealt out in one global random order.

A null source is a source of its own; a source without a weight has weight 0. Null ids
and texts hash as empty. Repeated rows get equal counts (copies with ids of their own
don't). An empty table gives an empty result; columns named like the outputs are
replaced, others are passed on, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, unpacked

SMALL_SOURCES = 10_000  # rates of at most so many sources are broadcast; more are joined by shuffle


def uniform(*parts: Column) -> Column:
    """In [0, 1): 52 bits of an MD5."""
    key = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def inverse(rate: float) -> list[float]:
    """P(N <= k) for k = 0, 1, ... up to where doubles reach 1."""
    if rate <= 0:
        return [1.0]
    out, at, k = [], 0.0, 0
    while True:
        # each term by itself: exp(-rate) is 0 for large rates
        at += math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1))
        if out and at <= out[-1] and k > rate:
            return out
        out.append(at)
        k += 1


def tempered(docs: DataFrame, source: str = "source", power: float = 0.5) -> dict:
    """Weights proportional to a power of the sources' sizes (one row per source on the driver)."""
    return {r[source]: r["count"] ** power for r in docs.groupBy(source).count().collect()}


def rates(docs: DataFrame, weights: dict, source: str = "source", total: float = 1.0) -> dict:
    """Mean repetitions of each source's documents, so that about total * rows come out in the target shares."""
    sizes = {r[source]: r["count"] for r in docs.groupBy(source).count().collect()}
    all_weights, rows = sum(weights.get(s, 0) for s in sizes), sum(sizes.values())
    return {s: total * rows * weights.get(s, 0) / all_weights / n if all_weights else 0.0 for s, n in sizes.items()}


def mix(docs: DataFrame, rate_of: dict, source: str = "source", identity: tuple[str, ...] = ("doc_id", "text"), seed: int = 11) -> DataFrame:
    """Every document repeated by its Poisson count, in a global order by hash, with replica (from 0) and mix_key."""
    docs = docs.drop("replica", "mix_key")
    own, kept = carried(docs)
    schema = f"source {docs.schema[source].dataType.simpleString()}, upto array<double>"
    table = docs.sparkSession.createDataFrame([(s, inverse(r)) for s, r in sorted(rate_of.items(), key=str)], schema)
    if len(rate_of) <= SMALL_SOURCES:
        table = F.broadcast(table)
    keyed = docs.select(own.alias("own"), uniform(F.lit(seed), *[F.col(f"`{c}`") for c in identity]).alias("u"), F.col(f"`{source}`").alias("from"))
    keyed = keyed.join(table, F.col("from").eqNullSafe(F.col("source"))).withColumn("n", F.size(F.filter("upto", lambda c: c <= F.col("u"))))
    out = keyed.where("n > 0").select("own", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("replica"))
    named = [F.coalesce(F.col("own").getField(f"c{kept.index(c)}").cast("string"), F.lit("")) for c in identity]
    key = F.md5(F.concat_ws("|", F.lit(str(seed + 1)), *named, F.col("replica").cast("string")))
    return out.select(*unpacked("own", kept), "replica", key.alias("mix_key")).repartitionByRange("mix_key").sortWithinPartitions("mix_key")


def op3_mixing(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text", "source")
    return mix(docs, rates(docs, tempered(docs)))


#: The same by tables of P(N <= k); both sides sum them term by term in doubles.
OP3_SQL = """
WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
weights AS (SELECT source, n, pow(n::DOUBLE, 0.5) AS w FROM sizes),
rate AS (SELECT source, (SELECT sum(n) FROM weights)::DOUBLE * w / (SELECT sum(w ORDER BY source) FROM weights) / n AS r FROM weights),
cdf AS (SELECT source, k, sum(exp(-r + k * ln(r) - lgamma(k + 1.0))) OVER (PARTITION BY source ORDER BY k) AS upto
        FROM (SELECT source, r, unnest(range((r + 12 * sqrt(r) + 40)::BIGINT)) AS k FROM rate)),
docs AS (SELECT doc_id, text, source, (('0x' || substr(md5(concat_ws('|', '11', coalesce(doc_id::VARCHAR, ''), coalesce(text, ''))), 1, 13))::BIGINT)::DOUBLE / 4503599627370496.0 AS u FROM documents),
counted AS (SELECT d.doc_id, d.text, d.source, count(c.k) AS n FROM docs d LEFT JOIN cdf c ON c.source IS NOT DISTINCT FROM d.source AND c.upto <= d.u GROUP BY ALL)
SELECT doc_id, text, source, replica::INT AS replica,
       md5(concat_ws('|', '12', coalesce(doc_id::VARCHAR, ''), coalesce(text, ''), replica::VARCHAR)) AS mix_key
FROM (SELECT doc_id, text, source, unnest(range(n)) AS replica FROM counted)
"""
