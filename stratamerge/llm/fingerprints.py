"""Document fingerprints of closed syncmers, in DataFrame functions only.

A text is a sequence of tokens: words, long ones in pieces of at most eight characters.
Every two neighbouring tokens are an s-mer, every six tokens a k-mer of five s-mers. A
k-mer is an anchor if the least of its s-mers' hashes is its first or its last. Whether
it is depends on its own tokens alone, so an edit changes anchors only near itself, and
anchors of two texts can be matched by code and position.

Null texts count as empty and have no anchors. A text of fewer than six tokens has one
anchor, of all its tokens. Two texts without anchors are alike (1.0). Rows without an id
follow all others, by the hash of their text; rows of equal id come by that hash, and
copies among them in any order, which makes no difference. Columns other than id and
text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

TOKEN = r"[^\x20\x09-\x0D]{1,8}"
SMERS = 5  # of two tokens each in a k-mer
EDGES = 100_000  # so many bucket edges are broadcast at most; more are joined by shuffle


def let(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def closed_syncmers(text: Column) -> Column:
    """array<struct<at, code>>: the anchors of a text, by token position."""

    def anchor(code: Column, at: Column) -> Column:
        return F.struct(at.cast("int").alias("at"), F.pmod(code, F.lit(1 << 31)).cast("int").alias("code"))

    def of_smers(s: Column) -> Column:
        def pick(x: Column, i: Column) -> Column:
            last = F.get(s, i + SMERS - 1)
            inner = F.least(*[F.get(s, i + j) for j in range(1, SMERS - 1)])
            return F.when(last.isNotNull() & (F.least(x, last) <= inner), anchor(F.xxhash64(x, *[F.get(s, i + j) for j in range(2, SMERS, 2)]), i))

        return F.array_compact(F.transform(s, pick))

    def of_tokens(t: Column) -> Column:
        smers = F.slice(F.transform(t, lambda w, i: F.xxhash64(w, F.get(t, i + 1))), 1, F.greatest(F.size(t) - 1, F.lit(0)))
        few = F.when(F.size(t) > 0, F.array(anchor(F.xxhash64(t), F.lit(0)))).otherwise(F.array().cast("array<struct<at:int,code:int>>"))
        return F.when(F.size(t) > SMERS, let(smers, of_smers)).otherwise(few)

    return let(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0)), of_tokens)


def codes(text: Column) -> Column:
    """Distinct anchor codes in order of their first occurrence."""
    return F.array_distinct(F.transform(closed_syncmers(text), lambda a: a["code"]))


def likeness(a: Column, b: Column) -> Column:
    """Share of anchors in common: twice the common ones over all."""
    both = F.size(a) + F.size(b)
    return F.when(both > 0, 2.0 * F.size(F.array_intersect(a, b)) / both).otherwise(1.0)


def printed(c: Column) -> Column:
    return F.array_join(c.cast("array<string>"), " ")


def with_next(docs: DataFrame, rows_a_bucket: int = 8000, ranges: int = 256) -> DataFrame:
    """doc_id, text and codes with those of the next row by descending doc_id (the first again after the last).

    Rows are dealt into buckets of consecutive ids; each bucket also gets the first row of
    the one after it. So texts are shuffled once, and no task sees more than a bucket.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("_o", -F.col("doc_id").cast("long")).withColumn("_h", F.xxhash64("text"))
    n, least, most, *_ = rows.agg(F.count(F.lit(1)), F.min("_o"), F.max("_o")).first()
    parts = max(1, -(-n // rows_a_bucket))
    some = min(ranges, parts)
    within = -(-parts // some)  # equal slices of each range, where ranges alone are too few
    cuts = rows.agg(F.percentile_approx("_o", [i / some for i in range(1, some)] or [0.5], 10_000)).first()[0] or []
    cuts = sorted(set(cuts)) if some > 1 else []
    bounds = [least or 0, *cuts, (most or 0) + 1]
    literal = F.array(*[F.lit(x).cast("long") for x in bounds])
    at = F.size(F.filter(literal, lambda x: x <= F.col("_o"))) - 1
    low, high = F.get(literal, F.col("_at")), F.get(literal, F.col("_at") + 1)
    slot = F.floor((F.col("_o") - low) * F.lit(within) / F.greatest(high - low, F.lit(1)))
    null_slot = F.floor((F.col("_h") / F.lit(2.0**64) + 0.5) * F.lit(parts))
    rows = rows.withColumn("_at", at)
    rows = rows.withColumn("_b", F.when(F.col("_o").isNull(), F.lit(len(bounds) * within) + null_slot).otherwise(F.col("_at") * within + F.least(slot, F.lit(within - 1)))).drop("_at")
    key = F.struct(F.col("_o").isNull().alias("none"), F.col("_o").alias("o"), F.col("_h").alias("h"))
    edges = written(rows.groupBy("_b").agg(F.min(key).alias("first")), "edges")
    every = Window.orderBy("_b")  # one row per bucket
    back = F.coalesce(F.lag("_b").over(every), F.max("_b").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    edges = edges.select(F.col("first.o").alias("_eo"), F.col("first.h").alias("_eh"), back.alias("_to"))
    if parts <= EDGES:
        edges = F.broadcast(edges)
    placed = rows.join(edges, F.col("_o").eqNullSafe(F.col("_eo")) & (F.col("_h") == F.col("_eh")), "left")
    own, halo = F.struct(F.col("_b").alias("b"), F.lit(False).alias("halo")), F.struct(F.col("_to").alias("b"), F.lit(True).alias("halo"))
    placed = placed.select("doc_id", "text", "_o", "_h", F.explode(F.when(F.col("_to").isNull(), F.array(own)).otherwise(F.array(own, halo))).alias("_p"))
    placed = placed.select("doc_id", "text", "_o", "_h", F.col("_p.b").alias("_b"), F.col("_p.halo").alias("_halo")).repartition("_b")
    placed = placed.withColumn("codes", codes(F.col("text")))
    order = Window.partitionBy("_b").orderBy("_halo", F.col("_o").asc_nulls_last(), "_h")
    found = placed.select("doc_id", "text", "codes", "_halo", F.lead("text").over(order).alias("next_text"), F.lead("codes").over(order).alias("next_codes"))
    return found.where("NOT _halo").drop("_halo")


def op6_fingerprints(docs: DataFrame) -> DataFrame:
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    rows = rows.withColumn("edited", F.concat(F.left("text", F.col("n_chars").cast("int") - cut), F.left("next_text", cut)))
    rows = rows.withColumn("edited_codes", codes(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), printed(F.col("codes")).alias("fingerprint"), printed(F.col("edited_codes")).alias("edited_fingerprint"),
        likeness(F.col("codes"), F.col("edited_codes")).alias("near_edited"), likeness(F.col("codes"), F.col("next_codes")).alias("near_next"),
    )
