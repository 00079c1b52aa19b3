"""Packing into length buckets of least padding.

A dynamic program over the global histogram of lengths chooses at most `buckets`
boundaries such that padding every document to its bucket's boundary costs least. In
each bucket, documents in a seeded random order form batches of as many rows as the
token budget holds at the boundary's length.

Every length that occurs has its own histogram cell, so the boundaries are optimal. D
different lengths add up to D * (D + 1) / 2 at least, so the histogram has at most
sqrt(2 * the corpus's length) cells: some millions of pairs of numbers for 100 TB. The
program takes cells * buckets steps on the driver.

Documents without a length (null) or with length 0 get bucket 0 of boundary 0 and no
batch. A document longer than the budget forms a batch of its own. Repeated rows are
packed each. Columns named like the outputs are replaced, others are passed on, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

from array import array

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, unpacked, written

OUTPUTS = ("bucket", "bucket_len", "batch", "slot", "padding")


def boundaries(cells: list[tuple[int, int, int]], buckets: int) -> list[int]:
    """Boundaries of least padding for cells (largest length, documents, sum of lengths), sorted by length.

    With C and S the running counts and sums, bucket (i, j] pads
    len_j * (C_j - C_i) - (S_j - S_i). For fixed j the choice of i is the lowest of lines
    with slopes -C_i, so each layer takes one sweep over a convex hull.
    """
    lens = [c[0] for c in cells]
    count, total = [0], [0]
    for _, n, s in cells:
        count.append(count[-1] + n)
        total.append(total[-1] + s)
    m = len(cells)
    best: list[int | None] = [0] + [None] * m
    choice: list[array] = []
    for _ in range(min(buckets, m)):
        hull: list[tuple[int, int, int]] = []  # slope, intercept, i
        new, came, at = [None] * (m + 1), array("l", [0]) * (m + 1), 0
        for j in range(1, m + 1):
            if best[j - 1] is not None:
                line = (-count[j - 1], best[j - 1] + total[j - 1], j - 1)
                while len(hull) > 1 and (line[1] - hull[-2][1]) * (hull[-2][0] - hull[-1][0]) <= (hull[-1][1] - hull[-2][1]) * (hull[-2][0] - line[0]):
                    hull.pop()
                hull.append(line)
                at = min(at, len(hull) - 1)
            if not hull:
                continue
            x = lens[j - 1]
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] <= hull[at][0] * x + hull[at][1]:
                at += 1
            new[j], came[j] = hull[at][0] * x + hull[at][1] + x * count[j] - total[j], hull[at][2]
        choice.append(came)
        # fewer buckets are never better, so the last layer that reaches m is the best
        best = new
    out, j = [], m
    for came in reversed(choice):
        if j:
            out.append(lens[j - 1])
            j = came[j]
    return out[::-1]


def pack(docs: DataFrame, length: str, buckets: int = 16, budget: int = 16384, rows_a_part: int = 20_000, seed: int = 7) -> DataFrame:
    """docs with bucket, bucket_len, batch (in the bucket), slot (in the batch) and padding.

    The order in a bucket is by hash. Its ranks come from equal parts by hash, each
    ranked on its own and shifted by the sizes of the parts before it, so no bucket
    passes through one task.
    """
    docs = docs.drop(*OUTPUTS)
    own, kept = carried(docs)
    plain = [i for i, c in enumerate(kept) if not isinstance(docs.schema[c].dataType, T.MapType | T.VariantType)]
    n = F.coalesce(F.col(f"`{length}`"), F.lit(0)).cast("long")
    table = docs.select(n.alias("n")).where("n > 0").groupBy("n").count().toPandas().sort_values("n")
    limits = boundaries(list(zip(table["n"].tolist(), table["count"].tolist(), (table["n"] * table["count"]).tolist(), strict=True)), buckets)
    parts = max(1, -(-int(table["count"].sum()) // rows_a_part))
    limit = F.array(*[F.lit(x).cast("long") for x in limits]) if limits else F.array().cast("array<long>")
    rows = docs.select(own.alias("own"), n.alias("n"), F.xxhash64(F.lit(seed), *[F.col(f"`{kept[i]}`") for i in plain]).alias("h"))
    rows = rows.withColumn("bucket", F.when(F.col("n") > 0, F.size(F.filter(limit, lambda x: x < F.col("n"))) + 1).otherwise(0))
    rows = rows.withColumn("bucket_len", F.coalesce(F.get(limit, F.col("bucket") - 1), F.lit(0))).withColumn("part", F.pmod("h", F.lit(parts)))
    sizes = rows.groupBy("bucket", "part").count()
    before = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("bucket", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("bucket", "part").orderBy("h", *[F.col("own").getField(f"c{i}") for i in plain])) - 1
    ranked = rows.withColumn("rank", rank).join(sizes, ["bucket", "part"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before"))
    fit = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest("bucket_len", F.lit(1))))
    some = F.col("bucket") > 0
    return ranked.select(
        *unpacked("own", kept), "bucket", "bucket_len",
        F.when(some, F.floor(F.col("rank") / fit)).alias("batch"), F.when(some, F.pmod("rank", fit)).alias("slot"),
        F.when(some, F.col("bucket_len") - F.col("n")).otherwise(0).alias("padding"),
    )


def word_count(text):
    """Number of words [^\\x20\\x09-\\x0D]+ (null: 0): each is counted at its last character."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r](?=[ \t-\r]|\z)")), F.lit(0)).cast("long")


def op2_packing(docs: DataFrame) -> DataFrame:
    return pack(written(docs.select("doc_id", word_count(F.col("text")).alias("n_words")), "lengths"), "n_words")
