"""Prefix trie of conversations: which of them share their first turns, and what that saves.

A turn's id is two 64-bit hashes of its role and text, with the text's bytes. Turn ids stand in
positional columns, `WIDTH` of them in a row. One ROLLUP over these columns aggregates all
prefixes together; grouping_id says how many columns a row's prefix has. A conversation
that is longer goes on in further rows, each grouped under the node that the row before
it ends at: a node's key is its depth and the XOR of two hashes of every (position, turn).

What a subtree holds is summed over its conversations, in a second ROLLUP: every node
belongs to its smallest member, so a conversation adds its bytes that smaller ones brought
already, and 1 for a leaf of its own. No path is walked and no level waits for another.

Null roles and texts are empty; a text is hashed whole, whatever its length. Rows
without a conversation id belong to none. Turns with the same number go in the order of
their hashes, and repeated turns count each. Rows of a conversation are numbered by
`ranked`, so one that holds many of all rows is spread over tasks; only its rows of WIDTH
turns pass one task, streamed. Other columns are not read. An empty table gives no nodes,
not even a root.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import discard
from .common import ranked, written

WIDTH = 8
CHUNK = 4096  # ids that are joined into one text before they are hashed


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, rank, total, a, b, n) of every turn: its place, the number of turns, its id and its text's bytes."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    ids = F.xxhash64(role, text).alias("a"), F.xxhash64(text, role, F.lit(1)).alias("b")
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *ids, F.octet_length(text).cast("long").alias("n"))
    return ranked(written(rows, "turns"), "conv_id", "turn", "a", "b", name="turns").drop("turn")


def rebuilt(turns: DataFrame, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, at, a, b, n) of rebuilt conversations, and all of these (conv_id, length).

    The first h turns come from the conversation whose id is the next multiple of `group`
    towards 0, h = crc32(id) mod heads; the others are its own after its first h.
    """
    convs = turns.where("rank = 0").select("conv_id", "total").withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")).withColumn("source", F.col("conv_id") - F.col("conv_id") % group)
    lengths = convs.select(F.col("conv_id").alias("source"), F.col("total").alias("there"))
    taken = F.least(F.col("h").cast("long"), F.coalesce("there", F.lit(0).cast("long")))
    convs = written(convs.join(lengths, "source", "left").select("conv_id", "source", "h", taken.alias("taken"), (taken + F.greatest(F.col("total") - F.col("h"), F.lit(0))).alias("length")), "convs")
    own = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where("rank >= h").select("conv_id", (F.col("rank") - F.col("h") + F.col("taken")).alias("at"), "a", "b", "n")
    first = turns.where(F.col("rank") < heads - 1).withColumnRenamed("conv_id", "source")  # few rows of each source, read by few conversations
    lent = first.join(convs.select("source", "conv_id", "h"), "source").where("rank < h").select("conv_id", F.col("rank").alias("at"), "a", "b", "n")
    return own.union(lent), convs.select("conv_id", "length")


def mark(at: Column, a: Column, b: Column, which: int) -> Column:
    """Hash of a turn at its position; a prefix's key is the XOR of those of its turns."""
    return F.xxhash64(at, a, b) if which == 1 else F.xxhash64(b, a, at, F.lit(2))


def blocks_of(turns: DataFrame, convs: DataFrame, width: int) -> DataFrame:
    """Rows of `width` turns, t1, t2, ... (null behind the last), with the key (p1, p2) and the bytes (before) of the turns before them; one row of nulls for a conversation without turns."""
    block = F.expr(f"at div {width}").alias("block")
    one = turns.groupBy("conv_id", block).agg(
        F.sort_array(F.collect_list(F.struct("at", "a", "b", "n"))).alias("ts"), F.sum("n").alias("bytes"),  # `width` turns at most
        *[F.bit_xor(mark(F.col("at"), F.col("a"), F.col("b"), i)).alias(f"x{i}") for i in (1, 2)],
    )
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    prior = [F.coalesce(F.bit_xor(f"x{i}").over(before), F.lit(0).cast("long")).alias(f"p{i}") for i in (1, 2)]
    turn = lambda i: F.get("ts", F.lit(i))
    ids = [F.when(turn(i).isNotNull(), F.struct(turn(i)["a"].alias("a"), turn(i)["b"].alias("b"), turn(i)["n"].alias("n"))).alias(f"t{i + 1}") for i in range(width)]
    rows = one.select("conv_id", "block", *prior, F.coalesce(F.sum("bytes").over(before), F.lit(0).cast("long")).alias("before"), *ids)
    none = convs.where("length = 0").select("conv_id", *[F.lit(0).cast("long").alias(c) for c in ("block", "p1", "p2", "before")])
    return rows.unionByName(none, allowMissingColumns=True)


def prefixes(blocks: DataFrame, aggregates: str, width: int) -> DataFrame:
    """One row a prefix: depth, key (k1, k2), the parent's key (u1, u2), the bytes above its last turn, and aggregates over the blocks that begin with it."""
    ts = [f"t{i + 1}" for i in range(width)]
    rolled = blocks.sparkSession.sql(
        f"SELECT block, p1, p2, {', '.join(ts)}, bit_count(grouping_id()) AS hidden, min(before) AS before, {aggregates} FROM {{blocks}} GROUP BY block, p1, p2, ROLLUP({', '.join(ts)})",
        blocks=blocks,
    )
    own = F.lit(width) - F.col("hidden")
    last = F.get(F.array(*ts), own - 1)
    rolled = rolled.withColumn("own", own).withColumn("last", F.when(F.col("own") > 0, last)).where("last IS NOT NULL OR own = 0 AND block = 0")
    depth, at = F.col("block") * width + F.col("own"), lambda i: F.col("block") * width + i
    key = lambda i: [F.coalesce(mark(at(j), F.col(t)["a"], F.col(t)["b"], i), F.lit(0).cast("long")) for j, t in enumerate(ts)]
    columns = [depth.alias("depth")]
    for i in (1, 2):
        whole = F.col(f"p{i}")
        for j, t in enumerate(ts):
            whole = whole.bitwiseXOR(F.when(F.col(t).isNotNull(), key(i)[j]).otherwise(F.lit(0).cast("long")))
        columns += [whole.alias(f"k{i}"), F.when(F.col("own") > 0, whole.bitwiseXOR(mark(depth - 1, F.col("last.a"), F.col("last.b"), i))).alias(f"u{i}")]
    above = F.col("before") + sum([F.coalesce(F.col(t)["n"], F.lit(0).cast("long")) for t in ts], F.lit(0).cast("long")) - F.coalesce(F.col("last.n"), F.lit(0).cast("long"))
    names = [c for c in rolled.columns if c not in ("block", "p1", "p2", *ts, "hidden", "before", "own", "last")]
    return rolled.select(*columns, above.alias("above"), *names)


NODE = ("depth", "k1", "k2")


def end_digests(ends: DataFrame) -> DataFrame:
    """depth, k1, k2, n_ends and ends_sha256 (of the ascending ids, joined by commas) of the nodes at which conversations end.

    Ids of a node that many conversations end at are joined in parts by many tasks; one task
    hashes these parts in order.
    """

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            new = np.zeros(batch.num_rows, bool)
            new[::CHUNK] = True
            for c in columns[:3]:
                new[1:] |= c[1:] != c[:-1]
            begin = np.flatnonzero(new)
            ids = columns[3].tolist()
            end = np.append(begin[1:], batch.num_rows)
            texts = [",".join(map(str, ids[a:b])) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*[pa.array(c[begin]) for c in columns], pa.array(end - begin), pa.array(texts, pa.string())], names=[*NODE, "first", "n", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h, count = None, None, 0
        for batch in batches:
            out = []
            for *node, _, n, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if node != now:
                    if now is not None:
                        out.append((*now, count, h.hexdigest()))
                    now, h, count = node, sha256(), 0
                h.update((("," if count else "") + ids).encode())
                count += n
            yield made(out)
        if now is not None:
            yield made([(*now, count, h.hexdigest())])

    def made(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 4 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=[*NODE, "n_ends", "ends_sha256"])

    order = [*NODE, "conv_id"]
    rows = ends.repartitionByRange(*order).sortWithinPartitions(*order).select(*order).mapInArrow(parts, "depth long, k1 long, k2 long, first long, n long, ids string")
    return rows.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digest, "depth long, k1 long, k2 long, n_ends long, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Nodes of the trie of conversations: turns (conv_id, at, a, b, n) at 0, 1, ...; convs (conv_id, length), those without turns too.

    Per node: conv_id (its smallest member) and depth, which name it; parent_conv_id, n_convs,
    n_children, n_leaves of its subtree, saved_tokens (bytes of last texts times members but
    one, over the subtree), ends_sha256 of the members that end there.
    """
    zero = F.lit(0).cast("long")
    turns = written(turns, "rebuilt")
    blocks = written(blocks_of(turns, convs, width), "blocks")
    sums = turns.groupBy("conv_id").agg(F.sum("n").alias("bytes"), *[F.bit_xor(mark(F.col("at"), F.col("a"), F.col("b"), i)).alias(f"k{i}") for i in (1, 2)])
    ends = written(convs.join(sums, "conv_id", "left").select("conv_id", F.col("length").alias("depth"), *[F.coalesce(c, zero).alias(c) for c in ("bytes", "k1", "k2")]), "ends")
    discard(turns)
    nodes = prefixes(blocks, "min(conv_id) AS conv_id, count(*) AS n_convs", width)
    nodes = nodes.join(end_digests(ends), list(NODE), "left").withColumns({"n_ends": F.coalesce("n_ends", zero), "ends_sha256": F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))})
    nodes = written(nodes, "nodes")
    # of conversations that are a node's smallest member: from which depth on, and alone from which
    top = F.min(F.struct("depth", "u1", "u2"))
    owners = nodes.groupBy("conv_id").agg(
        top.alias("top"), F.max("depth").alias("length"), F.min("above").alias("brought"), F.min(F.when(F.col("n_convs") == 1, F.col("depth"))).alias("alone"),
        F.max((F.col("n_convs") == F.col("n_ends")).cast("long")).alias("leaf"),
    )
    owners = written(owners.select("conv_id", "top.*", "length", "brought", "alone", "leaf"), "owners")
    shares = ends.select("conv_id", "bytes").join(owners.select("conv_id", "brought", "alone", "leaf"), "conv_id", "left")
    shares = shares.select("conv_id", F.coalesce("brought", "bytes").alias("share"), "alone", F.coalesce("leaf", zero).alias("leaf"))
    crowded = blocks.join(shares, "conv_id").where(f"alone IS NULL OR alone > block * {width} + 1 OR block = 0")
    inner = prefixes(crowded, "sum(share) AS shares, sum(leaf) AS leaves, count(*) AS members", width).where("members > 1").select(*NODE, "shares", "leaves")
    branch = owners.where("depth > 0").select("conv_id", (F.col("depth") - 1).alias("depth"), F.col("u1").alias("k1"), F.col("u2").alias("k2"))
    parents = branch.join(nodes.select(*NODE, F.col("conv_id").alias("parent")), list(NODE)).select("conv_id", "parent")
    many = branch.groupBy(*NODE).agg(F.count(F.lit(1)).alias("branches"))
    tops = owners.join(parents, "conv_id", "left").select("conv_id", F.col("depth").alias("top"), "length", "brought", "parent")
    out = nodes.join(inner, list(NODE), "left").join(many, list(NODE), "left").join(tops, "conv_id")
    return out.select(
        "conv_id", "depth", F.when(F.col("depth") > F.col("top"), F.col("conv_id")).otherwise(F.col("parent")).alias("parent_conv_id"), "n_convs",
        (F.coalesce("branches", zero) + F.when(F.col("length") > F.col("depth"), 1).otherwise(0)).alias("n_children"),
        F.coalesce("leaves", F.lit(1).cast("long")).alias("n_leaves"),
        F.coalesce(F.col("shares") - F.col("brought") - (F.col("n_convs") - 1) * F.col("above"), zero).alias("saved_tokens"), "ends_sha256",
    )


def op11_prefix_trie(conversations: DataFrame) -> DataFrame:
    return prefix_trie(*rebuilt(numbered(conversations)))


def op11_sql(crc32: str) -> str:
    """The trie by plain grouping of every prefix; crc32: SQL of the id's checksum."""
    return f"""WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS rank FROM conversations WHERE conv_id IS NOT NULL),
  convs AS (SELECT conv_id, conv_id - conv_id % 5 AS source, {crc32} % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
  rebuilt AS (SELECT c.conv_id, t.rank AS o, 0 AS own, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.source AND t.rank < c.h UNION ALL SELECT c.conv_id, t.rank, 1, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.rank >= c.h),
  placed AS (SELECT conv_id, row_number() OVER w AS depth, strlen(text) AS n, string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '' ORDER BY own, o) OVER (PARTITION BY conv_id ORDER BY own, o ROWS UNBOUNDED PRECEDING) AS path FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, o)),
  pre AS (SELECT conv_id, 0 AS depth, 0 AS n, sha256('') AS k FROM convs UNION ALL SELECT conv_id, depth, n, sha256(path) FROM placed),
  ends AS (SELECT conv_id, max(depth) AS depth, max_by(k, depth) AS k FROM pre GROUP BY conv_id),
  node AS (SELECT depth, k, min(conv_id) AS rep, count(*) AS n_convs, min(n) AS n FROM pre GROUP BY depth, k),
  named AS (SELECT n.*, coalesce(e.ids, '') AS ids, coalesce(e.c, 0) AS c FROM node n LEFT JOIN (SELECT depth, k, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids, count(*) AS c FROM ends GROUP BY depth, k) e USING (depth, k)),
  up AS (SELECT n.*, p.rep AS parent FROM named n LEFT JOIN pre q ON q.conv_id = n.rep AND q.depth = n.depth - 1 LEFT JOIN node p ON p.depth = q.depth AND p.k = q.k),
  below AS (SELECT q.depth, q.k, sum(n.n * (n.n_convs - 1)) AS saved, count(*) FILTER (n.n_convs = n.c) AS leaves, count(*) FILTER (n.depth = q.depth + 1) AS children FROM named n JOIN pre q ON q.conv_id = n.rep AND q.depth <= n.depth GROUP BY q.depth, q.k)
SELECT rep AS conv_id, u.depth::BIGINT AS depth, parent AS parent_conv_id, n_convs, children AS n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens, sha256(ids) AS ends_sha256 FROM up u JOIN below b USING (depth, k)"""
