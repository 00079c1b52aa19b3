"""The prefix trie against a plain one, on rebuilt and on given conversations."""

from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from stratamerge.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(convs):
    """Nodes of {id: [(role, text), ...]}, by walking every path."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for path, ids in members.items():
        subtree = [p for p in members if p[: len(path)] == path]
        children = [p for p in subtree if len(p) == len(path) + 1]
        leaves = [p for p in subtree if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in subtree)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in subtree if p)
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(path))
        out.add((min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids), len(children), len(leaves), saved, sha256(ends.encode()).hexdigest()))
    return out


def plain_rebuilt(rows):
    own = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if c is not None:
            own.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def some_rows():
    rows = []
    for c in [*range(1, 60), 1000, 1001, 1004, 7777777]:
        if c % 10 == 0:
            continue  # conversations without the one they begin with
        for t in range(c % 12 + (300 if c == 1001 else 0)):
            rows.append((c, None if t == 0 and c % 3 == 0 else t + 1, [None, "user", "bot"][t % 3], ["ä" * 3, None, "", "same"][(t + c % 2) % 4]))
    return rows + [(None, 1, "user", "nobody's"), (2000, 1, "user", "x" * 300_000), (2001, 1, "user", "x" * 300_000)]


def test_rebuilt_against_plain(spark):
    rows = some_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7).withColumns({"rank": F.lit(1), "total": F.lit("clash")})
    got = trie.op11_prefix_trie(docs).collect()
    want = plain(plain_rebuilt(rows))
    assert len(got) == len(want) and {tuple(r) for r in got} == want


@pytest.mark.parametrize("width", [1, 3])
def test_trie_of_given_conversations(spark, width):
    convs = {i: [("u", "ab"[: k % 3]) for k in range(i % 7)] for i in range(40)} | {-3: [("u", "")] * 5, 99: []}
    turns = spark.createDataFrame([(c, d, *t) for c, ts in convs.items() for d, t in enumerate(ts)], "conv_id long, at long, role string, text string")
    turns = turns.select("conv_id", "at", F.xxhash64("role", "text").alias("a"), F.xxhash64("text").alias("b"), F.octet_length("text").cast("long").alias("n"))
    lengths = spark.createDataFrame([(c, len(ts)) for c, ts in convs.items()], "conv_id long, length long")
    got = trie.prefix_trie(turns, lengths, width).collect()
    assert len(got) == len(plain(convs)) and {tuple(r) for r in got} == plain(convs)


def test_trie_of_nothing(spark):
    assert trie.op11_prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_ids_that_end_at_one_node_are_chunked(spark):
    ends = spark.range(30_000).select(F.lit(2).cast("long").alias("depth"), F.lit(5).cast("long").alias("k1"), F.lit(7).cast("long").alias("k2"), (F.col("id") - 9).alias("conv_id"))
    (row,) = trie.end_digests(ends.repartition(6)).collect()
    assert row["n_ends"] == 30_000 and row["ends_sha256"] == sha256(",".join(str(i - 9) for i in range(30_000)).encode()).hexdigest()
