"""Merkle manifest against a plain recursive one, with trees of many tiers."""

from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from stratamerge.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, more=0):
    values = [row[0], row[1], row[2], None if row[3] is None else row[3] + more, row[4]]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes, fan):
    """Levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + fan]) for i in range(0, len(levels[-1]), fan)])
    return levels


def plain(rows, fan):
    trees = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r))):
        trees.setdefault(r[2], []).append(r)
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    levels = {k: climb([plain_leaf(r) for r in trees[k]], fan) for k in order}
    top = climb([levels[k][-1][0] for k in order], fan)
    out = []
    for t, k in enumerate(order):
        for i, r in enumerate(trees[k]):
            odd = r[0] is not None and r[3] is not None and crc32(str(r[0]).encode()) % 7 == 0
            node, proof = plain_leaf(r, int(odd)), []
            for path, at in ((levels[k], i), (top, t)):
                for level in path[:-1]:
                    run = level[at // fan * fan : at // fan * fan + fan]
                    proof += run[: at % fan] + run[at % fan + 1 :]
                    node = h(*run[: at % fan], node, *run[at % fan + 1 :])
                    at //= fan
            out.append((r[0], plain_leaf(r), levels[k][-1][0], top[-1][0], h(*proof), node, node == top[-1][0]))
    return out


def some_rows(n):
    langs = ["de", None, "en", "", "ü", "en", "en"]
    rows = [(i * 37 % 1009, None if i % 5 == 0 else "s", langs[i % 7], None if i % 11 == 0 else i, [None, "", "äö€ " * (i % 9), "-"][i % 4]) for i in range(n)]
    return rows + rows[:3] + [(None, "x", "en", 3, "no id"), (None, None, None, None, None), (5, "s", "solo", 1, "x" * 300_000)]


@pytest.mark.parametrize(("fan", "height"), [(2, 2), (2, 12), (3, 1)])
def test_manifest_against_plain_trees(spark, fan, height):
    rows = some_rows(130)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("leaf", F.lit("clash")).withColumn("rank", F.lit(1))
    odd = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False)) & F.col("n_chars").isNotNull()
    changed = F.when(odd, merkle.leaf_digest(*[F.col(c) + 1 if c == "n_chars" else F.col(c) for c in merkle.FIELDS]))
    m = merkle.manifest(docs, changed=changed, fan=fan, height=height, keep=("doc_id", "rank"))
    got = merkle.proofs(m)
    assert got.columns == ["doc_id", "rank", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted((tuple(r) for r in got.drop("rank").collect()), key=key) == sorted(plain(rows, fan), key=key)


def test_manifest_of_nothing(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert merkle.op13_manifest(docs).collect() == []
    one = spark.createDataFrame([(1, None, None, None, None)], SCHEMA)
    (row,) = merkle.op13_manifest(one).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] == plain_leaf((1, None, None, None, None)) and row["verified"]
    assert row["proof_sha256"] == h()


def test_block_resumes_states():
    block = merkle.Block([h(str(i)).encode() for i in range(11)], 2, None)
    for i, leaf in enumerate(block.levels[0]):
        assert merkle.fold(leaf, [merkle.resumed(*s) for s in block.steps(i)]) == block.levels[-1][0]
        assert merkle.fold(b"x" * 64, [merkle.resumed(*s) for s in block.steps(i)]) != block.levels[-1][0]
