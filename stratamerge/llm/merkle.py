"""Merkle manifest of a table: a digest for every row, and a proof that it belongs to the root.

Rows are the leaves of one tree for each value of `by`, in the order of their key. Every
`fan` consecutive nodes, of the last run what is left, become the SHA-256 of their
concatenated hex digests, until one node is left: the subroot. Subroots, in the order of
`by`, become the root in the same way.

Trees are cut into blocks of fan^height leaves. A task holds one block: its digests and,
for each parent, copies of the hash state before each child slot. Replacing a child resumes
the state before its slot with the replacement and the siblings to its right only; what is
left of it is never hashed again. The roots of blocks are the leaves of the next tier, so a
tree of n leaves needs log(n) / (height log(fan)) tiers. On the way back every block gets
the path from its root to the top: the runs of siblings it passes, and its slots.

A null value counts as `-`, so it differs from the text `-`; an empty text is `0:`. Texts
are hashed whole, by Spark, whatever their length. Rows with a null key come first. Rows
that are equal are leaves each; of rows with the same key the one with the smaller digest
comes first. An empty table has no root and gives an empty result. Columns to be kept are
carried, whatever their names, unless an output is named alike; others are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, ranked, runs, unpacked, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEVEL = T.StructType().add("slot", "integer").add("run", T.ArrayType(T.StringType()))
PATH = T.StructType().add("subroot", "string").add("root", "string").add("levels", T.ArrayType(LEVEL))


def field(value: Column) -> Column:
    """`-` for null, else the value's length in UTF-8 bytes, a colon, and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


class Block:
    """Nodes of consecutive leaves by level, and the hash states before each child slot of their parents."""

    def __init__(self, leaves: list[bytes], fan: int, height: int | None):
        """height: so many levels; None: until one node is left."""
        self.fan, self.levels, self.states = fan, [leaves], []
        while len(self.levels[-1]) > 1 if height is None else len(self.states) < height:
            below, above, states = self.levels[-1], [], []
            for at in range(0, len(below), fan):
                h = sha256()
                for child in below[at : at + fan]:
                    states.append(h.copy())
                    h.update(child)
                above.append(h.hexdigest().encode())
            self.levels.append(above)
            self.states.append(states)

    def steps(self, at: int) -> Iterator[tuple[int, list[bytes], object]]:
        """For the leaf at a place, level by level: its slot, its run and the state before the slot."""
        for level, states in zip(self.levels, self.states, strict=False):
            slot = at % self.fan
            yield slot, level[at - slot : at - slot + self.fan], states[at]
            at //= self.fan


def fold(leaf: bytes, steps: list[tuple[object, bytes]]) -> bytes:
    """The top that a leaf leads to: each state is resumed with the node and the siblings right of it."""
    for state, right in steps:
        h = state.copy()
        h.update(leaf)
        h.update(right)
        leaf = h.hexdigest().encode()
    return leaf


def resumed(slot: int, run: list[bytes], state) -> tuple[object, bytes]:
    return state, b"".join(run[slot + 1 :])


def beside(slot: int, run: list[bytes]) -> bytes:
    return b"".join(run[:slot] + run[slot + 1 :])


@dataclass
class Manifest:
    """leaves: (own, tree, leaf, changed, rank, total); tiers: (tree, rank, total, digest) below each tier of blocks; paths: (tree, path) from subroots to the root."""

    leaves: DataFrame
    tiers: list[DataFrame]
    paths: DataFrame
    kept: list[str]
    fan: int
    height: int


def tops(rows: DataFrame, fan: int, height: int) -> DataFrame:
    """(tree, rank, total, digest) of the roots of the blocks of rows of the same columns."""
    size = fan**height

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in runs(batches, ["tree", "block"]):
            total = some.column("total")[0].as_py()
            top = Block([x.encode() for x in some.column("digest").to_pylist()], fan, height if total > size else None).levels[-1][0]
            yield pa.RecordBatch.from_arrays([some.column("tree").slice(0, 1).combine_chunks(), some.column("block").slice(0, 1).combine_chunks(), pa.array([-(-total // size)], pa.int64()), pa.array([top.decode()])], names=["tree", "rank", "total", "digest"])

    dealt = rows.select("tree", F.floor(F.col("rank") / size).alias("block"), "rank", "total", "digest")
    return dealt.repartition("tree", "block").sortWithinPartitions("tree", "block", "rank").mapInArrow(build, rows.select("tree", "rank", "total", "digest").schema)


def grown(rows: DataFrame, fan: int, height: int) -> tuple[list[DataFrame], DataFrame]:
    """The tiers (tree, rank, total, digest) from rows up, each written, and (tree, digest) of the trees' tops."""
    tiers, done = [], []
    while True:
        tiers.append(rows)
        above = written(tops(rows, fan, height), "tier")
        done.append(above.where("total = 1").select("tree", "digest"))
        rows = above.where("total > 1")
        if rows.isEmpty():
            out = done[0]
            for more in done[1:]:
                out = out.union(more)
            return tiers, out


def meeting(rows: DataFrame, above: DataFrame, size: int) -> DataFrame:
    """Blocks of rows, each after the row that holds its path: above has (tree, rank, path)."""
    block = F.floor(F.col("rank") / size)
    both = rows.withColumn("block", block).unionByName(above.select("tree", F.col("rank").alias("block"), F.lit(-1).cast("long").alias("rank"), "path"), allowMissingColumns=True)
    return both.repartition("tree", "block").sortWithinPartitions("tree", "block", "rank")


def descended(tiers: list[DataFrame], above: DataFrame, fan: int, height: int) -> DataFrame:
    """(tree, rank, path) of the rows of the lowest of some tiers; above: (tree, path) of the trees' tops."""
    size, found = fan**height, None
    for rows in reversed(tiers):

        def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for some in runs(batches, ["tree", "block"]):
                path = some.column("path")[0].as_py()
                if path is None or some.num_rows == 1:  # the path of a tree that ended in another tier
                    continue
                some = some.slice(1)
                block = Block([x.encode() for x in some.column("digest").to_pylist()], fan, height if some.column("total")[0].as_py() > size else None)
                paths = [path | {"levels": [{"slot": slot, "run": [x.decode() for x in run]} for slot, run, _ in block.steps(i)] + path["levels"]} for i in range(some.num_rows)]
                yield pa.RecordBatch.from_arrays([some.column("tree").combine_chunks(), some.column("rank").combine_chunks(), pa.array(paths, kind)], names=["tree", "rank", "path"])

        kind = pa.struct([("subroot", pa.string()), ("root", pa.string()), ("levels", pa.list_(pa.struct([("slot", pa.int32()), ("run", pa.list_(pa.string()))])))])
        parents = ended(rows, above, size) if found is None else found.unionByName(ended(rows, above, size))
        schema = T.StructType([rows.schema["tree"], T.StructField("rank", T.LongType()), T.StructField("path", PATH)])
        found = written(meeting(rows.select("tree", "rank", "total", "digest"), parents, size).mapInArrow(extend, schema), "paths")
    return found


def ended(rows: DataFrame, above: DataFrame, size: int) -> DataFrame:
    """(tree, rank, path) for the trees of rows that are one block: its path is that of the tree."""
    trees = rows.where((F.col("rank") == 0) & (F.col("total") <= size)).select(F.col("tree").alias("_tree"))
    return above.join(trees, F.col("tree").eqNullSafe(F.col("_tree"))).select("tree", F.lit(0).cast("long").alias("rank"), "path")


def manifest(docs: DataFrame, key: str = "doc_id", by: str = "lang", fields: tuple[str, ...] = FIELDS, keep: tuple[str, ...] = ("doc_id",), changed: Column | None = None, fan: int = 2, height: int = 12) -> Manifest:
    """Digests of all rows and the tree above them. keep: columns to carry; changed: another digest of a row, to be checked by `proofs`."""
    own, kept = carried(docs.select(*[F.col(f"`{c}`") for c in keep]))
    leaf = leaf_digest(*[F.col(f"`{c}`") for c in fields])
    rows = docs.select(own.alias("own"), F.col(by).alias("tree"), F.col(key).alias("key"), leaf.alias("digest"), (F.lit(None).cast("string") if changed is None else changed).alias("changed"))
    leaves = ranked(written(rows, "leaves"), "tree", "key", "digest")
    tiers, subroots = grown(leaves, fan, height)
    # the same above the trees, as one tree without a name
    named = ranked(written(subroots.select(F.lit("").alias("all"), "tree", "digest"), "subroots"), "all", "tree").withColumnRenamed("tree", "name").withColumn("tree", F.col("all"))
    upper, root = grown(named, fan, height)
    start = root.select("tree", F.struct(F.lit("").alias("subroot"), F.col("digest").alias("root"), F.array().cast(T.ArrayType(LEVEL)).alias("levels")).alias("path"))
    found = descended(upper, start, fan, height).select("rank", "path")
    paths = named.join(found, "rank").select(F.col("name").alias("tree"), F.struct(F.col("digest").alias("subroot"), F.col("path.root").alias("root"), F.col("path.levels").alias("levels")).alias("path"))
    return Manifest(leaves, tiers, written(paths, "tops"), kept, fan, height)


def proofs(m: Manifest) -> DataFrame:
    """The carried columns with leaf, subroot, root, proof_sha256 (of all siblings up to the root), folded_root and verified.

    folded_root comes from the row's changed digest where it has one, else its own, and the
    siblings of the manifest; verified: whether it is the root.
    """
    size, fan, height = m.fan**m.height, m.fan, m.height
    above = descended(m.tiers[1:], m.paths, fan, height) if m.tiers[1:] else None
    here = ended(m.tiers[0], m.paths, size)
    parents = here if above is None else above.unionByName(here)
    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in runs(batches, ["tree", "block"]):
            path = some.column("path")[0].as_py()
            if path is None:
                raise ValueError("a block without a path to the root")
            rows = some.slice(1)
            leaves, changed = ([x and x.encode() for x in rows.column(c).to_pylist()] for c in ("digest", "changed"))
            if not leaves:
                continue
            block = Block(leaves, fan, height if rows.column("total")[0].as_py() > size else None)
            upper, siblings = [], []
            for level in path["levels"]:
                slot, run = level["slot"], [x.encode() for x in level["run"]]
                upper.append(resumed(slot, run, sha256(b"".join(run[:slot]))))
                siblings.append(beside(slot, run))
            rest, proof, folded = b"".join(siblings), [], []
            for i, leaf in enumerate(leaves):
                steps = list(block.steps(i))
                proof.append(sha256(b"".join([beside(slot, run) for slot, run, _ in steps]) + rest).hexdigest())
                folded.append(fold(changed[i] or leaf, [resumed(*s) for s in steps] + upper).decode())
            n = len(leaves)
            yield pa.RecordBatch.from_arrays([rows.column("own").combine_chunks(), rows.column("digest").combine_chunks(), pa.array([path["subroot"]] * n), pa.array([path["root"]] * n), pa.array(proof), pa.array(folded)], names=["own", *names])

    schema = T.StructType([m.leaves.schema["own"], *[T.StructField(n, T.StringType()) for n in names]])
    out = meeting(m.leaves.select("own", "tree", "rank", "total", "digest", "changed"), parents, size).mapInArrow(check, schema)
    own = unpacked("own", m.kept)
    return out.select(*[c for c, n in zip(own, m.kept, strict=True) if n not in (*names, "verified")], *names, (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_manifest(docs: DataFrame) -> DataFrame:
    odd = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False)) & F.col("n_chars").isNotNull()
    more = [F.col("n_chars").cast("decimal(38,0)") + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    m = manifest(docs, changed=F.when(odd, leaf_digest(*more)))
    return proofs(m).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def value_sql(c: str) -> str:
    return f"coalesce(strlen(({c})::VARCHAR)::VARCHAR || ':' || ({c})::VARCHAR, '-')"


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text (polynomial 0xEDB88320, bits reversed)."""
    bits = "list_reduce([0,0,0,0,0,0,0,0], lambda a, _: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, xor(c, b)::BIGINT)"
    return f"xor(list_reduce(list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT), lambda c, b: {bits}, 4294967295::BIGINT), 4294967295)"


OP13_SQL = f"""WITH RECURSIVE leaves AS (SELECT doc_id, lang, sha256({' || '.join(map(value_sql, FIELDS))}) AS leaf,
    CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 7 = 0 THEN sha256({' || '.join(value_sql('n_chars + 1' if c == 'n_chars' else c) for c in FIELDS)}) END AS changed FROM documents),
  low AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
  tree AS (SELECT lang, 0 AS lvl, i, n, leaf AS h FROM low UNION ALL SELECT lang, lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM tree WHERE n > 1 GROUP BY lang, lvl, i // 2, n),
  subs AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
  cap AS (SELECT 0 AS lvl, i, n, h FROM subs UNION ALL SELECT lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM cap WHERE n > 1 GROUP BY lvl, i // 2, n),
  up AS (SELECT doc_id, leaf, lang, 0 AS lvl, i, n, coalesce(changed, leaf) AS f, '' AS proof, leaf AS tie FROM low
    UNION ALL SELECT u.doc_id, u.leaf, u.lang, u.lvl + 1, u.i // 2, (u.n + 1) // 2, sha256(CASE WHEN u.i % 2 = 0 THEN u.f || coalesce(t.h, '') ELSE t.h || u.f END), u.proof || coalesce(t.h, ''), u.tie
    FROM up u LEFT JOIN tree t ON t.lang IS NOT DISTINCT FROM u.lang AND t.lvl = u.lvl AND t.i = xor(u.i, 1) WHERE u.n > 1),
  top AS (SELECT u.doc_id, u.leaf, s.h AS subroot, 0 AS lvl, s.i, s.n, u.f, u.proof FROM up u JOIN subs s ON s.lang IS NOT DISTINCT FROM u.lang WHERE u.n = 1
    UNION ALL SELECT u.doc_id, u.leaf, u.subroot, u.lvl + 1, u.i // 2, (u.n + 1) // 2, sha256(CASE WHEN u.i % 2 = 0 THEN u.f || coalesce(t.h, '') ELSE t.h || u.f END), u.proof || coalesce(t.h, '')
    FROM top u LEFT JOIN cap t ON t.lvl = u.lvl AND t.i = xor(u.i, 1) WHERE u.n > 1)
SELECT doc_id, leaf, subroot, (SELECT h FROM cap WHERE n = 1) AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = (SELECT h FROM cap WHERE n = 1) AS verified FROM top WHERE n = 1"""
