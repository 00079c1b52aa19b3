"""Exact n-gram Jaccard self-join by signature trees.

A document's set holds its distinct word shingles as 64-bit hashes; links are checked on
their upper 56 bits, which take less disk. Equal sets become
one node, named by a 64-bit hash of the set; links are sought between different sets.

1. Sets keep a prefix of their shingles in the order of their hashes. Two sets that link
   share a key in prefixes of |x| - ceil(t |x|) + 1 shingles, and l keys in prefixes that
   are l - 1 longer.
2. So a set without enough keys that other sets have too has no links. Shared passages
   alone don't make a set a candidate.
3. Keys of the same candidates are one block, with their number as its weight.
4. The sets of each block are checked against the block's least set (and large blocks in
   parts too, by a hash): links that are linear in the rows. Their components
   contract: the leaves of the trees are few sets of one component and of similar size, or
   a single set. A leaf's node holds the OR of its sets' token bitmaps, as wide as their
   sizes ask for, and their size range.
5. In each block, a tree over the nodes of its leaves is traversed against itself; node
   pairs go when their maximum possible overlap is below what any pair of their sizes
   needs, or when they are of one component. Leaves of a block with very many are dealt
   into small units, and pairs of units over the tasks.
   A leaf leaves out its most frequent blocks, as far as links can't depend on them. A pair
   that is left comes out of the least block that both leaves are in.
6. These pairs are verified set by set, with the same bound on pairs of sets first. Pairs
   that are connected already need no check. Steps 5 and 6 pass twice: first in large
   blocks, with a few partners of each leaf, in neighbouring units only, whose links
   contract a large group; then in all blocks, with all that are left in different
   components.
7. Components of the links are found by large and small stars.

Nulls and texts without words have an empty set and are linked with nothing. Repeated
rows are copies of each other. Components are named by their least id (null ids are
passed over; null if there is no other). A text is read whole, whatever its length. Of
ties nothing depends: links have no order. An empty table gives an empty result. Columns
other than key and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import discard, sweep
from .common import bit_table, in_table, mix, pieces, runs, shingles, utf8, written
from .components import components

LEAF = 16  # sets of a leaf at most
HOT = 128  # blocks of more sets are linked to several representatives
UNIT = 256  # about so many leaves of a block are compared in one step
GUESTS = 4096  # about so many sets meet one copy of their representative
VISITS = 64  # about so many leaves meet one copy of their host
FEW = 4  # partners of a leaf in a step of the first pass
LARGE = 32  # the first pass is for blocks of more sets
WAIT = 0.5  # seconds before large shuffles of a finished step are dropped
BITS = 2  # bits of a bitmap for each shingle, at least


def need(n, m, percent: int):
    """Least overlap of linked sets of sizes n and m: 100 * o >= percent * (n + m - o)."""
    return -(-(percent * (n + m)) // (100 + percent))


def short_prefix(n, percent: int):
    """Two sets that link share one of the first so many shingles of each, in any common order."""
    return n - -(-(percent * n) // 100) + 1


def extra(n):
    """So many more shingles of each must be shared if the prefixes are so much longer."""
    return n // 10


def set_ids(h: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """64-bit names of the sets: sums of mixed members, mixed with the size; 0 for the empty set."""
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(mix(h ^ np.uint64(0xA24BAED4963EE407)), out=sums[1:])
    n = np.diff(cuts).astype(np.uint64)
    return np.where(n > 0, mix(sums[cuts[1:]] - sums[cuts[:-1]] + n), 0).astype(np.uint64).view(np.int64)


def packed(members: np.ndarray) -> bytes:
    """The upper 56 bits of a set's hashes, in their order, 7 bytes each. That two of a pair's shingles agree in them by chance is as rare as that two sets have the same name."""
    return (members >> np.uint64(8)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def members_of(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 7, 8), np.uint8)
    wide[:, 1:] = np.frombuffer(data, np.uint8).reshape(-1, 7)
    return wide.reshape(-1).view("<u8")


def described(docs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """key, n_shingles, sid of every row."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in pieces(offsets, 1_000_000):
                h, cuts = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(cuts), pa.int64()), pa.array(set_ids(h, cuts))], names=[key, "n_shingles", "sid"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(describe, f"`{key}` {kind}, n_shingles long, sid long")


def prefix_keys(docs: DataFrame, text: str, k: int, percent: int) -> DataFrame:
    """(key, sid): the prefix of each set, by hash, where the task meets the set first. Not written: it would take about as much disk as its shuffle."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for i, j in pieces(offsets, 1_000_000):
                h, cuts = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
                n, sid, signed = np.diff(cuts), set_ids(h, cuts), h.view(np.int64)
                until = cuts[:-1] + np.minimum(short_prefix(n, percent) + extra(n), n)
                new = [r for r, s in enumerate(sid.tolist()) if n[r] and s not in met and not met.add(s)]
                count = (until - cuts[:-1])[new]
                keys = [signed[cuts[r] : until[r]] for r in new]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([signed[:0], *keys])), pa.array(np.repeat(sid[new], count))], names=["key", "sid"])

    return docs.select(text).mapInArrow(describe, "key long, sid long")


def shared_keys(rows: DataFrame) -> DataFrame:
    """Rows (key, sid) of the keys that occur in two sets or more."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64)]  # rows of the last key so far
        hot = None  # a key known to be shared, whose rows go out at once

        def out(columns):
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "sid"])

        def shared(columns):
            key, sid = columns[0], columns[1]
            begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            last = np.concatenate([begin[1:], [len(key)]]) - 1
            return np.repeat(sid[begin] != sid[last], last - begin + 1)

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [np.concatenate([h, batch.column(i).to_numpy(zero_copy_only=False)]) for i, h in enumerate(held)]
            tail = int(np.searchsorted(columns[0], columns[0][-1]))
            use = shared(columns)
            if hot is not None:
                use |= columns[0] == hot
            hot = columns[0][-1] if use[-1] else None
            end = len(use) if use[-1] else tail
            yield out([c[:end][use[:end]] for c in columns])
            held = [c[end:] for c in columns]

    return rows.repartition("key").sortWithinPartitions("key", "sid").mapInArrow(keep, "key long, sid long")


def candidates(shared: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """sids of sets with as many shared keys as any link needs: those of its smallest possible partner."""
    least = F.ceil(F.col("n") * percent / 100)
    return shared.groupBy("sid").agg(F.countDistinct("key").alias("met")).join(sizes, "sid").where(F.col("met") > F.floor(least / 10)).select("sid")


def sets_of(docs: DataFrame, text: str, k: int, wanted) -> DataFrame:
    """(sid, members) of the sets that the filter lets pass, once a task."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, met = wanted.value, set()
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for i, j in pieces(offsets, 1_000_000):
                h, cuts = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
                sid, n = set_ids(h, cuts), np.diff(cuts)
                rows = [r for r in np.flatnonzero(in_table(table, sid) & (n > 0)).tolist() if not (sid[r] in met or met.add(sid[r]))]
                yield pa.RecordBatch.from_arrays([pa.array(sid[rows]), pa.array([packed(h[cuts[r] : cuts[r + 1]]) for r in rows], pa.binary())], names=["sid", "members"])

    return docs.select(text).mapInArrow(make, "sid long, members binary")


def size_class(n, percent: int):
    """Sizes of linked sets differ by the threshold at most: they are in the same class or the next."""
    return F.floor(F.log(n) / F.log(F.lit(100 / percent))).cast("int")


def blocks_of(shared: DataFrame) -> DataFrame:
    """(block, weight, c, sid): the c sets of keys that are all in the same sets; weight: how many keys."""
    keys = shared.groupBy("key").agg(F.count("sid").alias("c"), *[F.bit_xor(F.xxhash64("sid", F.lit(i))).alias(f"h{i}") for i in (1, 2)])
    blocks = keys.groupBy("c", "h1", "h2").agg(F.min("key").alias("key"), F.count("key").alias("weight"))
    return shared.join(blocks.select("key", "weight", "c"), "key").select(F.col("key").alias("block"), "weight", "c", "sid")


def star_links(blocks: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int, used: list[DataFrame]) -> DataFrame:
    """Links (a, b) of the sets of blocks with representatives: the least set of the block, and in large ones those of its parts by a hash.

    used gets the written tables that nobody needs once the links are written.
    """
    # powers of two, so that blocks of about the same sets have the same parts
    parts = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("c") / HOT))).cast("long")
    met = None
    for turn in range(2):
        some = blocks.where(F.col("c") > HOT) if turn else blocks
        dealt = some.select("block", "weight", "sid", (F.pmod(F.xxhash64("sid", F.lit(turn)), parts) if turn else F.lit(0).cast("long")).alias("part"))
        least = dealt.groupBy("block", "part").agg(F.min("sid").alias("to"))
        one = dealt.join(least, ["block", "part"]).where("sid <> to").groupBy("sid", "to").agg(F.sum("weight").alias("met"))
        met = one if met is None else met.union(one)
    # a hint only: what is passed over here is still compared leaf by leaf
    enough = F.col("met") > F.floor(F.ceil(F.col("n") * percent / 100) / 10)
    pairs = written(met.join(sizes, "sid").where(enough).select("sid", "to").distinct(), "stars")
    spread = pairs.groupBy("to").agg(F.ceil(F.count("sid") / GUESTS).alias("parts"))
    used.append(pairs)
    guests = pairs.join(spread, "to").select("to", F.pmod(F.xxhash64("sid"), "parts").alias("part"), "sid").join(sets, "sid")
    # sets are joined under their own names on both sides, so that one exchange of them serves both
    hosts = spread.join(sets, F.col("to") == F.col("sid")).select("to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("members").alias("other"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                found = []
                for a, b, x, y in zip(*[c.to_pylist() for c in whole.slice(at, 256).columns], strict=True):
                    n, m = len(x) // 7, len(y) // 7
                    overlap = len(np.intersect1d(members_of(x), members_of(y), assume_unique=True))
                    if 100 * overlap >= percent * (n + m - overlap):
                        found.append((a, b))
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], names=["a", "b"])

    return guests.join(hosts, ["to", "part"]).select("sid", "to", "members", "other").mapInArrow(check, "a long, b long")


# --- nodes and their traversal ----------------------------------------------------------


def width_of(size: int, percent: int) -> int:
    """Bits of the bitmaps of a size class: a power of two."""
    return 1 << max(9, int(np.ceil(np.log2(BITS * (100 / percent) ** (size + 1)))))


def signature(members: np.ndarray, width: int) -> np.ndarray:
    bits = np.zeros(width, bool)
    bits[(members >> np.uint64(8) & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits).view(np.uint64)


def ones(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1).astype(np.int64)


class Nodes:
    """Parallel arrays of nodes: OR of signatures, size range, the most members that share bits (slack), and a component if all have the same (else 0)."""

    def __init__(self, bits: np.ndarray, least: np.ndarray, most: np.ndarray, slack: np.ndarray, root: np.ndarray):
        self.bits, self.least, self.most, self.slack, self.root = bits, least, most, slack, root

    def possible(self, i: np.ndarray, other: Nodes, j: np.ndarray, percent: int) -> np.ndarray:
        """Whether some set below i and some below j can overlap as much as their sizes need, in different components."""
        ok = (100 * self.most[i] >= percent * other.least[j]) & (100 * other.most[j] >= percent * self.least[i]) & ((self.root[i] != other.root[j]) | (self.root[i] == 0))
        step = max(1, (1 << 20) // self.bits.shape[1])  # pairs of about 8 MB of bits
        at = np.flatnonzero(ok)
        for a in range(0, len(at), step):
            some = at[a : a + step]
            x, y = i[some], j[some]
            overlap = ones(self.bits[x] & other.bits[y]) + np.minimum(self.slack[x], other.slack[y])
            overlap = np.minimum(overlap, np.minimum(self.most[x], other.most[y]))
            ok[some] = overlap >= need(self.least[x], other.least[y], percent)
        return ok

    def parents(self, fan: int) -> Nodes:
        at = np.arange(0, len(self.least), fan)
        low, high = np.minimum.reduceat(self.root, at), np.maximum.reduceat(self.root, at)
        return Nodes(np.bitwise_or.reduceat(self.bits, at), np.minimum.reduceat(self.least, at), np.maximum.reduceat(self.most, at), np.maximum.reduceat(self.slack, at), np.where(low == high, low, 0))

    def folded(self, words: int) -> Nodes:
        """With bitmaps of so many words: bits that fall together count as more slack."""
        if self.bits.shape[1] == words:
            return self
        bits = np.bitwise_or.reduce(self.bits.reshape(len(self.bits), -1, words), axis=1)
        return Nodes(bits, self.least, self.most, self.slack + ones(self.bits) - ones(bits), self.root)

    def some(self, at) -> Nodes:
        return Nodes(self.bits[at], self.least[at], self.most[at], self.slack[at], self.root[at])


def traverse(left: Nodes, right: Nodes | None, percent: int, fan: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves that the bounds leave, by descending two trees together; right None: a tree against itself, pairs i < j."""
    alone = right is None
    sides = [[left], [left if alone else right]]
    while max(len(sides[0][-1].least), len(sides[1][-1].least)) > fan:
        for side in sides[:1] if alone else sides:
            side.append(side[-1].parents(fan))
        if alone:
            sides[1] = sides[0]
    n, m = len(sides[0][-1].least), len(sides[1][-1].least)
    i, j = np.triu_indices(n) if alone else (x.ravel() for x in np.indices((n, m)))
    for depth in range(len(sides[0]) - 1, -1, -1):
        x, y = sides[0][depth], sides[1][depth]
        ok = x.possible(i, y, j, percent)
        if depth == 0:
            ok &= (i < j) if alone else True
            return i[ok], j[ok]
        if alone:
            ok |= i == j
        i, j = i[ok], j[ok]
        step = np.arange(fan)
        i, j = np.broadcast_arrays(i[:, None, None] * fan + step[None, :, None], j[:, None, None] * fan + step[None, None, :])
        i, j = i.ravel(), j.ravel()
        use = (i < len(sides[0][depth - 1].least)) & (j < len(sides[1][depth - 1].least)) & ((i <= j) if alone else True)
        i, j = i[use], j[use]
    raise AssertionError


class Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.find(x)] = self.find(y)


def nodes_of(sets: list[np.ndarray], width: int) -> Nodes:
    bits = np.array([signature(s, width) for s in sets])
    n = np.array([len(s) for s in sets])
    return Nodes(bits, n, n, n - ones(bits), np.zeros(len(n), np.int64))


class Leaf:
    """Sets of a leaf with their nodes."""

    def __init__(self, sets: list[np.ndarray], width: int):
        self.sets, self.nodes = sets, nodes_of(sets, width)
        self.all = np.concatenate(sets)
        self.begin = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])


def links(left: Leaf, right: Leaf, percent: int, joined: Union, shift: int) -> list[tuple[int, int]]:
    """Links of left sets (numbers 0..) with right ones (numbers shift..) that connect what isn't connected."""
    out = []
    every, words = np.arange(len(right.sets)), min(left.nodes.bits.shape[1], right.nodes.bits.shape[1])
    ours, theirs = left.nodes.folded(words), right.nodes.folded(words)
    roots = {joined.find(i) for i in range(len(left.sets))} | {joined.find(shift + j) for j in every.tolist()}
    for i, s in enumerate(left.sets):
        if len(roots) == 1:
            break
        ok = ours.possible(np.full(len(every), i), theirs, every, percent)
        rest = [j for j in np.flatnonzero(ok).tolist() if joined.find(i) != joined.find(shift + j)]
        if not rest:
            continue
        if len(rest) * 2 > len(every):
            at = np.minimum(np.searchsorted(s, right.all), len(s) - 1)
            overlap = np.add.reduceat((s[at] == right.all).astype(np.int64), right.begin)
        else:
            overlap = {j: len(np.intersect1d(s, right.sets[j], assume_unique=True)) for j in rest}
        for j in rest:
            x, y = joined.find(i), joined.find(shift + j)
            if x != y and 100 * int(overlap[j]) >= percent * (len(s) + len(right.sets[j]) - int(overlap[j])):
                roots.discard(x)
                joined.join(x, y)
                out.append((i, shift + j))
    return out


LEAVES = "leaf long, root long, size int, least long, most long, slack long, bits binary, sids array<long>, sets array<binary>"


def build_leaves(sets: DataFrame, percent: int) -> DataFrame:
    """One row per leaf from (root, size, part, sid, members): its node and its sets.

    Sets of the same root, size class and part are neighbours; every LEAF of them are a
    leaf. Those with a root (not 0) are connected already; a set without one is a leaf.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sids, sets = None, [], []

        def leaf() -> pa.RecordBatch:
            nodes = nodes_of(sets, width_of(key[1], percent))
            return pa.RecordBatch.from_arrays([
                pa.array([sids[0]]), pa.array([key[0]]), pa.array([key[1]], pa.int32()), pa.array([int(nodes.least.min())]), pa.array([int(nodes.most.max())]), pa.array([int(nodes.slack.max())]),
                pa.array([np.bitwise_or.reduce(nodes.bits).tobytes()], pa.binary()), pa.array([sids], pa.list_(pa.int64())), pa.array([[packed(s) for s in sets]], pa.list_(pa.binary())),
            ], names=["leaf", "root", "size", "least", "most", "slack", "bits", "sids", "sets"])

        for batch in batches:
            for root, size, part, sid, members in zip(*[batch.column(c).to_pylist() for c in ("root", "size", "part", "sid", "members")], strict=True):
                if sids and (key != (root, size, part) or len(sids) == LEAF or not root and sid != sids[-1]):
                    yield leaf()
                    sids, sets = [], []
                key = (root, size, part)
                if not sids or sid != sids[-1]:
                    sids.append(sid)
                    sets.append(members_of(members))
        if sids:
            yield leaf()

    return sets.select("root", "size", "part", "sid", "members").repartition("root", "size", "part").sortWithinPartitions("root", "size", "part", "sid").mapInArrow(build, LEAVES)


NODE = ("root", "size", "least", "most", "slack", "bits", "blocks")


def node_rows(rows: pa.Table) -> tuple[np.ndarray, Nodes]:
    """Leaves and nodes of rows of one size class."""
    get = lambda c: rows.column(c).to_numpy()
    bits = np.frombuffer(b"".join(rows.column("bits").to_pylist()), np.uint64).reshape(rows.num_rows, -1)
    return get("leaf"), Nodes(bits, get("least"), get("most"), get("slack"), get("root"))


def meeting_lists(placed: DataFrame) -> DataFrame:
    """(leaf, blocks): the blocks of each leaf, ascending; as many as a set has keys, at most."""
    return placed.groupBy("leaf").agg(F.sort_array(F.collect_list("block")).alias("blocks"))


def up_to_own(rows: DataFrame) -> DataFrame:
    """rows with the blocks of their leaf cut behind the row's own: a pair only asks whether it meets in a lesser one."""
    return rows.withColumn("blocks", F.slice("blocks", F.lit(1), F.array_position("blocks", F.col("block")).cast("int")))


def rare_blocks(placed: DataFrame, percent: int) -> DataFrame:
    """placed (block, weight, c, leaf, root, size, least) without the rows that no pair needs, and with c counted anew.

    A leaf leaves out its most frequent blocks as long as their keys are fewer than any link
    of its sets needs. As all leaves do so in the same order of blocks, the rarest block that
    two linked leaves have in common stays in both. A leaf also needs another one of its
    size class or the next in a block.
    """
    hottest = Window.partitionBy("leaf").orderBy(F.desc("c"), F.desc("block")).rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("over", F.sum("weight").over(hottest)).where(F.col("over") > F.floor(F.ceil(F.col("least") * percent / 100) / 10)).drop("over", "c")
    counts = placed.groupBy("block", "size").agg(F.count("leaf").alias("c"))
    peers = counts.select("block", F.explode(F.array(*[F.col("size") + i for i in (-1, 0, 1)])).alias("size"), "c").groupBy("block", "size").agg(F.sum("c").alias("c"))
    kept = written(placed.join(peers.where("c > 1").select("block", "size"), ["block", "size"], "left_semi"), "rare")
    placed = written(kept.join(kept.groupBy("block").agg(F.count("leaf").alias("c")), "block"), "placed")
    discard(kept)
    return placed


def some_of_each(one: np.ndarray, two: np.ndarray, few: int) -> np.ndarray:
    """Which pairs are among the `few` first of their first leaf, in an order by hash."""
    h = mix(mix(one.view(np.uint64)) + two.view(np.uint64))
    order = np.lexsort((h, one))
    begin = np.flatnonzero(np.concatenate([[True], one[order][1:] != one[order][:-1]]))
    rank = np.arange(len(one)) - np.repeat(begin, np.diff(np.append(begin, len(one))))
    return order[rank < few]


def pairs_between(left: pa.Table, right: pa.Table | None, percent: int, few: int | None) -> pa.RecordBatch:
    """(one, two) of the leaf pairs of two size classes that the trees leave; right None: of one class with itself.

    A pair that meets in several blocks comes out of the least of them. few: so many pairs
    of each left leaf only (None: all).
    """
    leaf, nodes = node_rows(left)
    if right is None:
        other, across = leaf, nodes
        i, j = traverse(nodes, None, percent)
    else:
        other, across = node_rows(right)
        words = min(nodes.bits.shape[1], across.bits.shape[1])
        i, j = traverse(nodes.folded(words), across.folded(words), percent)
    keep = np.zeros(len(i), bool)
    if len(i):
        here = [side.column("blocks").combine_chunks() for side in (left, left if right is None else right)]
        flat = [lists.flatten().to_numpy() for lists in here]
        blocks = np.unique(np.concatenate(flat))
        tables = []
        for lists, values in zip(here, flat, strict=True):
            tables.append(np.zeros((len(lists), len(blocks)), bool))
            tables[-1][np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()), np.searchsorted(blocks, values)] = True
        own = int(np.searchsorted(blocks, left.column("block")[0].as_py()))
        step = max(1, (1 << 23) // len(blocks))
        for a in range(0, len(i), step):
            s = slice(a, a + step)
            keep[s] = (tables[0][i[s]] & tables[1][j[s]]).argmax(axis=1) == own
    i, j = i[keep], j[keep]
    if few is not None and len(i):
        some = some_of_each(leaf[i], other[j], few)
        i, j = i[some], j[some]
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(leaf[i], other[j])), pa.array(np.maximum(leaf[i], other[j]))], names=["one", "two"])


PAIRS = "one long, two long"


def leaf_pairs(placed: DataFrame, nodes: DataFrame, percent: int, few: int | None = None) -> DataFrame:
    """(one, two) of the leaves that meet in blocks of at most UNIT leaves."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, ["block"]):
            size = rows.column("size").to_numpy()
            cuts = [0, *(np.flatnonzero(size[1:] != size[:-1]) + 1).tolist(), len(size)]
            parts = [rows.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            for part, after in zip(parts, [*parts[1:], None], strict=True):
                if part.num_rows > 1:
                    yield pairs_between(part, None, percent, few)
                if after is not None and after.column("size")[0].as_py() == part.column("size")[0].as_py() + 1:
                    yield pairs_between(part, after, percent, few)

    return up_to_own(placed.select("block", "leaf").join(nodes, "leaf")).repartition("block").sortWithinPartitions("block", "size", "least").mapInArrow(pairs, PAIRS)


def unit_pairs(placed: DataFrame, nodes: DataFrame, percent: int, few: int | None = None) -> DataFrame:
    """leaf_pairs of blocks of any size: their leaves are dealt into units, and each pair of units is a step of its own.

    A unit holds leaves of one size class, and of one component where that has many;
    units of the same component don't meet. With few, a unit meets itself and its
    neighbours only, so that the steps are linear in the units.
    """
    own = placed.select("block", "leaf", "root", "size")
    held = own.groupBy("block", "root", "size").agg(F.count("leaf").alias("c"))
    held = held.withColumn("pool", F.when(F.col("c") >= UNIT, F.col("root")).otherwise(0))
    pools = held.groupBy("block", "pool", "size").agg(F.ceil(F.sum("c") / UNIT).alias("parts"))
    placed = own.join(held.select("block", "root", "size", "pool"), ["block", "root", "size"]).join(pools, ["block", "pool", "size"])
    placed = placed.withColumn("part", F.pmod(F.xxhash64("leaf"), "parts")).withColumn("unit", F.concat_ws(":", "pool", "size", "part"))
    units = pools.select("block", "pool", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    units = units.select("block", "pool", "size", "part", F.concat_ws(":", "pool", "size", "part").alias("unit"))
    one, two = (units.select("block", *[F.col(c).alias(f"{c}{i}") for c in ("pool", "size", "part", "unit")]) for i in (1, 2))
    steps = one.join(two, "block").where("(size1 < size2 OR size1 = size2 AND unit1 <= unit2) AND size2 - size1 <= 1 AND (pool1 <> pool2 OR pool1 = 0)")
    if few is not None:
        steps = steps.where("abs(part1 - part2) <= 1 AND (size1 < size2 OR pool1 = pool2) OR pool1 <> pool2 AND part1 = 0 AND part2 = 0")
    steps = steps.select("block", "unit1", "unit2", F.concat_ws("|", "block", "unit1", "unit2").alias("step"))
    sides = [steps.select("block", F.col("unit1").alias("unit"), "step", F.when(F.col("unit1") == F.col("unit2"), 2).otherwise(0).alias("side")), steps.where("unit1 <> unit2").select("block", F.col("unit2").alias("unit"), "step", F.lit(1).alias("side"))]
    rows = sides[0].union(sides[1]).join(placed, ["block", "unit"]).select("step", "side", "block", "leaf").join(nodes, "leaf")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in runs(batches, ["step"]):
            side = step.column("side").to_numpy()
            first = int((side == 0).sum())
            if side[0] == 2:  # a unit with itself
                yield pairs_between(step, None, percent, few)
            elif 0 < first < step.num_rows:
                yield pairs_between(step.slice(0, first), step.slice(first), percent, few)

    return up_to_own(rows).repartition("step").sortWithinPartitions("step", "side", "least").mapInArrow(pairs, PAIRS)


def cross_links(pairs: DataFrame, leaves: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the leaves of each pair. The leaf with fewer shingles travels."""
    cost = leaves.select("leaf", F.aggregate("sets", F.lit(0).cast("long"), lambda n, s: n + F.octet_length(s)).alias("cost"))
    sized = pairs.join(cost.select(F.col("leaf").alias("one"), F.col("cost").alias("c1")), "one").join(cost.select(F.col("leaf").alias("two"), F.col("cost").alias("c2")), "two")
    sized = sized.select(F.when(F.col("c1") >= F.col("c2"), F.col("one")).otherwise(F.col("two")).alias("home"), F.when(F.col("c1") >= F.col("c2"), F.col("two")).otherwise(F.col("one")).alias("leaf"))
    spread = sized.groupBy("home").agg(F.ceil(F.count("leaf") / VISITS).alias("parts"))
    dealt = sized.join(spread, "home").withColumn("part", F.pmod(F.xxhash64("leaf"), "parts"))
    guests = dealt.join(leaves.select("leaf", "root", "size", "sids", "sets"), "leaf").select("home", "part", F.col("leaf").alias("guest"), "root", "size", "sids", "sets")
    hosts = leaves.join(spread.select(F.col("home").alias("leaf"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")), "leaf").select(F.col("leaf").alias("home"), "part", F.lit(None).cast("long").alias("guest"), "root", "size", "sids", "sets")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host = own = n = None
        for batch in batches:
            found = []
            for r in batch.to_pylist():
                leaf = Leaf([members_of(x) for x in r["sets"]], width_of(r["size"], percent))
                if r["guest"] is None:
                    host, own, n = leaf, r, len(leaf.sets)
                    continue
                joined = Union(n + len(leaf.sets))
                for begin, end in ((0, n), (n, n + len(leaf.sets))):  # the sets of a leaf are connected
                    for x in range(begin, end - 1):
                        joined.join(x, x + 1)
                found += [(own["sids"][i], r["sids"][j - n]) for i, j in links(host, leaf, percent, joined, n)]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], names=["a", "b"])

    both = hosts.union(guests).repartition("home", "part").sortWithinPartitions("home", "part", F.col("guest").asc_nulls_first())
    return both.mapInArrow(check, "a long, b long")


def tree_links(blocks: DataFrame, sizes: DataFrame, sets: DataFrame, known: DataFrame, percent: int, few: int | None, used: list[DataFrame], spent: list[DataFrame]) -> DataFrame:
    """Links (a, b) that connect the components of known (node, root): known itself and those found through the trees.

    few: so many partners of each leaf in a step only (None: all, so no link is lost).
    used gets the written tables that nobody needs once the links are written; spent are
    those that nobody needs once the leaves are.
    """
    members = blocks.select("sid").distinct().join(sizes, "sid").withColumn("size", size_class(F.col("n"), percent))
    both = known.union(known.select("root", "root")).distinct()  # the root too; 0 names the empty set and so no root
    members = members.join(both.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", F.lit(0).cast("long")))
    groups = members.where("root <> 0").groupBy("root", "size").agg(F.ceil(F.count("sid") / (4 * LEAF)).alias("parts"))
    members = members.join(groups, ["root", "size"], "left").select("sid", "size", "root", F.when(F.col("root") == 0, F.col("sid")).otherwise(F.pmod("sid", "parts")).alias("part"))
    leaves = written(build_leaves(sets.join(members, "sid"), percent), "leaves")
    discard(*spent)
    sweep(blocks.sparkSession, WAIT)
    # blocks of leaves; those of one component only have nothing left to find, and equal ones count together
    meet = blocks.join(leaves.select("leaf", "root", F.explode("sids").alias("sid")), "sid").groupBy("block", "leaf", "root").agg(F.max("weight").alias("weight"))
    busy = meet.groupBy("block").agg(F.min("leaf").alias("lo"), F.max("leaf").alias("hi"), F.min("root").alias("one"), F.max("root").alias("two"), F.count("leaf").alias("c"), F.first("weight").alias("weight"), *[F.bit_xor(F.xxhash64("leaf", F.lit(i))).alias(f"h{i}") for i in (1, 2)])
    busy = busy.where("lo < hi AND (one <> two OR one = 0)").groupBy("c", "h1", "h2").agg(F.min("block").alias("block"), F.sum("weight").alias("weight"))
    busy = written(busy.select("block", "weight", "c"), "busy")
    placed = meet.select("block", "leaf").join(busy, "block").join(leaves.select("leaf", "root", "size", "least"), "leaf")
    placed = rare_blocks(placed, percent)
    nodes = leaves.select("leaf", *[c for c in NODE if c != "blocks"]).join(meeting_lists(placed), "leaf")
    near = leaf_pairs(placed.where(F.col("c") <= UNIT), nodes, percent, few)
    if not placed.where(F.col("c") > UNIT).isEmpty():
        near = near.union(unit_pairs(placed.where(F.col("c") > UNIT), nodes, percent, few))
    pairs = written(near, "pairs")
    sweep(blocks.sparkSession, WAIT)  # their rows hold a bitmap for each block of a leaf
    used += [leaves, busy, placed, pairs]
    return cross_links(pairs, leaves, percent).union(known.select(F.col("node").alias("a"), F.col("root").alias("b")))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """key, n_shingles and component_id (least key reachable by links) of every row of docs.

    Two rows link when 100 * intersection >= percent * union of their k-word shingles.
    """
    context = docs.sparkSession.sparkContext
    rows = written(described(docs, key, text, k), "rows")
    sizes = rows.where("n_shingles > 0").select("sid", F.col("n_shingles").alias("n")).distinct()
    shared = written(shared_keys(prefix_keys(docs, text, k, percent)), "shared")
    sweep(docs.sparkSession, WAIT)
    # the keys that candidates share with candidates
    left = shared.join(candidates(shared, sizes, percent), "sid", "left_semi")
    met = left.groupBy("key").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi")).where("lo < hi").select("key")
    left = written(left.join(met, "key", "left_semi").select("key", "sid").distinct(), "shared")
    discard(shared)
    sweep(docs.sparkSession, WAIT)
    some = written(candidates(left, sizes, percent), "wanted")
    wanted = context.broadcast(bit_table(some, "sid"))
    sets = written(sets_of(docs, text, k, wanted).dropDuplicates(["sid"]), "members")
    discard(some)
    sweep(docs.sparkSession, WAIT)
    blocks = written(blocks_of(left), "blocks")
    discard(left)
    used: list[DataFrame] = []
    roots = components(star_links(blocks, sizes, sets, percent, used))
    for few, some, spent in ((FEW, blocks.where(F.col("c") > LARGE), []), (None, blocks, [sets])):
        if not some.isEmpty():
            before = roots
            roots = components(tree_links(some, sizes, sets, roots, percent, few, used, spent))
            used.append(before)
        else:
            used += spent
        discard(*used)  # the edges are written
        used.clear()
    discard(blocks)
    firsts = rows.where("n_shingles > 0").groupBy("sid").agg(F.min(key).alias("first"))
    firsts = firsts.join(roots.select(F.col("node").alias("sid"), "root"), "sid", "left").select("sid", "first", F.coalesce("root", "sid").alias("root"))
    named = firsts.groupBy("root").agg(F.min("first").alias("component_id"))
    named = firsts.join(named, "root").select("sid", "component_id")
    out = rows.join(named, "sid", "left")
    return out.select(key, "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col(key)).alias("component_id"))


def op8_jaccard_join(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs.select("doc_id", "text"))
