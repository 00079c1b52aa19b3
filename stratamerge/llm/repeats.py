"""Removal of long byte strings that occur more than once, by suffix arrays over shards.

Every string of `window` bytes has an anchor: the position of its least hashed q-gram.
Equal strings have equal anchors at equal places, so strings are compared only with
those of the same anchor content, whatever document they are in.

1. Codes of all anchors are counted; a bit table keeps those met twice.
2. The string starts that belong to such an anchor are cut into a few ranges. All strings
   of a range share a core of bytes; ranges whose core is met once hold no repeats. Equal
   ranges are kept once, with their number.
3. The ranges are sorted into shards by core. Over the blocks of a shard's ranges a suffix
   array is built by linear grouping. Strings whose full blocks stand together in its
   order, by the common prefixes of neighbours, and whose few bytes before and after these
   blocks agree are equal; they repeat if they occur twice in all, counting equal ranges.
   A core with very many different ranges is halved first: its ranges become narrower, with
   longer cores, until a core's ranges fit a shard. Ranges of one string each are all equal.
4. The covered bytes of each document are united and cut out.

Texts are taken as UTF-8; a null text is empty. A text shorter than the window loses
nothing; a text is read whole, whatever its length. Repeated rows are occurrences like any
others. Codes, cores, ranges, blocks and the bytes beside them are told apart by 64-bit
hashes. Columns named like the outputs are replaced, others are passed on, whatever their
names and types. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SpanHash, bit_table, carried, in_table, mix, pieces, unpacked, utf8, written

RANGES = 4
BLOCK = 25
LARGE = 4096  # a core of more different ranges is halved
PLACE = np.uint64((1 << 28) - 1)  # positions in a piece, in packed comparisons


# --- suffix array -----------------------------------------------------------------------


def suffix_array(s: list[int]) -> list[int]:
    """Suffix array of a list of non-negative numbers, in linear time by grouping.

    First the suffixes are refined into groups of equal longest Lyndon prefix: groups are
    taken in descending order; each member's nearest smaller predecessor (the nearest one
    before it in a lower group) is promoted within its group, by how many members point to
    it. Then the order inside the groups follows by emission: for each suffix in order,
    the chain of predecessors that ends right before it goes to the next free places of
    their groups.
    """
    n = len(s)
    if not n:
        return []
    # counting sort by symbol
    size = [0] * (max(s) + 1)
    for x in s:
        size[x] += 1
    first, at = [0] * len(size), 0
    for x, c in enumerate(size):
        first[x] = at
        at += c
    order, place, group, free = [0] * n, [0] * n, [0] * n, first[:]
    for i, x in enumerate(s):  # place in order; first place of the group
        group[i], place[i], order[free[x]] = first[x], free[x], i
        free[x] += 1
    size = [0] * n
    for i in range(n):
        size[group[i]] += 1
    before = [-2] * n  # -2: not known yet, -1: none
    end = n
    while end > 0:
        start = group[order[end - 1]]
        members = order[start:end]
        pointed: dict[int, int] = {}
        for i in members:
            if before[i] != -2:
                continue
            path, j = [i], i - 1
            while j >= 0 and group[j] >= start:
                if before[j] == -2:  # of the same group: ends where i does
                    path.append(j)
                    j -= 1
                else:
                    j = before[j]
            for x in path:
                before[x] = j
        for i in members:
            j = before[i]
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        if pointed:
            by_count: dict[int, list[int]] = {}
            for j, c in pointed.items():
                by_count.setdefault(c, []).append(j)
            for c in range(max(by_count), 0, -1):
                promoted = by_count.get(c, ())
                moved: dict[int, int] = {}
                for j in promoted:  # to the end of its group
                    g = group[j]
                    k = moved.get(g, 0)
                    to = g + size[g] - 1 - k
                    other, at = order[to], place[j]
                    order[to], order[at] = j, other
                    place[j], place[other] = to, at
                    moved[g] = k + 1
                for g, k in moved.items():
                    if k < size[g]:
                        first = g + size[g] - k
                        size[g] -= k
                        size[first] = k
                        for r in range(first, first + k):
                            group[order[r]] = first
        end = start
    out, free, done = [-1] * n, [0] * n, [False] * n

    def emit(j: int) -> None:
        while j >= 0 and not done[j]:
            g = group[j]
            out[g + free[g]] = j
            free[g] += 1
            done[j] = True
            j = before[j]

    emit(n - 1)  # those that end with the text come before all that go on
    for r in range(n):
        emit(out[r] - 1)
    return out


def common_prefixes(s: list[int], order: list[int], stop: int) -> tuple[list[int], list[int]]:
    """Rank of each suffix, and by rank the length of the common prefix with the one before; the symbol `stop` ends suffixes."""
    n = len(s)
    rank = [0] * n
    for r, i in enumerate(order):
        rank[i] = r
    common, h = [0] * n, 0
    for i in range(n):
        if not rank[i]:
            h = 0
            continue
        j = order[rank[i] - 1]
        while i + h < n and j + h < n and s[i + h] == s[j + h] != stop:
            h += 1
        common[rank[i]] = h
        h -= h > 0
    return rank, common


# --- anchors and ranges -----------------------------------------------------------------


class Anchors:
    """Anchors of all strings of `window` bytes in a piece of texts: code, place, and first and last string start (all in the piece)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, q: int):
        self.width = window - q + 1  # q-grams of a string
        self.window, self.span = window, None
        self.code = self.place = self.first = self.last = np.zeros(0, np.int64)
        if len(data) < window:
            return
        self.span = SpanHash(data)
        at = np.arange(len(data) - q + 1)
        grams = self.span(at, at + q)
        least, have = (grams & ~PLACE) | at.astype(np.uint64), 1
        while have * 2 <= self.width:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        rest = self.width - have
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        left = np.repeat(offsets[1:], np.diff(offsets))[: len(least)] - np.arange(len(least))
        start = np.flatnonzero(left >= window)
        place = (least[start] & PLACE).astype(np.int64)
        new = np.ones(len(start), bool)
        new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
        cut = np.flatnonzero(new)
        self.place, self.first, self.last = place[cut], start[cut], start[np.append(cut[1:], len(start)) - 1] if len(cut) else start[cut]
        self.code = mix(grams[self.place])

    def ranges(self, use: np.ndarray) -> tuple[np.ndarray, ...]:
        """key (of code, range and core), full (of the whole range), first and last start, first start relative to the range's nominal one."""
        wide = -(-self.width // RANGES)
        code, place, first, last = self.code[use], self.place[use], self.first[use], self.last[use]
        out = []
        for r in range(RANGES):
            zero = place - (self.width - 1) + r * wide
            lo, hi = np.maximum(first, zero), np.minimum(last, zero + wide - 1)
            ok = lo <= hi
            c, z, lo, hi = code[ok], zero[ok], lo[ok], hi[ok]
            core = self.span(z + wide - 1, z + self.window)
            key = mix(mix(c + np.uint64(r)) + core)
            full = mix(self.span(lo, hi + self.window) + mix(((lo - z) * 1024 + hi - z).astype(np.uint64)))
            out.append((key.view(np.int64), full.view(np.int64), lo, hi, lo - z))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def anchor_codes(texts: DataFrame, window: int, q: int) -> DataFrame:
    """(v, n): anchors by code, counted per batch."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(batch.schema.get_field_index("text")))
            for i, j in pieces(offsets, 1_000_000):
                a = Anchors(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], window, q)
                code, n = np.unique(a.code, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(n.astype(np.int64))], names=["v", "n"])

    return texts.select("text").mapInArrow(find, "v long, n long")


def range_rows(texts: DataFrame, window: int, q: int, codes) -> DataFrame:
    """(k, key, full, lo, hi) of every range of an anchor that passes; lo and hi in the text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = codes.value
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            names = batch.column(0).to_numpy()
            for i, j in pieces(offsets, 1_000_000):
                own = offsets[i : j + 1] - offsets[i]
                a = Anchors(data[offsets[i] : offsets[j]], own, window, q)
                if a.span is None:
                    continue
                key, full, lo, hi, _ = a.ranges(in_table(table, a.code))
                row = np.searchsorted(own, lo, "right") - 1
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (names[i:j][row], key, full, lo - own[row], hi - own[row])], names=["k", "key", "full", "lo", "hi"])

    return texts.select("k", "text").mapInArrow(find, "k long, key long, full long, lo long, hi long")


def range_bytes(texts: DataFrame, window: int, q: int, codes, wanted) -> DataFrame:
    """(key, full, skip, bytes) of the wanted ranges, once a task; skip: the first start relative to the nominal one."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, want, met = codes.value, wanted.value, set()
        for batch in batches:
            data, offsets = utf8(batch.column(batch.schema.get_field_index("text")))
            for i, j in pieces(offsets, 1_000_000):
                part = data[offsets[i] : offsets[j]]
                a = Anchors(part, offsets[i : j + 1] - offsets[i], window, q)
                if a.span is None:
                    continue
                key, full, lo, hi, skip = a.ranges(in_table(table, a.code))
                use = [x for x in np.flatnonzero(in_table(want, key ^ full)).tolist() if (p := (int(key[x]), int(full[x]))) not in met and not met.add(p)]
                yield pa.RecordBatch.from_arrays([pa.array(key[use]), pa.array(full[use]), pa.array(skip[use]), pa.array([part[lo[x] : hi[x] + window].tobytes() for x in use], pa.binary())], names=["key", "full", "skip", "bytes"])

    return texts.select("text").mapInArrow(find, "key long, full long, skip long, bytes binary")


# --- shards -----------------------------------------------------------------------------


def repeats_in(keys: np.ndarray, skips: np.ndarray, weights: np.ndarray, texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, start in it) of the strings that occur more than once among texts of the same key at the same place; a text counts by its weight."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    length = np.array([len(t) for t in texts])
    base = np.concatenate([[0], np.cumsum(length)[:-1]])
    span = SpanHash(data)
    # blocks lie on a grid from the nominal start of the range, so equal strings have equal blocks
    head = -skips % BLOCK
    blocks = np.maximum((length - head) // BLOCK, 0)
    text = np.repeat(np.arange(len(texts)), blocks)
    nth = np.arange(len(text)) - np.repeat(np.concatenate([[0], np.cumsum(blocks)[:-1]]), blocks)
    begin = base[text] + head[text] + nth * BLOCK
    grid = (skips[text] + head[text]) // BLOCK + nth
    symbol = mix(mix(span(begin, begin + BLOCK) + grid.astype(np.uint64)) + keys[text].view(np.uint64))
    _, symbol = np.unique(symbol, return_inverse=True)
    place = np.arange(len(text)) + text  # one stop symbol after each text
    string = np.zeros(len(text) + len(texts), np.int64)
    string[place] = symbol.ravel() + 1
    letters = string.tolist()
    rank, common = (np.array(x) for x in common_prefixes(letters, suffix_array(letters), 0))
    # all starts, their first full block and how many full blocks they hold
    starts = length - window + 1
    t = np.repeat(np.arange(len(texts)), starts)
    i = np.arange(len(t)) - np.repeat(np.concatenate([[0], np.cumsum(starts)[:-1]]), starts)
    first = np.maximum(-(-(i - head[t]) // BLOCK), 0)
    held = (i + window - head[t]) // BLOCK - first
    origin = np.concatenate([[0], np.cumsum(blocks + 1)[:-1]])
    place = rank[origin[t] + first]
    # suffixes that share so many blocks stand together in the order
    group = np.zeros(len(t), np.int64)
    for depth in np.unique(held).tolist():
        some = held == depth
        group[some] = np.cumsum(common < depth)[place[some]] * window + depth
    # what lies before the first full block and after the last
    at = base[t] + i
    front = base[t] + head[t] + first * BLOCK
    beside = mix(span(at, front) + mix(span(front + held * BLOCK, at + window)))
    _, same = np.unique(mix(group.astype(np.uint64) + beside), return_inverse=True)
    again = np.bincount(same.ravel(), weights[t])[same.ravel()] > 1
    return t[again], i[again]


def runs_of(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = np.flatnonzero(np.concatenate([[True], starts[1:] != starts[:-1] + 1]))
    return starts[cut], starts[np.append(cut[1:], len(starts)) - 1]


RANGE = T.StructType().add("key", "long").add("full", "long").add("skip", "long").add("n", "long").add("bytes", "binary")
FOUND = T.StructType().add("key", "long").add("full", "long").add("from", "long").add("to", "long")


def shard_repeats(ranges: DataFrame, window: int, most: int = 2_000_000) -> DataFrame:
    """(key, full, from, to): runs of repeated starts in each range, from shards of whole keys of about `most` bytes."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def shard() -> pa.RecordBatch:
            keys, fulls, skips, weights, texts = zip(*held, strict=True)
            t, i = repeats_in(np.array(keys, np.int64), np.array(skips, np.int64), np.array(weights), list(texts), window)
            out: list[tuple] = []
            for x in np.unique(t).tolist():
                a, b = runs_of(i[slice(*np.searchsorted(t, [x, x + 1]))])
                out += [(keys[x], fulls[x], int(p), int(r)) for p, r in zip(a, b, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], pa.int64()) for c in range(4)], names=FOUND.names)

        size = 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and row[0] != held[-1][0] and size > most:
                    yield shard()
                    held.clear()
                    size = 0
                held.append(row)
                size += len(row[4])
        if held:
            yield shard()

    return ranges.select(*RANGE.names).repartition("key").sortWithinPartitions("key", "full").mapInArrow(find, FOUND)


def halved(ranges: DataFrame, window: int, wide: int) -> DataFrame:
    """Ranges of `wide` starts as halves: key, full, shift (of the half in the range), and part_key, part_full, skip, n, bytes of the half."""
    half = -(-wide // 2)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, full, skip, n, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                span = SpanHash(np.frombuffer(text, np.uint8))
                last = skip + len(text) - window
                for side in (0, 1):
                    zero = side * half
                    a, b = max(skip, zero), min(last, zero + half - 1)
                    if a > b:
                        continue
                    core = span(np.array([zero + half - 1 - skip]), np.array([zero + window - skip]))
                    whole = span(np.array([a - skip]), np.array([b - skip + window]))
                    seed, ends = np.array([key, (a - zero) * 1024 + b - zero], np.int64).view(np.uint64)
                    part = mix(mix(np.array([seed + np.uint64(side + 1)])) + core), mix(whole + mix(np.array([ends])))
                    out.append((key, full, a - skip, *(int(x.view(np.int64)[0]) for x in part), a - zero, n, text[a - skip : b - skip + window]))
            kinds = [pa.int64()] * 7 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], kind) for c, kind in enumerate(kinds)], names=["key", "full", "shift", "part_key", "part_full", "skip", "n", "bytes"])

    return ranges.select(*RANGE.names).mapInArrow(cut, "key long, full long, shift long, part_key long, part_full long, skip long, n long, bytes binary")


def repeats_of(ranges: DataFrame, window: int, wide: int) -> DataFrame:
    """(key, full, from, to) of written ranges of at most `wide` starts; cores of more than LARGE ranges by their halves."""
    large = ranges.groupBy("key").agg(F.count("full").alias("c")).where(F.col("c") > LARGE).select("key")
    if wide == 1 or large.isEmpty():
        return written(shard_repeats(ranges, window), "repeats")
    found = written(shard_repeats(ranges.join(large, "key", "left_anti"), window), "repeats")
    parts = written(halved(ranges.join(large, "key", "left_semi"), window, wide), "halves")
    alike = parts.groupBy("part_key", "part_full").agg(F.first("skip").alias("skip"), F.sum("n").alias("n"), F.first("bytes").alias("bytes"))
    alike = written(alike.withColumnsRenamed({"part_key": "key", "part_full": "full"}), "parts")
    again = alike.groupBy("key").agg(F.sum("n").alias("all")).where("all > 1").select("key")
    below = repeats_of(written(alike.join(again, "key", "left_semi"), "ranges"), window, -(-wide // 2))
    below = below.select(F.col("key").alias("part_key"), F.col("full").alias("part_full"), "from", "to")
    up = parts.join(below, ["part_key", "part_full"]).select("key", "full", (F.col("shift") + F.col("from")).alias("from"), (F.col("shift") + F.col("to")).alias("to"))
    return found.union(up)


def repeated_spans(texts: DataFrame, window: int, q: int) -> DataFrame:
    """(k, spans): per row number, the byte spans (array of from, to) covered by repeated strings, unsorted."""
    context = texts.sparkSession.sparkContext
    twice = anchor_codes(texts, window, q).groupBy("v").agg(F.sum("n").alias("n")).where("n > 1").select("v")
    codes = context.broadcast(bit_table(written(twice, "anchors"), "v"))
    rows = written(range_rows(texts, window, q, codes), "ranges")
    wholes = rows.groupBy("key", "full").agg(F.count(F.lit(1)).alias("n"))
    cores = wholes.groupBy("key").agg(F.sum("n").alias("all")).where("all > 1").select("key")
    wholes = written(wholes.join(cores, "key", "left_semi"), "wholes")
    wanted = context.broadcast(bit_table(wholes.select(F.col("key").bitwiseXOR(F.col("full")).alias("v")), "v"))
    data = range_bytes(texts, window, q, codes, wanted).dropDuplicates(["key", "full"]).join(wholes, ["key", "full"])
    found = repeats_of(written(data.select(*RANGE.names), "data"), window, -(-(window - q + 1) // RANGES))
    spans = rows.join(found, ["key", "full"]).select("k", (F.col("lo") + F.col("from")).alias("from"), (F.col("lo") + F.col("to") + window).alias("to"))
    return spans.groupBy("k").agg(F.collect_set(F.struct("from", "to")).alias("spans"))


OUTPUTS = T.StructType().add("kept", "binary").add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")


def remove_repeats(docs: DataFrame, text: str = "text", window: int = 400, q: int = 64) -> DataFrame:
    """docs with kept (binary: the bytes that are left), n_bytes, n_removed and n_spans in place of text.

    Every byte that lies in a string of `window` bytes which starts anywhere else too is
    removed; strings are judged on the input.
    """
    own, names = carried(docs, text, *OUTPUTS.names)
    # written once, so that row numbers stay what they are
    texts = written(docs.select(F.monotonically_increasing_id().alias("k"), own.alias("own"), F.coalesce(F.col(text), F.lit("")).alias("text")), "texts")
    joined = texts.join(repeated_spans(texts, window, q), "k", "left").select("own", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            kept, removed, count = [], [], []
            for r, some in enumerate(batch.column(2).to_pylist()):
                own, out, at, gone, n = data[offsets[r] : offsets[r + 1]].tobytes(), [], 0, 0, 0
                for a, b in sorted((x["from"], x["to"]) for x in some or ()):
                    if a > at or not n:
                        out.append(own[at:a])
                        n += 1
                    if b > at:
                        gone += b - max(a, at)
                        at = b
                kept.append(b"".join([*out, own[at:]]))
                removed.append(gone)
                count.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(count, pa.int64())], names=["own", *OUTPUTS.names])

    out = joined.mapInArrow(cut, T.StructType([texts.schema["own"], *OUTPUTS.fields]))
    return out.select(*unpacked("own", names), *OUTPUTS.names)


def op9_repeats(docs: DataFrame) -> DataFrame:
    out = remove_repeats(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
