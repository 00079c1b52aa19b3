"""Shared pieces: intermediate tables, Arrow access to text, word and shingle hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import discard, materialize_zstd, scratch


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: cuts lineage, survives executors."""
    return materialize_zstd(df, scratch(df.sparkSession, name))


def carried(docs: DataFrame, *but: str) -> tuple[Column, list[str]]:
    """All columns but some as one struct, so that no name of theirs clashes with ours; and their names."""
    kept = [c for c in docs.columns if c not in but]
    return F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]), kept


def unpacked(struct: str, kept: list[str]) -> list[Column]:
    """The columns of `carried` again."""
    return [F.col(struct).getField(f"c{i}").alias(c) for i, c in enumerate(kept)]


BUCKET = 1 << 15  # bits of one row of a bit table


def bit_table(values: DataFrame, column: str, least: int = 1 << 20, most: int = 1 << 30) -> np.ndarray:
    """Set of 64-bit hashes as bits: about 16 a hash, between 2^20 and 2^30 in all. What it lacks is not in the set.

    A plain array, so that executors can unpack its broadcast without this package.
    """
    n = values.count()
    size = min(most, max(least, 1 << max(16 * n - 1, 0).bit_length()))
    at = values.select(F.pmod(column, F.lit(size)).alias("at"))
    at = at.groupBy(F.expr(f"at div {BUCKET}").alias("bucket")).agg(F.bitmap_construct_agg(F.pmod("at", F.lit(BUCKET))).alias("bits"))
    table = np.zeros((size // BUCKET, BUCKET // 8), np.uint8)
    for r in at.collect() if size <= 1 << 26 else at.repartition(8).toLocalIterator():  # 8 MB, or a job for each of 8 parts
        table[r["bucket"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return table.ravel()


def in_table(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values.view(np.uint64) & np.uint64(8 * len(table) - 1)
    return (table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def unused(name: str, columns: list[str]) -> str:
    """The name, lengthened until it is none of the columns'."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def ranked(rows: DataFrame, group: str, *order: str, name: str = "ranked") -> DataFrame:
    """A written table's rows with rank (0, 1, ... within the group, in the order) and total (rows of the group).

    Rows are range-partitioned by group and order, so a group of any size is spread over
    tasks; places are what stands before a row in its part and the sizes of the parts before.
    Equal rows may take each other's places. The result is written.
    """
    keys = [F.col(f"`{c}`") for c in (group, *order)] + [F.col("_tie")]  # rows that are equal can be parted too
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    placed = written(dealt.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    starts = placed.groupBy(F.col(group).alias("_group"), part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before, every = Window.partitionBy("_group").orderBy("_part"), Window.partitionBy("_group")
    starts = starts.select("_group", "_part", (F.col("_first") - F.sum("_n").over(before) + F.col("_n")).alias("_zero"), F.sum("_n").over(every).alias("total"))
    out = written(placed.join(starts, F.col(group).eqNullSafe(F.col("_group")) & (part == F.col("_part"))).select(*rows.columns, (F.col("_at") - F.col("_zero")).alias("rank"), "total"), name)
    discard(placed)
    return out


def with_fields(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    """schema with fields added; a field of the same name is replaced."""
    new = {f.name for f in fields}
    return T.StructType([f for f in schema.fields if f.name not in new] + list(fields))


def put_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """batch with columns added at the end; columns of the same names are replaced."""
    kept = [(n, batch.column(i)) for i, n in enumerate(batch.schema.names) if n not in columns]
    return pa.RecordBatch.from_arrays([c for _, c in kept] + list(columns.values()), names=[n for n, _ in kept] + list(columns))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column one after another (null: empty), and the offsets of its rows."""
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges that hold about `most` bytes each (one row at least)."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n + 1, BASE, np.uint64), np.full(n + 1, BASE_INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def byte_codes() -> np.ndarray:
    """A fixed 64-bit code for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * BASE)


def words_of(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of word bytes, never across rows: first byte, end, row."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = is_word[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    firsts = offsets[:-1][(offsets[:-1] < offsets[1:])]
    begin[firsts] = inside[firsts]
    lasts = offsets[1:][(offsets[:-1] < offsets[1:])] - 1
    end[lasts] = inside[lasts]
    a, b = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return a, b, np.searchsorted(offsets, a, "right") - 1


class SpanHash:
    """Hash of any byte span by differences of prefix sums."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(byte_codes()[data] * up[: len(data)], out=self.sums[1:])

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.sums[b] - self.sums[a]) * self.down[a] + (b - a).astype(np.uint64))


def lower_ascii() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def not_space() -> np.ndarray:
    """Bytes of the words [^\\x20\\x09-\\x0D]+."""
    table = np.ones(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = False
    return table


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct k-word shingle hashes of all rows and the offsets of rows in them.

    A-Z count as a-z. A row of fewer words has its whole word sequence as its one
    shingle; a row without words has none.
    """
    data = lower_ascii()[data]
    a, b, row = words_of(data, offsets, not_space())
    n = len(offsets) - 1
    count = np.bincount(row, minlength=n)
    word = SpanHash(data)(a, b)
    first = np.concatenate([[0], np.cumsum(count)[:-1]]) if n else np.zeros(0, np.int64)
    short = (count > 0) & (count < k)
    size = np.minimum(count, k)
    starts = np.arange(len(word)) - first[row] if len(word) else np.zeros(0, np.int64)
    ok = np.where(short[row], starts == 0, starts <= count[row] - k) if len(word) else np.zeros(0, bool)
    at, row = np.flatnonzero(ok), row[ok]
    h = np.zeros(len(at), np.uint64)
    padded = np.concatenate([word, np.zeros(k, np.uint64)])
    for j in range(k):
        inside = j < size[row]
        h = np.where(inside, mix(h * np.uint64(5) + padded[at + j] + np.uint64(j + 1)), h)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    if len(h):
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(n + 1))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of each key, from batches sorted by the keys; a run may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for v in values:
            new[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        if held and last != tuple(v[0] for v in values):
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = tuple(v[-1] for v in values)
    if held:
        yield pa.Table.from_batches(held)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def remainder(column: str, n: int):
    """crc32 of the id as text, mod n; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % n, F.lit(-1))
