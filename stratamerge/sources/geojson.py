"""Features of GeoJSON files of any size, read by many tasks.

A file is cut into ranges of bytes. One pass over the ranges counts, for a range that
begins inside or outside a string, its quotes and brackets; sums over the ranges before
tell every range where in the document it begins. A second pass takes out the features
that begin in each range: the objects right inside an array of the document's object. A
feature that goes on behind its range is read to its end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .geoparquet import located

RANGE_BYTES = 1 << 25
MOST_TASKS = 100_000
MORE = 1 << 20  # bytes by which a feature is followed behind its range
QUOTE, SLASH = ord('"'), ord("\\")
DOWN, UP = np.frombuffer(b"{[", np.uint8), np.frombuffer(b"}]", np.uint8)
FEATURE_DEPTH = 2  # inside the document's object and an array of it


def escapes(f, at: int) -> int:
    """Whether the byte at a place of the file is escaped: 1 if an odd number of backslashes stands before it."""
    n = 0
    while at:
        step = min(at, 64)
        f.seek(at - step)
        before = f.read(step)
        run = len(before) - len(before.rstrip(b"\\"))
        n, at = n + run, at - step
        if run < step:
            break
    return n % 2


def marks(data: np.ndarray, escaped: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the quotes that begin or end strings, and of brackets with their step in depth. escaped: of the first byte."""
    quote = np.flatnonzero(data == QUOTE)
    maybe = quote[(quote > 0) & (data[quote - 1] == SLASH)]
    if len(maybe) or escaped:
        slash = np.flatnonzero(data == SLASH)
        run = np.concatenate([[True], slash[1:] != slash[:-1] + 1]) if len(slash) else np.zeros(0, bool)
        first = slash[run][np.cumsum(run) - 1] if len(slash) else slash  # of the run that each is in
        last = np.searchsorted(slash, quote) - 1
        beside = (last >= 0) & (slash[np.maximum(last, 0)] == quote - 1) if len(slash) else np.zeros(len(quote), bool)
        begin = np.where(beside, first[np.maximum(last, 0)], quote) if len(slash) else quote
        odd = (quote - begin + np.where(begin == 0, escaped, 0)) % 2 == 1
        quote = quote[~odd]
    step = np.isin(data, DOWN).astype(np.int8) - np.isin(data, UP).astype(np.int8)
    at = np.flatnonzero(step)
    return quote, at, step[at].astype(np.int64)


def counted(ranges: DataFrame) -> DataFrame:
    """path, begin, end with quotes, and the change of depth if the range begins outside (out) or inside a string (within)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, begin, end in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                store, name = located(path)
                with store.open_input_file(name) as f:
                    escaped = escapes(f, begin)
                    f.seek(begin)
                    quote, at, step = marks(np.frombuffer(f.read(end - begin), np.uint8), escaped)
                inside = np.searchsorted(quote, at) % 2
                rows.append((path, begin, end, len(quote), int(step[inside == 0].sum()), int(step[inside == 1].sum())))
            kinds = [pa.string(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["path", "begin", "end", "quotes", "out", "within"])

    return ranges.mapInArrow(count, "path string, begin long, end long, quotes long, out long, within long")


def whole_feature(f, data: bytes, end: int) -> bytes:
    """A feature that begins data and goes on in the file from `end` on, to its last bracket; what there is if the file is cut off."""
    while True:
        quote, at, step = marks(np.frombuffer(data, np.uint8), 0)
        outside = np.searchsorted(quote, at) % 2 == 0
        closed = at[outside][np.cumsum(step[outside]) == 0]
        if len(closed):
            return data[: closed[0] + 1]
        f.seek(end)
        more = f.read(max(MORE, len(data)))  # doubled, so that long features are scanned few times
        if not more:
            return data
        data, end = data + more, end + len(more)


def feature_texts(spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, feature): the text of every feature of the files. No file at all is an error; files without features give no rows."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    begin = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long")))
    ranges = files.withColumn("begin", begin).select("path", "begin", F.least(F.col("begin") + range_bytes, "length").alias("end"), (F.col("length") > range_bytes).alias("cut"))
    n = files.agg(F.sum(F.ceil(F.col("length") / range_bytes))).first()[0] or 1
    dealt = lambda df: df.repartition(min(n, MOST_TASKS), "path", "begin")  # noqa: E731  a stated number, as Spark would put rows so short into one task
    before = Window.partitionBy("path").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    known = counted(dealt(ranges.where("cut").select("path", "begin", "end"))).withColumn("inside", F.coalesce(F.sum("quotes").over(before), zero) % 2)
    known = known.withColumn("depth", F.coalesce(F.sum(F.when(F.col("inside") == 0, F.col("out")).otherwise(F.col("within"))).over(before), zero))
    known = known.select("path", "begin", "end", "inside", "depth").union(ranges.where("NOT cut").select("path", "begin", "end", zero, zero))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, begin, end, inside, depth in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                store, name = located(path)
                with store.open_input_file(name) as f:
                    escaped = escapes(f, begin)
                    f.seek(begin)
                    data = f.read(end - begin)
                    quote, at, step = marks(np.frombuffer(data, np.uint8), escaped)
                    outside = (np.searchsorted(quote, at) + inside) % 2 == 0
                    at, step = at[outside], step[outside]
                    level = depth + np.cumsum(step)
                    first, last = at[(step > 0) & (level == FEATURE_DEPTH + 1)], at[(step < 0) & (level == FEATURE_DEPTH)]
                    first = first[np.frombuffer(data, np.uint8)[first] == ord("{")]
                    held, size = [], 0
                    for a, b in zip(first.tolist(), np.append(last, -1)[np.searchsorted(last, first)].tolist(), strict=True):
                        held.append(data[a : b + 1] if b >= 0 else whole_feature(f, data[a:], end))
                        size += len(held[-1])
                        if size > MORE:
                            yield made(path, held)
                            held, size = [], 0
                    if held:
                        yield made(path, held)

    def made(path: str, features: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([path] * len(features)), pa.array(features, pa.binary()).cast(pa.string())], names=["path", "feature"])

    return dealt(known).mapInArrow(take, "path string, feature string")
