"""WKB polygons and multipolygons, a batch of rows at a time, by offsets and buffers.

Ring arrays and WKB hold the same coordinates in the same order; only headers stand
between them. So headers are placed by sums of lengths, and all coordinates are copied at
once. Reading follows the headers of all rows together, one ring of each row a step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .geometry import RINGS

#: Type codes of the format.
POLYGON, MULTIPOLYGON = 3, 6
HEADER, COUNT, POINT = 9, 4, 16  # bytes of a shape's or part's header, a ring's count and a point


def lengths(lists: pa.Array) -> np.ndarray:
    return pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def before(n: np.ndarray) -> np.ndarray:
    """Sums of what stands before each."""
    return np.cumsum(n) - n


def header(kind: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Rows of bytes: byte order 1, kind, n."""
    words = np.column_stack([kind, n]).astype("<u4").view(np.uint8).reshape(-1, 8)
    return np.column_stack([np.ones(len(n), np.uint8), words])


def encode(rings: pa.Array, is_hole: pa.Array) -> pa.Array:
    """Little-endian WKB of ring arrays; holes belong to the outer ring before them. Null stays null."""
    null = rings.is_null().to_numpy(zero_copy_only=False)
    each, flat = lengths(rings), rings.flatten()
    hole = is_hole.filter(pa.array(~null)).flatten().fill_null(False).to_numpy(zero_copy_only=False)
    if len(hole) != len(flat):
        raise ValueError("every ring needs a mark")
    shape = np.repeat(np.arange(len(each)), each)
    first = ~hole
    first[before(each)[each > 0]] = True
    parts = np.bincount(shape[first], minlength=len(each))
    many = parts != 1
    points = lengths(flat)
    lead = np.where(first & many[shape], HEADER, 0)  # a part's header before its first ring
    size = lead + COUNT + POINT * points
    whole = np.where(null, 0, HEADER)
    np.add.at(whole, shape, size)
    begin = before(whole)
    ring = begin[shape] + HEADER + before(size) - np.repeat(before(size)[before(each)[each > 0]], each[each > 0])
    out, coordinate = np.empty(whole.sum(), np.uint8), np.ones(whole.sum(), bool)

    def put(at: np.ndarray, rows: np.ndarray) -> None:
        where = at[:, None] + np.arange(rows.shape[1])
        out[where], coordinate[where] = rows, False

    put(begin[~null], header(np.where(many, MULTIPOLYGON, POLYGON)[~null], np.where(many, parts, each)[~null]))
    of_part = np.diff(np.append(np.flatnonzero(first), len(first)))  # rings of each part
    led = lead[first] > 0
    put(ring[first][led], header(np.full(int(led.sum()), POLYGON), of_part[led]))
    put(ring + lead, points.astype("<u4").view(np.uint8).reshape(-1, 4))
    x, y = (c.to_numpy(zero_copy_only=False) for c in flat.flatten().flatten())
    out[coordinate] = np.column_stack([x, y]).astype("<f8").view(np.uint8).ravel()
    offsets = np.append(begin, whole.sum())
    large = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(each), [pa.array(~null).buffers()[1], pa.py_buffer(offsets), pa.py_buffer(out)])
    return large.cast(pa.binary())


class Reader:
    """Numbers at places of a buffer, in the byte order of each."""

    def __init__(self, data: np.ndarray):
        self.data = data

    def word(self, at: np.ndarray, little: np.ndarray) -> np.ndarray:
        four = self.data[at[:, None] + np.arange(4)]
        return np.where(little, four.view("<u4")[:, 0], four.view(">u4")[:, 0]).astype(np.int64)

    def head(self, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte order, kind and count of headers."""
        if (at + HEADER > end).any():
            raise ValueError("WKB ends too early")
        little = self.data[at] > 0
        return little, self.word(at + 1, little), self.word(at + 5, little)


def decode(column: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Ring arrays and hole marks of WKB of either byte order; anything but (multi)polygons is an error. Null stays null."""
    null = column.is_null().to_numpy(zero_copy_only=False)
    column = column.fill_null(b"").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    read, end = Reader(data), offsets[1:]
    at = offsets[:-1].copy()
    little, parts, rings, new = np.ones(len(at), bool), np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), np.ones(len(at), bool)
    some = np.flatnonzero(~null)
    little[some], kind, n = read.head(at[some], end[some])
    if not np.isin(kind, (POLYGON, MULTIPOLYGON)).all():
        raise ValueError(f"WKB type {kind[~np.isin(kind, (POLYGON, MULTIPOLYGON))][0]}")
    parts[some], rings[some] = np.where(kind == MULTIPOLYGON, n, 0), np.where(kind == POLYGON, n, 0)
    at[some] += HEADER
    found: list[tuple[np.ndarray, ...]] = []
    while len(some := some[(rings[some] > 0) | (parts[some] > 0)]):
        inside = rings[some] > 0
        r, p = some[inside], some[~inside]
        if len(r):
            if (at[r] + COUNT > end[r]).any():
                raise ValueError("WKB ends too early")
            m = read.word(at[r], little[r])
            found.append((r, at[r] + COUNT, m, ~new[r], little[r]))
            at[r] += COUNT + POINT * m
            rings[r] -= 1
            new[r] = False
        if len(p):
            little[p], kind, rings[p] = read.head(at[p], end[p])
            if (kind != POLYGON).any():
                raise ValueError(f"WKB type {kind[kind != POLYGON][0]} in a multipolygon")
            at[p] += HEADER
            parts[p] -= 1
            new[p] = True
    if (at > end).any():
        raise ValueError("WKB ends too early")
    empty = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)] * 2
    shape, start, m, hole, small = (np.concatenate(c) for c in zip(*found, strict=True)) if found else empty
    order = np.lexsort((start, shape))
    shape, start, m, hole, small = shape[order], start[order], m[order], hole[order], small[order]
    edge = np.zeros(len(data) + 1, np.int32)  # +1 where coordinates begin, -1 where they end
    np.add.at(edge, start, 1)
    np.add.at(edge, start + POINT * m, -1)
    raw = data[np.cumsum(edge[:-1]) > 0]
    xy = raw.view("<f8")
    if not small.all():
        xy = np.where(np.repeat(small, 2 * m), xy, raw.view(">f8"))
    points = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(xy[i::2]).astype(np.float64)) for i in range(2)], names=["x", "y"])
    flat = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(m)).astype(np.int32)), points)
    cuts = pa.array(np.searchsorted(shape, np.arange(len(at) + 1)).astype(np.int32))
    return tuple(pa.ListArray.from_arrays(cuts, v, mask=pa.array(null)) for v in (flat, pa.array(hole)))


def rings_to_wkb(df: DataFrame, rings: str = "rings", is_hole: str = "is_hole", out: str = "geometry") -> DataFrame:
    """df with the shape columns replaced by one WKB column (null stays null)."""
    schema = T.StructType([f for f in df.schema.fields if f.name not in (rings, is_hole, out)] + [T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = [n for n in b.schema.names if n not in (rings, is_hole, out)]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in kept], encode(b.column(rings), b.column(is_hole))], names=[*kept, out])

    return df.mapInArrow(run, schema)


def wkb_to_rings(df: DataFrame, geometry: str = "geometry", rings: str = "rings", is_hole: str = "is_hole") -> DataFrame:
    """The reverse of rings_to_wkb."""
    schema = T.StructType([f for f in df.schema.fields if f.name not in (geometry, rings, is_hole)] + [T.StructField(rings, RINGS), T.StructField(is_hole, T.ArrayType(T.BooleanType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = [n for n in b.schema.names if n not in (geometry, rings, is_hole)]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in kept], *decode(b.column(geometry))], names=[*kept, rings, is_hole])

    return df.mapInArrow(run, schema)
