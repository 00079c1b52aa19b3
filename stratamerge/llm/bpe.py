"""Byte-level BPE: texts to token ids and back, equal to what the tokenizers library gives.

A task takes its texts in steps of about STEP bytes. The step's distinct pre-tokens lie in
one array of symbols, linked to their neighbours. An index holds, for each pair of symbols
that the vocabulary merges, all positions where it occurs. Ranks that have positions are
taken in ascending order: all occurrences of the pair are merged at once, and the pairs that
this makes go to the lists of their own ranks. Positions that a merge has changed meanwhile
are passed over. A vocabulary's merges only use what earlier merges make (this is checked),
so no rank comes up again. Ids of a text are those of its pre-tokens.

A null text has no ids. Added tokens in a text are tokens of their own, as by the library's
default; begin and end tokens aren't added. A text is encoded whole, in one task, whatever
its length; a single long word costs no more for a byte than many short ones. Repeated
rows are encoded each. Columns named like the output are replaced, others are passed on,
whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SpanHash, carried, pieces, unpacked, utf8
from .tokens import PIECE, added_tokens, cut

STEP = 16_000_000  # bytes of text whose distinct pre-tokens are encoded together
NO_RANK = np.iinfo(np.int32).max


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is visible, else one from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """Ranks of pairs, ids of bytes and bytes of ids."""

    def __init__(self, path: str):
        self.added = added_tokens(path)
        with open(path) as f:
            j = json.load(f)
        ids, model = j["model"]["vocab"], j["model"]
        if any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")) or (j.get("decoder") or {}).get("type") != "ByteLevel":
            raise ValueError(f"{path}: only plain byte-level BPE is encoded here")
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.size = len(ids) + len(self.added)
        self.left, self.right, self.merged = (np.array([ids[x] for x in side], np.int32) for side in zip(*[(a, b, a + b) for a, b in pairs], strict=True))
        made = {int(t): i for i, t in enumerate(self.merged)}
        if len(made) < len(pairs) or any(made.get(int(p), -1) >= i for side in (self.left, self.right) for i, p in enumerate(side)):
            raise ValueError(f"{path}: a merge comes before what it is made of")
        keys = self.left.astype(np.int64) << 32 | self.right
        self.rank_of = np.argsort(keys)
        self.keys = keys[self.rank_of]
        characters = byte_characters()
        self.byte_ids = np.array([ids[c] for c in characters], np.int32)
        self.added_ids = {t["content"].encode(): t["id"] for t in j.get("added_tokens", [])}
        byte_of = {c: b for b, c in enumerate(characters)}
        values = {i: bytes(byte_of[c] for c in word) for word, i in ids.items()} | {i: word for word, i in self.added_ids.items()}
        self.lengths = np.zeros(max(values) + 1, np.int64)
        for i, value in values.items():
            self.lengths[i] = len(value)
        self.begin = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(values.get(i, b"") for i in range(len(self.lengths))), np.uint8)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NO_RANK where it isn't merged."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], NO_RANK)


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class PairIndex:
    """Positions of every pair by its rank, and the ranks that have some."""

    def __init__(self):
        self.lists: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []

    def add(self, at: np.ndarray, rank: np.ndarray) -> None:
        """at: ascending positions, with their pairs' ranks."""
        use = rank != NO_RANK
        at, rank = at[use], rank[use]
        if not len(at):
            return
        if len(at) > 1:
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
        begin = [0, *(np.flatnonzero(rank[1:] != rank[:-1]) + 1).tolist()]
        for a, b in zip(begin, [*begin[1:], len(at)], strict=True):
            r = int(rank[a])
            if r not in self.lists:
                self.lists[r] = []
                heappush(self.active, r)
            self.lists[r].append(at[a:b])

    def pop(self) -> tuple[int, np.ndarray]:
        """The least rank and its positions, ascending."""
        r = heappop(self.active)
        some = self.lists.pop(r)
        return r, some[0] if len(some) == 1 else np.unique(np.concatenate(some))


def merge_words(v: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words (bytes one after another, offsets by word), and the offsets of the words in them."""
    n = len(data)
    symbol = np.append(v.byte_ids[data], -2).astype(np.int32)  # the last one stands for no neighbour
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    after[n], before[0] = n, n
    filled = offsets[:-1] < offsets[1:]
    after[offsets[1:][filled] - 1] = n
    before[offsets[:-1][filled]] = n
    index = PairIndex()
    at = np.flatnonzero(after[:n] < n)
    index.add(at, v.ranks(symbol[at], symbol[after[at]]))
    while index.active:
        r, at = index.pop()
        left, right = v.left[r], v.right[r]
        at = at[(symbol[at] == left) & (symbol[after[at]] == right)]
        if left == right and len(at) > 1:  # of a run of overlapping pairs every other one, from the left
            new = np.append(True, after[at[:-1]] != at[1:])
            place = np.arange(len(at))
            at = at[(place - place[new][np.cumsum(new) - 1]) % 2 == 0]
        if not len(at):
            continue
        gone = after[at]
        symbol[at], symbol[gone] = v.merged[r], -1
        following = after[gone]
        after[at], before[following] = following, at
        leading = before[at]
        near = np.concatenate([leading[leading < n], at[following < n]])
        if len(near) > 1:
            near = np.unique(near)
        index.add(near, v.ranks(symbol[near], symbol[after[near]]))
    alive = symbol[:n] >= 0
    counts = np.concatenate([[0], np.cumsum(alive)])
    return symbol[:n][alive], counts[offsets]


def gathered(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places of spans, one after another."""
    to = np.cumsum(length)
    return np.repeat(begin - to + length, length) + np.arange(to[-1] if len(to) else 0)


def distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and first places of distinct spans, and the number of each span among them."""
    h, first, number = np.unique(SpanHash(data)(start, end), return_index=True, return_inverse=True)
    same = (end - start) == (end - start)[first][number]
    if not same.all() or (data != data[gathered(start[first][number], end - start)]).any():  # spans lie side by side and cover the data
        raise ArithmeticError("two pre-tokens have the same hash")
    return h, first, number


def encode_texts(v: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts (UTF-8 bytes one after another, offsets by text), and the offsets of the texts in them."""
    parts, words, hashes = [], [], []
    for i, j in pieces(offsets, PIECE):
        text, own = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        start, end = cut(text, own, v.added)
        h, first, number = distinct(text, start, end)
        length = (end - start)[first]
        words.append((text[gathered(start[first], length)], length))
        hashes.append(h)
        parts.append((number.astype(np.int32), np.searchsorted(start, own)))  # an empty text has no pre-token
    flat, length = (np.concatenate([w[k] for w in words]) if words else np.zeros(0, np.uint8 if k == 0 else np.int64) for k in (0, 1))
    begin = np.cumsum(length) - length
    _, first, number = np.unique(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), return_index=True, return_inverse=True)
    if (length != length[first][number]).any() or (flat != flat[gathered(begin[first][number], length)]).any():
        raise ArithmeticError("two pre-tokens have the same hash")
    ids, cuts = merge_words(v, flat[gathered(begin[first], length[first])], np.concatenate([[0], np.cumsum(length[first])]))
    whole = {at: v.added_ids[w] for at in np.flatnonzero(np.isin(length[first], [len(w) for w in v.added_ids])).tolist() if (w := flat[begin[first[at]] : begin[first[at]] + length[first[at]]].tobytes()) in v.added_ids}
    if whole:
        each = [np.array([whole[k]], np.int32) if k in whole else ids[a:b] for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))]
        ids, cuts = np.concatenate(each), np.concatenate([[0], np.cumsum([len(x) for x in each])])
    size = np.diff(cuts)
    out, sizes, done = [], [], 0
    for (k, rows), h in zip(parts, hashes, strict=True):
        word = number[done : done + len(h)][k]
        done += len(h)
        out.append(ids[gathered(cuts[word], size[word])])
        sizes.append(np.diff(np.concatenate([[0], np.cumsum(size[word])])[rows]))
    return (np.concatenate(out) if out else np.zeros(0, np.int32)), np.concatenate([[0], np.cumsum(np.concatenate(sizes) if sizes else [])]).astype(np.int64)


def decode_ids(v: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Texts of the ids; ids beyond the vocabulary are passed over, bytes that aren't UTF-8 replaced."""
    known = (ids >= 0) & (ids < len(v.lengths))
    length = np.where(known, v.lengths[np.where(known, ids, 0)], 0)
    data = v.bytes[gathered(v.begin[np.where(known, ids, 0)], length)]
    to = np.concatenate([[0], np.cumsum(length)])[offsets]
    texts = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(to.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
    try:
        texts.validate(full=True)
    except pa.ArrowInvalid:
        raw = data.tobytes()
        texts = pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(to[:-1].tolist(), to[1:].tolist(), strict=True)], pa.large_string())
    return texts.cast(pa.string())


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """docs without the text, with binary column `out`: the token ids of each whole text as little-endian unsigned 32-bit integers.

    path: a byte-level BPE vocabulary of the tokenizers library, there on every machine.
    """
    own, kept = carried(docs, text, out)
    rows = docs.select(own.alias("own"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    vocabulary(path)  # what can't be encoded is an error here, not in tasks

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in pieces(offsets, STEP):
                ids, cuts = encode_texts(v, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(cuts * 4), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), packed.cast(pa.binary())], names=["own", "ids"])

    done = rows.mapInArrow(make, T.StructType([rows.schema["own"], T.StructField("ids", T.BinaryType())]))
    return done.select(*unpacked("own", kept), F.col("ids").alias(out))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """df with column `out`: the text of the token ids of `encode`, added tokens included; null ids give an empty text."""
    own, kept = carried(df, out)
    rows = df.select(own.alias("own"), F.coalesce(F.col(f"`{ids}`"), F.lit(b"")).alias("ids"))
    vocabulary(path)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            packed = batch.column(1).cast(pa.large_binary())
            offsets = np.frombuffer(packed.buffers()[1], np.int64, len(packed) + 1, packed.offset * 8)
            for i, j in pieces(offsets, STEP // 4):
                some = np.frombuffer(packed.buffers()[2] or b"", np.uint8)[offsets[i] : offsets[j]].view("<u4").astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), decode_ids(v, some, (offsets[i : j + 1] - offsets[i]) // 4)], names=["own", "text"])

    done = rows.mapInArrow(make, T.StructType([rows.schema["own"], T.StructField("text", T.StringType())]))
    return done.select(*unpacked("own", kept), F.col("text").alias(out))


def op12_bpe(docs: DataFrame, path: str) -> DataFrame:
    back = decode(encode(docs.select("doc_id", "text"), path), path, out="decoded")
    return back.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
