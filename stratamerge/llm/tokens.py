"""Token counts without token ids.

The pieces of a byte-level BPE text are those of its pre-tokens. One pass over the texts
writes each document's pre-tokens with their frequencies. Every distinct pre-token is
encoded once, and its piece count is joined to the documents' frequencies and summed.

Frequent pre-tokens (at most `head` of them, a bounded table) are joined by broadcast, so
that none of them brings its rows into one task; all others by a shuffle on the pre-token.
Which of the two joins a pre-token takes makes no difference to any result.

A null text counts as empty: 0 bytes, 0 tokens. A text is cut whole, in one task, whatever
its length. Repeated rows are counted each. Columns named like the output are replaced,
others are passed on, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SpanHash, carried, pieces, unpacked, utf8, written

PIECE = 1_000_000  # bytes of text that are cut in one step

LETTER, NUMBER, SPACE, OTHER, NONE = range(5)
#: What the pattern of pre-tokens takes apart after an apostrophe.
SUFFIXES = ("s", "t", "m", "d", "re", "ve", "ll")


@cache
def classes() -> np.ndarray:
    """LETTER, NUMBER, SPACE or OTHER for every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, points):
            table[ord(points[m.start()]) : ord(points[m.end() - 1]) + 1] = kind
    return table


def added_tokens(path: str) -> list[str]:
    """Added tokens of a vocabulary file; an error if it isn't byte-level BPE with the pre-tokens that are cut here."""
    with open(path) as f:
        j = json.load(f)
    cutter = j.get("pre_tokenizer") or {}
    if (cutter.get("type"), cutter.get("add_prefix_space"), cutter.get("use_regex", True)) != ("ByteLevel", False, True) or j.get("normalizer") or j["model"].get("type") != "BPE":
        raise ValueError(f"{path}: only byte-level BPE without a normalizer or a prefix space is counted here")
    if any(t[k] for t in j.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"{path}: added tokens must be plain strings")
    return [t["content"] for t in j.get("added_tokens", [])]


def added_spans(data: np.ndarray, offsets: np.ndarray, added: list[str]) -> list[tuple[int, int]]:
    """Where added tokens stand in the texts: they stay whole."""
    raw, names = data.tobytes(), [t.encode() for t in added]
    if not any(t in raw for t in names):
        return []
    find = re.compile(b"|".join(re.escape(t) for t in sorted(names, key=len, reverse=True))).finditer
    return [(m.start() + a, m.end() + a) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True) for m in find(raw[a:b])]


def cut(data: np.ndarray, offsets: np.ndarray, added: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every pre-token of the texts (UTF-8, offsets by row).

    A pre-token is a run of letters, of numbers or of other characters, with one blank
    before it if there is one; or a run of white space without the blank, or other last
    character, before what follows it. After an apostrophe that begins a run, SUFFIXES are
    taken off.
    """
    whole = added_spans(data, offsets, added)
    breaks = np.unique(np.concatenate([offsets, np.array(whole, np.int64).ravel()]))
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(lead):
        return lead, lead
    point = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    kind = classes()[point]
    first = np.searchsorted(lead, breaks[breaks < len(data)])
    before, after = np.empty_like(kind), np.empty_like(kind)
    before[1:], after[:-1] = kind[:-1], kind[1:]
    after[-1] = NONE
    before[first] = after[first[1:] - 1] = NONE
    blank = (point == 32) & (after != NONE)
    led = np.zeros(len(kind), bool)  # has a blank before it
    led[1:] = blank[:-1]
    space = kind == SPACE
    begin = np.where(space, (before != SPACE) | (after != SPACE) & (after != NONE), (kind != before) & ~led)
    # contractions
    mark = np.flatnonzero((point == 39) & begin & (after == LETTER))
    limit = np.append(first, len(kind))[np.searchsorted(first, mark, "right")]
    padded = np.append(point, [0, 0])
    for suffix in SUFFIXES:
        n = len(suffix)
        at = mark[(mark + n < limit) & np.logical_and.reduce([padded[mark + 1 + i] == ord(c) for i, c in enumerate(suffix)])]
        begin[at + 1] = False
        begin[(at + n + 1)[at + n + 1 < len(kind)]] = True
    for a, b in np.searchsorted(lead, np.array(whole, np.int64).reshape(-1, 2)).tolist():
        begin[a + 1 : b] = False
    start = lead[begin]
    return start, np.append(start[1:], len(data))


PRETOKENS = T.ArrayType(T.StructType().add("word", "string").add("n", "integer"))


def frequencies(data: np.ndarray, offsets: np.ndarray, added: list[str]) -> pa.Array:
    """Per row the distinct pre-tokens with their counts."""
    start, end = cut(data, offsets, added)
    row = np.searchsorted(offsets, start, "right") - 1
    h = SpanHash(data)(start, end)
    key = row.astype(np.uint64) << np.uint64(40) | h >> np.uint64(24)
    order = np.argsort(key)
    k, full = key[order], h[order]
    same = k[1:] == k[:-1]
    if (full[1:][same] != full[:-1][same]).any():  # two pre-tokens of a row that agree in 40 bits of their hashes
        order = np.lexsort((h, row))
        k, full = key[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (full[1:] != full[:-1])])) if len(k) else np.zeros(0, np.int64)
    n = np.diff(np.append(new, len(k)))
    at = order[new]
    length = end[at] - start[at]
    to = np.concatenate([[0], np.cumsum(length)])
    text = data[np.repeat(start[at] - to[:-1], length) + np.arange(to[-1])]
    words = pa.StringArray.from_buffers(len(at), pa.py_buffer(to.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(text)))
    cuts = np.searchsorted(row[at], np.arange(len(offsets)))
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.StructArray.from_arrays([words, pa.array(n.astype(np.int32))], names=["word", "n"]))


def encoded(words: DataFrame, path: str) -> DataFrame:
    """(word, pieces) of distinct words."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                part = whole.slice(at, 500)
                n = [len(e) for e in t.encode_batch(part.column(0).to_pylist(), add_special_tokens=False)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int32())], names=["word", "pieces"])

    return words.select("word").mapInArrow(encode, "word string, pieces int")


def frequent(texts: DataFrame, head: int) -> DataFrame:
    """(word): at most `head` pre-tokens, the most frequent ones by what tasks see of them more than once."""

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = pc.value_counts(batch.column(0).flatten().field("word"))
            counts = counts.filter(pc.greater(counts.field("counts"), 1))
            yield pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], names=["word", "n"])

    counts = texts.select("words").mapInArrow(often, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = written(counts.select("word", F.floor(F.log2("n") * 8).alias("octave")), "counts")
    # the frequency from which at most `head` are left, to an eighth of an octave
    least, left = 1 << 30, head
    for r in sorted(counts.groupBy("octave").count().collect(), reverse=True):
        left -= r["count"]
        if left < 0:
            break
        least = r["octave"]
    return counts.where(F.col("octave") >= least).select("word")


def count_tokens(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens", head: int = 1 << 18) -> DataFrame:
    """docs without the text, with column `out` (long): the number of tokens of each whole text, none added.

    path: a byte-level BPE vocabulary of the tokenizers library, there on every machine.
    """
    added = added_tokens(path)
    own, kept = carried(docs, text, out)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), own.alias("own"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for i, j in pieces(offsets, PIECE):
                words = frequencies(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], added)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), words], names=["row", "own", "words"])

    # written once, so that row numbers stay what they are
    texts = written(rows.mapInArrow(make, T.StructType().add("row", "long").add(rows.schema["own"]).add("words", PRETOKENS)), "frequencies")
    top = F.broadcast(written(encoded(frequent(texts, head), path), "frequent"))  # head rows at most
    each = texts.select("row", F.explode("words").alias("w")).select("row", "w.word", "w.n")
    rest = each.join(top, "word", "left_anti")
    priced = encoded(rest.select("word").distinct(), path)
    found = each.join(top, "word").groupBy("row").agg(F.sum(F.col("n") * F.col("pieces")).alias("s"))
    found = found.union(rest.join(priced, "word").groupBy("row").agg(F.sum(F.col("n") * F.col("pieces")).alias("s")))
    total = found.groupBy("row").agg(F.sum("s").alias("s"))
    return texts.select("row", "own").join(total, "row", "left").select(*unpacked("own", kept), F.coalesce("s", F.lit(0)).cast("long").alias(out))


def op10_token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    return count_tokens(docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")), path).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
