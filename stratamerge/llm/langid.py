"""Language identification by nearest centroid.

Texts become hashed TF-IDF vectors of their letter 1- to 3-grams, of unit length. Each
language has a few centroids, found by spherical k-means over its training texts; a
text takes the language of the centroid with the largest cosine. A text farther from
that centroid than its own members are (mean less `spread` deviations) is rejected.

Document frequencies come from all training rows. The centroids are fitted on a sample
of about `sample` training rows per language: a documented bound, so that the fit on
the driver doesn't grow with the corpus.

A null text or one without a letter is `und` with score 0 and is rejected; with no
training rows every text is. Rows with a null language train nothing. Of centroids that are
equally near the first counts, by language, then by number. A text is counted whole, in one
task, whatever its length. Repeated rows are scored alike; columns named like the outputs are
replaced, others are passed on. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import put_columns, remainder, unused, with_fields

UNKNOWN = "und"


#: Which code points below 2**16 are letters; those above count as letters.
LETTERS = np.array([chr(c).isalpha() for c in range(1 << 16)])


def counts(texts: list[str], dims: int) -> np.ndarray:
    """Hashed counts of letter 1- to 3-grams, one row per text; a run of other characters counts as one blank."""
    joined = "\n\n".join(texts).lower() if all(t.isascii() for t in texts) else "\n\n".join(t.lower() for t in texts)
    lengths = [len(t) for t in texts] if joined.isascii() else [len(t.lower()) for t in texts]
    c = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), np.array(lengths) + 2)[: len(c)]
    is_letter = np.ones(len(c), bool)
    low = c < (1 << 16)
    is_letter[low] = LETTERS[c[low]]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # the first of other characters after a letter stands for the blank
    c, row, is_letter = np.where(is_letter, c, 1)[keep], row[keep], is_letter[keep]
    out = np.zeros(len(texts) * dims, np.float32)
    h = np.zeros(len(c), np.uint64)
    for n in range(1, 4):
        h = h[: len(c) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + c[n - 1 :]
        bucket = ((h * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(40)) % np.uint64(dims)
        use = (row[: len(h)] == row[n - 1 :]) & (is_letter[: len(h)] | (n > 1))
        out += np.bincount(row[: len(h)][use] * dims + bucket[use].astype(np.int64), minlength=len(out)).astype(np.float32)
    return out.reshape(len(texts), dims)


def batches_of(texts: list[str], most: int = 64, chars: int = 400_000) -> Iterator[tuple[int, list[str]]]:
    """Texts in small groups, so that dense rows stay small."""
    at = 0
    while at < len(texts):
        to, n = at, 0
        while to < len(texts) and to - at < most and (to == at or n + len(texts[to]) <= chars):
            n += len(texts[to])
            to += 1
        yield at, texts[at:to]
        at = to


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts(texts, len(idf))) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


@dataclass(frozen=True)
class Centroids:
    languages: list[str]
    idf: np.ndarray
    vectors: np.ndarray  # unit rows
    language: np.ndarray  # of each row
    reach: np.ndarray  # least cosine that isn't rejected


def cluster(x: np.ndarray, k: int, rounds: int = 15) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: unit centroids (farthest-first start) and each row's cosine to its own."""
    c = x.mean(axis=0, keepdims=True)
    c /= max(np.linalg.norm(c), 1e-9)
    while len(c) < min(k, len(x)):
        c = np.vstack([c, x[np.argmin((x @ c.T).max(axis=1))]])
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        c = np.vstack([m / max(np.linalg.norm(m), 1e-9) for m in (x[own == i].mean(axis=0) for i in np.unique(own))])
    return c, x @ c.T


def fit(train: DataFrame, text: str = "text", lang: str = "lang", dims: int = 8192, per_language: int = 4, sample: int = 300, spread: float = 4.0) -> Centroids:
    """Centroids of the languages in train. The driver gets dims counts and about `sample` vectors per language."""
    train = train.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(*train.columns).alias("h"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(dims, np.int64), 0
        for batch in batches:
            for _, texts in batches_of(batch.column(0).to_pylist()):
                df += (counts(texts, dims) > 0).sum(axis=0)
                n += len(texts)
        if n:
            seen = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1)), pa.array(np.append(df[seen], n))], names=["bucket", "df"])

    df = np.zeros(dims)
    total = 0
    for bucket, n in train.select("text").mapInArrow(frequencies, "bucket long, df long").groupBy("bucket").agg(F.sum("df")).collect():
        if bucket < 0:
            total = n
        else:
            df[bucket] = n
    idf = np.where(df > 0, np.log((1 + total) / (1 + df)) + 1, 0).astype(np.float32)

    # a share of each language that gives about `sample` rows, whatever the language's size
    sizes = {r["lang"]: r["count"] for r in train.groupBy("lang").count().collect()}
    if not sizes:
        return Centroids([], idf, np.zeros((0, dims), np.float32), np.zeros(0, int), np.zeros(0))
    whole = 1 << 40
    share = F.create_map(*[F.lit(v) for k, n in sizes.items() for v in (k, min(whole, whole * sample // n))])

    def vectorise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in batches_of(batch.column(0).to_pylist()):
                rows = [x.tobytes() for x in vectors(texts, idf).astype(np.float16)]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(at, len(texts)), pa.array(rows, pa.binary())], names=["lang", "x"])

    picked = train.where(F.pmod("h", F.lit(whole)) < share[F.col("lang")]).select("text", "lang").mapInArrow(vectorise, "lang string, x binary").collect()
    languages, rows, owner, reach = sorted(sizes), [], [], []
    for i, name in enumerate(languages):
        x = [np.frombuffer(r["x"], np.float16).astype(np.float32) for r in sorted(picked, key=lambda r: bytes(r["x"])) if r["lang"] == name]
        if x:
            c, cos = cluster(np.vstack(x), per_language)
            own = cos.argmax(axis=1)
            for j in range(len(c)):
                mine = cos[own == j, j]
                reach.append(max(0.0, mean_less(mine, spread)))
            rows.append(c)
            owner += [i] * len(c)
    return Centroids(languages, idf, np.vstack(rows).astype(np.float32) if rows else np.zeros((0, dims), np.float32), np.array(owner, int), np.array(reach))


def mean_less(cosines: np.ndarray, spread: float) -> float:
    return float(cosines.mean() - spread * cosines.std()) if len(cosines) else 0.0


def classify(docs: DataFrame, model: Centroids, text: str = "text") -> DataFrame:
    """docs with lang_pred (nearest language), score (its cosine, 0 to 1) and rejected (too far from it)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.idf, model.vectors, model.language, model.reach))  # dims * (centroids + 1) floats
    letters = unused("_letters", docs.columns)
    docs = docs.withColumn(letters, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Centroids(*shared.value)
        for batch in batches:
            n = batch.num_rows
            ok = batch.column(batch.schema.get_field_index(letters)).to_numpy(zero_copy_only=False)
            lang, score, far = np.full(n, UNKNOWN, object), np.zeros(n), np.ones(n, bool)
            at = np.flatnonzero(ok) if len(m.vectors) else np.zeros(0, int)
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            for k, some in batches_of([texts[i] for i in at]):
                cos = vectors(some, m.idf) @ m.vectors.T
                best, rows = cos.argmax(axis=1), at[k : k + len(some)]
                top = cos[np.arange(len(some)), best]
                lang[rows] = [m.languages[j] for j in m.language[best]]
                score[rows] = np.clip(top, 0, 1)
                far[rows] = top < m.reach[best]
            yield put_columns(batch, {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(score), "rejected": pa.array(far)})

    return docs.mapInArrow(predict, with_fields(docs.schema, *fields)).drop(letters)


def op1_language(docs: DataFrame) -> DataFrame:
    held_out: Column = remainder("doc_id", 3) == 1
    model = fit(docs.where(F.col("doc_id").isNotNull() & ~held_out).select("doc_id", "text", "lang"))
    return classify(docs.select("doc_id", held_out.alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score", "rejected")
