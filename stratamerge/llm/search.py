"""Exact top-k search by BM25: inverted indexes with block-max pruning, per shard, merged exactly.

Documents are dealt into shards of bounded size. A shard orders its documents so that
neighbours are alike and cuts them into blocks. The rarer terms of its inverted index have
posting lists, from which all documents get their scores by these terms, for a batch of
queries at once. Each block keeps its impacts of the frequent terms as a small matrix, and
the largest of each. A block is a pivot of a query if these block maxima and the best score by
rarer terms in the block reach the query's k-th best score so far. Only pivots get the frequent
terms' part, all queries with a pivot in a block by one product in single precision; exact
scores follow for what may be among the best. The k-th score starts with the blocks of the
highest bounds. Queries that bring a threshold from other shards take all their pivots in one step.

Every query first meets FAN shards, where it is dealt with the shards' documents. Its k-th
score so far is the threshold for the next shards, FAN times as many after each round, until it
has met all. So about (FAN - 1) k rows a query come out of a round, and the rows in all grow with
the queries and the logarithm of the shards. The rounds' tasks read the queries from the
shared folder, in files of bounded size, one after another. A shard returns only what reaches
the threshold.

Document frequencies, the number of documents and their mean length are those of the
whole corpus, so the shards' scores are final and the best k of all shards are exact.
Scores are rounded to 6 decimals, equal ones ordered by key (null last).

Terms are runs of ASCII letters and digits (A-Z as a-z) and other characters beyond
ASCII. Null and empty texts are documents of length 0: as queries they find nothing, as
documents they aren't found; a query finds only documents that share a term with it.
Rows of one key among the queries are one query of all their terms; among the documents
each row is a document of its own and is found each. A text is read whole, whatever its
length. An empty table gives an empty result. Columns other than key and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.geoparquet import located
from ..sources.scratch import discard
from .common import SpanHash, bit_table, in_table, lower_ascii, pieces, utf8, words_of, written

K1, B = 1.2, 0.75
BLOCK = 64
DENSE = 512  # most frequent terms of a shard, whose impacts are held as a matrix for each block
BATCH, BATCH_TERMS = 256, 65_536  # queries that move together, and their terms (a longer query moves alone)
POSTINGS, FOUND = 65_536, 4096  # scored at a time
SLACK = 1e-4  # single precision is off by less than half this share of a score, for sums of up to DENSE terms
SHARD_ROWS, SHARD_POSTINGS = 8192, 2_000_000
FAN = 4  # shards that a query meets first, and by which they grow from round to round
CHUNK = 16 << 20  # bytes of queries that a task holds


def word_bytes() -> np.ndarray:
    table = np.zeros(256, bool)
    table[48:58] = table[65:91] = table[97:123] = table[128:] = True
    return table


def term_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of all rows (hash, row, count; by row, then hash) and the rows' lengths in terms."""
    data = lower_ascii()[data]
    a, b, row = words_of(data, offsets, word_bytes())
    h = SpanHash(data)(a, b)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return h[at], row[at], np.diff(np.append(at, len(h))), np.bincount(row, minlength=len(offsets) - 1)


def rows_of_terms(docs: DataFrame, key: str, text: str, wanted=None) -> DataFrame:
    """(key, length, terms, counts) of each row; only terms that pass the filter, if there is one."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = wanted.value if wanted is not None else None
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in pieces(offsets, 1_000_000):
                h, row, n, length = term_counts(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                if table is not None:
                    ok = in_table(table, h)
                    h, row, n = h[ok], row[ok], n[ok]
                cut = np.searchsorted(row, np.arange(j - i + 1))
                spans = list(zip(cut[:-1], cut[1:], strict=True))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array(length.astype(np.int64)),
                    pa.array([h[a:b].tobytes() for a, b in spans], pa.binary()), pa.array([n[a:b].astype(np.int32).tobytes() for a, b in spans], pa.binary()),
                ], names=["key", "length", "terms", "counts"])

    schema = T.StructType().add("key", docs.schema[key].dataType).add("length", "long").add("terms", "binary").add("counts", "binary")
    return docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(make, schema)


def exploded(rows: DataFrame) -> DataFrame:
    """(key, term, n) from rows of terms."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = [np.frombuffer(x, np.int64) for x in batch.column("terms").to_pylist()]
            n = [np.frombuffer(x, np.int32) for x in batch.column("counts").to_pylist()]
            if t:
                row = np.repeat(np.arange(len(t)), [len(x) for x in t])
                yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(row)), pa.array(np.concatenate(t)), pa.array(np.concatenate(n))], names=["key", "term", "n"])

    return rows.mapInArrow(make, T.StructType().add("key", rows.schema["key"].dataType).add("term", "long").add("n", "integer"))


def document_frequencies(rows: DataFrame) -> DataFrame:
    """(term, df), summed per task first."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            t, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(t), pa.array(n.astype(np.int64))], names=["term", "df"])

        size = 0
        for batch in batches:
            for x in batch.column(0).to_pylist():
                held.append(np.frombuffer(x, np.int64))
                size += len(held[-1])
            if size > 4_000_000:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    return rows.select("terms").mapInArrow(make, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


# --- one shard --------------------------------------------------------------------------


def alike_order(looks: np.ndarray, leaf: int, rounds: int = 6) -> np.ndarray:
    """Rows in an order in which neighbours are alike: halved by their leading component until `leaf` are left."""
    rng, done, todo = np.random.default_rng(0), [], [np.arange(len(looks))]
    while todo:
        some = todo.pop()
        if len(some) <= leaf:
            done.append(some)
            continue
        x = looks[some] - looks[some].mean(axis=0)
        v = rng.standard_normal(x.shape[1]).astype(np.float32)
        for _ in range(rounds):
            v = x.T @ (x @ v)
            v /= max(np.linalg.norm(v), 1e-9)
        some = some[np.argsort(x @ v, kind="stable")]
        half = -(-(len(some) // 2) // leaf) * leaf
        todo += [some[half:], some[:half]]
    return np.concatenate(done) if done else np.zeros(0, np.int64)


def spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], ... first[0] + n[0] - 1, first[1], ..."""
    return np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)


def pieces_of(n: np.ndarray, most: int, rows: int | None = None) -> Iterator[slice]:
    """Neighbours whose sum is `most` at most and whose number is `rows` at most; one at least."""
    total, a = np.cumsum(n), 0
    while a < len(n):
        b = int(np.searchsorted(total, (total[a - 1] if a else 0) + most, side="right"))
        b = max(a + 1, b if rows is None else min(b, a + rows))
        yield slice(a, b)
        a = b


class Shard:
    """Inverted index of some documents. Postings are ordered by term, then by document."""

    def __init__(self, size: int, length: np.ndarray, term: np.ndarray, doc: np.ndarray, tf: np.ndarray, mean: float):
        self.size, self.arrays = size, (length, term, doc, tf)
        self.norm = K1 * (1 - B + B * length / mean)
        self.impact = tf * (K1 + 1) / (tf + self.norm[doc])
        self.doc, self.blocks = doc, -(-size // BLOCK)
        begin = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
        self.terms, self.first = term[begin], np.append(begin, len(term))  # postings of each term
        n = np.diff(self.first)
        top = np.argsort(-n, kind="stable")[:DENSE]
        top = top[n[top] * 200 > size]
        self.row = np.full(len(begin), -1)
        self.row[top] = np.arange(len(top))
        row = np.repeat(self.row, n)
        at = np.flatnonzero(row >= 0)
        # rough impacts of the frequent terms that a block has; the exact ones follow from the counts
        dense = np.zeros((self.blocks, len(top), BLOCK), np.float32)
        dense[doc[at] // BLOCK, row[at], doc[at] % BLOCK] = self.impact[at]
        self.dense_most = dense.max(axis=2, initial=0).T
        has = [np.flatnonzero(most) for most in self.dense_most.T]
        self.dense = [(rows, dense[b, rows]) for b, rows in enumerate(has)]
        self.counts = np.zeros((size, len(top)), np.min_scalar_type(int(tf[at].max(initial=0))))
        self.counts[doc[at], row[at]] = tf[at]

    @classmethod
    def of(cls, lengths: list[int], terms: list[np.ndarray], counts: list[np.ndarray], mean: float) -> tuple[Shard, np.ndarray]:
        """The shard of some documents, and their order in it."""
        n, length = np.array([len(t) for t in terms]), np.array(lengths, np.int64)
        doc, term, tf = np.repeat(np.arange(len(terms)), n), np.concatenate(terms), np.concatenate(counts)
        known, at, df = np.unique(term, return_inverse=True, return_counts=True)
        top = np.argsort(-df, kind="stable")[:DENSE]
        row = np.full(len(known), -1)
        row[top] = np.arange(len(top))
        looks, some = np.zeros((len(terms), len(top)), np.float32), row[at] >= 0
        impact = tf[some] * (K1 + 1) / (tf[some] + K1 * (1 - B + B * length[doc[some]] / mean))
        looks[doc[some], row[at[some]]] = impact * np.log(1 + len(terms) / df[at[some]])
        order = alike_order(looks, BLOCK)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        doc = place[doc]
        by_term = np.lexsort((doc, term))
        return cls(len(terms), length[order], term[by_term], doc[by_term].astype(np.int32), tf[by_term].astype(np.int32), mean), order

    def stored(self) -> list[bytes]:
        """What an index row holds: lengths, terms, their postings' number, documents and frequencies, in the narrowest types."""
        length, term, doc, tf = self.arrays
        n = np.diff(np.append(np.searchsorted(term, self.terms), len(term)))
        narrow = lambda x: x.astype(np.min_scalar_type(int(x.max(initial=0)))).tobytes()
        return [length.astype(np.int64).tobytes(), self.terms.tobytes(), n.astype(np.int32).tobytes(), narrow(doc), narrow(tf)]

    @classmethod
    def loaded(cls, stored: list[bytes], mean: float) -> Shard:
        length, terms, n = (np.frombuffer(x, kind) for x, kind in zip(stored, (np.int64, np.uint64, np.int32), strict=False))
        wide = lambda x: np.frombuffer(x, f"u{len(x) // max(int(n.sum()), 1) or 1}").astype(np.int32)
        return cls(len(length), length, np.repeat(terms, n), wide(stored[3]), wide(stored[4]), mean)

    def search(self, terms: list[np.ndarray], weights: list[np.ndarray], floor: np.ndarray, k: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
        """(documents, scores) of each query's best k of at least its floor, with all that tie; and how many (query, block) pairs were scored."""
        m, wide = len(terms), self.blocks * BLOCK
        q, term, weight = np.repeat(np.arange(m), [len(t) for t in terms]), np.concatenate(terms), np.concatenate(weights)
        at = np.minimum(np.searchsorted(self.terms, term), max(len(self.terms) - 1, 0))
        ok = self.terms[at] == term if len(self.terms) else np.zeros(len(term), bool)
        q, at, weight = q[ok], at[ok], weight[ok]
        row = self.row[at]
        frequent = row >= 0
        w = np.zeros((m, self.counts.shape[1]))
        w[q[frequent], row[frequent]] = weight[frequent]
        single = w.astype(np.float32)
        # scores of all documents by the rarer terms, exact
        q, at, weight = q[~frequent], at[~frequent], weight[~frequent]
        n, scores = self.first[at + 1] - self.first[at], np.zeros((m, wide))
        for part in pieces_of(n, POSTINGS):
            lo, hi, posting = q[part.start], q[part.stop - 1] + 1, spread(self.first[at[part]], n[part])
            cell = np.repeat((q[part] - lo) * wide, n[part]) + self.doc[posting]
            scores[lo:hi] += np.bincount(cell, np.repeat(weight[part], n[part]) * self.impact[posting], (hi - lo) * wide).reshape(-1, wide)
        scores = scores.reshape(m, self.blocks, BLOCK)
        bound = (single @ self.dense_most + scores.max(axis=2, initial=0)) * (1 + SLACK)
        # with the frequent terms' part in single precision, for pivots
        rough, scored = np.zeros((m, self.blocks, BLOCK), np.float32), np.zeros((m, self.blocks), bool)

        def score(pivots: np.ndarray) -> None:
            for block in np.flatnonzero(pivots.any(axis=0)).tolist():
                who, (rows, dense) = np.flatnonzero(pivots[:, block]), self.dense[block]
                rough[who, block] = single[np.ix_(who, rows)] @ dense + scores[who, block]
            scored[pivots] = True

        def reached(part: np.ndarray) -> np.ndarray:
            """What the k-th best of these scores, or the floor, asks for."""
            kth = np.partition(part, -k, axis=1)[:, -k] if part.shape[1] >= k else np.zeros(m)
            return np.maximum(floor, kth * (1 - SLACK))

        if (floor > 0).all():  # k-th scores of several shards: this one hardly raises them
            score((bound >= floor[:, None] - 1e-6) & (bound > 0))
            least = floor
        else:
            lead = min(-(-2 * k // BLOCK) + 1, self.blocks)
            first = np.argpartition(-bound, lead - 1, axis=1)[:, :lead]
            pivots = np.zeros_like(scored)
            np.put_along_axis(pivots, first, True, axis=1)
            score(pivots & (bound > 0))
            least = reached(np.take_along_axis(rough, first[:, :, None], axis=1).reshape(m, -1))
            score((bound >= least[:, None] - 1e-6) & (bound > 0) & ~scored)
            least = reached(rough.reshape(m, wide))
        # exact scores of all that may be among the best
        least = np.maximum(least * (1 - SLACK) - 1e-6, 1e-9).astype(np.float32)
        who, found = np.divmod(np.flatnonzero(rough.reshape(m, wide) >= least[:, None]), wide)
        scores = scores.reshape(m, wide)
        exact = np.zeros(len(who))
        for a in range(0, len(who), FOUND):
            i, j = who[a : a + FOUND], found[a : a + FOUND]
            count = self.counts[j].astype(float)
            exact[a : a + FOUND] = np.round(scores[i, j] + np.einsum("ij,ij->i", w[i], count * (K1 + 1) / (count + self.norm[j][:, None])), 6)
        cuts = np.searchsorted(who, np.arange(m + 1))
        out = []
        for x, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            kth = np.partition(exact[i:j], j - i - k)[j - i - k] if j - i > k else 0.0
            use = exact[i:j] >= max(kth, floor[x], 1e-6)
            out.append((found[i:j][use], exact[i:j][use]))
        return out, int(scored.sum())


def hits(shard: Shard, keys: list, queries: list[tuple], k: int) -> tuple[list, list, list]:
    """query ids, documents and scores of the queries (id, terms, weights, floor), at most k each."""
    ids, docs, scores = [], [], []
    for part in pieces_of(np.array([len(x[1]) for x in queries], np.int64), BATCH_TERMS, BATCH):
        some = queries[part]
        found, _ = shard.search([x[1] for x in some], [x[2] for x in some], np.array([x[3] for x in some]), k)
        for (name, *_), (which, score) in zip(some, found, strict=True):
            rows = sorted(zip((-score).tolist(), [(keys[i] is None, keys[i]) for i in which.tolist()], strict=True))[:k]
            ids += [name] * len(rows)
            docs += [key for _, (_, key) in rows]
            scores += [-x for x, _ in rows]
    return ids, docs, scores


# --- all shards -------------------------------------------------------------------------

PARTS = ("lengths", "terms", "counts", "docs", "tfs")  # of a stored index


def index_shards(both: DataFrame, mean: float, k: int, key: T.DataType) -> DataFrame:
    """Per shard a row with its index, and rows with the best k of the queries dealt to it.

    both: (shard, query, key, length, terms, vals), a shard's documents before its queries.
    """
    schema = T.StructType().add("shard", "long")
    for name in PARTS:
        schema = schema.add(name, "binary")
    schema = schema.add("keys", T.ArrayType(key)).add("query_id", key).add("doc_id", key).add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, docs, queries, kind = None, [], [], None

        def out() -> pa.RecordBatch:
            keys, rows = [], ([], [], [])
            parts = [None] * len(PARTS)
            if docs:
                shard, order = Shard.of([d[1] for d in docs], [d[2] for d in docs], [d[3] for d in docs], mean)
                keys, parts = [docs[i][0] for i in order.tolist()], shard.stored()
                rows = hits(shard, keys, queries, k)
            n = len(rows[0])
            return pa.RecordBatch.from_arrays([
                pa.array([now] * (n + 1), pa.int64()), *[pa.array([x, *[None] * n], pa.binary()) for x in parts], pa.array([keys, *[None] * n], pa.list_(kind)),
                pa.array([None, *rows[0]], kind), pa.array([None, *rows[1]], kind), pa.array([None, *rows[2]], pa.float64()),
            ], names=[f.name for f in schema.fields])

        for batch in batches:
            kind = batch.column("key").type
            for number, query, name, length, terms, values in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if number != now:
                    if now is not None:
                        yield out()
                    now, docs, queries = number, [], []
                if query:
                    queries.append((name, np.frombuffer(terms, np.uint64), np.frombuffer(values, np.float64), 0.0))
                else:
                    docs.append((name, length, np.frombuffer(terms, np.uint64), np.frombuffer(values, np.int32)))
        if now is not None:
            yield out()

    return both.mapInArrow(run, schema)


def ask_shards(index: DataFrame, blocks: list[str], ahead: range, shards: int, mean: float, k: int, key: T.DataType) -> DataFrame:
    """(query_id, doc_id, score) of queries (key, terms, vals, floor, shard) from the shards that lie so far ahead of their own.

    blocks: files of the written queries, each of bounded size. A task loads its shard once and
    reads one block after another from the shared folder.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.column("keys").type.value_type
            for i in range(batch.num_rows):
                number, keys = batch.column("shard")[i].as_py(), batch.column("keys")[i].as_py()
                shard = Shard.loaded([batch.column(p)[i].as_buffer() for p in PARTS], mean)
                for path in blocks:
                    store, name = located(unquote(path))
                    with store.open_input_file(name) as f:
                        rows = pq.read_table(f, columns=["key", "terms", "vals", "floor", "shard"])
                    far = (number - rows.column("shard").to_numpy()) % shards
                    rows = rows.filter(pa.array((far >= ahead.start) & (far < ahead.stop)))
                    some = [(n, np.frombuffer(t, np.uint64), np.frombuffer(w, np.float64), f) for n, t, w, f in zip(*[c.to_pylist() for c in rows.columns[:4]], strict=True)]
                    ids, docs, scores = hits(shard, keys, some, k)
                    yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(docs, kind), pa.array(scores, pa.float64())], names=["query_id", "doc_id", "score"])

    return index.select("shard", *PARTS, "keys").mapInArrow(run, T.StructType().add("query_id", key).add("doc_id", key).add("score", "double"))


def best_of_all(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best of each query."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


def search(docs: DataFrame, queries: DataFrame, key: str = "doc_id", text: str = "text", k: int = 10, shard_rows: int = SHARD_ROWS, chunk: int = CHUNK) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best documents of each query, by the whole texts of both."""
    spark, kind = docs.sparkSession, docs.schema[key].dataType
    asked = written(rows_of_terms(queries, key, text), "queries")
    each = exploded(asked).groupBy("key", "term").agg(F.sum("n").alias("n"))
    wanted = spark.sparkContext.broadcast(bit_table(each.select("term").distinct(), "term"))
    rows = written(rows_of_terms(docs, key, text, wanted), "documents")
    n, total, postings = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)), F.coalesce(F.sum(F.octet_length("terms")), F.lit(0)) / 8).first()
    mean = total / n if total else 1.0
    shards = int(max(1, -(-n // shard_rows), -(-postings // SHARD_POSTINGS)))
    df = document_frequencies(rows)
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = each.join(df, "term").select("key", F.struct("term", (F.col("n") * idf).alias("w")).alias("t"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = [sorted((x["term"] & (1 << 64) - 1, x["w"]) for x in some) for some in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.array([a for a, _ in x], np.uint64).tobytes() for x in t], pa.binary()), pa.array([np.array([b for _, b in x]).tobytes() for x in t], pa.binary())], names=["key", "terms", "vals"])

    ready = weighed.groupBy("key").agg(F.collect_list("t").alias("ts")).mapInArrow(packed, T.StructType().add("key", kind).add("terms", "binary").add("vals", "binary"))
    ready = written(ready.withColumn("shard", F.pmod(F.xxhash64("terms", F.lit(1)), F.lit(shards).cast("long"))), "weighted")
    dealt = rows.where("octet_length(terms) > 0").select(F.pmod(F.xxhash64("key", "terms"), F.lit(shards).cast("long")).alias("shard"), F.lit(False).alias("query"), "key", "length", "terms", F.col("counts").alias("vals"))
    home = ready.select(F.explode(F.sequence(F.lit(0), F.lit(min(FAN, shards) - 1))).alias("ahead"), "*")
    home = home.select(F.pmod(F.col("shard") + F.col("ahead"), F.lit(shards)).alias("shard"), F.lit(True).alias("query"), "key", F.lit(0).cast("long").alias("length"), "terms", "vals")
    both = dealt.union(home).repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "query")
    index = written(index_shards(both, mean, k, kind), "shards")
    discard(asked, rows)
    best = best_of_all(index.where("score IS NOT NULL").select("query_id", "doc_id", "score"), k)
    if shards > FAN:
        best = written(best, "best")
        # blocks of about `chunk` bytes, a file each
        chunks = int(max(1, -(-ready.agg(F.coalesce(F.sum(F.octet_length("terms") + F.octet_length("vals")), F.lit(0))).first()[0] // chunk)))
    met = FAN
    while met < shards:
        reached = best.groupBy("query_id").agg(F.when(F.count("score") >= k, F.min("score")).otherwise(0.0).alias("floor"))
        asked = ready.join(reached, ready["key"].eqNullSafe(reached["query_id"]), "left").select("key", "terms", "vals", F.coalesce("floor", F.lit(0.0)).alias("floor"), "shard")
        asked = written(asked.repartition(chunks), "asked")
        found = ask_shards(index.where("terms IS NOT NULL"), sorted(asked.inputFiles()), range(met, min(FAN * met, shards)), shards, mean, k, kind)
        before, best = best, written(best_of_all(best.select(*found.columns).union(found), k), "best")
        discard(asked, before)
        met *= FAN
    return best


def every_fiftieth(key: str) -> Column:
    return F.col(key) % 50 == 0


def op4_search(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    return search(docs, docs.where(every_fiftieth("doc_id")))


#: The same by joining all terms.
OP4_SQL = """
WITH words AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS n FROM words GROUP BY ALL),
len AS (SELECT doc_id, count(*) AS length FROM words GROUP BY 1),
corpus AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT sum(length) FROM len)::DOUBLE / (SELECT count(*) FROM documents) AS mean),
idf AS (SELECT term, ln(1 + (c.n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, corpus c GROUP BY term, c.n),
scored AS (SELECT q.doc_id AS query_id, d.doc_id, round(sum(q.n * idf * d.n * 2.2 / (d.n + 1.2 * (0.25 + 0.75 * length / mean))), 6) AS score
  FROM tf q JOIN tf d USING (term) JOIN idf USING (term) JOIN len ON len.doc_id = d.doc_id, corpus WHERE q.doc_id % 50 = 0 GROUP BY 1, 2)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scored
QUALIFY rank <= 10
"""
