"""Toxicity by weak supervision.

Many voters look at a text: lexicon voters (the words and word beginnings that tell
toxic from clean labelled rows apart, dealt out over several small lexicons) and pattern
voters (capitals, exclamation marks, symbols, repetition). A generative label model
explains their votes by a hidden label: EM estimates each voter's accuracy, and voters
that depend on each other given the label are linked in a tree, so that agreeing copies
of one signal don't count twice. A human label enters it as one more, reliable voter.
A linear classifier over lexicon hits and patterns is trained on the posterior labels.

Lexicon and classifier are fitted on a sample of about `most` labelled rows a class at most
(a documented bound). Rows without a label all enter the label model: each gets its votes,
and the model sees how many rows have which votes. Scoring covers every whole text,
whatever its length.

Null and empty texts get the score of a text without any hit. Without labelled rows of
both classes every score is the share of toxic labels (0 with none). Labels of null are
no labels; several labels of a document count as several rows. Repeated rows are scored
alike; of ties nothing depends. Columns named like the outputs are replaced, others are
passed on. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SpanHash, lower_ascii, pieces, put_columns, remainder, utf8, with_fields, words_of, written

BEGINNINGS = (4, 5, 6)  # lengths in bytes of the word beginnings that are terms too
GOLD = 0.995  # reliability of a human label
PATTERNS = 5


def word_bytes() -> np.ndarray:
    table = np.zeros(256, bool)
    table[48:58] = table[65:91] = table[97:123] = table[128:] = True
    return table


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and word beginnings, and their rows."""
    data = lower_ascii()[data]
    a, b, row = words_of(data, offsets, word_bytes())
    span = SpanHash(data)
    found, rows = [span(a, b)], [row]
    for n in BEGINNINGS:
        long = b - a > n
        found.append(span(a[long], a[long] + n) + np.uint64(n))
        rows.append(row[long])
    return np.concatenate(found), np.concatenate(rows)


def patterns(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Votes of the pattern voters: shouting, exclamations, symbols, digits, one byte repeated."""
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(offsets))
    share = lambda mask: np.bincount(row[mask], minlength=n) / np.maximum(np.diff(offsets), 1)
    again = np.zeros(len(data), bool)
    again[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2])
    upper, digit = (data >= 65) & (data <= 90), (data >= 48) & (data <= 57)
    symbol = ((data >= 33) & (data <= 47) | (data >= 58) & (data <= 64) | (data >= 91) & (data <= 96)) & (data != 44) & (data != 46)
    return np.column_stack([share(upper) > 0.3, share(data == 33) > 0.01, share(symbol) > 0.05, share(digit) > 0.1, share(again) > 0.02])


def distinct(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], row[new]


def hits(lexicon: np.ndarray, data: np.ndarray, offsets: np.ndarray, maybe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (term number, row) of the sorted lexicon's terms; maybe: table of their first 20 bits."""
    h, row = terms(data, offsets)
    some = maybe[(h >> np.uint64(44)).astype(np.int64)]
    h, row = distinct(h[some], row[some])
    at = np.minimum(np.searchsorted(lexicon, h), max(len(lexicon) - 1, 0))
    ok = lexicon[at] == h if len(lexicon) else np.zeros(len(h), bool)
    return at[ok], row[ok]


def first_bits(lexicon: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << 20, bool)
    table[(lexicon >> np.uint64(44)).astype(np.int64)] = True
    return table


# --- generative label model -------------------------------------------------------------


@dataclass
class LabelModel:
    """P(label) and, per voter, P(vote | label, vote of its parent)."""

    prior: float
    parent: list[int]  # -1: none
    table: np.ndarray  # voter, label, parent's vote -> P(vote = 1)

    def posterior(self, votes: np.ndarray, gold: np.ndarray) -> np.ndarray:
        """P(label = 1) of each row; gold: 1, 0 or -1 for none."""
        odds = np.full(len(votes), np.log(self.prior) - np.log(1 - self.prior))
        for j, p in enumerate(self.parent):
            up = votes[:, p] if p >= 0 else np.zeros(len(votes), int)
            p1, p0 = self.table[j, 1, up], self.table[j, 0, up]
            v = votes[:, j]
            odds += np.where(v == 1, np.log(p1) - np.log(p0), np.log(1 - p1) - np.log(1 - p0))
        odds += np.where(gold < 0, 0, np.where(gold == 1, 1, -1) * (np.log(GOLD) - np.log(1 - GOLD)))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def maximise(votes: np.ndarray, q: np.ndarray, mass: np.ndarray, parent: list[int]) -> LabelModel:
    """The tables that suit labels q best; mass: how many rows each row stands for."""
    weight = np.column_stack([1 - q, q]) * mass[:, None]
    table = np.zeros((votes.shape[1], 2, 2))
    for j, p in enumerate(parent):
        for y in (0, 1):
            for u in (0, 1):
                w = weight[:, y] * (votes[:, p] == u) if p >= 0 else weight[:, y]
                table[j, y, u] = ((w * votes[:, j]).sum() + 0.5) / (w.sum() + 1)
    return LabelModel(float(np.clip((q * mass).sum() / mass.sum(), 1e-4, 1 - 1e-4)), parent, np.clip(table, 1e-4, 1 - 1e-4))


def correlations(votes: np.ndarray, q: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """Mutual information of each pair of voters given the label."""
    v = np.stack([1 - votes, votes]).astype(float)  # value, row, voter
    out = np.zeros((votes.shape[1],) * 2)
    for w in ((1 - q) * mass, q * mass):
        total = max(w.sum(), 1e-9)
        single = (v * w[None, :, None]).sum(axis=1) / total
        for a in (0, 1):
            for b in (0, 1):
                joint = (v[a] * w[:, None]).T @ v[b] / total
                out += total / mass.sum() * np.where(joint > 0, joint * np.log(np.maximum(joint, 1e-12) / np.maximum(np.outer(single[a], single[b]), 1e-12)), 0)
    return out


def dependency_tree(info: np.ndarray, least: float = 0.002) -> list[int]:
    """Parents in the maximum spanning forest of the links of at least `least`."""
    n = len(info)
    parent, done = [-1] * n, [False] * n
    for root in range(n):
        if done[root]:
            continue
        done[root], inside = True, [root]
        while True:
            best = max(((info[i, j], i, j) for i in inside for j in range(n) if not done[j]), default=(0, 0, 0))
            if best[0] < least:
                break
            parent[best[2]], done[best[2]] = best[1], True
            inside.append(best[2])
    return parent


def label_model(votes: np.ndarray, gold: np.ndarray, mass: np.ndarray | None = None, rounds: int = 15) -> LabelModel:
    """EM, with voters linked by the correlations among human-labelled rows first, then among all. mass: how many rows each row stands for (None: one)."""
    mass = np.ones(len(gold)) if mass is None else mass
    known = gold >= 0
    rate = (gold == 1).sum() / max(known.sum(), 1)
    q = np.where(known, np.where(gold == 1, GOLD, 1 - GOLD), rate)
    some = known if known.any() else np.ones(len(gold), bool)
    parent = dependency_tree(correlations(votes[some], q[some], mass[some]), 0.01)
    model = maximise(votes[some], q[some], mass[some], parent)
    for step in range(2):
        for _ in range(rounds):
            q = model.posterior(votes, gold)
            model = maximise(votes, q, mass, parent)
        if not step:
            parent = dependency_tree(correlations(votes, q, mass))
            model = maximise(votes, q, mass, parent)
    return model


def linear(row: np.ndarray, column: np.ndarray, width: int, target: np.ndarray, mass: np.ndarray | None = None, rounds: int = 400, rate: float = 0.05, shrink: float = 2e-4) -> np.ndarray:
    """Weights (the last is the bias) of a logistic regression on soft labels, by Adam.

    The training matrix is given by the (row, column) of its ones. mass: weights of the rows (None: all alike).
    """
    mass = np.full(len(target), 1 / max(len(target), 1)) if mass is None else mass / mass.sum()
    w, m, v = (np.zeros(width + 1) for _ in range(3))
    mean = float(np.clip((target * mass).sum(), 1e-3, 1 - 1e-3))
    w[-1] = np.log(mean / (1 - mean))
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[column], len(target)) + w[-1], -30, 30)))
        off = (p - target) * mass
        g = np.append(np.bincount(column, off[row], width), off.sum())
        g[:-1] += shrink * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w.astype(np.float32)


@dataclass
class Model:
    lexicon: np.ndarray  # sorted term hashes
    weights: np.ndarray  # of terms, patterns, bias


def fit(train: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", most: int = 5000, voters: int = 12, clean: float = 2.0, seed: int = 5) -> Model:
    """Label model and classifier from train's texts and the labels of their ids.

    most: about so many rows of each label are used, for the lexicon, the classifier and, with
    their labels, the label model. Rows without a label all count in the label model, by
    how many of them have which votes (2 to the number of voters at most); together they weigh as
    much as the labelled ones. clean: weight of clean rows in the classifier, as they are the more
    frequent ones.
    """
    labels = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).select(F.col(key).alias("_id"), F.col(label).cast("int").alias("_label"))
    ids = train.select(F.col(key).alias("_id"))
    labels = written(labels.join(ids, "_id", "left_semi"), "labels")
    sizes = {r[0]: r[1] for r in labels.groupBy("_label").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        p = float(bool(sizes.get(1)))
        return Model(np.zeros(0, np.uint64), np.array([*[0.0] * PATTERNS, 30.0 * (2 * p - 1)], np.float32))
    whole = 1 << 40
    share = lambda n: min(whole, whole * most // max(n, 1))
    h = F.pmod(F.xxhash64(F.lit(seed), "_id"), F.lit(whole))
    picked = labels.where(h < F.when(F.col("_label") == 1, F.lit(share(sizes[1]))).otherwise(F.lit(share(sizes[0]))))
    # about 2 * most ids: a bounded table
    chosen = F.broadcast(written(picked, "chosen"))
    sample = written(train.select(F.col(key).alias("_id"), F.coalesce(text, F.lit("")).alias("text")).join(chosen, "_id").select("text", "_label"), "sample")

    def list_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            gold = batch.column(1).to_numpy()
            for i, j in pieces(offsets, 1_000_000):
                t, row = distinct(*terms(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
                t, n = np.unique(np.column_stack([t.view(np.int64), gold[i:j][row]]), axis=0, return_counts=True) if len(t) else (np.zeros((0, 2), np.int64), np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(t[:, 0]), pa.array(n * (t[:, 1] == 1)), pa.array(n * (t[:, 1] == 0))], names=["term", "n1", "n0"])

    # log odds with their error, of terms in some rows at least
    n1, n0 = (int(sample.where(F.col("_label") == y).count()) for y in (1, 0))
    counts = sample.where("_label >= 0").mapInArrow(list_terms, "term long, n1 long, n0 long").groupBy("term").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    odd = F.log((F.col("n1") + 0.5) / (n1 - F.col("n1") + 0.5)) - F.log((F.col("n0") + 0.5) / (n0 - F.col("n0") + 0.5))
    error = F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    best = counts.where("n1 + n0 >= 3").select("term", odd.alias("odd"), (odd / error).alias("z")).where("abs(z) > 3 AND abs(odd) > 2").select("term", "z").collect()
    z = {r["term"]: r["z"] for r in best}
    words = np.sort(np.array(list(z), np.int64).view(np.uint64)) if z else np.zeros(0, np.uint64)
    strength = np.array([z[t] for t in words.view(np.int64).tolist()])
    shared = sample.sparkSession.sparkContext.broadcast((words, first_bits(words)))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, maybe = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for i, j in pieces(offsets, 1_000_000):
                part = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                t, row = hits(lex, *part, maybe)
                cuts = np.searchsorted(row, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays([
                    batch.column(1).slice(i, j - i),
                    pa.array([t[a:b].astype(np.int32).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                    pa.array([v.tobytes() for v in patterns(*part)], pa.binary()),
                ], names=["gold", "hits", "patterns"])

    rows = sorted(sample.mapInArrow(find, "gold int, hits binary, patterns binary").collect(), key=lambda r: (r["gold"], bytes(r["hits"]), bytes(r["patterns"])))
    gold = np.array([r["gold"] for r in rows])
    looks = np.array([np.frombuffer(r["patterns"], bool) for r in rows]).astype(int)
    terms_of = [np.frombuffer(r["hits"], np.int32) for r in rows]
    row, term = np.repeat(np.arange(len(rows)), [len(t) for t in terms_of]), np.concatenate(terms_of).astype(np.int64)
    # toxic terms are dealt out over the lexicon voters by strength; clean terms only enter the classifier
    toxic = np.argsort(-strength)[: int((strength > 0).sum())]
    voter = np.full(len(words), -1)
    voter[toxic] = np.arange(len(toxic)) % voters
    lexica = np.zeros((len(rows), voters), int)
    lexica[row[voter[term] >= 0], voter[term[voter[term] >= 0]]] = 1
    told = sample.sparkSession.sparkContext.broadcast((words, first_bits(words), voter))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, maybe, who = told.value
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in pieces(offsets, 1_000_000):
                part = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                t, row = hits(lex, *part, maybe)
                v = np.zeros((j - i, voters + PATTERNS), np.int64)
                v[row[who[t] >= 0], who[t[who[t] >= 0]]] = 1
                v[:, voters:] = patterns(*part)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(v @ (1 << np.arange(voters + PATTERNS)))], names=["_id", "votes"])

    cast = T.StructType([T.StructField("_id", train.schema[key].dataType), T.StructField("votes", T.LongType())])
    others = train.select(F.col(key).alias("_id"), F.coalesce(text, F.lit("")).alias("text")).mapInArrow(vote, cast).join(labels.select("_id"), "_id", "left_anti")
    rest = sorted((r["votes"], r["n"]) for r in others.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect())
    codes, many = (np.array([r[k] for r in rest], np.int64) for k in range(2))
    own = np.column_stack([lexica, looks])
    votes = np.vstack([own, codes[:, None] >> np.arange(voters + PATTERNS) & 1])
    mass = np.concatenate([np.ones(len(own)), many * (len(own) / max(many.sum(), 1))])
    model = label_model(votes, np.concatenate([gold, np.full(len(codes), -1)]), mass)
    seen, look = np.nonzero(looks)
    target = model.posterior(own, gold)
    weights = linear(np.append(row, seen), np.append(term, len(words) + look), len(words) + PATTERNS, target, np.where(gold == 1, 1.0, clean))
    return Model(words, weights)


def score_toxicity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with score (0 to 1) and predicted (1 if score >= 0.5)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.lexicon, first_bits(model.lexicon), model.weights))
    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, maybe, w = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
            out = np.zeros(batch.num_rows)
            for i, j in pieces(offsets, 1_000_000):
                part = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                t, row = hits(lex, *part, maybe)
                x = np.bincount(row, w[t], minlength=j - i) + patterns(*part) @ w[len(lex) : -1] + w[-1]
                out[i:j] = 1 / (1 + np.exp(-np.clip(x, -30, 30)))
            yield put_columns(batch, {"score": pa.array(out), "predicted": pa.array((out >= 0.5).astype(np.int32))})

    return docs.mapInArrow(score, with_fields(docs.schema, *fields))


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows that labels may be learned from: crc32(doc_id as text) mod 5 is not 0."""
    return docs.where(remainder("doc_id", 5) > 0)


def op7_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(training_rows(docs).select("doc_id", "text"), labels)
    rows = docs.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "text")
    return score_toxicity(rows, model).select("doc_id", "held_out", "score", "predicted")
