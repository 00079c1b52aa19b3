"""The label model, the classifier and the nearest centroid against plain computations on small tables."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratamerge.llm import langid, toxicity
from stratamerge.llm.common import documents


def plain_posterior(model, votes, gold):
    out = []
    for v, g in zip(votes.tolist(), gold.tolist(), strict=True):
        p = {}
        for y in (0, 1):
            p[y] = model.prior if y else 1 - model.prior
            for j, parent in enumerate(model.parent):
                one = model.table[j, y, v[parent] if parent >= 0 else 0]
                p[y] *= one if v[j] else 1 - one
            if g >= 0:
                p[y] *= toxicity.GOLD if g == y else 1 - toxicity.GOLD
        out.append(p[1] / (p[0] + p[1]))
    return out


def test_posterior_and_tables_against_plain():
    rng = np.random.default_rng(3)
    votes, gold, q, mass = rng.integers(0, 2, (40, 4)), rng.integers(-1, 2, 40), rng.random(40), rng.integers(1, 5, 40).astype(float)
    parent = [-1, 0, 0, 2]
    model = toxicity.maximise(votes, q, mass, parent)
    assert model.prior == pytest.approx(sum(q * mass) / sum(mass))
    for j, y, u in itertools.product(range(4), (0, 1), (0, 1)):
        rows = [i for i in range(40) if parent[j] < 0 or votes[i, parent[j]] == u]
        w = {i: mass[i] * (q[i] if y else 1 - q[i]) for i in rows}
        assert model.table[j, y, u] == pytest.approx((sum(w[i] for i in rows if votes[i, j]) + 0.5) / (sum(w.values()) + 1))
    assert model.posterior(votes, gold) == pytest.approx(plain_posterior(model, votes, gold))


def test_rows_count_as_often_as_their_mass():
    rng = np.random.default_rng(4)
    votes, gold, many = rng.integers(0, 2, (30, 3)), rng.integers(-1, 2, 30), rng.integers(1, 4, 30)
    one, other = toxicity.label_model(votes, gold, many.astype(float)), toxicity.label_model(np.repeat(votes, many, axis=0), np.repeat(gold, many))
    assert one.prior == pytest.approx(other.prior) and one.parent == other.parent and np.allclose(one.table, other.table)


def test_linear_weights_are_a_minimum():
    rng = np.random.default_rng(5)
    x, target, mass = rng.integers(0, 2, (60, 3)), rng.random(60), rng.random(60)
    row, column = np.nonzero(x)
    w = toxicity.linear(row, column, 3, target, mass, rounds=4000, rate=0.02)

    def loss(w):
        p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
        return -(mass / mass.sum() * (target * np.log(p) + (1 - target) * np.log(1 - p))).sum() + 1e-4 * (w[:-1] ** 2).sum()

    best = loss(w.astype(float))
    assert all(best <= loss(w.astype(float) + step * np.eye(4)[i]) + 1e-7 for i in range(4) for step in (-0.02, 0.02))


def test_unlabelled_rows_all_count(spark, monkeypatch):
    rows = [(i, ("vile filth " if i % 2 else "calm words ") * 3 + f"t{i % 7}", i % 2 if i < 400 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    seen = {}
    real = toxicity.label_model
    monkeypatch.setattr(toxicity, "label_model", lambda votes, gold, mass: seen.update(gold=gold, mass=mass) or real(votes, gold, mass))
    model = toxicity.fit(df.select("doc_id", "text"), df.where("toxic IS NOT NULL").select("doc_id", "toxic"), most=100)
    own = seen["gold"] >= 0
    assert 120 < own.sum() < 280 and seen["mass"][~own].sum() == pytest.approx(own.sum()) and (~own).sum() < 50
    out = {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(df, model).collect()}
    assert all(out[i] == i % 2 for i in range(3000))


def test_nearest_centroid_against_plain(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = langid.fit(docs)
    some = docs.where("length(text) < 2000").orderBy("doc_id").limit(40)
    got = {r["doc_id"]: r for r in langid.classify(some, model).collect()}
    for r in some.collect():
        (x,) = langid.vectors([r["text"] or ""], model.idf)
        x = np.asarray(x, float)
        cosines = [float(x @ c) / max(math.sqrt(float(x @ x)) * math.sqrt(float(c @ c)), 1e-12) for c in model.vectors.astype(float)]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        assert got[r["doc_id"]]["lang_pred"] == model.languages[model.language[best]] and got[r["doc_id"]]["score"] == pytest.approx(min(max(cosines[best], 0), 1), abs=1e-3)
    assert langid.classify(some.where(F.lit(False)), model).collect() == []


def test_queries_of_many_terms_move_in_batches_of_bounded_terms(monkeypatch):
    from stratamerge.llm import search

    rng = np.random.default_rng(3)
    terms = [np.unique(rng.integers(0, 900, n).astype(np.uint64)) for n in rng.integers(1, 400, 300)]
    shard, order = search.Shard.of([len(t) for t in terms], terms, [np.ones(len(t), np.int32) for t in terms], 150.0)
    queries = [(i, t, np.ones(len(t)), 0.0) for i, t in enumerate(terms)]
    sizes, real = [], search.Shard.search
    monkeypatch.setattr(search.Shard, "search", lambda self, t, *a: sizes.append([len(x) for x in t]) or real(self, t, *a))
    whole = search.hits(shard, order.tolist(), queries, 5)
    for name, n in (("BATCH_TERMS", 500), ("POSTINGS", 50), ("FOUND", 3)):
        monkeypatch.setattr(search, name, n, raising=False)
    sizes.clear()
    assert sorted(zip(*search.hits(shard, order.tolist(), queries, 5))) == sorted(zip(*whole))
    assert sum(map(len, sizes)) == 300 and all(sum(s) <= 500 for s in sizes)


def test_rarer_terms_bound_a_block_by_its_best_document(monkeypatch):
    """Two rare terms in two documents of a block don't add up, so the block is no pivot; scores are those of a brute force."""
    from stratamerge.llm import search

    u = lambda *x: np.array(x, np.uint64)
    one = lambda t: [np.ones(len(x), np.int32) for x in t]
    shard = search.Shard(512, np.ones(512), u(1, 2), np.arange(2), np.ones(2, int), 1.0)
    found, scored = shard.search([u(1, 2)], [np.ones(2)], np.array([1.5]), 1)
    assert scored == 0 and len(found[0][0]) == 0

    rng = np.random.default_rng(5)
    terms = [np.unique(np.append((400 * rng.random(n) ** 2).astype(np.uint64), rng.integers(400, 9000, n).astype(np.uint64))) for n in rng.integers(1, 90, 700)]
    monkeypatch.setattr(search, "DENSE", 40)
    shard, order = search.Shard.of([len(t) for t in terms], terms, one(terms), 70.0)
    weights = [rng.random(len(t)) for t in terms[:150]]
    norm = np.array([2.2 / (1 + search.K1 * (0.25 + 0.75 * len(t) / 70.0)) for t in terms])[order]
    full = np.array([[w[np.isin(t, terms[d], assume_unique=True)].sum() for d in order] for t, w in zip(terms[:150], weights, strict=True)]) * norm
    for floor in (np.zeros(150), np.sort(full, axis=1)[:, -6] * 0.999):
        found, _ = shard.search(terms[:150], weights, floor, 10)
        for scores, least, (which, score) in zip(full, floor, found, strict=True):
            want = np.flatnonzero(np.round(scores, 6) >= max(np.sort(np.round(scores, 6))[-10], least, 1e-6))
            assert which.tolist() == want.tolist() and np.allclose(score, scores[want], atol=2e-6)
