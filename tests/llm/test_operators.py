"""Small cases of every operator: nulls, empty texts, ties, repeats, empty tables, clashing names; and brute force."""

import hashlib
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratamerge.llm import components, fingerprints, langid, mixing, neardup, packing, repeats, search, secrets, tokens, toxicity
from stratamerge.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "x", "en", "a", 1), (4, "!!! 12", "en", None, 6), (None, "some words of no id", "de", "b", 19), (5, "word " * 30_000, "en", "a", 150_000)]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, one of them twice, with extra columns named like outputs."""
    rows = [(*r, 1.0, 2, "b") for r in [*ODD, ODD[2]]]
    return spark.createDataFrame(rows, DOCS + ", score double, bucket int, secrets string")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").cache()


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- 1 language


def test_language_held_out_accuracy(docs):
    out = langid.op1_language(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in out) >= 0.98 * len(out) > 0
    assert all(0 <= r["score"] <= 1 for r in out)


def test_language_keeps_columns_of_any_name(spark, docs):
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    got = langid.classify(docs.limit(5).withColumn("_letters", F.lit("mine")), model)
    assert {r["_letters"] for r in got.collect()} == {"mine"}


def test_language_odd_rows(odd, none, docs):
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    out = langid.classify(odd, model).collect()
    assert len(out) == 7 and all((r["lang_pred"] == "und") == (r["text"] is None or not re.search("[a-z]", r["text"])) for r in out)
    assert langid.op1_language(none).count() == 0
    assert {r["lang_pred"] for r in langid.classify(odd, langid.fit(none)).collect()} == {"und"}
    far = langid.classify(odd.sparkSession.createDataFrame([(1, "зщшгне укцйф ячсмит")], "doc_id long, text string"), model).first()
    assert far["rejected"]


# --- 2 packing


def test_packing_is_optimal():
    import itertools

    random.seed(1)
    for _ in range(200):
        lens = sorted(random.sample(range(1, 60), random.randint(1, 8)))
        cells = [(x, n, x * n) for x in lens for n in [random.randint(1, 9)]]
        k = random.randint(1, 4)
        cost = lambda bs: sum(n * (min(b for b in bs if b >= x) - x) for x, n, _ in cells)  # noqa: B023, E731
        best = min(cost([*c, lens[-1]]) for m in range(k) for c in itertools.combinations(lens[:-1], m))
        got = packing.boundaries(cells, k)
        assert len(got) <= k and cost(got) == best


def test_packing_batches(docs, odd, none):
    out = packing.pack(docs.select("doc_id", F.length("text").alias("n")), "n", buckets=5, budget=20_000, rows_a_part=7)
    rows = out.collect()
    assert len(rows) == docs.count() and len({r["bucket_len"] for r in rows}) <= 5
    for r in rows:
        assert r["padding"] == r["bucket_len"] - r["n"] >= 0 and r["slot"] < max(1, 20_000 // r["bucket_len"])
    places = [(r["bucket"], r["batch"], r["slot"]) for r in rows]
    assert len(set(places)) == len(places)
    full = {}
    for b, n, _ in places:
        full.setdefault(b, {}).setdefault(n, 0)
        full[b][n] += 1
    assert all(len(set(list(dict(sorted(x.items())).values())[:-1])) <= 1 for x in full.values())  # all but the last are full
    out = packing.pack(odd.withColumn("n", packing.word_count(F.col("text"))), "n").collect()
    assert len(out) == 7 and {r["n"]: r["bucket"] for r in out}[0] == 0 and all((r["batch"] is None) == (r["n"] == 0) for r in out)
    assert packing.op2_packing(none).count() == 0


def test_packing_of_long_texts_is_optimal(spark):
    import itertools

    # nine long lengths in sixteen buckets need no padding
    lens = [2048 + 3 * i for i in range(9)]
    many = spark.createDataFrame([(x, "k", {"a": x}) for x in lens * 3], "n long, own string, rank map<string,long>")
    out = packing.pack(many, "n").collect()
    assert sum(r["padding"] for r in out) == 0 and sorted(r["rank"]["a"] for r in out) == sorted(lens * 3) and {r["own"] for r in out} == {"k"}
    # and in three as little as the best of all choices
    best = min(3 * sum(min(b for b in (*c, lens[-1]) if b >= x) - x for x in lens) for c in itertools.combinations(lens[:-1], 2))
    assert sum(r["padding"] for r in packing.pack(many, "n", buckets=3).collect()) == best


def test_op2_against_brute_force(docs):
    from collections import Counter

    out = packing.op2_packing(docs).collect()
    words = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in docs.collect()}
    assert {r["doc_id"]: r["n_words"] for r in out} == words
    sizes = Counter(n for n in words.values() if n)
    lens = sorted(sizes)
    # the plain quadratic program over all lengths
    best = [0] + [float("inf")] * len(lens)
    for _ in range(16):
        best = [0] + [min(best[i] + sum(sizes[x] * (lens[j] - x) for x in lens[i : j + 1]) for i in range(j + 1)) for j in range(len(lens))]
    assert sum(r["padding"] for r in out) == best[-1]


def test_word_count(spark):
    rows = [("a b", 2), ("", 0), (None, 0), ("  a\n\tb c ", 3), ("é", 1)]
    got = spark.createDataFrame(rows, "t string, n int").select("n", packing.word_count(F.col("t")).alias("w")).collect()
    assert all(r["n"] == r["w"] for r in got)


# --- 3 mixing


def test_mixing(docs, odd, none):
    weights = mixing.tempered(docs)
    out = mixing.mix(docs, mixing.rates(docs, weights, total=20.0))
    n, all_rows = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}, out.count()
    for s, w in weights.items():
        assert abs(n[s] / all_rows - w / sum(weights.values())) < 0.02
    keys = [r["mix_key"] for r in out.select("mix_key").collect()]
    assert keys == sorted(keys)
    assert sorted(mixing.op3_mixing(docs).collect()) == sorted(mixing.op3_mixing(docs.repartition(3)).collect())
    got = mixing.mix(odd, {None: 3.0, "a": 2.0})  # source b has no rate
    assert {r["source"] for r in got.collect()} <= {None, "a"} and got.columns[: len(odd.columns)] == odd.columns
    assert mixing.op3_mixing(none).count() == 0


def test_mixing_clashing_names(spark):
    rows = spark.createDataFrame([(i, f"t{i}", "a", i, "x", float(i), [1.0]) for i in range(50)], "doc_id long, text string, source string, n long, own string, u double, upto array<double>")
    got = mixing.mix(rows, {"a": 2.0})
    assert got.columns == [*rows.columns, "replica", "mix_key"]
    assert all((r["n"], r["own"], r["u"], r["upto"]) == (r["doc_id"], "x", float(r["doc_id"]), [1.0]) for r in got.collect())
    plain = mixing.mix(rows.select("doc_id", "text", "source"), {"a": 2.0})
    assert sorted(r["mix_key"] for r in got.collect()) == sorted(r["mix_key"] for r in plain.collect())


def test_poisson_inverse():
    import math

    cdf = mixing.inverse(2.5)
    assert cdf[0] == math.exp(-2.5) and abs(cdf[-1] - 1) < 1e-12 and cdf == sorted(cdf)
    assert mixing.inverse(0.0)[0] == 1.0


def test_poisson_inverse_of_large_rates():
    for rate in (720.0, 1250.0):
        cdf = mixing.inverse(rate)
        mean = sum(1 - c for c in cdf)
        assert abs(cdf[-1] - 1) < 1e-9 and abs(mean - rate) < 1e-3 and cdf[int(rate) - 200] < 1e-6


# --- 4 search


def brute_bm25(docs, queries, k):
    import math

    split = lambda t: re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
    words = {i: split(t) for i, t in docs}
    mean = sum(map(len, words.values())) / len(words)
    df = {}
    for w in words.values():
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = {}
    for q in queries:
        found = []
        for d, w in words.items():
            s = sum(math.log(1 + (len(words) - df[t] + 0.5) / (df[t] + 0.5)) * w.count(t) * 2.2 / (w.count(t) + 1.2 * (0.25 + 0.75 * len(w) / mean)) for t in words[q] if t in w)
            if s > 0:
                found.append((-round(s, 6), d))
        out[q] = [(d, -s) for s, d in sorted(found)[:k]]
    return out


@pytest.mark.parametrize("shard_rows", [16_384, 23])
def test_search_is_exact(spark, shard_rows):
    random.seed(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["the", "of"] * 20
    rows = [(i, " ".join(random.choices(vocabulary, k=random.randint(0, 40)))) for i in range(200)]
    rows += [(200 + i, rows[50][1]) for i in range(30)]  # ties
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {}
    for r in search.search(df, df.where("doc_id % 10 = 0"), shard_rows=shard_rows).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    want = brute_bm25(rows, [i for i, _ in rows if i % 10 == 0], 10)
    for q, best in want.items():
        mine = sorted(got.get(q, []))
        assert [m[1] for m in mine] == [d for d, _ in best]
        assert all(abs(m[2] - s) < 2e-6 for m, (_, s) in zip(mine, best, strict=True))


def test_search_repeated_query_rows(spark):
    random.seed(14)
    rows = [(i, " ".join(random.choices([f"w{j}" for j in range(40)], k=12))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    asked = spark.createDataFrame([(1, "w1 w2"), (1, "w2 w3"), (2, "w1 w2 w2 w3")], "doc_id long, text string")
    for kind in ("long", "double", "string"):
        out = {}
        for r in search.search(df.withColumn("doc_id", F.col("doc_id").cast(kind)), asked.withColumn("doc_id", F.col("doc_id").cast(kind)), shard_rows=50).collect():
            out.setdefault(r["query_id"], []).append((r["rank"], r["doc_id"], r["score"]))
        one, two = (sorted(x) for _, x in sorted(out.items()))
        assert one == two and len(one) == 10  # rows of one key are one query of all their terms


def test_shards_return_few_rows(spark, monkeypatch):
    """What all shards return grows with the logarithm of their number, not with the number."""
    random.seed(24)
    rows = [(i, " ".join(random.choices([f"w{j}" for j in range(80)], k=15))) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made, real = [], search.ask_shards
    monkeypatch.setattr(search, "ask_shards", lambda *a: made.append(real(*a).count()) or real(*a))
    got = {}
    for r in search.search(df, df.where("doc_id % 100 = 0"), shard_rows=32).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["doc_id"]))
    want = brute_bm25(rows, range(0, 2000, 100), 10)
    assert all([d for _, d in sorted(got[q])] == [d for d, _ in best] for q, best in want.items())
    assert sum(made) < 100 * len(want)  # 63 shards of 10 rows each before


def test_search_odd_rows(odd, none):
    assert search.op4_search(none).count() == 0
    out = search.search(odd, odd).collect()
    assert {r["query_id"] for r in out} == {3, 4, 5, None}


# --- 5 secrets


def base_spans(text):
    rules = [("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6), ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 24)]
    return sorted((m.start(), i, m.end()) for i, (_, p, ok) in enumerate(rules) for m in re.finditer(p, text) if ok(m))


def test_secrets_against_regular_expressions(spark, docs):
    parts = ["password", "passwd", "Secret", "TOKEN", "api_key", "=", ":", " ", '"', "AKIA", "ABC123", "abcdef0123456789", "é", "\n", ",", "x", "-----BEGIN ", "RSA PRIVATE KEY-----", "ghp_", "a" * 40]
    random.seed(5)
    rows = [(i, "".join(random.choices(parts, k=random.randint(0, 25)))) for i in range(800)] + [(900, "".join(random.choices(parts, k=20_000)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").union(docs.select("doc_id", "text"))
    kinds = ["assign", "access", "hex"]
    for r in secrets.scan_secrets(df).collect():
        got = [(s["start"], kinds.index(s["kind"]), s["end"]) for s in r["secrets"] if s["kind"] in kinds]
        assert got == base_spans(r["text"])


def test_secrets_odd_rows_and_redaction(spark, odd, none):
    out = secrets.scan_secrets(odd, redacted="text").collect()
    assert len(out) == 7 and all(r["secrets"] == [] for r in out) and {r["text"] for r in out} == {r[1] for r in ODD}
    assert secrets.op5_secrets(none).count() == 0
    row = secrets.scan_secrets(spark.createDataFrame([("é password=hunter22, AKIA" + "A" * 16 + "!",)], "text string"), redacted="text").first()
    assert row["text"] == "é [ASSIGN], [ACCESS]!"
    r = secrets.op5_secrets(spark.createDataFrame([(1, "token=abcdef")], "doc_id long, text string")).first()
    assert r["spans"] == "assign:0:12" and r["base_sha256"] == hashlib.sha256(b"assign:0:12").hexdigest() and r["n_assign"] == 1


# --- 6 fingerprints


def test_fingerprints(docs, none, odd):
    texts = [(r["doc_id"], r["text"]) for r in docs.orderBy(F.desc("doc_id")).collect()]
    out = by_id(fingerprints.op6_fingerprints(docs))
    for i, (d, t) in enumerate(texts):
        after, cut = texts[(i + 1) % len(texts)][1], len(t) // 3
        assert out[d]["n_chars"] == len(t) and out[d]["edited_sha256"] == hashlib.sha256((t[: len(t) - cut] + after[:cut]).encode()).hexdigest()
    assert len({(r["text"], out[r["doc_id"]]["fingerprint"]) for r in docs.collect()}) == docs.select("text").distinct().count()
    assert sum(r["near_edited"] for r in out.values()) / len(out) > 0.5 > 0.05 > sum(r["near_next"] for r in out.values()) / len(out)
    assert fingerprints.op6_fingerprints(none).count() == 0
    assert fingerprints.op6_fingerprints(odd).count() == 7
    one = fingerprints.op6_fingerprints(docs.limit(1)).first()
    assert one["near_next"] == 1.0


def test_fingerprint_buckets_agree(docs):
    a = fingerprints.with_next(docs, rows_a_bucket=8000).select("doc_id", "next_text").collect()
    b = fingerprints.with_next(docs, rows_a_bucket=7, ranges=4).select("doc_id", "next_text").collect()
    assert sorted(a) == sorted(b)


def test_fingerprint_plan_is_native(docs):
    plan = fingerprints.op6_fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- 7 toxicity


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    rows = toxicity.op7_toxicity(docs, labels).where("held_out").join(labels, "doc_id").collect()
    found, marked = {r["doc_id"] for r in rows if r["predicted"]}, {r["doc_id"] for r in rows if r["toxic"]}
    assert len(found & marked) >= 0.8 * len(marked) and len(found & marked) >= 0.9 * len(found) > 0
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_toxicity_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    out = toxicity.score_toxicity(odd, toxicity.fit(odd, labels)).collect()
    assert len(out) == 7 and {r["predicted"] for r in out} == {0}
    assert toxicity.op7_toxicity(none, labels).count() == 0


def test_toxicity_lexicon_has_no_limit(spark):
    random.seed(7)
    strong, weak, plain = ([f"{c}{i:03x}" for i in range(n)] for c, n in (("s", 1100), ("w", 250), ("p", 100)))
    rows = []
    for i in range(800):
        toxic = [w for p, words in ((0.5, strong), (0.2, weak)) for w in words if random.random() < p] if i % 2 else []
        rows.append((i, " ".join(toxic + random.choices(plain, k=20)), i % 2))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert len(model.lexicon) >= len(strong) + len(weak)
    asked = spark.createDataFrame([(1, " ".join(weak)), (2, " ".join(plain))], "doc_id long, text string")
    assert {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(asked, model).collect()} == {1: 1, 2: 0}


def test_label_model_finds_the_good_voters():
    import numpy as np

    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.3
    voter = lambda right: np.where(rng.random(4000) < right, y, ~y).astype(int)
    good, bad = voter(0.9), voter(0.55)
    votes = np.column_stack([good, voter(0.85), bad, bad, bad, voter(0.8)])  # one voter three times
    model = toxicity.label_model(votes, np.where(np.arange(4000) < 300, y, -1))
    assert ((model.posterior(votes, np.full(4000, -1)) > 0.5) == y).mean() > 0.9
    assert {2, 3, 4} & {model.parent[2], model.parent[3], model.parent[4]}  # the copies are linked


# --- 8 near duplicates


def brute_components(texts):
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
        sets[i] = frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_duplicates_against_all_pairs(spark, docs, monkeypatch):
    random.seed(8)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    base = [f"v{random.randint(0, 10**6)}" for _ in range(150)]
    for i in range(150):  # a chain of edits: neighbours link, ends don't
        base = [w if random.random() > 0.012 else f"e{i}{j}" for j, w in enumerate(base)]
        rows.append((10_000 + i, " ".join(base)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows)
    for leaf in (128, 3):
        monkeypatch.setattr(neardup, "LEAF", leaf)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.op8_jaccard_join(df).collect()}
        assert got == want


def test_near_duplicates_of_a_large_group(spark, monkeypatch):
    random.seed(18)
    rows, base = [], [f"v{i}" for i in range(120)]
    for i in range(240):  # near copies with different texts, and others that share a passage with them
        edited = [w if random.random() > 0.006 else f"e{i}" for w in base]
        rows.append((i, " ".join(edited if i % 8 else base[:70] + [f"o{i // 16}x{j}" for j in range(50)])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check, seen = neardup.cross_links, []
    monkeypatch.setattr(neardup, "cross_links", lambda pairs, *rest: seen.append(pairs.count()) or check(pairs, *rest))
    for name, small in (("LEAF", 2), ("HOT", 8), ("UNIT", 4), ("GUESTS", 7), ("VISITS", 3)):
        monkeypatch.setattr(neardup, name, small, raising=False)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.op8_jaccard_join(df).collect()}
    assert got == brute_components(rows)
    assert seen[0] < 1000  # 1957 if leaves of one component are compared


def test_sets_take_seven_bytes_a_shingle(spark):
    h = np.unique(np.random.default_rng(8).integers(0, 2**64, 300, np.uint64))
    data = neardup.packed(h)
    assert len(data) == 7 * len(h) and (neardup.members_of(data) == h >> np.uint64(8) << np.uint64(8)).all()
    text = " ".join(f"w{i}" for i in range(54))
    rows = neardup.prefix_keys(spark.createDataFrame([(text,), (text,), (None,), ("a b",)], "text string").coalesce(1), "text", 5, 80)
    # one set of 50 shingles (its copy is met already) and one of one
    assert sorted(r["count"] for r in rows.distinct().groupBy("sid").count().collect()) == [1, neardup.short_prefix(50, 80) + neardup.extra(50)]


def test_near_duplicates_leave_little_on_disk(spark, monkeypatch):
    base = [f"v{i}" for i in range(120)]
    rows = [(i, " ".join([f"e{i}x{i % 3}" if j == i % 60 + 30 else w for j, w in enumerate(base)])) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sets, kept, write, check = [], [], neardup.written, neardup.cross_links
    monkeypatch.setattr(neardup, "written", lambda df, name: (out := write(df, name), name == "members" and sets.append(out.written_to.removeprefix("file:")))[0])
    monkeypatch.setattr(neardup, "cross_links", lambda *args: kept.append(os.path.exists(sets[0])) or check(*args))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.op8_jaccard_join(df).collect()}
    assert got == brute_components(rows)
    assert kept[-1] is False  # the sets are in the leaves by then


def test_rows_of_nodes_hold_blocks_up_to_their_own(spark):
    placed = spark.createDataFrame([(b, leaf) for leaf in (1, 2) for b in (7, -3, 2**40)[leaf - 1 :]], "block long, leaf long")
    rows = neardup.up_to_own(placed.join(neardup.meeting_lists(placed), "leaf")).collect()
    assert sorted((r["leaf"], r["block"], r["blocks"]) for r in rows) == [(1, -3, [-3]), (1, 7, [-3, 7]), (1, 2**40, [-3, 7, 2**40]), (2, -3, [-3]), (2, 2**40, [-3, 2**40])]


def test_stars_exchange_their_sets_once(spark, monkeypatch):
    monkeypatch.setattr(neardup, "HOT", 8)
    sids = list(range(1, 9))
    members = neardup.packed(np.arange(1, 21, dtype=np.uint64) << np.uint64(8))
    blocks = spark.createDataFrame([(5, 9, len(sids), s) for s in sids], "block long, weight long, c long, sid long")
    sizes = spark.createDataFrame([(s, 20) for s in sids], "sid long, n long")
    sets = neardup.written(spark.createDataFrame([(s, members) for s in sids], "sid long, members binary"), "members")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = neardup.star_links(blocks, sizes, sets, 80, [])
        assert sorted((r["a"], r["b"]) for r in links.collect()) == [(s, 1) for s in sids[1:]]
        plan = links._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("ReadSchema: struct<sid:bigint,members:binary>") == 1


def test_near_duplicates_odd_rows(odd, none):
    assert neardup.op8_jaccard_join(none).count() == 0
    out = neardup.near_duplicates(odd).collect()
    assert len(out) == 7 and {r["doc_id"]: r["component_id"] for r in out} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, None: None}


@pytest.mark.parametrize("few", [0, 1 << 20])
def test_components(spark, few):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 101), (100, 101)]
    out = dict(components.components(spark.createDataFrame(edges, "a long, b long"), few=few).collect())
    assert out == {i: 0 for i in range(1, 41)} | {101: 100}
    assert components.components(spark.createDataFrame([(7, 7)], "a long, b long"), few=few).collect() == []


# --- 9 repeats


def brute_repeats(texts, window):
    count, data, out = {}, [(t or "").encode() for t in texts], []
    for b in data:
        for i in range(len(b) - window + 1):
            count[b[i : i + window]] = count.get(b[i : i + window], 0) + 1
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if count[b[i : i + window]] > 1:
                gone[i : i + window] = b"\x01" * window
        spans = sum(1 for p in range(len(b)) if gone[p] and (not p or not gone[p - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, y in zip(b, gone, strict=True) if not y)).hexdigest()))
    return out


@pytest.mark.parametrize("large", [4096, 3])
def test_repeats_against_all_windows(spark, none, monkeypatch, large):
    monkeypatch.setattr(repeats, "LARGE", large)
    random.seed(9)
    base = ["".join(random.choices("abcdef ", k=1500)) for _ in range(3)]
    texts = ["a" * 399, "a" * 400, "a" * 900, "", None, "ab" * 500, "é" * 300]
    for _ in range(60):
        t = ""
        for _ in range(random.randint(0, 4)):
            b, a = random.choice(base), random.randint(0, 1400)
            t += random.choice(["", "x", "é", "".join(random.choices("abcdef", k=random.randint(0, 500)))]) + b[a : a + random.randint(1, 900)]
        texts.append(t)
    texts.append(texts[-1])
    got = by_id(repeats.op9_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)))
    want = brute_repeats(texts, 400)
    assert [tuple(got[i])[1:] for i in range(len(texts))] == want
    assert repeats.op9_repeats(none).count() == 0


def test_repeats_by_the_order_alone():
    import numpy as np

    random.seed(19)
    text = bytes(random.choices(b"abc ", k=900))
    texts = [text[:480], b"x" * 30 + text[30:480], text[:450] + b"y" * 30, bytes(random.choices(b"abc ", k=480))]
    def found(weights):
        t, i = repeats.repeats_in(np.zeros(4, np.int64), np.zeros(4, np.int64), np.array(weights), texts, 400)
        return set(zip(t.tolist(), i.tolist(), strict=True))

    want = {(a, i) for a in range(4) for b in range(4) for i in range(81) if a != b and texts[a][i : i + 400] == texts[b][i : i + 400]}
    assert found([1, 1, 1, 1]) == want and (0, 10) in want and (1, 20) not in want
    assert found([1, 1, 1, 2]) == want | {(3, i) for i in range(81)}


def test_repeats_clashing_names(spark):
    schema = "doc_id long, text string, k long, spans string, own int, n_bytes int, m map<string,int>"
    rows = [(i, "ab" * 300 if i < 2 else "c", 7, "s", 1, 2, {"a": i}) for i in range(3)]
    out = by_id(repeats.remove_repeats(spark.createDataFrame(rows, schema)))
    assert out[0]["n_removed"] == 600 and out[2]["n_removed"] == 0 and out[2]["k"] == 7 and out[1]["spans"] == "s" and out[2]["m"] == {"a": 2} and out[0]["n_bytes"] == 600


def test_repeats_odd_rows(odd):
    out = repeats.remove_repeats(odd).collect()
    assert len(out) == 7 and {r["n_removed"] for r in out if r["doc_id"] == 5} == {150_000}


def test_suffix_array():
    random.seed(3)
    for _ in range(500):
        s = [random.randint(0, random.choice([1, 3, 10])) for _ in range(random.randint(0, 40))]
        assert repeats.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


# --- 10 token counts


def test_token_counts_against_the_tokenizer(spark, docs, none):
    from tokenizers import Tokenizer

    random.seed(10)
    parts = ["a", "Hello", " ", "  ", "\n", "\t", "'s", "12", "é", " ", "　", "\x1c", "<|endoftext|>", "<|endof", "!?", "日本", "😀", "\r\n", "x ", "\0"]
    rows = [(i, "".join(random.choices(parts, k=random.randint(0, 12)))) for i in range(3000)] + [(4000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").union(docs.select("doc_id", "text"))
    t = Tokenizer.from_file(tokenizer_path())
    for head in (1 << 16, 5):
        got = tokens.count_tokens(df.withColumn("whole", F.col("text")), tokenizer_path(), head=head).collect()
        assert len(got) == df.count() and all(r["n_tokens"] == len(t.encode(r["whole"] or "", add_special_tokens=False)) for r in got)
    assert tokens.op10_token_counts(none, tokenizer_path()).count() == 0


def test_token_counts_odd_rows(odd):
    out = tokens.op10_token_counts(odd, tokenizer_path()).collect()
    assert len(out) == 7 and {r["doc_id"]: r["n_tokens"] for r in out}[1] == 0 and {r["doc_id"]: r["over_limit"] for r in out}[5]
