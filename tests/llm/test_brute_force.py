"""Fingerprints and the pipeline against plain Python, written from their descriptions."""

import hashlib
import math
import re
import struct
from collections import Counter

import corpus_pipeline as p
import xxhash

from stratamerge.llm import fingerprints
from stratamerge.llm.common import written


def spark_hash(*values):
    """xxhash64 of Spark: the hash of each value is the seed of the next."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<q", v), seed=h)
    return h - (1 << 64) if h >= 1 << 63 else h


def anchors(text):
    t = re.findall(r"[^\x20\x09-\x0D]{1,8}", text)
    if len(t) < 6:
        return [spark_hash(*t) % (1 << 31)] if t else []
    s = [spark_hash(a, b) for a, b in zip(t, t[1:])]
    windows = [s[i : i + 5] for i in range(len(s) - 4)]
    return [spark_hash(w[0], w[2], w[4]) % (1 << 31) for w in windows if min(w) in (w[0], w[4])]


def near(a, b):
    a, b = set(a), set(b)
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0


def test_op6_against_plain_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()), reverse=True)
    got = {r["doc_id"]: r for r in fingerprints.op6_fingerprints(docs).collect()}
    assert len(got) == len(rows)
    for (key, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        own, changed, r = anchors(text), anchors(edited), got[key]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == " ".join(map(str, dict.fromkeys(own)))
        assert r["edited_fingerprint"] == " ".join(map(str, dict.fromkeys(changed)))
        assert abs(r["near_edited"] - near(own, changed)) < 1e-12 and abs(r["near_next"] - near(own, anchors(after))) < 1e-12


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def first_of_groups(rows):
    """Ids that are the least of their near-duplicate group, by all pairs."""
    ids = sorted(rows)
    sets = {i: shingle_set(rows[i]) for i in ids}
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x in ids:
        for y in ids:
            if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {i for i in ids if find(i) == i}


def poisson_count(rate, u):
    """Number of k with P(N <= k) <= u."""
    k, total = 0, math.exp(-rate)
    while total <= u:
        k += 1
        total += math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1))
    return k


def least_padding(lengths, buckets):
    sizes = Counter(n for n in lengths if n)
    lens = sorted(sizes)
    best = [0] + [math.inf] * len(lens)
    for _ in range(buckets):
        best = [0] + [min(best[i] + sum(sizes[x] * (lens[j] - x) for x in lens[i : j + 1]) for i in range(j + 1)) for j in range(len(lens))]
    return best[-1]


def test_pipeline_against_plain_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    clean = written(p.drop_toxic(spark, docs, sf_dir), "clean")
    firsts = written(p.drop_near_duplicates(spark, clean, sf_dir), "firsts")
    assert {r["doc_id"] for r in firsts.collect()} == first_of_groups({r["doc_id"]: r["text"] for r in clean.collect()})
    safe = p.redact_secrets(spark, firsts, sf_dir).collect()
    sizes = Counter(r["source"] for r in safe)
    weights = {s: n**0.5 for s, n in sizes.items()}
    want = Counter()
    for r in safe:
        rate = len(safe) * weights[r["source"]] / sum(weights.values()) / sizes[r["source"]]
        u = int(hashlib.md5(f"11|{r['doc_id']}|{r['text'] or ''}".encode()).hexdigest()[:13], 16) / (1 << 52)
        want[r["doc_id"], r["text"]] += poisson_count(rate, u)
    out = p.run(spark, sf_dir).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == +want
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in out]
    assert [r["n_words"] for r in out] == words
    assert sum(r["padding"] for r in out) == least_padding(words, 16)
