"""Whole scores against brute force, and whether they are probabilities."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq

from cartoscope.llm import queries, toxicity

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def words_of(text):
    low = (text or "").encode().lower().split()
    return Counter(w for w in (x.strip(PUNCTUATION.encode()) for x in low) if w)


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def brute(docs, labels, k=25, prior=0.25):
    """Score of each document by dense cosines; all labelled rows are examples."""
    bags = {d: words_of(t) for d, t in docs}
    learn = {}
    for d, y in labels:
        if y is not None and not held_out(d) and d in bags:
            learn[d] = max(learn.get(d, 0), y)
    n1, n0 = sum(learn.values()), len(learn) - sum(learn.values())
    seen = {1: Counter(), 0: Counter()}
    for d, y in learn.items():
        seen[y].update(bags[d].keys())
    places = {w: i for i, w in enumerate(sorted(set(seen[0]) | set(seen[1])))}
    df = Counter(w for b in bags.values() for w in b if w in places)
    weight = np.zeros(len(places))
    for w, i in places.items():
        a, b = seen[1][w] + 0.5, seen[0][w] + 0.5
        z = (math.log(a / (n1 + 1)) - math.log(b / (n0 + 1))) / math.sqrt(1 / a + 1 / b)
        weight[i] = math.log((1 + len(docs)) / (1 + df[w])) * (1 + z * z)

    def vector(bag):
        v = np.zeros(len(places))
        for w, n in bag.items():
            if w in places:
                v[places[w]] = (1 + math.log(n)) * weight[places[w]]
        size = np.sqrt((v * v).sum())
        return v / size if size else v

    ids = sorted(learn)
    examples, rate = np.array([vector(bags[d]) for d in ids]), n1 / len(ids)
    label = np.array([learn[d] for d in ids])

    def voted(bag, without=None):
        cosine = examples @ vector(bag)
        if without is not None:
            cosine[ids.index(without)] = 0
        best = [i for i in np.argsort(-cosine, kind="stable")[:k] if cosine[i] > 0]
        for_it, against = cosine[best][label[best] == 1].sum(), cosine[best][label[best] == 0].sum()
        return (for_it + prior * rate) / (for_it + against + prior)

    x = toxicity._log_odds(np.array([voted(bags[d], d) for d in ids]))
    best, at = math.inf, (1.0, 0.0)
    for span in (2.0, 0.3, 0.05, 0.008, 0.001):  # the map by plain search
        a0, b0 = at
        for a in np.linspace(a0 - span, a0 + span, 41):
            for b in np.linspace(b0 - span, b0 + span, 41):
                p = 1 / (1 + np.exp(-(a * x + b)))
                loss = -(np.log(np.where(label == 1, p, 1 - p))).sum() + ((a - 1) ** 2 + b * b) / 2
                if loss < best:
                    best, at = loss, (a, b)
    return {d: 1 / (1 + math.exp(-(at[0] * toxicity._log_odds(voted(b)) + at[1]))) for d, b in bags.items()}


def test_scores_are_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r.values()) for r in pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    labels = [(r["doc_id"], r["toxic"]) for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()]
    got = {r["doc_id"]: r["score"] for r in queries.op10_toxic_neighbours(spark, sf).collect()}
    want = brute(docs, labels)
    assert set(got) == set(want)
    # equal cosines at the k-th place may be ordered otherwise
    apart = [abs(got[d] - want[d]) for d in want]
    assert np.quantile(apart, 0.97) < 1e-3 and max(apart) < 0.1


def test_held_out_scores_are_probabilities(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist() if r["toxic"] is not None}
    rows = [(r["score"], labels[r["doc_id"]]) for r in queries.op10_toxic_neighbours(spark, sf).where("held_out").collect() if r["doc_id"] in labels]
    score, label = (np.array(x, dtype=float) for x in zip(*rows, strict=True))
    for low, high in ((0, 0.05), (0.05, 0.5), (0.5, 0.9), (0.9, 1.01)):
        own = (score >= low) & (score < high)
        assert abs(score[own].mean() - label[own].mean()) < 0.15 and own.sum() > 5
    assert ((score - label) ** 2).mean() < 0.025
    assert (score[label == 1] >= 0.3).mean() > 0.85 and (score[label == 0] >= 0.3).mean() < 0.02
