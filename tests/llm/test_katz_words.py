"""The word model of Katz scoring against brute force, whatever is cached and however counts are dealt."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cartoscope.llm import katz, queries, textscan

SF = "/root/testdata/sf0.001"


def words_of(text):
    return (text or "").encode().lower().split()


def brute(texts, train):
    """(tokens, known, train tokens, base, score) of each text under the bigram model of all training words."""
    uni = Counter(w for t in train for w in words_of(t))
    if train:
        uni["</s>"] = len(train)
    n, kinds = sum(uni.values()), len(uni)
    pairs = Counter()
    for t in train:
        seq = ["<s>", *words_of(t), "</s>"]
        pairs.update(zip(seq, seq[1:], strict=False))
    d1, d2 = (katz._discounts(Counter(c.values())) for c in (uni, pairs))
    cut = lambda d, c: (d[c] if c <= katz.TOP else 1.0) * c
    used = sum(cut(d1, c) for c in uni.values()) / n
    kept = min(used, n / (n + 1))
    p1 = {w: cut(d1, c) / n * kept / used for w, c in uni.items()}
    unseen = 1 - kept
    after = {}
    for (h, w), c in pairs.items():
        after.setdefault(h, {})[w] = c
    model = {}
    for h, seen in after.items():
        m = sum(seen.values())
        share = sum(cut(d2, c) for c in seen.values()) / m
        mass = min(share, m / (m + 1))
        back = (1 - mass) / (1 - sum(p1[w] for w in seen))
        model[h] = {w: cut(d2, c) / m * mass / share for w, c in seen.items()}, back
        every = sum(model[h][0].values()) + back * (unseen + sum(p for w, p in p1.items() if w not in seen))
        assert math.isclose(every, 1, rel_tol=1e-9)
    out = []
    for t in texts:
        seq = ["<s>", *words_of(t), "</s>"]
        score = 0.0
        for h, w in zip(seq, seq[1:], strict=False):
            seen, back = model.get(h, ({}, 1.0))
            score += math.log10(seen[w] if w in seen else back * p1.get(w, unseen))
        tail = seq[1:]
        out.append((len(tail), sum(w in uni for w in tail), n, sum(math.log10((uni[w] + 1) / (n + kinds + 1)) for w in tail), score))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    common = [f"w{i}" for i in range(40)]
    made = []
    for i in range(120):
        words = rng.choices(common, weights=[1 / (k + 1) for k in range(40)], k=rng.randint(0, 30))
        words += [f"rare{rng.randint(0, 60)}" for _ in range(rng.randint(0, 6))] + [f"once{i}"] * (i % 3 == 0)
        rng.shuffle(words)
        made.append(" ".join(words))
    return made + [None, "", "never seen words", "W1 w1 rare1 RARE2 never"]


@pytest.mark.parametrize(
    "sizes",
    [{}, {"head_words": 0, "head_bigrams": 0}, {"head_words": 12, "head_bigrams": 5, "part_entries": 100}, {"head_words": 30, "head_bigrams": 20, "part_entries": 40, "lanes": 4}],
)
def test_scores_do_not_depend_on_sizes(spark, texts, sizes):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = sorted(katz.score(docs, docs.where("doc_id < 100"), **sizes).collect())
    for r, w in zip(got, brute(texts, texts[:100]), strict=True):
        assert tuple(r)[1:4] == w[:3] and np.allclose(tuple(r)[4:], w[3:], rtol=1e-9)


def test_query_is_brute_force(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = sorted(queries.op9_katz_scores(spark, SF).collect())
    held = {r["doc_id"]: r["held_out"] for r in got}
    want = brute([t for _, t in rows], [t for d, t in rows if not held[d]])
    for r, w in zip(got, want, strict=True):
        assert tuple(r)[1:4] == w[:3] and np.allclose(tuple(r)[4:6], w[3:], rtol=1e-9)


def test_long_text_in_pieces(spark, monkeypatch):
    rng = random.Random(1)
    long = " ".join(f"v{rng.randint(0, 300)}" for _ in range(5000))
    texts = ["v1 v2 v3", long, "v4", f"  {long} v7  ", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    scan = textscan.scan
    monkeypatch.setattr(katz, "scan", lambda column, **k: scan(column, 700, **k))
    monkeypatch.setattr(katz, "FLUSH", 500)
    want = brute(texts, texts)
    batch = pa.record_batch([pa.array(range(5)), pa.array(texts)], names=["doc_id", "text"])
    chunks = [w for w in katz.scan(batch.column(1))]
    assert len(chunks) > 20 and sum(w.texts for w in chunks if w.opens) >= len(texts)
    got = sorted(katz.score(docs, docs, head_words=50).collect())
    for r, w in zip(got, want, strict=True):
        assert tuple(r)[1:4] == w[:3] and np.allclose(tuple(r)[4:], w[3:], rtol=1e-9)
