"""Whole queries against plain Python, certified quality rules against SQL, and the pipeline on odd tables."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cartoscope.llm import langid, mixing, quality, queries
from cartoscope.llm.oracles import ORACLES

SF = "/root/testdata/sf0.001"


def rows_of(name, *columns):
    return pq.read_table(f"{SF}/{name}.parquet", columns=list(columns) or None).to_pylist()


# 1


def grams(text):
    """Counts of n-grams by key: letters of 16 bits each, a blank being 1."""
    out = Counter()
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        line = f" {word} "
        for n in (1, 2, 3, 4):
            for i in range(len(line) - n + 1):
                g = line[i : i + n]
                if g.strip() and " " not in g[1:-1]:
                    key = 0
                    for c in g:
                        key = key << 16 | (1 if c == " " else ord(c) & 0xFFFF ^ ord(c) >> 16)
                    out[key] += 1
    return out


def test_languages(spark):
    docs = rows_of("documents", "doc_id", "text", "lang")
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in docs}
    totals = defaultdict(Counter)
    own = {r["doc_id"]: grams(r["text"] or "") for r in docs}
    for r in docs:
        if r["lang"] is not None and r["text"] is not None and not held[r["doc_id"]]:
            totals[r["lang"]].update(own[r["doc_id"]])
    top = lambda c: [k for k, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:400]]
    profiles = {k: {g: i for i, g in enumerate(top(c))} for k, c in sorted(totals.items())}
    got = {r["doc_id"]: r for r in queries.op1_language_profiles(spark, SF).collect()}
    for d, c in own.items():
        mine = top(c)
        if not mine:
            assert (got[d]["lang_pred"], got[d]["score"]) == ("und", 0.0)
            continue
        apart = {k: sum(abs(p[g] - i) if g in p else 400 for i, g in enumerate(mine)) for k, p in profiles.items()}
        best = min(apart, key=lambda k: (apart[k], k))
        assert got[d]["lang_pred"] == best and got[d]["held_out"] == held[d]
        assert got[d]["score"] == pytest.approx(1 - apart[best] / (400 * len(mine)), abs=1e-12)


# 2


def topic_of(t):
    if not t:
        return "empty"
    n = lambda signs: sum(t.count(s) for s in signs)
    for name, signs in (("table", "|"), ("markup", mixing.MARKS), ("numbers", mixing.DIGITS)):
        if n(signs) * 40 > len(t):
            return name
    return "long prose" if len(t) >= 4000 else "prose"


def capped_targets(mass, power, keep):
    total = sum(mass.values())
    share = {k: v / total for k, v in mass.items()}
    full, scale = set(), 0.0
    while True:
        scale = (1 - sum(share[k] / keep for k in full)) / sum(s**power for k, s in share.items() if k not in full)
        more = {k for k, s in share.items() if k not in full and scale * s**power >= s / keep}
        if not more:
            return {k: share[k] / keep if k in full else scale * s**power for k, s in share.items()}
        full |= more


def test_mixing(spark):
    docs = rows_of("documents", "doc_id", "text", "lang", "source")
    told = {r["doc_id"]: (r["source"], r["lang"], topic_of(r["text"]), len(re.split(r"[ \t\n\x0b\f\r]+", r["text"].strip(" \t\n\x0b\f\r"))) if (r["text"] or "").strip(" \t\n\x0b\f\r") else 0) for r in docs}
    tokens = Counter()
    for *cell, n in told.values():
        tokens[tuple(cell)] += n
    cells = [c for c in tokens if tokens[c]]
    size = np.array([tokens[c] for c in cells], dtype=float)
    keep, total = 0.5, size.sum()
    got = queries.op2_proportional_mixing(spark, SF).withColumn("draw", F.shiftrightunsigned(F.xxhash64(F.lit(17), "doc_id", F.lit(None).cast("long")), 11) / float(1 << 53)).collect()
    for power in (0.7, 0.85, 0.925, 1.0):  # the first whose targets can be met
        weight, cap = size / total, size / (keep * total)
        groups = []
        for at in range(3):
            mass = Counter()
            for c, n in zip(cells, size, strict=True):
                mass[c[at]] += n
            goal = capped_targets(mass, power, keep)
            groups += [(np.array([i for i, c in enumerate(cells) if c[at] == v]), g) for v, g in goal.items()]
        for _ in range(3000):
            for own, goal in groups:
                low, high = 0.0, 1e6
                for _ in range(60):
                    mid = (low + high) / 2 if high < 1e5 else low * 2 + 1
                    low, high = (mid, high) if np.minimum(weight[own] * mid, cap[own]).sum() < goal else (low, mid)
                weight[own] *= (low + high) / 2
            given = np.minimum(weight, cap)
            if max(abs(given[own].sum() / goal - 1) for own, goal in groups) < 1e-5:
                break
        if max(abs(given[own].sum() / goal - 1) for own, goal in groups) < 1e-3:
            break
    chance = {c: given[i] * keep * total / size[i] for i, c in enumerate(cells)}
    for r in got:
        *cell, n = told[r["doc_id"]]
        assert (r["source"], r["lang"], r["topic"], r["n_tokens"]) == (*cell, n)
        want = chance[tuple(cell)] if n else 0.0
        assert r["probability"] == pytest.approx(want, rel=0.05, abs=1e-3)
        assert r["sampled"] == (r["draw"] < r["probability"])


# 6


def test_certified_rules_equal_sql(spark):
    import duckdb

    rows, labels = [], []
    for i in range(9000):
        words = [f"w{(i * 7 + k) % 500}" for k in range(60)]
        if i % 15 == 0:
            words = [w + "##" for w in words]
        if i % 15 == 1:
            words = words[:40] + words[:20]
        if i % 15 == 2:
            words = [w * 9 for w in words]
        text = " ".join(words) if i % 15 != 3 else "\n".join(["same line here"] * 25)
        rows.append((i, text, ("en", "de", None)[i % 3] if i % 50 else "fr"))
        labels.append((i, int(i % 15 > 3 or i % 1000 == 0) if i % 9 else None, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.judge(docs, known)
    assert got.where("reject_rule is not null and not base_failed").count() > 100
    c = duckdb.connect()
    c.register("documents", docs.toArrow())
    c.register("labels", known.toArrow())
    r = c.execute(ORACLES["op6_risk_controlled_rules"])
    names = [x[0] for x in r.description]
    assert sorted(tuple(x) for x in got.select(*names).collect()) == sorted(r.fetchall())


# The pipeline


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_on_odd_tables(spark, empty):
    import corpus_pipeline

    names = "lot place offset _source _id _mark _drop _gone own mark row told".split()
    schema = "doc_id int, text string, lang string, source string, " + ", ".join(f"{n} int" for n in names)
    plain = "der die das und nicht ein eine mit von zu " * 6
    texts = [None, "", " \n ", plain, plain, plain + "noch mehr Wörter", "the and of to in that it is was for " * 6, "1234 !!!", "x " * 60_000]
    rows = [(i % 7 if i else None, t, None if i % 3 else "de", "s", *range(len(names))) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([] if empty else rows, schema)
    learn = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        source = kept
        if name == corpus_pipeline.STAGES[0][0] and not empty:
            # learnt from real documents, applied to the odd ones
            profiles = langid.fit_profiles(langid.learnable(learn))
            found = langid.identify(kept, profiles).where("lang_pred <> 'und'").select(*kept.columns)
        else:
            found = stage(spark, kept, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert found.columns == docs.columns
        kept = spark.createDataFrame(found.collect(), found.schema)
        assert kept.count() <= source.count()
    assert {"shard", "slot"} <= set(kept.columns) and (kept.count() == 0) == empty
