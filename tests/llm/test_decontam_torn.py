"""Torn and re-parameterised copies, texts in pieces, and candidates against a plain search."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from cartoscope.llm import decontam, textscan

SF = "/root/testdata/sf0.01"
ITEM = "Marta buys 12 kg of apples and later sells 12 kg to Pedro for 30 dollars in the old market near the river bank"
LIMITS = decontam.Limits(8, 13, 0.5, True)


def found(texts, bench, limits=LIMITS):
    return {(m.doc, m.item) for m in decontam.matches(pa.array(texts, pa.string()), bench, limits)}


def test_torn_copies():
    bench = decontam.prepare([1], [ITEM], 8)
    words = ITEM.split()
    torn = ITEM.replace("12", "17", 1)
    put_in = " ".join([*words[:11], "really", *words[11:]])
    left_out = " ".join(words[:10] + words[11:])
    half = "nothing of " + " ".join(words[4:9]) + " is left"
    texts = [f"some words before. {t} and some after" for t in (torn, put_in, left_out, half)]
    assert found(texts, bench) == {(0, 0), (1, 0), (2, 0)}
    assert found(texts, bench, LIMITS._replace(torn=False)).isdisjoint({(0, 0)})


def reworded(text, rng):
    """Every number another, one for one; the sign after it stays."""
    new = {}
    return re.sub(r"\d+", lambda m: new.setdefault(m[0], str(rng.randint(2, 9999))), text)


def test_reworded_copies_are_found(spark):
    rng = random.Random(4)
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect() if r["text"]]
    numbers = [f"{i} {rng.choice(items)} with {rng.randint(2, 99)} boxes of {rng.randint(2, 99)} kg each" for i in range(50)]
    bench = decontam.prepare(list(range(len(items) + 50)), items + numbers, 8)
    copies = [f"before it. {reworded(t, rng)} and after" for t in items + numbers]
    got = {d for d, i in found(copies, bench) if d == i}
    assert len(got) >= 0.9 * len(copies)


def plain_hits(text, item, width):
    """Places in text and item of the windows that are alike in a form that the item's window takes."""
    def forms(t):
        w = next(textscan.scan(pa.array([t]), strip=True))
        kind = decontam.kinds(w)
        h = w.hash.tolist()
        typed = [x if k == 0 else -int(k) for x, k in zip(h, kind, strict=True)]
        named = [x if k in (0, 13) else -int(k) for x, k in zip(h, kind, strict=True)]
        return h, typed, named, kind

    th, tt, tn, _ = forms(text)
    ih, it, in_, kind = forms(item)
    wide = min(len(ih), width)
    out = set()
    for p in range(len(ih) - wide + 1):
        k = kind[p : p + wide]
        wanted = []
        if wide >= 4 and 2 * (k != 0).sum() <= wide:
            wanted.append((tt, it))
        if wide >= 4 and 2 * ((k != 0) & (k != 13)).sum() <= wide:
            wanted.append((tn, in_))
        for a, b in wanted or [(th, ih)]:
            out |= {(c, p) for c in range(len(th) - wide + 1) if a[c : c + wide] == b[p : p + wide]}
    return out, wide, len(ih)


@pytest.mark.parametrize("torn", [False, True])
def test_plain_search_agrees(torn):
    rng = random.Random(8)
    pool = ["a", "b", "the", "3", "17", "kg", "Ann", "Bob", "x", "runs.", "5"]
    items = [" ".join(rng.choices(pool, k=rng.randint(1, 25))) for _ in range(25)]
    texts = []
    for _ in range(80):
        words = rng.choices(pool, k=rng.randint(0, 20))
        words[rng.randint(0, len(words)) : 0] = [w if rng.random() > 0.04 else rng.choice(pool) for w in rng.choice(items).split()]
        texts.append(" ".join(words))
    limits = decontam.Limits(4, 6, 0.5, torn)
    bench = decontam.prepare(list(range(len(items))), items, 4)
    want = set()
    for d, t in enumerate(texts):
        w = next(textscan.scan(pa.array([t]), strip=True))
        for i, item in enumerate(items):
            if not len(w.hash):
                continue
            hits, wide, n = plain_hits(t, item, 4)
            runs = []
            for shift in sorted({c - p for c, p in hits}):
                covered = np.array(sorted({c + k for c, p in hits if c - p == shift for k in range(wide)}))
                runs.append((d, i, int(covered[0]), shift, covered))
            chains = decontam._chains(runs) if torn else [(d, i, r[4], r[4] - r[3]) for r in runs]
            need = min(6, -(-n // 2))
            for _, _, covered, place in chains:
                parts = decontam._parts(covered, place, bench.slots[i], w.hash)
                whole = len(covered) >= need and len(parts) == 1
                split = torn and len(covered) >= need and (max(p[0] for p in parts) >= need or decontam._literal(covered, place, bench.words[i], w.hash) >= 6)
                if whole or split:
                    want.add((d, i))
    assert found(texts, bench, limits) == want and len(want) > 40


def test_long_texts_in_pieces():
    rng = random.Random(2)
    filler = [" ".join(rng.choices(["one", "two", "three", "four", "five"], k=20_000)) for _ in range(8)]
    bench = decontam.prepare([1, 2], [ITEM, "four short words here"], 8)
    long = f" {ITEM} ".join(filler)
    assert len(long) > 1 << 19
    want = [(0, 0), (2, 0), (3, 1)]
    texts = [long, "", ITEM, "has four short words here"]
    whole = found(texts, bench)
    assert sorted(whole) == want
    pieces = list(textscan.scan(pa.array([long]), limit=70_000, strip=True, overlap=bench.overlap))
    assert len(pieces) > 5 and pieces[0].opens and pieces[-1].ends and not pieces[1].opens and not pieces[1].ends
    words = [bytes(w.data[s:e]) for w in pieces for s, e in zip(w.start, w.end, strict=True)]
    assert len(words) > len(long.split())
    very = " ".join([long] * 6) + " " + "four short words here"
    assert found([very, ITEM], bench) == {(0, 0), (0, 1), (1, 0)}
