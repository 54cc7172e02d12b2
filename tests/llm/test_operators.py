"""Operators against brute force, and on odd tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cartoscope.llm import chat, decontam, katz, langid, lines, mixing, quality, queries, sharding, simhash, textscan, toxicity

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, kept int, shard string, n int, h1 int, a int, of int, fp int, key int"


def odd_rows():
    long = "word " * 60_000
    texts = [None, "", " \n\t ", "One two three four five", "One two three four five", "ONE two three four five\nLine", long, "a\n\nb", "日本語 テキスト", "1234 !!! |||"]
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "src", None, "x", 1, "y", 2, 3, 4, 5, 6, 7) for i, t in enumerate(texts)]
    return [*rows, rows[3], (None, "no id here", "en", "src", 1, "x", 1, "y", 2, 3, 4, 5, 6, 7)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_scan_is_split():
    texts = ["A b\tc\x0bD", None, "", "  x  ", "é È\nz", "a" * 3000 + " b"]
    for limit in (1, 10, 1 << 20):
        found = defaultdict(list)
        for w in textscan.scan(pa.array(texts), limit):
            for d, s, e in zip(w.doc, w.start, w.end, strict=True):
                found[w.first + d].append(bytes(w.data[s:e]))
        assert [found[i] for i in range(len(texts))] == [(t or "").encode().lower().split() for t in texts]
    a, b = (textscan.word_hash(x) for x in (b"abc", b"ABC"))
    assert a == b != textscan.word_hash(b"abd")


def test_scan_strips_punctuation():
    w = next(textscan.scan(pa.array(['"Hello," (x) *** 3.5%']), strip=True))
    assert [bytes(w.data[s:e]) for s, e in zip(w.start, w.end, strict=True)] == [b"hello", b"x", b"3.5"]


# 1


def test_profiles_rank_like_counters():
    text = "The cat, the Hat: it's 9 naïve cats"
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    line = f" {' '.join(words)} "
    want = Counter()
    for n in langid.ORDERS:
        grams = (line[i : i + n] for i in range(len(line) - n + 1))
        want.update(g for g in grams if g.strip() and " " not in g[1:-1])
    keys, counts = np.unique(langid.gram_keys(text), return_counts=True)
    assert sorted(counts) == sorted(want.values())
    assert len(langid.ranked(langid.gram_keys(text), 5)) == 5


def test_language_held_out(spark):
    got = queries.op1_language_profiles(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).collect()[0][0]
    assert held > 0.95
    assert {r["doc_id"] for r in got.where("held_out").collect()} == {i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2}


def test_language_odd(odd, empty, docs):
    profiles = langid.fit_profiles(langid.learnable(docs))
    got = langid.identify(odd, profiles)
    assert got.count() == odd.count() and set(odd.columns) <= set(got.columns)
    und = {r["doc_id"] for r in got.where("lang_pred = 'und'").collect()}
    assert und == {0, 1, 2, 9}
    assert langid.identify(empty, profiles).count() == 0
    assert langid.fit_profiles(langid.learnable(empty)) == {}
    assert langid.identify(odd, {}).where("lang_pred <> 'und'").count() == 0


# 2


def test_raking_meets_targets(spark):
    rng = random.Random(1)
    rows = [(f"s{i}", f"l{j}", f"t{k}", rng.randint(1, 900)) for i in range(5) for j in range(3) for k in range(2)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    goal = {"source": {f"s{i}": (i + 1) / 15 for i in range(5)}, "lang": {"l0": 0.5, "l1": 0.3, "l2": 0.2}, "topic": {"t0": 0.9, "t1": 0.1}}
    targets = {d: spark.createDataFrame(list(t.items()), f"{d} string, target double") for d, t in goal.items()}
    weights = mixing.rake(cells, targets)
    got = {(r["source"], r["lang"], r["topic"]): r["weight"] for r in weights.collect()}
    want = np.array([r[3] for r in rows], float).reshape(5, 3, 2)
    for _ in range(200):
        for axis, t in enumerate(goal.values()):
            others = tuple(a for a in range(3) if a != axis)
            shape = [1, 1, 1]
            shape[axis] = -1
            want = want * (np.array(list(t.values())) / want.sum(axis=others)).reshape(shape)
    assert np.allclose([got[r[:3]] for r in rows], want.ravel(), rtol=1e-4)
    drawn = mixing.calibrate(weights, 0.4).collect()
    assert math.isclose(sum(r["tokens"] * r["probability"] for r in drawn), 0.4 * sum(r[3] for r in rows), rel_tol=1e-6)
    assert max(r["probability"] for r in drawn) <= 1


def test_mixing_odd(odd, empty):
    got = mixing.mixed(odd)
    assert got.count() == odd.count()
    assert got.where("n_tokens = 0 and sampled").count() == 0
    assert mixing.mixed(empty).count() == 0


# 3


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    bits = [2 * sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) > len(shingles) for b in range(64)]
    return sum(b << i for i, b in enumerate(bits))


def brute_components(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def test_golay_keys_meet():
    rng = random.Random(3)
    table = simhash.golay_table()
    assert np.bincount(table, minlength=4096).tolist() == [2048] * 4096
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 2)):
            b ^= 1 << bit
        rows, keys = simhash.fuzzy_keys(np.array([a, b], dtype=np.uint64))
        assert set(keys[rows == 0]) & set(keys[rows == 1])


@pytest.mark.parametrize("dense", [64, 2])
def test_links_and_components(spark, dense):
    rng = random.Random(dense)
    fps = []
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 14)):
            fps.append(x)
            for bit in rng.sample(range(64), rng.randint(1, 3)):
                x ^= 1 << bit
    fps = list(dict.fromkeys(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), dense)
    assert all(((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= 2 for r in edges.collect())
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    want = brute_components(fps)
    groups = defaultdict(set)
    for f, w in zip(signed, want, strict=True):
        groups[w].add(f)
    for members in groups.values():
        assert {got.get(m, m) for m in members} == {min(members)}


def test_simhash_query(spark, docs):
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    fps = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(fps)
    got = sorted(tuple(r) for r in queries.op3_simhash_golay(spark, SF).collect())
    assert got == [(d, f"{f:016x}", rows[r][0]) for (d, _), f, r in zip(rows, fps, roots, strict=True)]


def test_simhash_odd(odd, empty):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    assert {r["component_id"] for r in got if r["doc_id"] in (0, 1, 2)} == {0}
    assert {r["component_id"] for r in got if r["doc_id"] in (3, 4)} == {3}
    assert simhash.near_duplicates(empty).count() == 0


# 4

ITEM = "Marta buys 12 kg of apples and later sells 12 kg to Pedro for 30 dollars in the old market near the river bank"


def leak(spark, text, **k):
    bench = spark.createDataFrame([(1, ITEM), (2, "short one here today"), (3, None), (4, "")], "item_id long, text string")
    return [tuple(r)[1:] for r in decontam.leaks(spark.createDataFrame([(7, text)], "doc_id long, text string"), bench, **k).collect()]


def test_templates(spark):
    around = "some other words stand before this. {} and some more come after it"
    assert [x[0] for x in leak(spark, around.format(ITEM))] == [1]
    other = ITEM.replace("12", "17").replace("Pedro", "Ivan").replace("30", "45")
    found = leak(spark, around.format(other))
    assert [x[0] for x in found] == [1] and found[0][3] == 4
    torn = ITEM.replace("12", "17", 1)
    assert leak(spark, around.format(torn)) == []
    assert leak(spark, "twelve words that have nothing to do with the benchmark at all today") == []
    assert [x[0] for x in leak(spark, "x y short one here today z")] == [2]
    for changed in (str.lower, str.upper, str.title):
        assert [x[0] for x in leak(spark, around.format(changed(ITEM)))] == [1]


def test_two_values_may_become_one(spark):
    same = ITEM.replace("12", "45").replace("30", "45").replace("Pedro", "Marta")
    assert [x[0] for x in leak(spark, f"some words before. {same} and after")] == [1]


def test_literal_windows(spark):
    numbers = "3 kg 17 m 25 cm 4 8 15 16 23 42"
    bench = spark.createDataFrame([(1, numbers), (2, "square root two"), (3, "12 * 12 = 144"), (4, "one plain word then 1 2 3 4 5 6 7 8 9 10 11 12")], "item_id long, text string")
    texts = [f"before it {numbers} after it", numbers.replace("25", "26"), "the square root, two of them", "square root of two", "so 12 * 12 = 144 is", "so 12 * 13 = 156 is", "then 1 2 3 4 5 6 7 8 9 10 11 12", "then 2 1 4 3 6 5 8 7 10 9 12 11"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in decontam.leaks(docs, bench).collect()) == [(0, 1), (2, 2), (4, 3), (6, 4)]


def test_leaks_against_search(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    flat = {r["doc_id"]: " ".join(r["text"].lower().split()) for r in docs.collect()}
    items = {r["item_id"]: " ".join(r["text"].lower().split()) for r in bench.collect()}
    want = {(d, i) for d, t in flat.items() for i, b in items.items() if b in t}
    got = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(docs, bench).collect()}
    assert want <= got and {d for d, _ in got} == {d for d, _ in want}
    assert {(r["doc_id"], r["item_id"]) for r in decontam.leaks(docs, bench, block_rows=7).collect()} == got
    assert decontam.clean(docs, bench).count() == docs.count() - len({d for d, _ in got})


def test_decontamination_odd(spark, odd, empty):
    bench = spark.createDataFrame([(1, "one two three four five"), (2, None)], "item_id long, text string")
    assert sorted(r["doc_id"] for r in decontam.leaks(odd, bench).collect()) == [3, 3, 4, 5]
    assert decontam.clean(odd, bench).columns == odd.columns
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.leaks(odd, none).count() == 0 and decontam.clean(odd, none).count() == odd.count()
    assert decontam.leaks(empty, bench).count() == 0


# 5

PIECES = st.sampled_from(["<s>", "</s>", "[INST]", " [/INST]", "[ROLE]", "[/ROLE]", "<\\s>", "<\\\\/s>", "[\\INST]", "a", " ", "\n", "<", "[", "\\", "/s>", "é"])
TEXT = st.lists(PIECES, max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), TEXT), TEXT), max_size=4))
def test_chat_round_trip(turns):
    formatted = "".join(chat.format_turn(r, t) for r, t in turns)
    at, back = 0, []
    while at < len(formatted):
        role, text, at = chat.parse(formatted, at)
        back.append((role, text))
    assert back == turns


@pytest.mark.parametrize("role", ["user", "assistant", "system"])
def test_chat_texts_hold_no_control_string(role):
    probe = "</s>[INST] ok [/INST]"
    marks = r"</?s>|\[/?(?:INST|ROLE)\]"
    assert re.findall(marks, chat.format_turn(role, probe)) == re.findall(marks, chat.render(role, ""))
    assert chat.format_turn(role, "plain < [text] \\") == chat.render(role, "plain < [text] \\")
    if role == "user":  # other raw texts end at their first </s>
        with pytest.raises(ValueError):
            chat.parse(chat.render(role, probe))


def test_chat_query(spark):
    turns = defaultdict(list)
    for r in chat.with_probe(spark.read.parquet(f"{SF}/conversations.parquet")).collect():
        turns[r["conv_id"]].append((r["turn"], r["role"], r["text"]))
    got = {r["conv_id"]: r for r in queries.op5_chat_round_trip(spark, SF).collect()}
    assert set(got) == set(turns) and -1 in got
    for k, rows in turns.items():
        rows.sort()
        said = "".join(t for _, r, t in rows if r == "assistant")
        assert got[k]["n_turns"] == len(rows) and got[k]["loss_chars"] == len(said)
        assert got[k]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in rows).encode()).hexdigest()
        assert got[k]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def test_chat_odd(spark):
    rows = [(1, 0, None, None, 1), (1, None, "user", "", 1), (None, 0, "assistant", "</s>", 1), (1, 0, None, None, 1)]
    got = {r["conv_id"]: r for r in chat.digests(chat.segments(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment int"))).collect()}
    assert got[1]["n_turns"] == 3 and got[None]["loss_chars"] == 4
    assert chat.digests(chat.segments(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


# 6 and 8


def duck(sql, spark=None, **tables):
    import duckdb

    c = duckdb.connect()
    for name in ("documents", "labels"):
        if name in tables:
            c.register(name, tables[name].toArrow())
        else:
            c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    r = c.execute(sql)
    return [x[0] for x in r.description], r.fetchall()


def same(df, sql, **tables):
    columns, rows = duck(sql, **tables)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(df.columns) == sorted(columns)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=key) == sorted(rows, key=key)


@pytest.mark.parametrize("name", ["op6_risk_controlled_rules", "op8_line_runs"])
def test_oracles(spark, name):
    from cartoscope.llm.oracles import ORACLES

    same(queries.QUERIES[name](spark, SF), ORACLES[name])


def test_quality_certifies(spark):
    good = " ".join(f"w{i}" for i in range(80))
    bad = " ".join(f"w{i}###" for i in range(80))
    rows = [(i, bad if i % 10 == 0 else good, "en") for i in range(30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    labels = spark.createDataFrame([(i, int(i % 10 != 0)) for i in range(30_000)], "doc_id long, quality int")
    got = quality.judge(docs, labels)
    assert got.where("not kept").count() == 3000 and got.where("reject_rule = 'symbols'").count() == 3000


def test_binomial_tail(spark):
    cases = [(100, 0), (100, 1), (2000, 3), (50_000, 200), (50_000, 251), (0, 0)]
    got = spark.createDataFrame(cases, "n long, k long").select(quality.tail("n", "k", 0.005)).collect()
    for (n, k), (p,) in zip(cases, got, strict=True):
        want = 1.0 if k > n * 0.005 else sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(0.005) + (n - i) * math.log(0.995)) for i in range(k + 1))
        assert math.isclose(p, want, rel_tol=1e-6)


def test_quality_odd(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1, 0), (3, None, 1), (None, 1, 1), (5, 0, None)], "doc_id long, quality int, toxic int")
    got = quality.judge(odd, labels)
    assert got.count() == odd.count()
    rows = {r["doc_id"]: r for r in got.collect()}
    assert rows[0]["n_words"] == 0 and rows[6]["n_repeat_words"] == 60_000 and rows[6]["base_failed"]
    assert quality.judge(empty, labels).count() == 0
    assert quality.judge(odd, labels.limit(0)).count() == odd.count()


def test_lines_levels(spark):
    rows = [(i, f"Header  \nbody {i}\n header\n\nrare {i // 9}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for count in (1, 3, 7):
        got = lines.drop_frequent_lines(docs, 10, count)
        assert {r["n_dropped"] for r in got.collect()} == {2}
        assert sorted(r["kept"] for r in got.collect()) == sorted(f"body {i}\n\nrare {i // 9}" for i in range(40))


def test_lines_odd(odd, empty):
    got = lines.drop_frequent_lines(odd, 2).select("doc_id", "n_lines", "n_dropped", "kept").collect()
    assert len(got) == odd.count()
    rows = {r["doc_id"]: r for r in got}
    assert tuple(rows[0])[1:] == (1, 0, "") and tuple(rows[3])[1:] == (1, 1, "") and rows[5]["kept"] == "Line"
    assert lines.drop_frequent_lines(empty).count() == 0


# 7


@pytest.mark.parametrize("sizes", [[1] * 500, [1] * 20 + [5000], [10, 20, 30] * 100, [7] * 3])
def test_shards(spark, sizes):
    rows = [(i, "x" * (s - 1) if i % 3 else "same") for i, s in enumerate(sizes)]
    got = sharding.shard_table(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(len(rows)))
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
        assert r["size"] == len(rows[r["doc_id"]][1]) + 1 and r["text_crc32"] == zlib.crc32(rows[r["doc_id"]][1].encode())
    total, most = sum(r["size"] for r in got), max(r["size"] for r in got)
    for s, members in by.items():
        assert 0 <= s < 16 and sorted(r["slot"] for r in members) == list(range(len(members)))
        assert abs(sum(r["size"] for r in members) - total / 16) <= 2 * most + 0.02 * total / 16


def test_sharding_odd(odd, empty):
    got = sharding.shard(odd)
    assert got.count() == odd.count() and got.where("doc_id = 0").collect()[0]["size"] == 1
    assert sharding.shard(empty).count() == 0 and sharding.shard_table(empty).count() == 0


# 9


def brute_katz(texts, train, share):
    tok = lambda t: (t or "").encode().lower().split()
    uni = Counter(w for t in train for w in tok(t))
    n = sum(uni.values()) + len(train)
    kinds = len(uni) + bool(train)
    least = max(2, -(-n // share))
    vocabulary = {w for w, c in uni.items() if c >= least}
    cls = lambda w: w if w in vocabulary else 0
    pairs = Counter()
    for t in train:
        seq = ["<s>", *map(cls, tok(t)), "</s>"]
        pairs.update(zip(seq, seq[1:], strict=False))
    counts = {w: float(uni[w]) for w in vocabulary} | {"</s>": len(train) + 1.0, 0: sum(c for w, c in uni.items() if w not in vocabulary) + 1.0}
    total = sum(counts.values())
    p1 = {w: c / total for w, c in counts.items()}
    d, du = katz._discounts(Counter(pairs.values())), katz._discounts(Counter(uni.values()))
    cut = lambda d, c: d[min(c, katz.TOP)] if c <= katz.TOP else 1.0

    def bigram(h):
        seen = {w: c for (a, w), c in pairs.items() if a == h}
        m = sum(seen.values())
        if not m:
            return dict(p1)
        used = sum(cut(d, c) * c for c in seen.values()) / m
        kept = 1.0 if len(seen) >= len(p1) else min(used, m / (m + 1))
        rest = 1 - sum(p1[w] for w in seen)
        return {w: cut(d, seen[w]) * seen[w] / m * kept / used if w in seen else (1 - kept) / rest * p for w, p in p1.items()}

    tables = {h: bigram(h) for h in {"<s>", 0, *vocabulary}}
    for p in tables.values():
        assert math.isclose(sum(p.values()), 1, rel_tol=1e-9)
    rare = {w: cut(du, c) * c / counts[0] for w, c in uni.items() if w not in vocabulary}
    out = []
    for t in texts:
        seq = ["<s>", *tok(t), "</s>"]
        score = base = known = 0
        for h, w in zip(seq, seq[1:], strict=False):
            c = len(train) if w == "</s>" else uni[w]
            hc, wc = (x if x in ("<s>", "</s>") else cls(x) for x in (h, w))
            score += math.log10(tables[hc][wc])
            if wc == 0:
                score += math.log10(rare.get(w, 1 - sum(rare.values())))
            base += math.log10((c + 1) / (n + kinds + 1))
            known += c > 0
        out.append((len(seq) - 1, known, n, base, score))
    return out


@pytest.mark.parametrize(("share", "part"), [(10**6, 4_000_000), (40, 50)])
def test_katz(spark, share, part):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(60)], k=rng.randint(0, 40))) for _ in range(80)] + [None, "", "never seen words", "W1 w1"]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(katz.score(docs, docs.where("doc_id < 70"), share, part).collect())
    want = brute_katz(texts, texts[:70], share)
    for r, w in zip(got, want, strict=True):
        assert tuple(r)[1:4] == w[:3] and np.allclose(tuple(r)[4:], w[3:], rtol=1e-9)


def test_katz_odd(odd, empty):
    got = katz.score_held_out(odd)
    assert got.count() == odd.count() and got.where("score is null or isnan(score) or score = double('-infinity')").count() == 0
    assert katz.score_held_out(empty).count() == 0
    assert katz.score(odd, empty).where("n_known > 0").count() == 0


# 10


def test_neighbours_are_exact():
    rng = np.random.default_rng(4)
    words = np.sort(rng.integers(1, 1 << 60, 50).astype(np.uint64))
    idf = rng.random(50) + 0.1
    bag = lambda: (w := np.sort(rng.choice(words, rng.integers(0, 12), replace=False)), rng.integers(1, 5, len(w)))
    rows = [(i, int(rng.integers(0, 2)), *bag()) for i in range(500)]
    index = toxicity.build(rows, words, idf, 0.1, 1.0)
    dense = np.zeros((500, 50))
    place = {d: i for i, d in enumerate(index.ids)}
    for d, _, h, n in rows:
        at, w = toxicity._vector(h, n, words, idf)
        dense[place[d], at] = w
    for _ in range(100):
        at, w = toxicity._vector(*bag(), words, idf)
        cosine = dense[:, at] @ w if len(at) else np.zeros(500)
        found, scores = toxicity.nearest(index, at, w, 25)
        assert np.allclose(np.sort(scores)[::-1], np.sort(cosine[cosine > 0])[::-1][:25])
        assert np.allclose(cosine[found], scores)


def test_toxicity_learns(spark):
    rng = random.Random(2)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(1200):
        toxic = i % 8 == 0
        text = rng.choices(plain, k=40) + (rng.choices(["scum", "loser", "moron"], k=2) if toxic else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scored = toxicity.score(docs, toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))).collect()
    assert all(0 <= r["score"] <= 1 for r in scored)
    assert all((r["score"] >= 0.3) == (r["doc_id"] % 8 == 0) for r in scored)


def test_copies_of_examples_meet_them(spark):
    texts = {i: f"only{i} once{i}, here{i}" for i in range(60)}
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in texts], "doc_id long, toxic int")
    index = toxicity.fit(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), labels)
    learnt = dict(zip(index.ids.tolist(), index.label.tolist(), strict=True))
    copies = spark.createDataFrame([(1000 + i, f"({texts[i].upper()})") for i in learnt], "doc_id long, text string")
    for r in toxicity.score(copies, index).collect():
        assert r["evidence"] == [r["doc_id"] - 1000]
        assert (r["score"] >= 0.3) == (learnt[r["doc_id"] - 1000] == 1)


def test_toxicity_odd(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1), (4, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    assert toxicity.score(odd, toxicity.fit(odd, labels)).where("score between 0 and 1").count() == odd.count()
    assert toxicity.score(empty, toxicity.fit(empty, labels.limit(0))).count() == 0


# The pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, kept, SF)
        ids, before = [r["doc_id"] for r in after.select("doc_id").collect()], {r["doc_id"] for r in kept.select("doc_id").collect()}
        assert set(ids) <= before and len(ids) == len(set(ids))
        if name == "SimHash near-dedup":
            texts = {r["doc_id"]: r["text"] for r in kept.collect()}
            order = sorted(texts)
            roots = brute_components([brute_fingerprint(texts[i]) for i in order])
            assert sorted(ids) == [order[i] for i in sorted(set(roots))]
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns
            kept = spark.createDataFrame(after.collect(), docs.schema)
    assert {"shard", "slot"} <= set(after.columns)


def test_dedup_goes_by_row(spark):
    import corpus_pipeline

    one, two, three, four = (" ".join(f"{w}{i}" for i in range(40)) for w in "abcd")
    rows = [(1, one), (None, one), (None, two), (5, one), (5, three), (7, four), (7, four), (None, two)]
    got = corpus_pipeline.deduplicated(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted([(1, one), (None, two), (5, three), (7, four)], key=str)
