"""Long texts come in pieces; names of the input do not clash; ids may be ints."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartoscope.llm import chat, decontam, katz, langid, lines, mixing, quality, sharding, simhash, textscan, toxicity

NAMES = "lot place offset _source _id _mark _drop _gone own mark of spots told row hash fp least key part kind k1 k2 keep cell draw chance law slot_ cut_symbols _stratum".split()


@pytest.fixture(scope="module")
def clashing(spark):
    texts = [None, "", "One two three four five six", "One two three four five six", "Der die das und nicht", " \n\n x"]
    rows = [(i, t, "en", "s", *range(len(NAMES))) for i, t in enumerate(texts)] + [(None, "the same text", "en", "s", *range(len(NAMES)))] * 3
    return spark.createDataFrame(rows, "doc_id int, text string, lang string, source string, " + ", ".join(f"{n} int" for n in NAMES))


def long_text(n=30_000):
    rng = random.Random(n)
    return " ".join(f"w{rng.randint(0, 900)}" + rng.choice(["", ",", ".\n", " é", "  "]) for _ in range(n))


def test_profiles_in_pieces(monkeypatch):
    text = long_text()
    whole = np.unique(langid.gram_keys(text), return_counts=True)
    pieces = langid.pieces
    monkeypatch.setattr(langid, "pieces", lambda t: pieces(t, 700))
    for a, b in zip(langid.gram_counts(text), whole, strict=True):
        assert np.array_equal(a, b)
    assert "".join(pieces("a bc  d", 1)) == "a bc  d" and list(pieces("")) == []


def test_fingerprints_in_pieces(monkeypatch):
    text = long_text(5000)
    cases = [text, "", "one", "one two", " a  b c ", "x\x0by z", None]
    whole = [simhash.fingerprint(t) for t in cases]
    pieces = simhash._pieces
    for size in (1, 5, 400):
        monkeypatch.setattr(simhash, "_pieces", lambda d, size=size: pieces(d, size))
        assert [simhash.fingerprint(t) for t in cases] == whole


def test_bags_in_pieces(monkeypatch):
    column = pa.array([long_text(4000), "a b", None, long_text(3000)])
    whole = list(toxicity.bags(column))
    scan = textscan.scan
    monkeypatch.setattr(toxicity, "scan", lambda c, **k: scan(c, 900, **k))
    got = list(toxicity.bags(column))
    assert [g[0] for g in got] == [0, 1, 2, 3]
    for a, b in zip(got, whole, strict=True):
        assert np.array_equal(a[1], b[1]) and np.array_equal(a[2], b[2])


def test_columns_stay(spark, clashing):
    bench = spark.createDataFrame([(1, "five four three two one")], "item_id int, text string")
    labels = spark.createDataFrame([(2, 1, 1), (4, 0, 0)], "doc_id int, quality int, toxic int")
    n = clashing.count()
    for made, rows in (
        (sharding.shard(clashing), n),
        (mixing.mixed(clashing), n),
        (lines.drop_frequent_lines(clashing, 2), n),
        (simhash.one_each(clashing), None),
        (decontam.clean(clashing, bench, torn=True), n),
        (langid.identify(clashing, langid.fit_profiles(langid.learnable(clashing))), n),
    ):
        assert made.columns[: len(clashing.columns)] == clashing.columns
        got = made.select(*NAMES).distinct().collect()
        assert [tuple(r) for r in got] == [tuple(range(len(NAMES)))] and rows in (None, made.count())
    for made in (simhash.near_duplicates(clashing), katz.score_held_out(clashing), quality.judge(clashing, labels), toxicity.score(clashing, toxicity.fit(clashing, labels)), sharding.shard_table(clashing)):
        assert made.count() == n
    assert decontam.leaks(clashing, bench).count() == 0


def test_equal_rows_are_dealt_out(spark):
    same = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("one text").alias("text"))
    sizes = [r["n"] for r in sharding.shard_table(same).groupBy("shard").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 16 and max(sizes) - min(sizes) <= 0.02 * 20_000 / 16 + 3
    slots = sharding.shard(same).groupBy("shard").agg(F.count_distinct("slot").alias("d"), F.max("slot").alias("m"), F.count("*").alias("n")).collect()
    assert all(r["d"] == r["n"] == r["m"] + 1 for r in slots)


def test_chat_takes_int_ids(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], "conv_id int, turn int, role string, text string")
    got = chat.digests(chat.segments(turns)).collect()[0]
    assert (got["conv_id"], got["n_turns"], got["loss_chars"]) == (1, 2, 1)
