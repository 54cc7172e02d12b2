"""Raking with caps, targets that can't be met, and names that clash."""

from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cartoscope.llm import mixing, queries

SF = "/root/testdata/sf0.01"


def table(spark, dimension, goal):
    return spark.createDataFrame(list(goal.items()), f"{dimension} string, target double")


def cells_of(spark, rows):
    return spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")


def test_caps_hold_and_targets_are_met(spark):
    rows = [("a", "x", "t", 10), ("a", "y", "t", 400), ("b", "x", "t", 300), ("b", "y", "t", 290)]
    rows += [("c", lang, topic, 250) for lang in "xy" for topic in "tu"]
    goal = {"source": {"a": 0.38, "b": 0.27, "c": 0.35}, "lang": {"x": 0.4, "y": 0.6}, "topic": {"t": 0.85, "u": 0.15}}
    weights = mixing.rake(cells_of(spark, rows), {d: table(spark, d, g) for d, g in goal.items()}, keep=0.5, tolerance=1e-4)
    drawn = mixing.calibrate(weights, 0.5).collect()
    expected = {r[:3]: r["probability"] * r["tokens"] for r in drawn}
    uncapped = mixing.rake(cells_of(spark, rows), {d: table(spark, d, g) for d, g in goal.items()})
    assert all(r["probability"] <= 1 for r in drawn) and any(r["weight"] * 1000 > r["tokens"] for r in uncapped.collect())
    for at, g in enumerate(goal.values()):
        sums = defaultdict(float)
        for k, v in expected.items():
            sums[k[at]] += v / 1000
        assert sums == pytest.approx(g, rel=1e-3)


def test_infeasible_targets_raise(spark):
    rows = [("a", "x", "t", 100), ("b", "y", "t", 100)]
    goal = {"source": {"a": 0.9, "b": 0.1}, "lang": {"x": 0.1, "y": 0.9}, "topic": {"t": 1.0}}
    with pytest.raises(mixing.Infeasible, match="source|lang"):
        mixing.rake(cells_of(spark, rows), {d: table(spark, d, g) for d, g in goal.items()}, most=5)


def test_query_meets_its_targets(spark):
    got = queries.op2_proportional_mixing(spark, SF).cache()
    cells = got.select(*[F.coalesce(d, F.lit(mixing.NULL)).alias(d) for d in mixing.DIMENSIONS], F.col("n_tokens").alias("tokens"))
    total = got.agg(F.sum(F.col("n_tokens") * F.col("probability")), F.sum("n_tokens")).collect()[0]
    assert total[0] == pytest.approx(0.5 * total[1], rel=1e-3)
    for d in mixing.DIMENSIONS:
        want = {r[d]: r["target"] for r in mixing.flattened(cells, d, 0.7, 0.5).collect()}
        have = got.groupBy(F.coalesce(d, F.lit(mixing.NULL)).alias(d)).agg(F.sum(F.col("n_tokens") * F.col("probability")).alias("w")).collect()
        assert sum(want.values()) == pytest.approx(1)
        for r in have:
            assert r["w"] / total[0] == pytest.approx(want.get(r[d], 0.0), rel=0.01, abs=1e-9)
    near = got.agg(F.sum(F.when(F.col("sampled"), F.col("n_tokens"))), F.sum("n_tokens")).collect()[0]
    assert near[0] / near[1] == pytest.approx(0.5, abs=0.08)


def test_names_and_null_ids(spark):
    names = ["_source", "_lang", "_topic", "cell", "own", "draw", "chance", "of", "tokens", "weight"]
    rows = [(None, f"some words {i} here", "en", "s", *range(len(names))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string, " + ", ".join(f"{n} int" for n in names))
    got = mixing.mixed(docs)
    assert got.columns == [*docs.columns, "topic", "n_tokens", "probability", "sampled"]
    assert 140 < got.where("sampled").count() < 260
    assert got.select(*names).distinct().collect() == [tuple(range(len(names)))]
