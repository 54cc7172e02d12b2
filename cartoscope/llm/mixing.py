"""Mixing sources to target weights by iterative proportional fitting.

Documents are pre-aggregated to cells (source, language, topic) of token
counts. Raking scales the cells in turn to the target shares of each marginal
until all three hold, no cell giving more than it has; a document is then drawn
with its cell's calibrated probability. Only DataFrame operations are used, and
after the first aggregation only cells, never documents, move.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .storage import forget, store

DIMENSIONS = ("source", "lang", "topic")
BLANKS = " \t\n\x0b\x0c\r"
#: A word and the blanks after it: one character each leaves a text as long as its words are many.
WORD = r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+"
MARKS, DIGITS = "#*$%&<>{}=;", "0123456789"
#: Stands for a null source, language or topic.
NULL = "\u0000"


class Infeasible(ValueError):
    """No weights meet the targets; the message says by how much each marginal is off."""


def n_tokens(text: Column) -> Column:
    words = F.regexp_replace(F.ltrim(text, F.lit(BLANKS)), WORD, "x")
    return F.coalesce(F.length(words), F.lit(0)).cast("long")


def form_topic(text: Column) -> Column:
    """Topic of documents that carry none: the form their text takes."""
    signs = F.regexp_replace(text, rf"[^|{MARKS}{DIGITS}]++", "")
    cut = F.length(signs) - F.length(F.translate(signs, "|", ""))
    marks = F.length(signs) - F.length(F.translate(signs, MARKS, ""))
    digits = F.length(signs) - F.length(F.translate(signs, DIGITS, ""))
    long = F.length(text)
    return (
        F.when(text.isNull() | (long == 0), "empty")
        .when(cut * 40 > long, "table")
        .when(marks * 40 > long, "markup")
        .when(digits * 40 > long, "numbers")
        .when(long >= 4000, "long prose")
        .otherwise("prose")
    )


def flattened(cells: DataFrame, dimension: str, power: float, keep: float | None = None) -> DataFrame:
    """Target shares proportional to the natural shares to a power under one.

    With ``keep``, the share of all tokens that is wanted, no target exceeds what
    its value has; what that leaves goes to the others in proportion.
    """
    mass = cells.groupBy(dimension).agg(F.sum("tokens").alias("t")).where("t > 0")
    total = mass.agg(F.sum("t")).collect()[0][0] or 1
    share = F.col("t") / total
    wish, most = F.pow(share, F.lit(power)), share / keep if keep else F.lit(float("inf"))
    scale, before = 0.0, None
    while scale != before:
        full = wish * scale >= most
        sums = mass.agg(F.sum(F.when(full, most)), F.sum(F.when(~full, wish))).collect()[0]
        before = scale
        if sums[1]:
            scale = max(scale, (1 - (sums[0] or 0.0)) / sums[1])
    return mass.select(dimension, F.least(most, wish * scale).alias("target"))


def _fit(state: DataFrame, dimension: str) -> DataFrame:
    """One step: weights of each value scaled so that what its cells give comes to the target.

    A cell gives its weight, but at most its cap; where some are at their caps the
    others make up for it, which caps more of them, so a later step goes on.
    """
    full = F.col("weight") >= F.col("cap")
    sums = state.groupBy(F.col(dimension).alias("_value")).agg(
        F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)).alias("_full"),
        F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("_free"),
        F.first(f"target_{dimension}").alias("_goal"),
    )
    given, free, goal = F.col("_full") + F.col("_free"), F.col("_free"), F.col("_goal")
    grown = F.when((free > 0) & (goal > F.col("_full")), (goal - F.col("_full")) / free)
    factor = F.coalesce(grown, F.when(given > 0, goal / given), F.lit(1.0))
    joined = state.join(sums.select("_value", factor.alias("_factor")), F.col(dimension) == F.col("_value"))
    return joined.withColumn("weight", F.col("weight") * F.col("_factor")).drop("_value", "_factor")


def _errors(state: DataFrame, dimensions: list[str]) -> dict[str, float]:
    """Largest relative error of each marginal."""
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.col(d).alias("value"), F.col(f"target_{d}").alias("t")) for d in dimensions]))
    sums = state.select(each.alias("m"), F.least("weight", "cap").alias("w")).groupBy("m").agg(F.sum("w").alias("w")).where("m.t > 0")
    worst = sums.groupBy("m.d").agg(F.max(F.abs(F.col("w") / F.col("m.t") - 1)).alias("error"))
    return {d: 0.0 for d in dimensions} | {r["d"]: r["error"] for r in worst.collect()}


def rake(cells: DataFrame, targets: dict[str, DataFrame], keep: float | None = None, tolerance: float = 1e-6, most: int = 60) -> DataFrame:
    """``cells`` with weight: shares of all tokens whose marginals are the targets.

    With ``keep``, the share of all tokens that is wanted, no cell's weight
    exceeds what it has. Cells without tokens, or whose value has no target, get
    weight 0. After each cycle the weights are written and the largest relative
    error of each marginal is read; if it is over ``tolerance`` after ``most``
    cycles, :class:`Infeasible` is raised.
    """
    state = cells.where("tokens > 0")
    for d, target in targets.items():
        state = state.join(target.withColumnRenamed("target", f"target_{d}"), d)
    state = store(state.withColumn("weight", F.col("tokens").cast("double")), "rake")
    total = state.agg(F.sum("tokens")).collect()[0][0] or 1
    cap = F.col("tokens") / (keep * total) if keep else F.lit(float("inf"))
    state = state.withColumns({"weight": F.col("weight") / total, "cap": cap})
    errors: dict[str, float] = {}
    for _ in range(most):
        fitted = store(reduce(_fit, targets, state), "rake")
        forget(state)
        state, errors = fitted, _errors(fitted, list(targets))
        if max(errors.values()) <= tolerance:
            return state.select(*DIMENSIONS, "tokens", F.least("weight", "cap").alias("weight"))
    raise Infeasible(f"after {most} cycles the marginals are off by " + ", ".join(f"{d} {e:.3g}" for d, e in errors.items()))


def calibrate(weights: DataFrame, keep: float) -> DataFrame:
    """Cells with probability: in proportion to weight / tokens, 1 at most, such
    that ``keep`` of all tokens are expected; what full cells can't give is taken
    from the others. Weights raked for that ``keep`` need none of this."""
    ratio = F.col("weight") / F.col("tokens")
    budget = keep * (weights.agg(F.sum("tokens")).collect()[0][0] or 0)
    scale, before = budget, None
    while scale != before:
        full = ratio * scale >= 1
        sums = weights.agg(F.sum(F.when(full, F.col("tokens"))), F.sum(F.when(~full, F.col("weight")))).collect()[0]
        before = scale
        if sums[1]:
            scale = max(scale, (budget - (sums[0] or 0)) / sums[1])
    return weights.withColumn("probability", F.least(F.lit(1.0), ratio * scale))


def natural_targets(cells: DataFrame, keep: float, power: float, tolerance: float, halvings: int = 3) -> DataFrame:
    """Weights raked to natural shares to ``power``. While no weights meet these, the
    power moves half way to 1, and at last to 1, where every cell keeps its share."""
    for k in range(halvings + 1):
        p = 1 - (1 - power) / 2**k if k < halvings else 1.0
        try:
            return rake(cells, {d: flattened(cells, d, p, keep) for d in DIMENSIONS}, keep, tolerance, 30)
        except Infeasible:
            if p == 1.0:
                raise
    raise AssertionError("the last power is 1")


def mixed(
    docs: DataFrame,
    targets: dict[str, DataFrame] | None = None,
    keep: float = 0.5,
    power: float = 0.7,
    seed: int = 17,
    broadcast_cells: int = 20_000,
    keep_text: bool = True,
    tolerance: float = 1e-3,
) -> DataFrame:
    """``docs`` with topic, n_tokens, probability and sampled.

    ``targets``: by dimension a table (dimension, target) of shares, met to
    ``tolerance`` by the expected tokens, or :class:`Infeasible` is raised; else
    the natural shares to ``power`` (:func:`natural_targets`), as far as each
    value has the tokens. topic is the input's column of that name or
    :func:`form_topic`. Null source, language or topic count as a value of
    their own. Documents without words, and cells without a target, have
    probability 0; the draw hashes doc_id, so equal ids are drawn alike (null
    ids by their text). Other columns stay, whatever their names; n_tokens,
    probability and sampled are replaced. An empty table gives an empty result.

    Each text is measured once: rows go to the shared folder with what was
    measured, without the text unless ``keep_text``. Cells go to every task
    only if there are at most ``broadcast_cells``; otherwise they are joined by
    shuffle.
    """
    docs = docs.drop("n_tokens", "probability", "sampled")
    text = F.col("text")
    if "topic" not in docs.columns:
        docs = docs.withColumn("topic", form_topic(text))
    key = F.struct(*[F.coalesce(F.col(d), F.lit(NULL)).alias(d) for d in DIMENSIONS]).alias("cell")
    draw = F.xxhash64(F.lit(seed), F.col("doc_id"), F.when(F.col("doc_id").isNull(), F.xxhash64(text)))
    own = F.struct(*[F.col(c) for c in docs.columns if keep_text or c != "text"]).alias("own")
    rows = store(docs.select(own, key, n_tokens(text).alias("n_tokens"), (F.shiftrightunsigned(draw, 11) / float(1 << 53)).alias("draw")), "measured")
    cells = store(rows.groupBy("cell").agg(F.sum("n_tokens").alias("tokens")).select("cell.*", "tokens"), "cells")
    weights = natural_targets(cells, keep, power, tolerance) if targets is None else rake(cells, targets, keep, tolerance)
    chance = store(calibrate(weights, keep).select(F.struct(*DIMENSIONS).alias("of"), F.col("probability").alias("chance")), "chances")
    if chance.count() <= broadcast_cells:
        chance = F.broadcast(chance)
    joined = rows.join(chance, F.col("cell") == F.col("of"), "left")
    probability = F.when(F.col("n_tokens") > 0, F.coalesce("chance", F.lit(0.0))).otherwise(0.0)
    return joined.select("own.*", "n_tokens", probability.alias("probability"), (F.col("draw") < probability).alias("sampled"))
