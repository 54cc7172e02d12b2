"""Quality rules whose cutoffs carry a guarantee on false rejections.

Each rule rejects documents whose value exceeds a cutoff. On labelled documents
of good quality, the number that a cutoff rejects is binomial; the exact test of
"this stratum's false rejection rate is over ``alpha``" gives a p-value for
every (stratum, rule, cutoff). Bonferroni over all of them makes the chance of
any wrongly certified cutoff at most ``delta``. A stratum's rule takes its
strictest certified cutoff, or rejects nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .storage import store

#: The grid tested: fixed beforehand, so that the correction covers every choice.
CUTOFFS = {
    "symbols": (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.5, 0.75, 1.0),
    "dup_lines": (0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.75),
    "repeats": (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.45),
    "word_length": (7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0),
}
BLANKS = r" \t\n\u000b\u000c\r"

_FEATURES = rf"""
transform(array(filter(split(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), x -> x <> '')), w -> struct(
  cast(size(w) as bigint) as n_words,
  transform(array(if(size(w) < 3, cast(array() as array<bigint>), transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])))), h ->
    if(size(array_distinct(h)) = size(h), 0L,
      transform(array(sort_array(transform(h, (x, i) -> struct(x, i)))), s ->
        aggregate(
          sort_array(transform(filter(
            transform(s, (e, k) -> struct(e.i as i, coalesce(get(s, k - 1).x = e.x, false) or coalesce(get(s, k + 1).x = e.x, false) as again)),
            e -> e.again), e -> e.i)),
          struct(0L as total, -3 as last),
          (a, i) -> struct(a.total + least(3, i - a.last) as total, i as last),
          a -> a.total))[0]))[0] as n_repeat_words))[0]
"""
_LINES = rf"""
transform(array(filter(split(coalesce(text, ''), '\n', -1), l -> btrim(l, '{BLANKS}') <> '')), l -> struct(
  cast(size(l) as bigint) as n_lines, cast(size(l) - size(array_distinct(l)) as bigint) as n_dup_lines))[0]
"""


def base(docs: DataFrame, *keep: str) -> DataFrame:
    """Word, symbol, line and repetition counts of whole texts, a row per row.

    A null text has no words. n_repeat_words counts the words inside any 3-word
    window that occurs twice or more in the text, its first occurrence included.
    """
    text = F.coalesce("text", F.lit(""))
    blank = F.expr(f"translate(coalesce(text, ''), '{BLANKS}', '')")
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    found = docs.select(
        *keep,
        F.expr(_FEATURES).alias("w"),
        F.expr(_LINES).alias("l"),
        F.length(blank).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
    )
    counts = found.select(*keep, "w.n_words", "word_chars", "n_symbols", "l.n_lines", "l.n_dup_lines", "w.n_repeat_words")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counts.withColumn("base_failed", failed)


def rule_values() -> dict[str, Column]:
    """Value of each rule, from the base counts; higher is worse, 0 without words."""

    def rate(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return {
        "symbols": rate("n_symbols", "n_words"),
        "dup_lines": rate("n_dup_lines", "n_lines"),
        "repeats": rate("n_repeat_words", "n_words"),
        "word_length": rate("word_chars", "n_words"),
    }


def _ln_factorial(m: str) -> str:
    """Exact to about 1e-12: a table of factorials up to 20, Stirling's series above."""
    series = f"{m} * ln({m}) - {m} + 0.5D * ln(2 * pi() * {m}) + 1 / (12D * {m}) - 1 / (360D * pow({m}, 3)) + 1 / (1260D * pow({m}, 5))"
    return f"if({m} <= 20, ln(double(factorial(int(least({m}, 20))))), {series})"


def tail(n: str, k: str, rate: float) -> Column:
    """P(Bin(n, rate) <= k); 1 where k > n * rate, which is never small.

    Terms are summed downwards from that of k, relative to it. Below n * rate
    they fall faster and faster, so ten standard deviations hold all that a
    double can show, and no n or k is too large.
    """
    odds = f"{(1 - rate) / rate!r}D"
    most = f"int(least({k}, 10 * sqrt({n} * {rate!r}D) + 50))"
    falling = f"""aggregate(sequence(0, {most}), struct(1D as term, 0D as sum),
      (a, j) -> struct(if({k} - j > 0, a.term * ({k} - j) / ({n} - {k} + j + 1) * {odds}, 0D) as term, a.sum + a.term as sum), a -> a.sum)"""
    first = f"""exp({_ln_factorial(n)} - ({_ln_factorial(k)}) - ({_ln_factorial(f"({n} - {k})")})
      + {k} * ln({rate!r}D) + ({n} - {k}) * ln(1 - {rate!r}D))"""
    return F.expr(f"if({k} > {n} * {rate!r}D, 1D, least(1D, {first} * {falling}))")


def certified(good: DataFrame, stratum: str, alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """Strictest certified cutoff by stratum: a row (stratum, rule columns).

    ``good`` holds the base counts of labelled documents of good quality.
    All of its rows are tested. ``alpha`` is shared equally by the rules. The
    number of tests counts every stratum, rule and cutoff. A rule without a
    certified cutoff is null.
    """
    rate = alpha / len(CUTOFFS)
    over = [F.count_if(rule_values()[r] > c).alias(f"{r}_{i}") for r, cs in CUTOFFS.items() for i, c in enumerate(cs)]
    counts = store(good.groupBy(stratum).agg(F.count("*").alias("n"), *over), "quality-tests")
    tests = counts.count() * sum(map(len, CUTOFFS.values()))
    best = []
    for r, cs in CUTOFFS.items():
        passed = [F.when(tail("n", f"{r}_{i}", rate) * tests <= delta, F.lit(c)) for i, c in enumerate(cs)]
        best.append(F.least(*passed).alias(f"cut_{r}"))
    return counts.select(stratum, *best)


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """doc_id, stratum, base counts, base_failed, reject_rule and kept of every row of ``docs``.

    A document is good if all its labels of quality are 1; labels that are null
    count for nothing. Strata with few or no labels certify no cutoff and keep
    all that passes the base rules; a null stratum is one of its own. The
    strata must be few (languages, sources): one row of cutoffs each goes to
    every task, after a check that there are at most 20,000.
    """
    facts = store(base(docs, "doc_id", stratum), "quality-facts")
    good = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")
    cuts = store(certified(facts.join(good, "doc_id"), stratum, alpha, delta), "quality-cuts").withColumnRenamed(stratum, "_stratum")
    if cuts.count() <= 20_000:
        cuts = F.broadcast(cuts)
    joined = facts.join(cuts, facts[stratum].eqNullSafe(F.col("_stratum")), "left")
    broken = [F.when(v > F.col(f"cut_{r}"), r) for r, v in rule_values().items()]
    rule = F.coalesce(*broken)
    kept = ~F.col("base_failed") & rule.isNull()
    return joined.withColumns({"reject_rule": rule, "kept": kept}).drop("_stratum", *[f"cut_{r}" for r in CUTOFFS])
