"""Curation: dedup, review, vocabulary proposals, reports and export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import vocabulary as V
from ..functions import text as T


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row of each key in arrival order; nulls are one key, and come first in the order.

    Of rows that arrive alike the one with the least hash stays. Aggregates with
    map-side combine instead of ranking, so a key that many rows share costs no
    large group; keys are compared by 128 bits of hash, so a long text among
    them travels once.
    """
    plain = [n for n, t in df.dtypes if "map<" not in t]
    arrival = F.struct(*order, F.xxhash64(*plain))
    marks = [c for k in keys for c in (F.col(k), F.col(k).isNull())]
    best = df.groupBy(F.xxhash64(*marks), F.xxhash64(F.lit(1), *marks)).agg(F.min_by(F.struct(*df.columns), arrival).alias("_row"))
    return best.select("_row.*")


def first_n(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], n: int, name: str = "place") -> DataFrame:
    """The first n rows of each group: the feature of a report with examples."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(name, place).where(F.col(name) <= n)


def unseen(review: DataFrame, seen: DataFrame, key: str = "url") -> DataFrame:
    """Rows whose key is not in ``seen``; a missing key counts as empty."""
    done = seen.select(T.text(F.col(key)).alias("_seen")).distinct()
    return review.join(done, T.text(review[key]) == F.col("_seen"), "left_anti")


def token_counts(df: DataFrame, c: Column, order: Column, least: int = 4, letters: str = "а-яё", stop: Sequence[str] = V.STOP_WORDS) -> DataFrame:
    """Frequency of each token, and where it first came."""
    words = df.select(order.alias("seq"), F.posexplode(T.tokens(c, least, letters)).alias("pos", "word"))
    counts = words.where(~F.col("word").isin(*stop)).groupBy("word")
    return counts.agg(F.count("*").alias("cnt"), F.min(F.struct("seq", "pos")).alias("first"))


def proposals(counts: DataFrame, known: Sequence[str], least: int = 3) -> DataFrame:
    """Frequent words that no known stem begins, and that begin none."""
    w = F.col("word")
    out = counts.where(F.col("cnt") >= least)
    for stem in known:
        out = out.where(~(F.startswith(w, F.lit(stem)) | F.startswith(F.lit(stem), w)))
    return out


def is_empty(c: str, kind: str) -> Column:
    """Whether a value is missing: null, and for texts and lists also empty; a number is never empty for being 0."""
    missing = F.col(c).isNull()
    if kind == "string":
        return missing | (F.col(c) == "")
    return missing | (F.size(c) == 0) if kind.startswith(("array", "map")) else missing


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Empty values by column, in one pass: (column, empty, total)."""
    kinds = dict(df.dtypes)
    counts = df.agg(F.count("*").alias("total"), *[F.count_if(is_empty(c, kinds[c])).alias(c) for c in columns])
    return counts.unpivot(["total"], list(columns), "column_name", "empty").select("column_name", "empty", "total")


def gap_examples(df: DataFrame, columns: Sequence[str], name: str, n: int = 3) -> DataFrame:
    """The first n names with a gap in each column: (column_name, place, name)."""
    kinds = dict(df.dtypes)
    gaps = F.array_compact(F.array(*[F.when(is_empty(c, kinds[c]), F.lit(c)) for c in columns]))
    rows = df.select(F.col(name).alias("name"), F.explode(gaps).alias("column_name"))
    return first_n(rows, ["column_name"], ["name"], n).select("column_name", "place", "name")


def with_gaps(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """How many distinct names have a gap in any column."""
    kinds = dict(df.dtypes)
    gap = F.exists(F.array(*[is_empty(c, kinds[c]) for c in columns]), lambda x: x)
    return df.agg(F.countDistinct(F.when(gap, F.col(name))).alias("with_gaps"))


def fill_only_null(df: DataFrame, given: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``df`` with the values of ``given`` (a row per key) where it has none; what it has stays."""
    new = given.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = df.join(new, df[key] == F.col("_key"), "left")
    return joined.select(*[F.coalesce(c, f"_new_{c}").alias(c) if c in columns else F.col(c) for c in df.columns])


def outcomes(df: DataFrame, status: Column) -> DataFrame:
    """Rows by what became of them: (status, n)."""
    return df.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


def containing(titles: DataFrame, words: DataFrame, n: int = 3) -> DataFrame:
    """The first n titles (id, title) that contain each of a few words: (word, place, id)."""
    found = titles.join(F.broadcast(words.select("word")), F.contains(F.lower("title"), F.col("word")))
    return first_n(found, ["word"], ["id"], n).select("word", "place", "id")


def trigger_report(proposed: DataFrame, rejected: DataFrame, most: int = 20) -> DataFrame:
    """Lines of the report on new vocabulary: all proposals, then the ``most`` commonest
    words of rejected titles, each by falling count and first appearance: (part, place, line).
    A report, so the words' counts are ranked in one task."""
    by = Window.orderBy(F.desc("cnt"), "first")
    lines = []
    for part, words, cap in ((0, proposed, None), (1, rejected, most)):
        ranked = words.withColumn("place", F.row_number().over(by))
        ranked = ranked if cap is None else ranked.where(F.col("place") <= cap)
        lines.append(ranked.select(F.lit(part).alias("part"), "place", F.format_string("%3d×  %s", "cnt", "word").alias("line")))
    return lines[0].unionAll(lines[1])


def routed(df: DataFrame, title: Column) -> DataFrame:
    """Every record with its class and where it goes: results if positive, review otherwise."""
    cls = T.classify(title)
    return df.withColumn("cls", cls).withColumn("route", F.when(F.col("cls") == "positive", "results").otherwise("review"))


def curated(df: DataFrame, target: Sequence[str], regions: Sequence[tuple[str, str]]) -> DataFrame:
    """Export rows from (seq, title, territory, url, description, year_from, year_to).

    Titles are repaired, then rows outside the target stems go, then the first
    row of each url stays (a row that goes reserves no url), then the derived
    columns are added.
    """
    fixed = df.withColumn("title", T.fix_title(F.col("title"))).where(T.any_stem(F.col("title"), target))
    first = keep_first(fixed, ["url"], ["seq"])
    low, high = F.nullif("year_from", F.lit(0)), F.nullif("year_to", F.lit(0))
    return first.select(
        "url",
        "title",
        F.nullif(F.substring(T.text(F.col("description")), 1, 2000), F.lit("")).alias("description"),
        T.admin_level(F.col("title")).alias("level"),
        T.language(F.col("title")).alias("language"),
        F.nullif(T.modern_regions(F.col("title"), F.col("territory"), regions), F.lit("")).alias("regions"),
        F.when(T.slippage(F.col("title")), "да").alias("doubtful"),
        low.alias("year_from"),
        F.coalesce(high, low).alias("year_to"),
    )


def sparse_json(df: DataFrame) -> DataFrame:
    """One JSON object per row; empty properties are absent."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("page"))
