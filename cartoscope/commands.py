"""Commands over captured pages and the files of a run: ``python -m cartoscope <command> --help``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import vocabulary as V
from .functions import fields as D, text as T
from .operators import curation as C, search as S
from .sources import libraries as L, records

#: Search words and years of a source's test.
TEST = ("карта Калужской губернии", 1700, 1920)


def pages_at(spark: SparkSession, path: str) -> DataFrame:
    """Captured pages; Parquet is read as such, with filters and columns pushed down."""
    return spark.read.parquet(path)


def plan(spark: SparkSession, names: Sequence[str] = (), done: DataFrame | None = None, most: int = 0) -> DataFrame:
    """The combinations that a run would do, in order: source by source, territory by territory.

    An unknown source is a ValueError before anything runs.
    """
    known = {s for s, _ in (*V.SOURCES, *V.OTHER_SOURCES)}
    if unknown := sorted(set(names) - known):
        raise ValueError(f"unknown sources: {', '.join(unknown)}; known: {', '.join(sorted(known))}")
    chosen = S.sources(spark)
    if names:
        rows = [r for r in (*V.SOURCES, *V.OTHER_SOURCES) if r[0] in names]
        chosen = S.inline(spark, [(s, m, i) for i, (s, m) in enumerate(rows)], "source string, mode string, source_ord int")
    combos = S.combinations(chosen, S.territories(spark), S.keywords(spark))
    left = combos if done is None else S.pending(combos, done)
    order = ["source_ord", "territory_ord", "keyword_ord"]
    return S.capped(left, order, most) if most else left.orderBy(*order)


def run(spark: SparkSession, pages: DataFrame, folder: str, names: Sequence[str] = (), resume: bool = False, most: int = 0, max_pages: int = 5, updated: str = "") -> DataFrame:
    """Search all pending combinations, write results, review and checkpoint, and return the totals by source.

    A source's pages are parsed once; the combinations of its territories and
    keywords then are one join on the words that the record must contain.
    """
    done = records.read_checkpoint(spark, f"{folder}/checkpoint") if resume else spark.createDataFrame([], "combo string")
    todo = plan(spark, names, done, most)
    found = None
    for source in [r["source"] for r in todo.select("source").distinct().collect()]:
        rows = L.search(pages, source, max_pages=max_pages)
        combos = todo.where(F.col("source") == source)
        asked = combos.select("source", F.coalesce("territory", F.lit("")).alias("territory"), F.coalesce("keyword", F.lit("")).alias("keyword"))
        fits = (F.col("keyword") == "") | F.contains(F.lower("title"), F.lower("keyword")) & F.contains(F.lower(F.concat_ws(" ", "title", "description")), F.lower("territory"))
        got = rows.join(F.broadcast(asked), fits).select(F.col("source").alias("source_id"), "territory", "keyword", "title", "year_from", "year_to", "url", "description")
        found = got if found is None else found.unionAll(got)
    if found is None:
        return spark.createDataFrame([], "source_id string, found long, positive long")
    routed = C.routed(found, F.col("title"))
    records.write_routed(routed, folder, records.run_mode(spark, folder, done))
    records.write_checkpoint(done.unionAll(todo.select("combo")), f"{folder}/checkpoint_new", updated)
    records.replace(spark, f"{folder}/checkpoint_new", f"{folder}/checkpoint")
    return routed.groupBy("source_id").agg(F.count("*").alias("found"), F.count_if(F.col("cls") == "positive").alias("positive"))


def check(pages: DataFrame, names: Sequence[str]) -> DataFrame:
    """One test search of each source: how many records, up to five, and what that means."""
    query, first, last = TEST
    counts = None
    for name in names:
        n = L.search(pages, name, query, first, last).limit(5).agg(F.lit(name).alias("source"), F.count("*").alias("n"))
        counts = n if counts is None else counts.unionAll(n)
    return S.check_summary(counts).withColumn("verdict", D.verdict(F.col("n")))


def words(rows: DataFrame, most: int = 40) -> DataFrame:
    """The commonest words of titles, those that are known to mark maps pointed out."""
    counts = C.token_counts(rows, F.col("title"), F.monotonically_increasing_id(), 3)
    return counts.orderBy(F.desc("cnt"), "first").limit(most).select("cnt", "word", D.marked(F.col("word")).alias("mark"))


def territories(spark: SparkSession, names: str, detail: int = 1) -> DataFrame:
    """Search territories of provinces named freely, with commas between; all four if none
    is known. detail: 1 the provinces, 2 their districts too, 3 the names as they are."""
    given = [n.strip() for n in names.replace(";", ",").split(",") if n.strip()]
    asked = S.inline(spark, [(n, i) for i, n in enumerate(given)], "name string, place int")
    if detail == 3:
        return asked.select(F.col("name").alias("territory"))
    meant = S.provinces_named(spark, asked).where("province is not null").select("province").distinct()
    every = S.territories(spark).where("kind = 'province'" if detail == 1 else "true")
    own = every.join(meant, "province", "left_semi")
    return (every if meant.isEmpty() else own).orderBy("territory_ord").select("territory")


def period(spark: SparkSession, written: str) -> tuple[int, int]:
    low, high = T.period(F.lit(written))
    return tuple(spark.range(1).select(low, high).collect()[0])


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="cartoscope", description=__doc__)
    commands = out.add_subparsers(dest="command", required=True)

    def add(name: str, *paths: str) -> argparse.ArgumentParser:
        made = commands.add_parser(name)
        for p in paths:
            made.add_argument(p)
        return made

    made = add("run", "pages", "folder")
    made.add_argument("--source", action="append", default=[])
    made.add_argument("--dry-run", action="store_true")
    made.add_argument("--resume", action="store_true")
    made.add_argument("--max-pages", type=int, default=5)
    made.add_argument("--max-combos", type=int, default=0)
    made = add("search", "pages", "query")
    made.add_argument("--source", action="append", default=[])
    made.add_argument("--year-from", type=int)
    made.add_argument("--year-to", type=int)
    made.add_argument("--territory", default="")
    made.add_argument("--max-pages", type=int, default=3)
    add("check", "pages").add_argument("source", nargs="+")
    add("fix-titles", "rows")
    add("words", "rows")
    add("review", "folder")
    made = add("ask", "provinces", "years")
    made.add_argument("--detail", type=int, choices=(1, 2, 3), default=1)
    return out


def main(spark: SparkSession, arguments: Sequence[str]) -> DataFrame:
    """Run one command and return what it has to show."""
    a = parser().parse_args(arguments)
    if a.command == "run":
        if a.dry_run:
            return plan(spark, a.source, records.read_checkpoint(spark, f"{a.folder}/checkpoint") if a.resume else None, a.max_combos)
        return run(spark, pages_at(spark, a.pages), a.folder, a.source, a.resume, a.max_combos, a.max_pages)
    if a.command == "search":
        found = L.registry(pages_at(spark, a.pages))
        names = a.source or [s for s, _ in V.SOURCES]
        return found.search_all(spark, names, a.query, year_from=a.year_from, year_to=a.year_to, max_pages=a.max_pages, territory=a.territory)
    if a.command == "check":
        return check(pages_at(spark, a.pages), [s for s, _ in V.SOURCES] if a.source == ["all"] else a.source)
    if a.command == "fix-titles":
        rows = records.read_rows(spark, a.rows)
        records.write_fixed(rows, a.rows)
        fixed = T.fix_title(F.col("title"))
        return rows.agg(F.count("*").alias("rows"), F.count_if(fixed != F.col("title")).alias("fixed"))
    if a.command == "words":
        return words(records.read_rows(spark, a.rows))
    if a.command == "review":
        seen = f"{a.folder}/review_progress"
        rows = records.read_rows(spark, f"{a.folder}/review")
        return C.unseen(rows, records.read_seen(spark, seen)) if records._exists(spark, seen) else rows
    low, high = period(spark, a.years)
    return territories(spark, a.provinces, a.detail).withColumns({"year_from": F.lit(low), "year_to": F.lit(high)})
