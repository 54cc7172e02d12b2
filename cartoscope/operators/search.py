"""Planning and resuming searches: combinations, checkpoints, cut-offs, health."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import vocabulary as V


def inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A dimension of a few rows, in one partition: products with it add no tasks."""
    return spark.createDataFrame(rows, schema).coalesce(1)


def territories(spark: SparkSession) -> DataFrame:
    """Province by province: its two names, then its districts."""
    rows = [(g, t, kind) for g in V.PROVINCES for kind, table in (("province", V.PROVINCES), ("district", V.DISTRICTS)) for t in table[g]]
    return inline(spark, [(*r, i) for i, r in enumerate(rows)], "province string, territory string, kind string, territory_ord int")


def keywords(spark: SparkSession) -> DataFrame:
    return inline(spark, [(k, i) for i, k in enumerate(V.KEYWORDS)], "keyword string, keyword_ord int")


def sources(spark: SparkSession) -> DataFrame:
    return inline(spark, [(s, m, i) for i, (s, m) in enumerate(V.SOURCES)], "source string, mode string, source_ord int")


def combinations(sources: DataFrame, territories: DataFrame, keywords: DataFrame) -> DataFrame:
    """Every territory and keyword for each query source; one walk for each walk source.

    The three inputs are dimensions; the product is what the search consists of.
    """
    query = sources.where("mode = 'query'").crossJoin(territories.select("territory", "territory_ord")).crossJoin(keywords)
    key = F.concat_ws("|", "territory", "keyword", "source")
    asked = query.select("source", "source_ord", "territory", "territory_ord", "keyword", "keyword_ord", key.alias("combo"), F.concat_ws(" ", "keyword", "territory").alias("query"))
    none = [F.lit(None).cast(t).alias(n) for n, t in (("territory", "string"), ("territory_ord", "int"), ("keyword", "string"), ("keyword_ord", "int"))]
    walk = sources.where("mode = 'walk'").select("source", "source_ord", *none, F.concat(F.lit("__walk__|"), F.col("source")).alias("combo"), F.lit("").alias("query"))
    return asked.unionByName(walk)


def pending(combos: DataFrame, done: DataFrame) -> DataFrame:
    return combos.join(done.select("combo").distinct(), "combo", "left_anti")


def progress(combos: DataFrame, done: DataFrame) -> DataFrame:
    """Done, total and whole percent by source."""
    marked = combos.join(done.select("combo", F.lit(1).alias("hit")).distinct(), "combo", "left")
    counts = marked.groupBy("source").agg(F.count("*").alias("total"), F.count("hit").alias("done"))
    pct = F.floor(F.col("done") / F.col("total") * 100).cast("int")
    status = F.when(F.col("done") == F.col("total"), "complete").when(F.col("done") == 0, "waiting").otherwise("partial")
    return counts.withColumns({"pct": pct, "status": status})


def streak_cutoff(
    log: DataFrame, by: Sequence[str], order: Sequence[str], outcome: Column, counted: str, resets: Column, limit: int, chunk: Column | None = None
) -> DataFrame:
    """Where each group first has ``limit`` of ``counted`` in a row.

    ``resets`` rows start a new island; anything else neither counts nor
    resets. Groups that never get there are absent. ``chunk`` (rising with the
    order, such as a day or a range of numbers) lets tasks share a long group:
    rows are counted within their chunk, and only what each chunk carries over
    to the next is summed along the group.
    """
    own = log.withColumns({"_outcome": outcome, "_chunk": F.lit(0) if chunk is None else chunk})
    part = [*by, "_chunk"]
    up = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    island = own.withColumn("_island", F.sum(F.when(resets, 1).otherwise(0)).over(up))
    inside = Window.partitionBy(*part, "_island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    run = island.withColumn("_run", F.sum(F.when(F.col("_outcome") == counted, 1).otherwise(0)).over(inside))
    if chunk is not None:
        ends = run.groupBy(*part).agg(F.max("_island").alias("_islands"), F.max_by("_run", F.struct("_island", "_run")).alias("_left"))
        along = Window.partitionBy(*by).orderBy("_chunk")
        upto = along.rowsBetween(Window.unboundedPreceding, 0)
        ends = ends.withColumn("_since", F.sum(F.when(F.col("_islands") > 0, 1).otherwise(0)).over(upto))
        ends = ends.withColumn("_after", F.sum("_left").over(Window.partitionBy(*by, "_since").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, 0)))
        carried = ends.select(*[F.col(p).alias(f"_of_{p}") for p in part], F.coalesce(F.lag("_after").over(along), F.lit(0)).alias("_carried"))
        same = [F.col(p).eqNullSafe(F.col(f"_of_{p}")) for p in part]
        run = run.join(carried, same).withColumn("_run", F.col("_run") + F.when(F.col("_island") == 0, F.col("_carried")).otherwise(0))
    hit = run.where((F.col("_run") >= limit) & (F.col("_outcome") == counted))
    return hit.groupBy(*by).agg(F.min(F.struct(*order)).alias("_at")).select(*by, *[F.col(f"_at.{o}").alias(f"cut_{o}") for o in order])


def capped(pending: DataFrame, order: Sequence[str], most: int) -> DataFrame:
    """The first ``most`` pending rows in order: the feature of a bounded run."""
    return pending.orderBy(*order).limit(most)


def health(events: DataFrame, library: str, seq: Column, state: Column, problem: Column) -> DataFrame:
    """Worst state of each library: ok < partial < down. The first problem of a
    down library stays, the last of a partial one; cut to 1800 characters."""
    rank = F.when(state == "down", 2).when(state == "partial", 1).otherwise(0)
    pick = F.max_by(F.struct(state.alias("status"), F.substring(problem, 1, 1800).alias("problem")), F.struct(rank, F.when(rank == 2, -seq).otherwise(seq)))
    best = events.groupBy(library).agg(pick.alias("s"))
    return best.select(library, "s.status", F.when(F.col("s.status") == "ok", "").otherwise(F.col("s.problem")).alias("problem"))


def numbered(plan: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Each row of a plan (a dimension, not data) with its place n of total, rows to skip included."""
    total = plan.agg(F.count("*").alias("total"))
    return plan.withColumn("n", F.row_number().over(Window.orderBy(*order))).crossJoin(F.broadcast(total))


def check_summary(counts: DataFrame, n: str = "n") -> DataFrame:
    """What a test search of each source says: records found, none, skipped (-1) or failed (-2)."""
    status = F.when(F.col(n) == -1, "skipped").when(F.col(n) == -2, "error").when(F.col(n) == 0, "empty").otherwise("ok")
    return counts.withColumn("status", status)


def sampled(records: DataFrame, source: str, order: Sequence[str | Column], n: int = 5) -> DataFrame:
    """The first n records of each source: the feature of a test search."""
    place = F.row_number().over(Window.partitionBy(source).orderBy(*order))
    return records.withColumn("place", place).where(F.col("place") <= n)


def within_pages(pages: DataFrame, most: int, page: str = "page_no", server_most: str | None = None, limit: int = 100) -> DataFrame:
    """Pages 1 to ``most``; where the server names its own last page, no further than that or ``limit``."""
    last = F.lit(most)
    if server_most:
        last = F.least(last, F.coalesce(F.col(server_most), F.lit(limit)), F.lit(limit))
    return pages.where(F.col(page) <= last)


def vocabulary(*lists: DataFrame) -> DataFrame:
    """All words of several one-column lists, once each."""
    first, *rest = lists
    for words in rest:
        first = first.unionAll(words)
    return first.distinct()


def provinces_named(spark: SparkSession, names: DataFrame, name: str = "name") -> DataFrame:
    """``names`` with the first province that each freely written name means (null: none).

    Endings in а, я, о or й go, and either name may contain the other.
    """
    written = F.regexp_replace(F.trim(F.lower(F.col(name))), "[аяой]+$", "")
    known = F.array(*map(F.lit, V.PROVINCES))
    fits = F.filter(known, lambda k: F.contains(k, written) | F.contains(written, k))
    return names.withColumn("province", F.get(fits, F.lit(0)))


def workarounds(spark: SparkSession) -> DataFrame:
    """What to try for each kind of fault."""
    return inline(spark, [(k, t) for k, t in V.WORKAROUNDS.items()], "fault string, advice string")
