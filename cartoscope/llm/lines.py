"""Line dedup over levelled sorted runs of line hashes.

A run is a bucketed table of line hashes, sorted, with the number of documents
that hold the line. A batch of documents first merge-anti-joins the runs'
settled lines (already frequent enough), then adds the counts of its other
lines as a run of level 0. Two runs of one level are compacted into one of the
next, so each count is rewritten a logarithmic number of times. Runs share one
bucketing, so merges and anti-joins need no exchange of what is stored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .storage import fresh_path

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_lines(text: Column) -> Column:
    """Lines between line feeds; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(text: Column) -> Column:
    """128-bit hashes of the lines' keys, null where a key is empty."""
    lines = split_lines(F.translate(text, UPPER, LOWER))
    key = F.transform(lines, lambda x: F.btrim(x, F.lit(BLANKS)))
    return F.transform(key, lambda x: F.when(x != "", F.struct(F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(1), x).alias("h2"))))


class LineRuns:
    """Line counts of all batches added so far.

    ``min_docs`` documents make a line settled. Tables go to the session's
    warehouse catalogue with files in the shared folder; ``drop`` takes them out
    of the catalogue and leaves the files, which ``settled`` reads.
    """

    def __init__(self, spark: SparkSession, min_docs: int = 10):
        self.spark, self.min_docs = spark, min_docs
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: dict[int, DataFrame] = {}
        self.names: list[str] = []
        self.last = ""

    def _run(self, counts: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = counts.select("h1", "h2", "n").write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
        self.last = fresh_path(self.spark, "line-run")
        writer.option("path", self.last).saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def add(self, docs: DataFrame) -> None:
        """Count the lines of a batch (column text); each row is a document."""
        found = F.explode(F.array_distinct(F.filter(line_keys(F.col("text")), lambda x: x.isNotNull())))
        counts = docs.select(found.alias("k")).select("k.h1", "k.h2").groupBy("h1", "h2").agg(F.count("*").alias("n"))
        for run in self.levels.values():
            counts = counts.join(run.where(F.col("n") >= self.min_docs), ["h1", "h2"], "left_anti")
        run, level = self._run(counts), 0
        while level in self.levels:
            run, level = self._merge(self.levels.pop(level), run), level + 1
        self.levels[level] = run

    def _merge(self, a: DataFrame, b: DataFrame) -> DataFrame:
        a, b = a.alias("a"), b.alias("b")
        total = F.coalesce(F.col("a.n"), F.lit(0)) + F.coalesce(F.col("b.n"), F.lit(0))
        key = [F.coalesce(F.col(f"a.{h}"), F.col(f"b.{h}")).alias(h) for h in ("h1", "h2")]
        same = (F.col("a.h1") == F.col("b.h1")) & (F.col("a.h2") == F.col("b.h2"))
        return self._run(a.join(b, same, "full").select(*key, total.alias("n")))

    def compact(self) -> DataFrame:
        """All runs as one."""
        while len(self.levels) > 1:
            low, high = sorted(self.levels)[:2]
            self.levels[high] = self._merge(self.levels.pop(low), self.levels.pop(high))
        return next(iter(self.levels.values()))

    def settled(self) -> DataFrame:
        """Hashes of the lines found in at least ``min_docs`` documents.

        Read as plain files, not as a bucketed table: a probe then exchanges
        both sides, and AQE can split a line that very many documents hold.
        """
        schema = self.compact().schema
        return self.spark.read.schema(schema).parquet(self.last).where(F.col("n") >= self.min_docs).select("h1", "h2")

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names, self.levels = [], {}


def batches(docs: DataFrame, count: int) -> list[DataFrame]:
    """Equal doc_id ranges, which Parquet statistics prune; null ids join the first."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).collect()[0]
    if low is None or high - low < count:
        return [docs]
    cuts = [low + (high - low + 1) * i // count for i in range(1, count)]
    edges = [None, *cuts, None]
    out = []
    for a, b in zip(edges, edges[1:], strict=False):
        place = F.lit(True) if a is None else F.col("doc_id") >= a
        if b is not None:
            place = place & (F.col("doc_id") < b)
        out.append(docs.where(place | F.col("doc_id").isNull() if a is None else place))
    return out


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, count: int = 4) -> DataFrame:
    """``docs`` with kept (the text without frequent lines), n_lines and n_dropped.

    A line's key is the line without blanks at either end, A-Z in lower case.
    Keys of one character or more found in at least ``min_docs`` documents lose
    all their lines. Null and empty texts are one empty line and stay so; a
    repeated row is a document of its own. The input's columns stay, whatever
    their names, except kept, n_lines and n_dropped, which are replaced.
    """
    docs = docs.drop("kept", "n_lines", "n_dropped")
    runs = LineRuns(docs.sparkSession, min_docs)
    try:
        for batch in batches(docs.select("doc_id", "text"), count):
            runs.add(batch)
        settled = runs.settled()
    finally:
        runs.drop()
    return without(docs, settled)


def without(docs: DataFrame, settled: DataFrame) -> DataFrame:
    """Drop the lines in ``settled``. Only hashes travel to the join with it;
    each text travels once, to meet the positions of its dropped lines."""
    text = F.col("text")
    mark = F.struct(F.col("doc_id"), F.xxhash64("text").alias("text")).alias("mark")
    spots = docs.select(mark, F.posexplode(line_keys(text)).alias("at", "k"))
    hits = spots.select("mark", "at", "k.h1", "k.h2").join(settled, ["h1", "h2"], "left_semi")
    found = hits.groupBy(F.col("mark").alias("of")).agg(F.collect_set("at").alias("spots"))
    joined = docs.select(F.struct("*").alias("own"), mark).join(found, F.col("mark") == F.col("of"), "left")
    text, drop = F.col("own.text"), F.col("spots")
    lines = split_lines(text)
    every = F.sequence(F.lit(0), F.size(lines) - 1)
    stay = F.array_except(every, F.coalesce(drop, F.expr("cast(array() as array<int>)")))
    kept = F.when(drop.isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
    told = joined.select("own", kept.alias("kept"), F.size(lines).cast("long").alias("n_lines"), F.coalesce(F.size(drop), F.lit(0)).cast("long").alias("n_dropped"))
    return told.select("own.*", "kept", "n_lines", "n_dropped")
