"""Records in other formats, and the files of a run."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import fields as D, text as T

CANONICAL = (
    "title string, author string, year_from int, year_to int, place string, scale int, description string, url string, "
    "library_id string, library_name string, category string, extra map<string,string>, seq long"
)
RESULT = "source_id string, territory string, keyword string, title string, year_from string, year_to string, url string, description string"


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """Result or review rows; a byte order mark is dropped, blank years are null."""
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8")
    return rows.withColumns({c: F.expr(f"try_cast(nullif(trim(`{c}`), '') AS int)") for c in ("year_from", "year_to") if c in rows.columns})


def guess_columns(columns: list[str]) -> tuple[str | None, str | None]:
    """Title and comment column of a table by what their headers contain."""
    title = next((c for c in columns if any(s in c.lower() for s in ("назван", "наим"))), None)
    return title, next((c for c in columns if any(s in c.lower() for s in ("коммент", "примеч", "описан"))), None)


def write_routed(df: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """results and review as CSV; review has two empty columns for decisions."""
    cut = df.withColumn("description", F.substring(T.text(F.col("description")), 1, 200))
    cut.where("route = 'results'").drop("route", "cls").write.mode(mode).csv(f"{folder}/results", header=True)
    review = cut.where("route <> 'results'").drop("route", "cls")
    review.withColumns({"decision": F.lit(""), "comment": F.lit("")}).write.mode(mode).csv(f"{folder}/review", header=True)


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """Keys done by earlier runs, from ``{"done": [...], "updated": ...}`` or lines
    ``{"combo": ..., "updated": ...}``; without a file, none."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "combo string")
    rows = spark.read.schema("done array<string>, combo string").json(path, multiLine=not _is_folder(spark, path))
    return rows.select(F.explode(F.coalesce("done", F.array("combo"))).alias("combo")).distinct()


def write_checkpoint(done: DataFrame, path: str, updated: str) -> None:
    """Keys done so far, a line each, so that no task holds them all; the reader takes these too."""
    done.select(F.col("combo")).distinct().withColumn("updated", F.lit(updated)).write.mode("overwrite").json(path)


def read_seen(spark: SparkSession, path: str) -> DataFrame:
    """URLs that a review has been through, from ``{"seen": [...]}`` or lines ``{"url": ...}``."""
    rows = spark.read.schema("seen array<string>, url string").json(path, multiLine=not _is_folder(spark, path))
    return rows.select(F.explode(F.coalesce("seen", F.array("url"))).alias("url")).distinct()


def write_seen(seen: DataFrame, path: str) -> None:
    """The review's progress, rewritten whole."""
    seen.select(T.text(F.col("url")).alias("url")).distinct().write.mode("overwrite").json(path)


def append_confirmed(rows: DataFrame, folder: str) -> None:
    """Confirmed review rows go to the end of the results; the decision columns stay behind."""
    rows.drop("decision", "comment").write.mode("append").csv(f"{folder}/results", header=True)


def run_mode(spark: SparkSession, folder: str, done: DataFrame) -> str:
    """``append`` if the run has results and a checkpoint with keys, else ``overwrite``."""
    return "append" if _exists(spark, f"{folder}/results") and not done.isEmpty() else "overwrite"


def write_fixed(rows: DataFrame, path: str, title: str = "title") -> None:
    """The rows with repaired titles, as ``<path>_fixed``; columns stay as they are."""
    rows.withColumn(title, T.fix_title(F.col(title))).write.mode("overwrite").csv(f"{path}_fixed", header=True)


def write_lines(report: DataFrame, path: str, *order: str) -> None:
    """A report's lines as text, in order."""
    report.orderBy(*order).select("line").coalesce(1).write.mode("overwrite").text(path)


def read_tables(spark: SparkSession, path: str) -> DataFrame:
    """Rows of captured answers of a table service, all pages: ``{"results": [...], "has_more": ..., "next_cursor": ...}``."""
    schema = "results array<map<string,string>>, has_more boolean, next_cursor string"
    return spark.read.schema(schema).json(path, multiLine=True).select(F.explode("results").alias("row"))


def table_status(tables: dict[str, DataFrame | None]) -> dict[str, str]:
    """Whether each table can be read and has rows: ``rows``, ``empty`` or ``missing``."""
    return {name: "missing" if df is None else "empty" if df.isEmpty() else "rows" for name, df in tables.items()}


def columns_of(df: DataFrame) -> list[tuple[str, str]]:
    """Names and types of a table's columns."""
    return df.dtypes


def secret(name: str, files: tuple[str, ...] = ()) -> str:
    """A secret from the environment or from the first ``.env`` file that names it; never from code."""
    if value := os.environ.get(name, ""):
        return value
    for file in files:
        if os.path.exists(file):
            with open(file, encoding="utf-8") as lines:
                for line in lines:
                    key, _, value = line.partition("=")
                    if key.strip() == name and value.strip():
                        return value.split()[0]
    raise RuntimeError(f"{name} is not set")


def reachable(status: Column) -> Column:
    """Whether a probe's HTTP status means that the site answers."""
    return F.coalesce(status < 400, F.lit(False))


def replace(spark: SparkSession, new: str, old: str) -> None:
    """Put the files of ``new`` in the place of those of ``old``."""
    source, fs = _path(spark, new)
    target, _ = _path(spark, old)
    fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"cannot rename {new}")


def _path(spark: SparkSession, path: str):
    made = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return made, made.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    made, fs = _path(spark, path)
    return fs.exists(made)


def _is_folder(spark: SparkSession, path: str) -> bool:
    made, fs = _path(spark, path)
    return fs.exists(made) and fs.getFileStatus(made).isDirectory()


def latest_run(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest run below ``root``; runs are named by date."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    return max((n for n in names if n.startswith("20")), default=None)


def marc_field(xml: Column, tag: str, code: str) -> Column:
    """First subfield of a MARC record; empty if there is none. Broken XML is read as far as its fields go."""
    fields = F.regexp_extract_all(T.text(xml), F.lit(rf"""(?s)<(?:\w+:)?datafield\b[^>]*\btag=["']{tag}["'][^>]*>(.*?)</(?:\w+:)?datafield>"""), F.lit(1))
    value = F.regexp_extract(F.array_join(fields, "\n"), rf"""(?s)<(?:\w+:)?subfield\b[^>]*\bcode=["']{code}["'][^>]*>(.*?)</""", 1)
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        value = F.replace(value, F.lit(name), F.lit(sign))
    return T.strip(value)


# Tags and subfields of a record's fields, in order of preference.
MARC = {
    "title": ("245a", "200a"), "author": ("245c", "100a", "700a"), "place": ("260a", "210a"), "date": ("534b", "260c", "210d"),
    "language": ("041a", "101a"), "scale": ("034b", "255a", "206a"), "size": ("300c",), "series": ("490a",), "description": ("520a",),
}


def marc_record(xml: Column) -> Column:
    """Title, author, place, date, language, scale, size, series and description of a MARC record.

    Brackets around a title, author or place go; a record without a language is Russian.
    """
    found = {n: T.first_text(*[marc_field(xml, t[:3], t[3:]) for t in tags]) for n, tags in MARC.items()}
    first, last = T.years_any4(found["date"])
    return F.struct(
        *[D.without_brackets(found[n]).alias(n) for n in ("title", "author", "place")],
        first.alias("year_from"),
        last.alias("year_to"),
        T.language_name(T.first_text(found["language"], F.lit("rus"))).alias("language"),
        T.scale(found["scale"]).alias("scale"),
        *[found[n].alias(n) for n in ("date", "size", "series", "description")],
    )


def canonical(df: DataFrame, library: str, **columns: Column) -> DataFrame:
    """Source-specific rows as canonical records; what is not given is null."""
    given = columns | {"library_id": F.lit(library)}
    schema = df.sparkSession.createDataFrame([], CANONICAL).schema
    return df.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
