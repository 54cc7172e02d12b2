"""Named queries over the test tables, each beside the SQL that gives the same rows.

``titles`` is every whole document text plus a few titles in Russian.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import vocabulary as V
from ..functions import text as T
from ..operators import curation as C, search as S
from ..sources import html as H, libraries as L
from . import fixtures as X

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Stems that stand in for the Russian vocabulary in the invented prose of the tables.
LATIN_POSITIVE = ("tionan", "ungsch", "mentes", "elleau")
LATIN_DOUBTFUL = ("thand", "keit", "ción", "éanier")


def query(sql: str):
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("t"))
    return docs.unionAll(X.spark_table(spark, X.TITLES).select(-F.col("id"), "t"))


TITLES = f"(SELECT doc_id AS id, text AS t FROM documents UNION ALL SELECT -id, t FROM {X.sql_table(X.TITLES)})"


def sql_any(column: str, stems) -> str:
    return "(" + " OR ".join(f"contains(lower({column}), {X.literal(s)})" for s in stems) + ")"


def sql_list(words) -> str:
    return "[" + ", ".join(map(X.literal, words)) + "]"


def sql_years(pattern: str = T.YEAR) -> str:
    return rf"list_transform(list_filter(string_split_regex(t, '[^\p{{L}}\p{{N}}_]+'), lambda w: regexp_full_match(w, '{pattern}')), lambda w: w::INTEGER)"


def of_titles(name: str, sql: str, **columns: Callable[[Column], Column]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return titles(spark, sf_dir).select("id", *[c(F.col("t")).alias(k) for k, c in columns.items()])

    QUERIES[name], ORACLES[name] = run, f"SELECT id, {sql} FROM {TITLES}"


def of_values(name: str, rows: dict[int, str], sql: str, **columns: Callable[[Column], Column]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return X.spark_table(spark, rows).select("id", *[c(F.col("t")).alias(k) for k, c in columns.items()])

    QUERIES[name], ORACLES[name] = run, f"SELECT id, {sql} FROM {X.sql_table(rows)}"


def of_mixed(name: str, rows: dict[int, str], sql: str, **columns: Callable[[Column], Column]) -> None:
    """A function over every whole document and a few authored texts."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("t"))
        every = docs.unionAll(X.spark_table(spark, rows).select(-F.col("id"), "t"))
        return every.select("id", *[c(F.col("t")).alias(k) for k, c in columns.items()])

    QUERIES[name] = run
    ORACLES[name] = f"SELECT id, {sql} FROM (SELECT doc_id AS id, text AS t FROM documents UNION ALL SELECT -id, t FROM {X.sql_table(rows)})"


POSITIVE, DOUBTFUL = (*V.POSITIVE, *LATIN_POSITIVE), (*V.DOUBTFUL, *LATIN_DOUBTFUL)
SQL_CLASS = f"CASE WHEN {sql_any('t', POSITIVE)} THEN 'positive' WHEN {sql_any('t', DOUBTFUL)} THEN 'doubtful' ELSE 'negative' END"

# Predicates and scalar functions
of_titles("classify_titles", f"{SQL_CLASS} AS cls", cls=lambda t: T.classify(t, POSITIVE, DOUBTFUL))
of_titles("cart_filter", f"{sql_any('t', POSITIVE)} AS keep", keep=lambda t: T.any_stem(t, POSITIVE))
of_titles("doubtful_filter", f"{sql_any('t', DOUBTFUL)} AS doubtful", doubtful=lambda t: T.any_stem(t, DOUBTFUL))
of_titles("collection_filter", f"{sql_any('t', V.COLLECTION)} AS keep", keep=lambda t: T.any_stem(t, V.COLLECTION))
of_titles("category_gate", f"contains(lower(t), {X.literal(V.CATEGORY)}) AS keep", keep=lambda t: F.lower(t).contains(V.CATEGORY))
of_titles("territory_stems", f"{sql_any('t', [s.lower() for s in V.TERRITORY_STEMS])} AS keep", keep=lambda t: T.any_stem(t, [s.lower() for s in V.TERRITORY_STEMS]))
of_titles(
    "geo_map_filter",
    f"({sql_any('t', ('перм', *V.GEO_WORDS))} AND NOT {sql_any('t', V.NOT_MAPS)}) AS keep",
    keep=lambda t: T.geo_map(t, F.lit(""), ("Перм",)),
)
of_titles("relaxed_filter", f"({sql_any('t', POSITIVE)} OR regexp_matches(t, '[0-9]{{4}}')) AS keep", keep=lambda t: T.any_stem(t, POSITIVE) | t.rlike("[0-9]{4}"))
of_titles("min_title_length", "length(t) >= 5 AS keep", keep=lambda t: F.length(t) >= 5)
of_titles(
    "query_overlap",
    "len(list_filter(['карта', 'пермская', 'tion', 'schein'], lambda w: contains(lower(t), w))) > 0 AS keep",
    keep=lambda t: T.query_overlap(F.lit("карта пермская tion на schein"), t),
)
of_titles("years_minmax", f"list_min({sql_years()}) AS year_from, list_max({sql_years()}) AS year_to", year_from=lambda t: T.years(t)[0], year_to=lambda t: T.years(t)[1])
of_titles(
    "years_narrow", f"list_min({sql_years(T.YEAR_NARROW)}) AS year_from, list_max({sql_years(T.YEAR_NARROW)}) AS year_to",
    year_from=lambda t: T.years(t, T.YEAR_NARROW)[0], year_to=lambda t: T.years(t, T.YEAR_NARROW)[1],
)
of_titles("years_firstlast", f"({sql_years()})[1] AS year_from, ({sql_years()})[-1] AS year_to", year_from=lambda t: T.years_in_order(t)[0], year_to=lambda t: T.years_in_order(t)[1])
of_titles(
    "years_any4",
    "regexp_extract_all(t, '[0-9]{4}')[1]::INTEGER AS year_from, regexp_extract_all(t, '[0-9]{4}')[-1]::INTEGER AS year_to",
    year_from=lambda t: T.years_any4(t)[0], year_to=lambda t: T.years_any4(t)[1],
)
SQL_FIX = "trim(regexp_replace(regexp_replace(t, '([а-яёa-z0-9])([А-ЯЁA-Z])', '\\1 \\2', 'g'), ' {2,}', ' ', 'g'), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
of_titles("fix_title", f"{SQL_FIX} AS title", title=lambda t: T.fix_title(t))
of_titles("slippage", f"regexp_matches(t, '[{T.CYRILLIC}]{{14,}}') AS slip", slip=lambda t: T.slippage(t))
SQL_WORDS = r"string_split_regex(lower(t), '[^\p{L}\p{N}_]+')"
SQL_LANGUAGE = (
    f"CASE WHEN len(regexp_extract_all(t, '[a-zA-Z]')) > len(regexp_extract_all(t, '[{T.CYRILLIC}]')) THEN "
    f"CASE WHEN list_has_any({SQL_WORDS}, {sql_list(V.GERMAN_WORDS)}) THEN 'Немецкий' "
    f"WHEN list_has_any({SQL_WORDS}, {sql_list(V.FRENCH_WORDS)}) THEN 'Французский' ELSE 'Латинский' END ELSE 'Русский' END"
)
of_titles("language", f"{SQL_LANGUAGE} AS language", language=lambda t: T.language(t))
SQL_LEVEL = (
    f"CASE WHEN {sql_any('t', ('губерни', 'наместничеств', 'провинци'))} THEN 'Губерния' "
    f"WHEN {sql_any('t', ('уезда', 'уезде', ' уезд'))} THEN 'Уезд' WHEN {sql_any('t', ('волост',))} THEN 'Волость' END"
)
of_titles("admin_level", f"{SQL_LEVEL} AS level", level=lambda t: T.admin_level(t))
SQL_REGIONS = "concat_ws(', ', " + ", ".join(f"CASE WHEN contains(lower(t), {X.literal(s)}) THEN {X.literal(r)} END" for s, r in V.REGIONS) + ")"
of_titles("modern_regions", f"{SQL_REGIONS} AS regions", regions=lambda t: T.modern_regions(t, F.lit("")))
of_titles("truncations", "left(t, 200) AS short, left(t, 2000) AS long", short=lambda t: F.left(t, F.lit(200)), long=lambda t: F.left(t, F.lit(2000)))

of_mixed("kgr_filter", X.SHELVES, "(t = '' OR regexp_matches(upper(t), '^(KGR|КГР)')) AS keep", keep=lambda t: T.map_shelfmark(t))
of_mixed("rubric_filter", X.TITLES, f"{sql_any('t', V.RUBRICS)} AS keep", keep=lambda t: T.map_rubric(t, F.lit("")))
of_mixed("scale_parse", X.SCALES, "TRY_CAST(regexp_replace(t, '[^0-9]', '', 'g') AS BIGINT) AS scale", scale=lambda t: T.scale(t))
of_mixed(
    "cipher_parse", X.CIPHERS,
    r"""regexp_extract(t, 'Ф[.\s]+([\p{L}\p{N}_.-]+)', 1) AS fund, regexp_extract(t, '[Оо]п[.\s]+([^\s]+)', 1) AS inventory, regexp_extract(t, 'Д[.\s]+([0-9]+[\p{L}\p{N}_]*)', 1) AS "case" """,
    fund=lambda t: T.cipher(t).fund, inventory=lambda t: T.cipher(t).inventory, case=lambda t: T.cipher(t)["case"],
)
of_mixed(
    "cipher_digits", X.CIPHERS,
    r"""regexp_extract(t, 'Ф\.([0-9]+)', 1) AS fund, regexp_extract(t, 'Оп\.([0-9]+)', 1) AS inventory, regexp_extract(t, 'Д\.([0-9]+)', 1) AS "case" """,
    fund=lambda t: T.digit_cipher(t).fund, inventory=lambda t: T.digit_cipher(t).inventory, case=lambda t: T.digit_cipher(t)["case"],
)
of_mixed(
    "lang_code", X.CODES,
    "CASE lower(left(t, 3)) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in V.LANGUAGE_CODES.items()) + f" ELSE '{V.OTHER_LANGUAGE}' END AS language",
    language=lambda t: T.language_name(t),
)
of_mixed("workaround", X.FAULTS, "CASE " + " ".join(f"WHEN contains(lower(t), '{k}') THEN '{k}'" for k in V.FAULTS) + " ELSE 'other' END AS fault", fault=lambda t: T.fault(t))
of_mixed("access_class", X.ACCESSES, "CASE " + " ".join(f"WHEN contains(lower(t), '{k}') THEN '{v}'" for k, v in V.ACCESS) + " ELSE '' END AS access", access=lambda t: T.access_class(t))
of_mixed("document_type", X.TITLES, "CASE " + " ".join(f"WHEN contains(t, '{k}') THEN '{k}'" for k in V.DOCUMENT_TYPES) + " ELSE '' END AS kind", kind=lambda t: T.first_of(t, V.DOCUMENT_TYPES))
_CENTURY = "CASE " + " ".join(f"WHEN contains(upper(t), '{r}') AND regexp_matches(upper(t), '[XVI]\\s*В') THEN {{}}" for r, _ in V.CENTURIES) + " ELSE {} END"
_YS = "list_transform(regexp_extract_all(t, '[0-9]{4}'), lambda w: w::INTEGER)"
_UPTO = "(contains(lower(t), 'до') OR contains(lower(t), 'по'))"
of_mixed(
    "period_parse", X.PERIODS,
    f"CASE WHEN len({_YS}) >= 2 THEN ({_YS})[1] WHEN len({_YS}) = 1 THEN CASE WHEN {_UPTO} THEN 1700 ELSE ({_YS})[1] END "
    f"ELSE {_CENTURY.format(*[y for _, y in V.CENTURIES], 1750)} END AS year_from, "
    f"CASE WHEN len({_YS}) >= 2 THEN ({_YS})[2] WHEN len({_YS}) = 1 THEN CASE WHEN {_UPTO} THEN ({_YS})[1] ELSE ({_YS})[1] + 50 END "
    f"ELSE {_CENTURY.format(*[y + 99 for _, y in V.CENTURIES], 1917)} END AS year_to",
    year_from=lambda t: T.period(t)[0], year_to=lambda t: T.period(t)[1],
)
of_values(
    "url_normalise", X.LINKS,
    "CASE WHEN starts_with(t, 'http') THEN t ELSE 'http://b.org' || t END AS url, regexp_replace(regexp_replace(t, '[#?].*$', ''), '/$', '') AS bare, "
    "(t <> '' AND NOT regexp_matches(t, '^(#|mailto:|javascript:)')) AS real",
    url=lambda t: T.absolute_url(t, "http://b.org"), bare=lambda t: T.normal_url(t), real=lambda t: T.real_href(t),
)
of_values(
    "kv_text_map", X.RECORDS,
    "coalesce(trim(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '^Название:'))[-1][10:]), '') AS title, "
    "coalesce(trim(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '^Автор:'))[-1][7:]), '') AS author, "
    "coalesce(trim(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '^Шифр:'))[-1][6:]), '') AS shelf",
    title=lambda t: F.coalesce(F.element_at(T.pairs(t), "Название"), F.lit("")), author=lambda t: F.coalesce(F.element_at(T.pairs(t), "Автор"), F.lit("")),
    shelf=lambda t: F.coalesce(F.element_at(T.pairs(t), "Шифр"), F.lit("")),
)
of_values(
    "map_filter", X.RECORDS, "len(list_filter(string_split(t, chr(10)), lambda x: contains(x, ':') AND NOT starts_with(x, 'Год') AND NOT (starts_with(x, 'Шифр: 1') AND contains(t, 'Шифр: 2')))) AS n",
    n=lambda t: F.size(F.map_filter(T.pairs(t), lambda k, v: k != "Год")).cast("long"),
)


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders WHERE year(o_orderdate) <= 1996 AND year(o_orderdate) + 1 >= 1994")
def year_overlap(spark, d):
    y = F.year("o_orderdate")
    return table(spark, d, "orders").where(T.year_overlap(y, y + 1, 1994, 1996)).select("o_orderkey", y.alias("y"))


# Planning, resuming, cut-offs
_TERR = "(VALUES " + ", ".join(f"({X.literal(x)}, {i})" for i, x in enumerate(x for g in V.PROVINCES for tab in (V.PROVINCES, V.DISTRICTS) for x in tab[g])) + ") te(territory, territory_ord)"
_KEYS = "(VALUES " + ", ".join(f"({X.literal(k)}, {i})" for i, k in enumerate(V.KEYWORDS)) + ") ke(keyword, keyword_ord)"
_SRC = "(VALUES " + ", ".join(f"('{s}', '{m}', {i})" for i, (s, m) in enumerate(V.SOURCES)) + ") so(source, mode, source_ord)"
_COMBOS = (
    f"(SELECT source, source_ord, territory, territory_ord, keyword, keyword_ord, concat_ws('|', territory, keyword, source) AS combo, keyword || ' ' || territory AS query "
    f"FROM {_SRC}, {_TERR}, {_KEYS} WHERE mode = 'query' UNION ALL "
    f"SELECT source, source_ord, NULL, NULL, NULL, NULL, '__walk__|' || source, '' FROM {_SRC} WHERE mode = 'walk')"
)
_DONE = f"(SELECT combo FROM {_COMBOS} WHERE source_ord < 1 OR source_ord = 1 AND keyword_ord < 2)"


def combos(spark: SparkSession) -> DataFrame:
    return S.combinations(S.sources(spark), S.territories(spark), S.keywords(spark))


def done(spark: SparkSession) -> DataFrame:
    return combos(spark).where("source_ord < 1 or source_ord = 1 and keyword_ord < 2").select("combo")


@query(f"SELECT * FROM {_COMBOS}")
def combo_plan(spark, d):
    return combos(spark)


@query(f"SELECT source, count(*) AS n FROM {_COMBOS} GROUP BY ALL")
def combo_plan_size(spark, d):
    return combos(spark).groupBy("source").agg(F.count("*").alias("n"))


@query(f"SELECT combo, source, source_ord, territory, territory_ord, keyword, keyword_ord, query FROM {_COMBOS} WHERE combo NOT IN (SELECT combo FROM {_DONE})")
def resume_pending(spark, d):
    return S.pending(combos(spark), done(spark))


@query(
    f"SELECT source, count(*) AS total, count(d.combo) AS done, CAST(floor(count(d.combo) * 100 / count(*)) AS INTEGER) AS pct, "
    f"CASE WHEN count(d.combo) = count(*) THEN 'complete' WHEN count(d.combo) = 0 THEN 'waiting' ELSE 'partial' END AS status "
    f"FROM {_COMBOS} c LEFT JOIN {_DONE} d USING (combo) GROUP BY source"
)
def progress_by_source(spark, d):
    return S.progress(combos(spark), done(spark))


@query(f"SELECT combo FROM {_COMBOS} WHERE combo NOT IN (SELECT combo FROM {_DONE}) ORDER BY source_ord, territory_ord NULLS FIRST, keyword_ord NULLS FIRST LIMIT 300")
def max_combos_cap(spark, d):
    return S.capped(S.pending(combos(spark), done(spark)), ["source_ord", "territory_ord", "keyword_ord"], 300).select("combo")


_OUTCOME = "CASE event_type WHEN 'error' THEN 'err' WHEN 'view' THEN 'empty' ELSE 'hit' END"


def event_outcome() -> Column:
    return F.when(F.col("event_type") == "error", "err").when(F.col("event_type") == "view", "empty").otherwise("hit")


def _streak_sql(counted: str, resets: str, limit: int) -> str:
    return (
        f"WITH a AS (SELECT user_id % 50 AS grp, event_id, {_OUTCOME} AS o FROM events), "
        f"b AS (SELECT *, sum(CASE WHEN {resets} THEN 1 ELSE 0 END) OVER (PARTITION BY grp ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS isl FROM a), "
        f"c AS (SELECT *, sum(CASE WHEN o = '{counted}' THEN 1 ELSE 0 END) OVER (PARTITION BY grp, isl ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM b) "
        f"SELECT grp, min(event_id) AS cut_event_id FROM c WHERE run >= {limit} AND o = '{counted}' GROUP BY grp"
    )


def _chunk() -> Column:
    """Parts of a long log: a task counts one at a time."""
    return F.floor(F.col("event_id") / 250_000)


def _grouped(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("grp", F.col("user_id") % 50)


@query(_streak_sql("empty", "o = 'hit'", V.EMPTY_LIMIT))
def empty_streak_cutoff(spark, d):
    return S.streak_cutoff(_grouped(spark, d), ["grp"], ["event_id"], event_outcome(), "empty", F.col("_outcome") == "hit", V.EMPTY_LIMIT, _chunk())


@query(_streak_sql("err", "o <> 'err'", V.ERROR_LIMIT))
def error_streak_cutoff(spark, d):
    return S.streak_cutoff(_grouped(spark, d), ["grp"], ["event_id"], event_outcome(), "err", F.col("_outcome") != "err", V.ERROR_LIMIT, _chunk())


@query(
    "WITH a AS (SELECT user_id, event_id, CASE event_type WHEN 'error' THEN 'down' WHEN 'view' THEN 'partial' ELSE 'ok' END AS st, props FROM events), "
    "b AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE st WHEN 'down' THEN 2 WHEN 'partial' THEN 1 ELSE 0 END DESC, "
    "CASE WHEN st = 'down' THEN event_id ELSE -event_id END) AS rn FROM a) "
    "SELECT user_id, st AS status, CASE WHEN st = 'ok' THEN '' ELSE left(props, 1800) END AS problem FROM b WHERE rn = 1"
)
def health_rollup(spark, d):
    state = F.when(F.col("event_type") == "error", "down").when(F.col("event_type") == "view", "partial").otherwise("ok")
    return S.health(table(spark, d, "events"), "user_id", F.col("event_id"), state, F.col("props"))


@query(f"SELECT v.s AS source FROM (VALUES ('gpib'), ('nowhere'), ('rsl'), ('lost')) v(s) WHERE v.s NOT IN (SELECT source FROM {_SRC})")
def unknown_sources(spark, d):
    asked = spark.createDataFrame([("gpib",), ("nowhere",), ("rsl",), ("lost",)], "source string")
    return asked.join(S.sources(spark), "source", "left_anti")


_SLUGS = "(VALUES " + ", ".join(f"({X.literal(a)}, '{b}')" for a, b in V.PORTAL_SLUGS) + ") s(stem, slug)"


@query(
    f"SELECT id, slug FROM {X.sql_table(X.TITLES)}, {_SLUGS} WHERE contains(lower(t), left(stem, 5)) "
    f"OR id NOT IN (SELECT id FROM {X.sql_table(X.TITLES)}, {_SLUGS} WHERE contains(lower(t), left(stem, 5)))"
)
def region_slugs(spark, d):
    named = F.array_compact(F.array(*[F.when(T.any_stem(F.col("t"), (stem[:5],)), slug) for stem, slug in V.PORTAL_SLUGS]))
    every = F.array(*[F.lit(slug) for _, slug in V.PORTAL_SLUGS])
    return X.spark_table(spark, X.TITLES).select("id", F.explode(F.when(F.size(named) == 0, every).otherwise(named)).alias("slug"))


# Dedup, anti-joins, joins, unions
@query("SELECT text AS url, min(doc_id) AS seq, arg_min(source, doc_id) AS source FROM documents GROUP BY text")
def dedup_url_first(spark, d):
    docs = table(spark, d, "documents").select(F.col("text").alias("url"), F.col("doc_id").alias("seq"), "source")
    return C.keep_first(docs, ["url"], ["seq"])


@query("SELECT min(o_orderkey) AS o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders GROUP BY o_custkey, year(o_orderdate)")
def dedup_title_year(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"))
    return C.keep_first(rows, ["o_custkey", "y"], ["o_orderkey"])


@query(f"SELECT text AS url, min(doc_id) AS seq FROM documents WHERE {sql_any('text', LATIN_DOUBTFUL)} GROUP BY text")
def dedup_after_filter(spark, d):
    docs = table(spark, d, "documents").where(T.any_stem(F.col("text"), LATIN_DOUBTFUL)).select(F.col("text").alias("url"), F.col("doc_id").alias("seq"))
    return C.keep_first(docs, ["url"], ["seq"])


@query("SELECT source, count(*) AS total, count(DISTINCT text) AS uniq FROM documents GROUP BY source")
def unique_total(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("total"), F.countDistinct("text").alias("uniq"))


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def review_pending(spark, d):
    return C.unseen(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), "doc_id")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def insert_if_absent(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_name").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@query("SELECT o_orderkey, o_custkey, count(*) AS n_lines, sum(l_quantity) AS qty FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL")
def listing_detail_join(spark, d):
    detail = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n_lines"), F.sum("l_quantity").alias("qty"))
    return table(spark, d, "orders").join(detail, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "o_custkey", "n_lines", "qty")


@query(
    "SELECT c_custkey, o_orderkey, l_linenumber, l_quantity FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey "
    "WHERE year(o_orderdate) BETWEEN 1994 AND 1995"
)
def three_level_walk(spark, d):
    orders = table(spark, d, "orders").where(F.year("o_orderdate").between(1994, 1995)).select("o_orderkey", "o_custkey")
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    joined = table(spark, d, "customer").select("c_custkey").join(orders, F.col("c_custkey") == F.col("o_custkey")).join(items, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select("c_custkey", "o_orderkey", "l_linenumber", "l_quantity")


@query(
    "SELECT 'supplier' AS library, s_suppkey AS id, s_name AS title, NULL AS segment FROM supplier UNION ALL SELECT 'customer', c_custkey, c_name, c_mktsegment FROM customer "
    "UNION ALL SELECT 'part', p_partkey, p_name, NULL FROM part"
)
def source_union(spark, d):
    a = table(spark, d, "supplier").select(F.lit("supplier").alias("library"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("title"))
    b = table(spark, d, "customer").select(F.lit("customer").alias("library"), F.col("c_custkey").alias("id"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("segment"))
    c = table(spark, d, "part").select(F.lit("part").alias("library"), F.col("p_partkey").alias("id"), F.col("p_name").alias("title"))
    return a.unionByName(b, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)


@query("SELECT id, max_by(name, pri) AS name FROM (SELECT s_suppkey AS id, s_name AS name, 1 AS pri FROM supplier UNION ALL SELECT c_custkey, c_name, 2 FROM customer) GROUP BY id")
def override_union(spark, d):
    old = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit(1).alias("pri"))
    new = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit(2).alias("pri"))
    return old.unionAll(new).groupBy("id").agg(F.max_by("name", "pri").alias("name"))


# Tokens and proposals
_TOKENS = (
    "(SELECT word, count(*) AS cnt, min(seq * 1000000 + pos) AS first FROM (SELECT seq, unnest(ws) AS word, unnest(range(len(ws))) AS pos "
    "FROM (SELECT doc_id AS seq, regexp_extract_all(lower(text), '[а-яёa-z]{4,}') AS ws FROM documents)) GROUP BY word)"
)


def _counts(spark: SparkSession, d: str) -> DataFrame:
    return C.token_counts(table(spark, d, "documents"), F.col("text"), F.col("doc_id"), 4, "а-яёa-z")


@query(f"SELECT word, cnt FROM {_TOKENS}")
def token_freq(spark, d):
    return _counts(spark, d).select("word", "cnt")


@query(f"SELECT word, cnt FROM {_TOKENS} ORDER BY cnt DESC, first LIMIT 20")
def top_words(spark, d):
    return _counts(spark, d).orderBy(F.desc("cnt"), "first").limit(20).select("word", "cnt")


@query(
    f"SELECT word, cnt FROM {_TOKENS} WHERE cnt >= 3 AND NOT ("
    + " OR ".join(f"starts_with(word, {X.literal(s)}) OR starts_with({X.literal(s)}, word)" for s in (*POSITIVE, *DOUBTFUL))
    + ")"
)
def trigger_proposals(spark, d):
    return C.proposals(_counts(spark, d), (*POSITIVE, *DOUBTFUL)).select("word", "cnt")


@query(
    "WITH e AS (SELECT word, doc_id, row_number() OVER (PARTITION BY word ORDER BY doc_id) AS place FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[а-яёa-z]{4,}')) AS word FROM documents)), "
    f"w AS (SELECT word FROM {_TOKENS} ORDER BY cnt DESC, first LIMIT 10) SELECT e.word, e.place::INTEGER AS place, e.doc_id FROM e JOIN w USING (word) WHERE place <= 3"
)
def word_examples(spark, d):
    top = [r["word"] for r in _counts(spark, d).orderBy(F.desc("cnt"), "first").limit(10).collect()]
    named = F.array_intersect(F.array(*map(F.lit, top)).cast("array<string>"), T.tokens(F.col("text"), 4, "а-яёa-z"))
    found = table(spark, d, "documents").select("doc_id", F.explode(named).alias("word"))
    return C.first_n(found, ["word"], ["doc_id"], 3).select("word", "place", "doc_id")


# Reports
@query(
    "WITH j AS (SELECT d.doc_id, lang, source, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)) SELECT * FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL OR CAST({c} AS VARCHAR) = '') AS empty, count(*) AS total FROM j" for c in ("lang", "source", "quality", "toxic"))
    + ")"
)
def completeness(spark, d):
    joined = table(spark, d, "documents").select("doc_id", "lang", "source").join(table(spark, d, "labels"), "doc_id", "left")
    return C.completeness(joined, ["lang", "source", "quality", "toxic"])


@query(f"SELECT {SQL_LANGUAGE} AS language, coalesce({SQL_LEVEL}, 'не определён') AS level, count(*) AS n FROM {TITLES} GROUP BY ALL")
def value_counts(spark, d):
    level = F.coalesce(T.admin_level(F.col("t")), F.lit("не определён")).alias("level")
    return titles(spark, d).groupBy(T.language(F.col("t")).alias("language"), level).agg(F.count("*").alias("n"))


@query("SELECT source, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS pct FROM documents GROUP BY source")
def share_of_total(spark, d):
    docs = table(spark, d, "documents")
    total = docs.agg(F.count("*").alias("total"))
    counts = docs.groupBy("source").agg(F.count("*").alias("n")).crossJoin(F.broadcast(total))
    return counts.select("source", "n", F.round(100.0 * F.col("n") / F.col("total"), 4).alias("pct"))


@query(f"SELECT count(*) AS total, count(*) FILTER (WHERE {SQL_FIX} <> t) AS changed FROM {TITLES}")
def changed_rows(spark, d):
    return titles(spark, d).agg(F.count("*").alias("total"), F.count_if(T.fix_title(F.col("t")) != F.col("t")).alias("changed"))


@query(f"SELECT source, count(*) AS found, count(*) FILTER (WHERE cls = 'positive') AS pos, count(*) FILTER (WHERE cls <> 'positive') AS review FROM (SELECT source, {SQL_CLASS.replace('(t)', '(text)')} AS cls FROM documents) GROUP BY source")
def routed_totals(spark, d):
    cls = T.classify(F.col("text"), POSITIVE, DOUBTFUL)
    docs = table(spark, d, "documents").select("source", cls.alias("cls"))
    return docs.groupBy("source").agg(F.count("*").alias("found"), F.count_if(F.col("cls") == "positive").alias("pos"), F.count_if(F.col("cls") != "positive").alias("review"))


# Pages, JSON
_HREFS = """(SELECT page_id, unnest(hs) AS href, unnest(range(len(hs))) AS pos FROM (SELECT page_id, regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1) AS hs FROM pages))"""


@query(f"SELECT page_id, CAST(pos AS INTEGER) AS pos, href FROM {_HREFS}")
def html_links(spark, d):
    return H.links(table(spark, d, "pages")).select("page_id", "pos", "href")


@query("SELECT page_id, trim(regexp_extract(html, '<title>(.*?)</title>', 1, 's')) AS title FROM pages")
def html_title(spark, d):
    return table(spark, d, "pages").select("page_id", H.title(F.col("html")).alias("title"))


@query(f"SELECT page_id, href FROM {_HREFS} WHERE href <> '' AND NOT regexp_matches(href, '^(#|mailto:|javascript:)') AND regexp_matches(href, '^/[a-zA-Z]{{4,}}')")
def href_filter(spark, d):
    return H.links(table(spark, d, "pages")).where(T.real_href(F.col("href")) & F.col("href").rlike("^/[a-zA-Z]{4,}")).select("page_id", "href")


_LINKS = r"""(SELECT page_id, url AS page, pos, href, trim(regexp_replace(regexp_replace(l, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS title FROM (
  SELECT page_id, url, unnest(hs) AS href, unnest(ls) AS l, unnest(range(len(hs))) AS pos FROM (SELECT page_id, url, regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"', 1) AS hs,
  regexp_extract_all(html, '(?s)<a\s[^>]*href="[^"]*"[^>]*>(.*?)</a>', 1) AS ls FROM pages)))"""
_ABSOLUTE = "CASE WHEN starts_with(href, 'http') THEN href ELSE regexp_extract(page, '^([a-z]+://[^/]+)', 1) || href END"
_REAL = r"href <> '' AND NOT regexp_matches(href, '^(#|mailto:|javascript:)') AND title <> ''"


def captured(spark: SparkSession, d: str, source: str) -> DataFrame:
    return table(spark, d, "pages").select(F.lit(source).alias("source_id"), "url", "html")


@query(f"SELECT page_id, CAST(pos AS INTEGER) AS pos, href, title FROM {_LINKS}")
def link_texts(spark, d):
    return L.link_rows(table(spark, d, "pages")).select("page_id", "pos", "href", "title")


@query(f"SELECT 'rgo' AS library_id, title, {_ABSOLUTE} AS url FROM {_LINKS} WHERE {_REAL}")
def source_search(spark, d):
    return L.search(captured(spark, d, "rgo"), "rgo").select("library_id", "title", "url")


@query(
    f"SELECT 'aonb' AS library_id, url, arg_min(title, (page, pos)) AS title FROM (SELECT *, {_ABSOLUTE} AS url FROM {_LINKS} WHERE {_REAL}) "
    "WHERE contains(lower(title), 'nicht') OR contains(lower(title), 'tion') GROUP BY url"
)
def source_search_asked(spark, d):
    return L.search(captured(spark, d, "aonb"), "aonb", "Nicht die tion").select("library_id", "url", "title")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k long").k.alias("k"))


# The whole curation
_CURATED_REGIONS = (("tion", "East"), ("schein", "North"), ("ción", "South"), ("eau", "West"))
_CURATED_TARGET = tuple(s for s, _ in _CURATED_REGIONS)
_R = "nullif(concat_ws(', ', " + ", ".join(f"CASE WHEN contains(lower(t || ' ' || source), {X.literal(s)}) THEN '{r}' END" for s, r in _CURATED_REGIONS) + "), '')"


@query(
    f"WITH f AS (SELECT doc_id, n_chars, source, text AS url, {SQL_FIX.replace('(t,', '(text,')} AS t FROM documents), "
    f"g AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY doc_id) AS rn FROM f WHERE {sql_any('t', _CURATED_TARGET)}) "
    f"SELECT url, t AS title, nullif(left(url, 2000), '') AS description, {SQL_LEVEL} AS level, {SQL_LANGUAGE} AS language, {_R} AS regions, "
    f"CASE WHEN regexp_matches(t, '[{T.CYRILLIC}]{{14,}}') THEN 'да' END AS doubtful, "
    f"CAST(nullif(n_chars % 3, 0) AS INTEGER) AS year_from, CAST(coalesce(nullif(n_chars % 2, 0), nullif(n_chars % 3, 0)) AS INTEGER) AS year_to FROM g WHERE rn = 1"
)
def curate_export(spark, d):
    docs = table(spark, d, "documents").select(
        F.col("doc_id").alias("seq"), F.col("text").alias("title"), F.col("source").alias("territory"), F.col("text").alias("url"), F.col("text").alias("description"),
        (F.col("n_chars") % 3).cast("int").alias("year_from"), (F.col("n_chars") % 2).cast("int").alias("year_to"),
    )
    return C.curated(docs, _CURATED_TARGET, _CURATED_REGIONS)
