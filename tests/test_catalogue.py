from __future__ import annotations

import random
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cartoscope import vocabulary as V
from cartoscope.functions import text as T
from cartoscope.operators import curation as C, search as S
from cartoscope.plans import catalogue
from cartoscope.sources import connector, html, records
from cartoscope.streaming import resume

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    r = duck.execute(catalogue.ORACLES[name])
    columns = [x[0] for x in r.description]
    key = lambda row: tuple((x is None, str(x)) for x in row)
    assert sorted(columns) == sorted(df.columns)
    assert sorted((tuple(x) for x in df.select(*columns).collect()), key=key) == sorted(r.fetchall(), key=key)


def test_dimensions(spark):
    assert len(V.POSITIVE) == 31 and len(V.DOUBTFUL) == 8
    assert S.territories(spark).count() == 49
    assert S.combinations(S.sources(spark), S.territories(spark), S.keywords(spark)).count() == 2059


def test_year_overlap_truth_table(spark):
    rows = [(None, None), (1600, 1650), (1690, 1710), (1990, 1995), (1800, None)]
    got = spark.createDataFrame(rows, "a int, b int").select(T.year_overlap(F.col("a"), F.col("b"), 1700, 1980)).collect()
    assert [r[0] for r in got] == [True, False, True, False, True]


def test_streaks_equal_a_loop(spark):
    rng = random.Random(1)
    log = [(g, i, rng.choices(["hit", "empty", "err"], [1, 4, 2])[0]) for g in range(20) for i in range(60)]
    want = {}
    for g in range(20):
        n = 0
        for _, i, o in (r for r in log if r[0] == g):
            n = n + 1 if o == "empty" else 0 if o == "hit" else n
            if o == "empty" and n >= 5 and g not in want:
                want[g] = i
    df = spark.createDataFrame(log, "g int, i int, o string")
    got = S.streak_cutoff(df, ["g"], ["i"], F.col("o"), "empty", F.col("_outcome") == "hit", 5)
    assert {r["g"]: r["cut_i"] for r in got.collect()} == want


def test_keep_first_is_idempotent(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 3, "z"), (None, 0, "w")], "url string, seq int, v string")
    once = C.keep_first(df, ["url"], ["seq"])
    assert {r["v"] for r in once.collect()} == {"y", "w"}
    assert set(C.keep_first(once, ["url"], ["seq"]).collect()) == set(once.collect())


def test_label_strategies():
    assert html.parse_pairs("<dl><dt>Автор:</dt><dd>Иванов</dd><dt>Год</dt><dd>1800</dd></dl>") == {"Автор": "Иванов", "Год": "1800"}
    assert html.parse_pairs('<div class="field-label">Шифр: </div><div class="field-items">Ф.1 <b>Оп.2</b></div>') == {"Шифр": "Ф.1 Оп.2"}
    assert html.parse_pairs("<table><tr><th>A</th><td>1</td></tr></table>") == {"A": "1"}
    assert html.parse_pairs("<p>Тема: карты</p><p>прочее</p>") == {"Тема": "карты"}
    assert html.parse_pairs(None) == {}


def test_label_udf_and_marc(spark):
    page = spark.createDataFrame([("<dl><dt>A</dt><dd>1</dd></dl>",), (None,)], "h string")
    assert [r[0] for r in page.select(html.label_values("h")).collect()] == [{"A": "1"}, {}]
    marc = (
        '<record><datafield tag="200"><subfield code="a">Карта</subfield></datafield><datafield tag="210"><subfield code="a">СПб</subfield>'
        '<subfield code="d">1796-1801</subfield></datafield><datafield tag="101"><subfield code="a">rus</subfield></datafield></record>'
    )
    got = spark.createDataFrame([(marc,)], "x string").select(records.marc_record(F.col("x")).alias("r")).select("r.*").collect()[0]
    assert (got["title"], got["place"], got["year_from"], got["year_to"], got["language"]) == ("Карта", "СПб", 1796, 1801, "Русский")


def test_run_files(spark, tmp_path):
    rows = [("s", "План города", 1, "x" * 300), ("s", "Список", 2, None)]
    df = C.routed(spark.createDataFrame(rows, "source_id string, title string, seq int, description string"), F.col("title"))
    records.write_routed(df, str(tmp_path / "20260101"))
    assert len(records.read_rows(spark, str(tmp_path / "20260101" / "results")).collect()[0]["description"]) == 200
    assert "decision" in records.read_rows(spark, str(tmp_path / "20260101" / "review")).columns
    assert records.latest_run(spark, str(tmp_path)) == "20260101"
    (tmp_path / "c.json").write_text('{"done": ["a|b|c",\n "d"], "updated": "x"}')
    assert {r["combo"] for r in records.read_checkpoint(spark, str(tmp_path / "c.json")).collect()} == {"a|b|c", "d"}


def test_connector(spark, tmp_path):
    rows = [("a", "u1", "<p>"), ("b", "u2", None), ("a", "u3", "")]
    spark.createDataFrame(rows, "source_id string, url string, html string").repartition(2).write.parquet(str(tmp_path / "p"))
    connector.register(spark)
    pages = spark.read.format("captured_pages").option("path", str(tmp_path / "p")).load()
    assert pages.count() == 3 and pages.where("source_id = 'a'").count() == 2
    registry = connector.Registry()
    registry.add("a", "query", lambda s, q: pages.where("source_id = 'a'"))
    with pytest.raises(KeyError):
        registry.search_all(spark, ["a", "z"], "q")
    assert registry.search_all(spark, ["a", "a"], "q").count() == 4


def test_stream_resumes(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.where("event_id < 500").write.parquet(str(tmp_path / "in"))
    go = lambda: resume.run_available(spark, str(tmp_path / "in"), events.schema, lambda s: s.where("event_type <> 'error'"), str(tmp_path / "out"), str(tmp_path / "cp"), "event_id")
    first = go().count()
    assert first == events.where("event_id < 500 and event_type <> 'error'").count() == go().count()
    events.where("event_id >= 400").write.mode("append").parquet(str(tmp_path / "in"))
    assert go().count() == events.where("event_type <> 'error'").count()


def test_rest_stands_alone(tmp_path):
    """Without the training-data folders everything else still imports."""
    import shutil

    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "cartoscope", tmp_path / "cartoscope", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert 'curate_export' in e.queries() and not any(k.startswith('op') for k in e.queries()); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
