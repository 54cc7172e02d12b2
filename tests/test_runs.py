"""Run files, encodings, broken pages and commands."""

from __future__ import annotations

import json
import random
from urllib.parse import quote, quote_plus

import pytest
from pyspark.sql import functions as F

from cartoscope import commands
from cartoscope.functions import fields as D, text as T
from cartoscope.operators import curation as C, search as S
from cartoscope.sources import connector, html as H, libraries as L, records
from cartoscope.streaming import resume


def values(spark, rows, **columns):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string").coalesce(1).orderBy("i")
    return df.select(*[c(F.col("t")).alias(k) for k, c in columns.items()]).collect()


def test_keep_first_keeps_rows_without_an_order(spark):
    df = spark.createDataFrame([("u", None, "x"), (None, 1, "a"), (None, 1, "b"), ("v", None, "y"), ("v", 2, "z"), ("w", None, "p"), ("w", None, "q")], "url string, seq int, v string")
    got = sorted(((r["url"] or "", r["v"]) for r in C.keep_first(df, ["url"], ["seq"]).collect()))
    assert [u for u, _ in got] == ["", "u", "v", "w"] and ("u", "x") in got and ("v", "y") in got
    assert sorted((r["url"] or "", r["v"]) for r in C.keep_first(df.repartition(5), ["url"], ["seq"]).collect()) == got
    pairs = spark.createDataFrame([(None, "a", 1), ("a", None, 2), ("a", "a", 3)], "x string, y string, n int")
    assert C.keep_first(pairs, ["x", "y"], ["n"]).count() == 3


def test_broken_anchors(spark):
    html = "<a href=\"/1\">One<a href=\"/2\">Two</a><A class=k HREF = '/3'>Three</A><a href=/4>Four</a><a data-href='/no' name=x>no</a><a href=\"/5\" title=\"x>y\">Five"
    pages = spark.createDataFrame([(1, "http://h/", html), (2, "http://h/2", None)], "page_id int, url string, html string")
    got = [(r["pos"], r["href"], r["title"]) for r in L.link_rows(pages).orderBy("pos").collect()]
    assert [g[1:] for g in got[:4]] == [("/1", "One"), ("/2", "Two"), ("/3", "Three"), ("/4", "Four")] and got[4][1] == "/5"
    assert [r["href"] for r in H.links(pages).orderBy("pos").collect()] == ["/1", "/2", "/3", "/4", "/5"]


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_streaks_by_chunk_equal_a_loop(spark, size):
    rng = random.Random(size)
    log = [(g, i, rng.choices(["hit", "empty", "err"], [1, 5, 2])[0]) for g in range(15) for i in range(70)]
    want = {}
    for g in range(15):
        n = 0
        for _, i, o in (r for r in log if r[0] == g):
            n = n + 1 if o == "empty" else 0 if o == "hit" else n
            if o == "empty" and n >= 6 and g not in want:
                want[g] = i
    df = spark.createDataFrame(log, "g int, i int, o string")
    got = S.streak_cutoff(df, ["g"], ["i"], F.col("o"), "empty", F.col("_outcome") == "hit", 6, F.floor(F.col("i") / size))
    assert {r["g"]: r["cut_i"] for r in got.collect()} == want


def test_encodings(spark):
    texts = ["Калуга & Ёж «№ 5»", "", "plain/a~b c*d", "日本 é Ђ", "\x98?"]
    rows = values(spark, texts, utf=D.percent, form=D.percent_cp1251, raw=D.to_cp1251)
    for t, r in zip(texts, rows, strict=True):
        raw = t.encode("cp1251", "replace")
        assert r["utf"] == quote(t) and r["form"] == quote_plus(raw) and bytes(r["raw"]) == raw
    blobs = [b for t in texts[:3] for b in (t.encode("cp1251"), t.encode())] + [b'<?xml encoding="windows-1251"?>' + "Я".encode("cp1251")]
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(blobs)], "i int, b binary").orderBy("i")
    got = [r[0] for r in df.select(D.decoded(F.col("b"))).collect()]
    assert got[:6] == [t for t in texts[:3] for _ in range(2)] and got[6] == '<?xml encoding="utf-8"?>Я'


def test_fields(spark):
    assert values(spark, ["1\nодин\n2\nдва"], n=D.numbered_blocks)[0]["n"] == [(1, "один"), (2, "два")]
    card = "Шифр хранения\nKGR Ko 1\nТема\nкоротко"
    assert tuple(values(spark, [card], a=lambda t: D.after_label(t, "Шифр хранения"), b=lambda t: D.after_label(t, "Тема", 20))[0]) == ("KGR Ko 1", "")
    assert values(spark, ["Ф.Р-79 Оп.1 Д.2162"], c=D.whole_cipher)[0]["c"] == ("Ф.Р-79 Оп.1 Д.2162", "Р-79", "1", "2162")
    form = "<input type='hidden' name='a' value='1'><input type=\"hidden\" name='a' value=\"2\"><input type=hidden name='b'>"
    assert values(spark, [form, None], f=D.hidden_fields) == [({"a": "2", "b": ""},), ({},)]
    assert values(spark, [None, ""], s=T.language, d=lambda t: D.has(t, "")) == [("Русский", True)] * 2


def test_red_cells_marc_and_items(spark):
    rows = [
        ("rnb_kart", "http://n/1", "<table><tr><td><FONT COLOR='RED'>12</FONT><br>К 1-2<br>Карта уезда 1796<br>Rusmarc</td><td>x</td></tr></table>"),
        ("neb_marc", "http://m/1", '<r xmlns:m="x"><m:datafield tag="245"><m:subfield code="a">[Карта &amp; план]</m:subfield></m:datafield><m:datafield tag="034"><m:subfield code="b">84 000</m:subfield></m:datafield>'),
        ("rsl", "http://r/search?1", json.dumps({"content": '<div><a href="/ru/record/1">Карта 1800</a></div><div>Шифр хранения</div><div>KGR 1</div><div>читальный зал</div>'})),
    ]
    pages = spark.createDataFrame(rows, "source_id string, url string, html string")
    red = L.search(pages, "rnb_kart").collect()
    assert [(r["title"], r["year_from"], r["extra"]["shelfmark"]) for r in red if r["extra"]] == [("Карта уезда 1796", 1796, "К 1-2")]
    marc = L.search(pages, "neb_marc").collect()[0]
    assert (marc["title"], marc["scale"]) == ("Карта & план", 84000)
    item = L.search(pages, "rsl").collect()[0]
    assert (item["url"], item["year_from"], item["extra"]["access"], item["extra"]["shelfmark"]) == ("http://r/ru/record/1/", 1800, "reading_room", "KGR 1")
    assert L.search(pages, "rsl", territory="Пермь").count() == 0
    with pytest.raises(KeyError):
        L.search(pages, "rsl_items")


def test_run_state(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    assert records.read_checkpoint(spark, f"{folder}/none").count() == 0
    done = spark.createDataFrame([("a|b|c",), ("d",), ("d",)], "combo string")
    records.write_checkpoint(done, f"{folder}/checkpoint", "now")
    assert sorted(r[0] for r in records.read_checkpoint(spark, f"{folder}/checkpoint").collect()) == ["a|b|c", "d"]
    records.write_seen(spark.createDataFrame([("u",), (None,)], "url string"), f"{folder}/seen")
    assert sorted(r[0] for r in records.read_seen(spark, f"{folder}/seen").collect()) == ["", "u"]
    (tmp_path / "seen.json").write_text('{"seen": ["x",\n "y"]}')
    assert records.read_seen(spark, f"{folder}/seen.json").count() == 2
    assert records.run_mode(spark, folder, done) == "overwrite"
    rows = spark.createDataFrame([("s", "КартаРоссии", "", "")], "source_id string, title string, decision string, comment string")
    records.append_confirmed(rows, folder)
    records.append_confirmed(rows, folder)
    got = records.read_rows(spark, f"{folder}/results")
    assert got.count() == 2 and got.columns == ["source_id", "title"] and records.run_mode(spark, folder, done) == "append"
    records.write_fixed(got, f"{folder}/results")
    assert {r["title"] for r in records.read_rows(spark, f"{folder}/results_fixed").collect()} == {"Карта России"}
    (tmp_path / "t.json").write_text('{"results": [{"name": "a"}, {"name": "b"}], "has_more": false}')
    assert records.read_tables(spark, f"{folder}/t.json").count() == 2
    assert records.table_status({"a": got, "b": got.limit(0), "c": None}) == {"a": "rows", "b": "empty", "c": "missing"}
    assert records.guess_columns(["id", "Наименование", "Примечание"]) == ("Наименование", "Примечание")
    assert records.columns_of(got)[0] == ("source_id", "string")
    assert [r[0] for r in spark.createDataFrame([(200,), (404,), (None,)], "s int").select(records.reachable(F.col("s"))).collect()] == [True, False, False]
    (tmp_path / ".env").write_text("OTHER=1\nTOKEN_X=abc def\n")
    assert records.secret("TOKEN_X", (f"{folder}/.env",)) == "abc"
    monkeypatch.setenv("TOKEN_X", "env")
    assert records.secret("TOKEN_X") == "env"
    with pytest.raises(RuntimeError):
        records.secret("TOKEN_Y")
    sparse = C.sparse_json(spark.createDataFrame([("a", None)], "x string, y string")).collect()[0][0]
    assert json.loads(sparse) == {"x": "a"}


def test_bounded_stream(spark, tmp_path):
    events = spark.createDataFrame([(i % 5, f"2026-01-01 00:00:0{i}") for i in range(9)], "k int, at string").select("k", F.col("at").cast("timestamp").alias("at"))
    events.write.parquet(str(tmp_path / "in"))
    got = resume.run_available(spark, str(tmp_path / "in"), events.schema, lambda s: s, str(tmp_path / "out"), str(tmp_path / "cp"), "k", time="at", late="1 hour")
    assert got.count() == 5


def test_streaming_states(spark, tmp_path):
    rows = [("a", 1, "ok", "", "2026-01-01 00:10:00"), ("a", 2, "down", "403", "2026-01-01 00:20:00"), ("a", 3, "partial", "x", "2026-01-01 02:00:00"), ("b", 4, "partial", "y", "2026-01-01 00:30:00")]
    events = spark.createDataFrame(rows, "library_id string, seq long, event string, problem string, at string").select("*", F.col("at").cast("timestamp").alias("ts"), F.col("event").alias("event_type"))
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    for name, df in (("health_now", resume.health_stream(stream)), ("windows_now", resume.windowed_counts(stream))):
        df.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / name)).start().awaitTermination()
    assert {tuple(r) for r in spark.table("health_now").collect()} == {("a", "down", "403"), ("b", "partial", "y")}
    assert sum(r["n"] for r in spark.table("windows_now").collect()) == 4


def test_breaker_carries_its_state(spark, tmp_path):
    rng = random.Random(3)
    log = [(f"s{g}", i, rng.choices(["hit", "err", "late"], [1, 5, 2])[0]) for g in range(6) for i in range(40)]
    want = {}
    for g in range(6):
        n = 0
        for s, i, o in (r for r in log if r[0] == f"s{g}"):
            n = n + 1 if o == "err" else 0 if o == "hit" else n
            if n >= 5 and o == "err" and s not in want:
                want[s] = i
    schema = "source string, seq long, outcome string"
    for part in range(4):  # four batches
        rows = [r for r in log if r[1] // 10 == part]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        out = resume.breaker_stream(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
        out.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    got = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(got) == sorted(want.items()) and len(want) > 2


def test_connector_reads_one_source(spark, tmp_path):
    rows = [(s, f"{s}{i}", None if i % 2 else "x") for s in "ab" for i in range(50)]
    spark.createDataFrame(rows, "source_id string, url string, html string").repartition(3).write.parquet(str(tmp_path / "p"))
    connector.register(spark)
    read = spark.read.format("captured_pages").option("path", str(tmp_path / "p"))
    every = read.load()
    assert every.where("source_id = 'a'").unionAll(every.where("source_id = 'b'")).count() == 100
    assert sorted(r["url"] for r in read.option("source_id", "b").load().collect()) == sorted(f"b{i}" for i in range(50))


def test_commands(spark, tmp_path):
    page = '<a href="/1">Карта Пермская губерния 1796</a><a href="/2">План Оса 1801</a><a href="/3">Роман</a>'
    rows = [("rgo", "http://g/1", page), ("aonb", "http://a/1", page)]
    spark.createDataFrame(rows, "source_id string, url string, html string").write.parquet(str(tmp_path / "pages"))
    pages, folder = str(tmp_path / "pages"), str(tmp_path / "run")
    assert commands.main(spark, ["run", pages, folder, "--dry-run"]).count() == 2059
    assert commands.main(spark, ["run", pages, folder, "--dry-run", "--source", "rgo", "--max-combos", "7"]).count() == 7
    with pytest.raises(ValueError, match="nowhere"):
        commands.main(spark, ["run", pages, folder, "--dry-run", "--source", "nowhere"])
    totals = commands.main(spark, ["run", pages, folder, "--source", "rgo"]).collect()
    assert [tuple(r) for r in totals] == [("rgo", 2, 2)]
    assert commands.main(spark, ["run", pages, folder, "--source", "rgo", "--resume"]).count() == 0
    assert records.read_checkpoint(spark, f"{folder}/checkpoint").count() == 49 * 6
    assert commands.main(spark, ["search", pages, "карта", "--source", "rgo", "--year-from", "1800"]).count() == 2
    got = commands.main(spark, ["check", pages, "rgo", "neb"]).collect()
    assert {(r["source"], r["status"], r["verdict"]) for r in got} == {("rgo", "ok", "OK"), ("neb", "empty", "FAIL")}
    assert tuple(commands.main(spark, ["fix-titles", f"{folder}/results"]).collect()[0]) == (2, 0)
    assert "карта" in {r["word"] for r in commands.main(spark, ["words", f"{folder}/results"]).collect()}
    assert commands.main(spark, ["review", folder]).count() == 0
    asked = commands.main(spark, ["ask", "Пермской, Тверская", "до 1850", "--detail", "2"])
    assert asked.count() == 11 and {(r["year_from"], r["year_to"]) for r in asked.collect()} == {(1700, 1850)}
    assert commands.main(spark, ["ask", "Тверская", "1800"]).count() == 8


def test_rest_collects_without_the_training_data_folders(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    leave = shutil.ignore_patterns("llm", "__pycache__", ".git", ".pytest_cache", "corpus_pipeline.py", "spark-warehouse")
    shutil.copytree(root, tmp_path / "repo", ignore=leave)
    assert not (tmp_path / "repo" / "corpus_pipeline.py").exists() and not (tmp_path / "repo" / "cartoscope" / "llm").exists()
    run = lambda *a: subprocess.run([sys.executable, *a], cwd=tmp_path / "repo", check=True, capture_output=True, text=True).stdout
    assert "test_runs.py" in run("-m", "pytest", "--collect-only", "-q", "tests")
    code = "import __spark_entry__ as e; q = e.queries(); assert set(q) == set(e.oracle_sql()) and 'source_gpib' in q and 'pipeline' not in q; import cartoscope.commands"
    run("-c", code)
