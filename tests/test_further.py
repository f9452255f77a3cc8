import json
import random
import sqlite3
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from adloom.functions import lines, registered, stats
from adloom.functions import text as T
from adloom.operators import classifier, languages, matching, pipeline, remote, sentences, upsert
from adloom.operators.ranks import next_page, numbered
from adloom.sources import files, tables, workbook
from adloom.sources.sqlite import read_sqlite, write_sqlite
from adloom.streaming.incremental import collect_daily, first_seen


def test_numbers_of_a_hot_key(spark):
    rows = [("hot", i) for i in range(3000)] + [(f"k{i % 7}", i) for i in range(70)] + [(None, 1), (None, 2)]
    random.seed(1)
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v long").repartition(6)
    got = {(r.k, r.v): r.place for r in numbered(df, ["k"], ["v"]).collect()}
    want = {}
    for k in {k for k, _ in rows}:
        for n, v in enumerate(sorted(v for x, v in rows if x == k), 1):
            want[k, v] = n
    assert got == want
    everyone = numbered(df, [], [F.desc("v"), "k"]).orderBy("place").collect()
    assert [r.place for r in everyone] == list(range(1, len(rows) + 1)) and everyone[0].v == 2999
    assert numbered(df.limit(0), ["k"], ["v"]).count() == 0
    ids, last, seen = spark.range(25), None, []
    while page := [r.id for r in next_page(ids, "id", last, 10).collect()]:
        seen += page
        last = page[-1]
    assert seen == list(range(25))


def test_workbook(spark, tmp_path):
    a = spark.createDataFrame([(1, "x & <y>", 0.5, None), (2, " sp\nace ", None, True)], "n long, t string, d double, b boolean")
    path = str(tmp_path / "w.xlsx")
    workbook.write_workbook({"one": a, "two 'and' \"more\"": spark.range(3).toDF("id")}, path)
    got = workbook.read_sheet(spark, path, "one")
    assert got.columns == ["n", "t", "d", "b"] and [tuple(r) for r in got.collect()] == [("1", "x & <y>", "0.5", None), ("2", " sp\nace ", None, "1")]
    assert workbook.read_sheet(spark, path, "two 'and' \"more\"").count() == 3 and workbook.read_sheet(spark, path).columns[0] == "n"
    with pytest.raises(ValueError):
        workbook.read_sheet(spark, path, "none")
    assert workbook._letters(0) == "A" and workbook._letters(27) == "AB" and workbook._letters(702) == "AAA"


def test_tables(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    schema = tables.declared([("id", "INT(11)", False), ("t", "VARCHAR(9)", True), ("d", "DECIMAL(8,2)", True), ("at", "DATETIME", True)])
    assert [f.dataType.simpleString() for f in schema.fields] == ["bigint", "string", "double", "string"]
    tables.create_table(spark, path, schema)
    tables.insert(path, spark.createDataFrame([(1, "a", "extra")], "id long, t string, more string"))
    tables.insert(path, spark.range(25).coalesce(1), per_file=10)
    tables.create_table(spark, path, schema)
    assert spark.read.parquet(path).count() == 26 and len(list((tmp_path / "t.parquet").glob("part-*.parquet"))) >= 4
    tables.rebuild(path, spark.read.parquet(path).where("t is not null"))
    assert [r.t for r in spark.read.parquet(path).collect()] == ["a"] and tables.list_tables(spark, str(tmp_path)) == ["t"]
    tables.write_indexed(spark.range(100), str(tmp_path / "i"), "id")
    assert spark.read.parquet(str(tmp_path / "i")).where("id = 7").count() == 1
    tables.write_report(str(tmp_path / "r"), spark, k=F.lit(2), rows=spark.range(3))
    assert json.loads(spark.read.text(str(tmp_path / "r")).first()[0]) == {"k": 2, "rows": [{"id": 0}, {"id": 1}, {"id": 2}]}
    parts = tables.year_predicates("d", 2024, 2025)
    days = spark.createDataFrame([(x,) for x in ("2023-12-31", "2024-01-01", "2024-12-31", "2025-06-01", "2026-01-01", None)], "d string")
    assert [days.where(p).count() for p in parts] == [2, 1, 3]


def test_database_of_many_processes(spark, tmp_path):
    days = spark.createDataFrame([(1, "2024-05-01"), (2, "2025-01-01"), (3, None)], "id long, day string")
    url = tables.derby_database(days, str(tmp_path / "d"), "ads", '"id" BIGINT, "day" VARCHAR(10)')
    read = tables.read_jdbc(spark, url, "ads", tables.year_predicates('"day"', 2024, 2025), ["id", "day"], **tables.DERBY)
    assert sorted(map(tuple, read.collect())) == [(1, "2024-05-01"), (2, "2025-01-01"), (3, None)] and read.rdd.getNumPartitions() == 3
    # another process reads it while this one has it open
    run = [sys.executable, "-c", f"from pyspark.sql import SparkSession; s = SparkSession.builder.getOrCreate(); print('rows', s.read.jdbc({url!r}, 'ads', properties={tables.DERBY}).count())"]
    assert "rows 3" in subprocess.run(run, capture_output=True, text=True, cwd=tmp_path, timeout=120).stdout
    empty = tables.derby_database(days.where("id > 3"), str(tmp_path / "e"), "ads", '"id" BIGINT, "day" VARCHAR(10)')
    assert spark.read.jdbc(empty, "ads", properties=tables.DERBY).count() == 0 and sorted(p.name for p in tmp_path.iterdir() if p.name != "derby.log") == ["d", "e"]


def test_files(spark, tmp_path):
    for name, n in (("jobads_jp_esco", 2), ("jobads_de_esco", 3), ("other", 4)):
        (tmp_path / f"{name}.jsonl").write_text("".join(f'{{"id": {i}}}\n' for i in range(n)))
    args = (spark, str(tmp_path / "*.jsonl"), "id long", "jobads_([a-z]+)_esco")
    assert {tuple(r) for r in files.read_by_country(*args).groupBy("country").count().collect()} == {("jp", 2), ("de", 3)}
    only = files.read_by_country(*args, ["de"])
    assert only.count() == 3 and [f.rsplit("/", 1)[1] for f in only.inputFiles()] == ["jobads_de_esco.jsonl"]
    assert files.read_by_country(*args, ["xx"]).count() == 0
    (tmp_path / "bad.jsonl").write_text('{"id": 1}\n{"id": \n')
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "bad.jsonl"), "id long", strict=True).collect()
    (tmp_path / "doc.json").write_text('{"a": {"jp": 1},\n "b": [1, 2]}')
    assert files.read_document(spark, str(tmp_path / "doc.json"), "a map<string,int>, b array<int>").first().b == [1, 2]
    files.write_sheets({"x": spark.range(2), "y": spark.range(3)}, str(tmp_path / "sheets"))
    assert spark.read.csv(str(tmp_path / "sheets/y"), header=True).count() == 3


def test_sqlite_filters_reach_the_database(spark, tmp_path):
    path = str(tmp_path / "d.db")
    write_sqlite(spark.createDataFrame([(i, f"t{i}", i / 2, "x") for i in range(20)], "id long, t string, v double, more string"), path, "ads")
    df = read_sqlite(spark, path, "ads", columns=["id", "t"])
    assert df.columns == ["id", "t"] and df.where("id >= 5 and id < 9 and t <> 't6'").count() == 3
    with sqlite3.connect(path) as c:  # a value no reader could make a number of: it must not be read at all
        c.execute("UPDATE ads SET id = 'broken' WHERE id = 3")
    assert read_sqlite(spark, path, "ads", columns=["t", "v"]).where("t = 't4'").collect() == [("t4", 2.0)]
    assert df.where("t = 't4'").count() == 1


def test_lines_are_those_of_sentences(spark):
    texts = ["## **Duties**\n> see https://x.y/z now\n- a　b \\* c\n---\n[x]: rest\n •  item **bold** *\n\nPay: 5", "【A】\n" + "w" * 50 + "\nWhat we offer:\nOne two three four five six seven:", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.x for r in df.select("i", lines.clean_lines(F.col("t")).alias("x")).collect()}
    for i, t in enumerate(texts):
        assert (got[i] or []) == [x for x in map(sentences.clean_line, (t or "").split("\n")) if x]
    every = [x for v in got.values() for x in v or []]
    told = spark.createDataFrame([(x,) for x in every], "x string").select("x", lines.is_heading(F.col("x")).alias("h"), lines.is_particular(F.col("x")).alias("p")).collect()
    assert all(r.h == sentences.is_heading(r.x) and r.p == bool(sentences._DROPPED.match(r.x)) for r in told)
    shown = ["Knowledge of", "SQL, and", "one two,", "Lead teams", "Nurses", "done.", "and more", "(in x", "Über uns", "étage", ") x", "A long line without an end here"]
    got = spark.createDataFrame([(x,) for x in shown], "x string").select("x", lines.may_go_on(F.col("x")).alias("m"), lines.goes_on(F.col("x")).alias("g")).collect()
    assert all(r.m == sentences._ends(r.x) and r.g == sentences._continues(r.x) for r in got)
    assert {r.x for r in told if r.h} == {"Duties", "What we offer:"} and {r.x for r in told if r.p} == {"Pay: 5", "w" * 50}


def test_registered(spark):
    registered.register(spark)
    r = spark.sql("SELECT clean_line('- a **b** c') AS a, token_set_ratio('b a', 'a b c') AS b, clean_line(NULL) AS c").first()
    assert tuple(r) == ("a b c", 100.0, None)
    got = spark.sql("SELECT s.pos, s.sentence FROM (SELECT 'We bake bread daily. You lead a team.' AS t) x, LATERAL ad_sentences(t) s").collect()
    assert [tuple(x) for x in got] == [(0, "We bake bread daily."), (1, "You lead a team.")]


def test_languages(spark):
    rows = [(1, "We look for the cook", None), (2, "ケーキを焼く", " "), (3, "Wir suchen die Köche und Helfer", None), (4, "  ", None), (5, "any", "XX"), (6, None, ""), (7, "zzz", None), (8, "nhân viên và quản lý của", None)]
    got = {r.id: r.l for r in languages.fill_languages(spark.createDataFrame(rows, "id long, t string, l string"), {"t": "l"}).collect()}
    assert got == {1: "EN", 2: "JA", 3: "DE", 4: None, 5: "XX", 6: None, 7: None, 8: "VI"}


def test_classifier_on_held_out_sentences():
    rng = random.Random(2)
    asks, others = ["experience", "knowledge", "skills", "fluency"], ["parking", "lunch", "uniform", "station"]
    made = [(f"{rng.choice(['some', 'good', 'near'])} {rng.choice(words)} {rng.choice(['with', 'of', 'at'])} {rng.choice(['tools', 'work', 'plant'])}", y) for words, y in ((asks, 1), (others, 0)) for _ in range(300)]
    rng.shuffle(made)
    model = classifier.Classifier().fit([t for t, _ in made[:300]], [y for _, y in made[:300]])
    assert sum((s >= 0.5) == y for s, (_, y) in zip(model([t for t, _ in made[300:]]), made[300:])) >= 290


class Service:
    """Counts what is asked of it, and fails once."""

    def __init__(self):
        self.asked, self.data, self.polls, self.broken = [], {}, {}, True

    def upload(self, name, data):
        self.asked.append(("upload", name))
        self.data[f"f-{name}"] = data
        return f"f-{name}"

    def create(self, file):
        self.asked.append(("create", file))
        return f"b-{file}"

    def status(self, batch):
        if self.broken:
            self.broken = False
            raise ConnectionError
        self.polls[batch] = self.polls.get(batch, 0) + 1
        return ("completed", f"o-{batch}") if self.polls[batch] > 1 else ("in_progress", None)

    def download(self, file):
        self.asked.append(("download", file))
        out = []
        for line in self.data[file.removeprefix("o-b-")].decode().splitlines():
            r = json.loads(line)
            out.append(json.dumps({"custom_id": r["custom_id"], "response": {"body": {"output": [{"content": [{"text": ""}, {"text": r["body"]["input"].upper()}]}]}}}))
        return "\n".join([*out, "broken"]).encode()


def test_batches_go_on_where_they_stopped(spark, tmp_path):
    made = spark.createDataFrame([(f"t:{i}:title", f"text {i}") for i in range(6)], "custom_id string, input string")
    files.write_requests(made.select("custom_id", F.struct("input").alias("body")).coalesce(1), str(tmp_path / "requests"), 3)
    service, args = Service(), (str(tmp_path / "requests"), str(tmp_path / "results"), str(tmp_path / "state.json"))
    with pytest.raises(ConnectionError):
        remote.run_batches(spark, service, *args, sleep=lambda s: None)
    state = remote.run_batches(spark, service, *args, sleep=lambda s: None)
    assert len(state) == 2 and {x["status"] for x in state.values()} == {"completed"}
    assert sorted(k for k, _ in service.asked) == ["create"] * 2 + ["download"] * 2 + ["upload"] * 2
    remote.run_batches(spark, service, *args, sleep=lambda s: None)
    assert len(service.asked) == 6
    got = remote.read_results(spark, args[1])
    assert {(r.custom_id, r.value) for r in got.collect()} == {(f"t:{i}:title", f"TEXT {i}") for i in range(6)}
    target = spark.createDataFrame([(0, None), (1, "kept"), (9, " ")], "id long, english string")
    assert {r.id: r.english for r in pipeline.apply_batch_results(target, got, {"title": "english"}).collect()} == {0: "TEXT 0", 1: "kept", 9: " "}


def test_steps(spark, tmp_path):
    assert matching.effective_threshold(0.48, False) == 0.53 and matching.effective_threshold(0.48, True) == 0.48 and matching.effective_threshold(0.6, False) == 0.6
    assert pipeline.token_budget(3072, 200, 9, 8) == 2855 and pipeline.token_budget(10, 20, 1, 1) == 0
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id long, t string")
    assert {r.id: r.answer for r in pipeline.generate(df, "t", lambda: lambda xs: [x * 2 for x in xs], batch=1).collect()} == {1: "aa", 2: None, 3: "cc"}
    made = []
    make = lambda: made.append(1) or df
    for model in ("m1", "m1", "m2", "m1"):
        assert pipeline.cached(spark, str(tmp_path / "c"), model, make).count() == 3
    assert len(made) == 2
    x = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("b", "x", 0)], "g string, k string, n long")
    assert {r.g: r.shares for r in stats.share_map(x, ["g"], "k", "n").collect()} == {"a": {"x": 0.25, "y": 0.75}, "b": {}}
    assert upsert.project(df, ["t", "new"]).collect()[0] == ("a", None) and upsert.lacking_columns(df, x) == ["id", "t"] and upsert.without_columns(df, ["t", "no"]).columns == ["id"]
    names = spark.createDataFrame([("x_desc.jsonl",), ("x.jsonl",)], "n string").select(T.output_name(F.col("n"), "_desc", "_skills")).collect()
    assert [r[0] for r in names] == ["x_skills.jsonl", "x_skills.jsonl"]


def test_flag_is_cleared_where_a_cell_was_filled(spark):
    target = spark.createDataFrame([(1, None, 1), (2, "x", 1), (3, " ", 1)], "id long, v string, f int")
    values = spark.createDataFrame([(1, "a", 1), (1, " b ", 2), (1, " ", 3), (2, "c", 1)], "id long, w string, o int")
    assert {r.id: (r.v, r.f) for r in upsert.fill_blanks(target, values, "id", "v", "w", F.col("o"), last=True, flag="f").collect()} == {1: ("b", 0), 2: ("x", 1), 3: (" ", 1)}


def test_collecting_needs_a_master_that_can_be_read(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text('{"id": 1, "url": "a"}\n')
    (tmp_path / "master").mkdir()
    (tmp_path / "master/part-0.parquet").write_text("broken")
    with pytest.raises(Exception):
        collect_daily(spark, str(tmp_path / "in"), "id long, url string", str(tmp_path / "master"), str(tmp_path / "cp"), "url", "id")


def test_first_seen(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text('{"url": "a", "at": "2025-01-01T00:00:00"}\n{"url": "a", "at": "2025-01-01T00:01:00"}\n{"url": "b", "at": "2025-01-01T00:00:00"}\n')
    stream = first_seen(spark.readStream.schema("url string, at timestamp").json(str(tmp_path / "in")), "url", "at", "1 hour")
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
