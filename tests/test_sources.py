import sqlite3

from pyspark.sql import functions as F

from adloom.sources.files import in_year, read_dictionary, read_jsonl, write_jsonl, write_requests
from adloom.sources.sqlite import read_sqlite, spark_type, sqlite_tables
from adloom.streaming.incremental import collect_daily, pending, process_new_files


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1, "value": "x"}\n\nbroken\n{"value": "no id"}\n')
    df = read_jsonl(spark, str(tmp_path / "a.jsonl"), "id long, value string")
    assert [tuple(r) for r in df.collect()] == [(1, "x")]
    write_jsonl(df, str(tmp_path / "out"), "id")
    assert spark.read.json(str(tmp_path / "out")).count() == 1
    write_requests(spark.range(25).coalesce(1), str(tmp_path / "requests"), 10)
    assert len(list((tmp_path / "requests").glob("*.json"))) == 3


def test_dictionary(spark, tmp_path):
    (tmp_path / "d.csv").write_text('conceptUri,preferredLabel,description\nu1,cook,"two\nlines ""q"""\nu2,,x\n')
    assert [r.preferredLabel for r in read_dictionary(spark, str(tmp_path / "d.csv")).collect()] == ["cook"]


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "x.db")
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE jobads_jp (id INTEGER, t TEXT, amount REAL)")
        c.executemany("INSERT INTO jobads_jp VALUES (?, ?, ?)", [(i, f"t{i}" if i % 3 else None, i / 2) for i in range(50)])
        c.execute("CREATE TABLE jobads_empty (id INTEGER)")
    df = read_sqlite(spark, path, "jobads_jp")
    assert df.count() == 50 and df.where("t is null").count() == 17 and df.agg(F.sum("amount")).first()[0] == 612.5
    assert read_sqlite(spark, path, "jobads_empty").count() == 0
    assert sqlite_tables(path, "jobads_") == ["jobads_empty", "jobads_jp"]
    assert [spark_type(x) for x in ("POINT", "VARCHAR(9)", "DOUBLE", "DATETIME", "")] == ["bigint", "string", "double", "string", "string"]


def test_year(spark):
    df = spark.createDataFrame([("2025-12-31",), ("2026-01-01",), ("2027-01-01",)], "d string")
    assert in_year(df, "d", 2026).count() == 1 and in_year(df, "none", 2026).count() == 3


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "1.json").write_text('{"id": 1, "url": "a"}\n{"id": 2, "url": "b"}\n{"id": 3, "url": "a"}\n{"url": "x"}\n')
    args = (spark, str(src), "id long, url string")
    process_new_files(*args, lambda s: s.withColumn("n", F.length("url")), str(tmp_path / "out"), str(tmp_path / "cp"))
    process_new_files(*args, lambda s: s.withColumn("n", F.length("url")), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    collect_daily(*args, str(tmp_path / "master"), str(tmp_path / "cp2"), "url", "id")
    (src / "2.json").write_text('{"id": 4, "url": "b"}\n{"id": 5, "url": "c"}\n')
    collect_daily(*args, str(tmp_path / "master"), str(tmp_path / "cp2"), "url", "id")
    assert sorted(r.url for r in spark.read.parquet(str(tmp_path / "master")).collect()) == ["a", "b", "c", "x"]
    assert pending(spark.range(5), spark.createDataFrame([(1,), (None,)], "id long")).count() == 4
