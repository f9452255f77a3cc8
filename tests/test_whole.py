import datetime

from pyspark.sql import functions as F

import __spark_entry__ as entry
from adloom.functions import text
from adloom.operators import matching


def test_days(spark):
    values = ["2025-10-13", "2025-10-13T21:10:52", "2025/10/14", "13.10.2025", " 2025-1-2 03:04", "3.1.2025", "2025-10-13T23:30:00Z", "2025-13-40", "31.02.2025", "本日", "30+ days ago", "", None]
    got = [r.d for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").orderBy("i").select(text.day(F.col("v")).alias("d")).collect()]
    want = [(2025, 10, 13), (2025, 10, 13), (2025, 10, 14), (2025, 10, 13), (2025, 1, 2), (2025, 1, 3), (2025, 10, 13)]
    assert got == [datetime.date(*d) for d in want] + [None] * 6


def run(spark, folder, name, **tables):
    """A query over small tables."""
    for k, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{k}.parquet")
    return entry.queries()[name](spark, str(folder))


def test_months_posted_counts_every_readable_day(spark, tmp_path):
    values = ["2025-10-13", "2025-10-13T21:10:52", "2025/10/14", "13.10.2025", "30+ days ago", None]
    got = run(spark, tmp_path, "agg12_months_posted", jobads_jp=([(i, v) for i, v in enumerate(values)], "id long, date_posted string"))
    assert [tuple(r) for r in got.collect()] == [("2025-10", 4)]


def test_regroup_keeps_repeated_ids(spark, tmp_path):
    a, b = [("u", "x", 0.5), ("v", "y", 0.5)], [("w", "z", None)]
    got = run(spark, tmp_path, "arr03_regroup", jp_mentions=([(1, a), (1, a), (2, b)], "id long, skills array<struct<uri:string,label:string,score:double>>"))
    assert {tuple(r) for r in got.collect()} == {(1, "x|y"), (2, "z")}


def test_checkpoint_returns_every_row(spark, tmp_path):
    rows = [(1, "a", None), (2, " b　", " "), (3, None, None), (4, "\tc", "kept"), (5, "\xa0", "")]
    kind = "id long, job_title string, job_title_english string, employer string, job_title_lang string, needs_title_translation int"
    got = run(spark, tmp_path, "joi07_apply_checkpoint", jobads_jp=([(*r, None, "JA", 1) for r in rows], kind))
    assert {r.id: r.job_title_english for r in got.collect()} == {1: "a", 2: "b", 3: None, 4: "kept", 5: ""}
    # the last of an id counts if it isn't blank, and the flag goes where a cell was filled
    again = run(spark, tmp_path / "again", "joi07_apply_checkpoint", jobads_jp=([(*r, " early ", "JA" if r[0] != 2 else None, 1) for r in rows], kind))
    assert {r.id: (r.job_title_english, r.needs_title_translation) for r in again.collect()} == {1: ("a", 0), 2: ("early", 0), 3: ("early", 0), 4: ("kept", 1), 5: ("early", 0)}


def test_fuzzy_scores_titles_without_a_shared_word(spark):
    titles = ["negotiation", "team work", "data clerk", "clerk", "nursing care", "care"]
    words = ["negotiations", "teamwork", "clerks of data", "nursin car", "data clerks", "zzz", "ab"]
    table = spark.createDataFrame([(t, str(i)) for i, t in enumerate(titles)], "title string, code string")
    got = {r.term: (r.code, r.score) for r in matching.fuzzy(spark.createDataFrame([(w,) for w in words], "term string"), table, "term", "title", "code").collect()}
    assert got["negotiations"][0] == "0" and got["teamwork"][0] == "1"
    for w in words:
        x = set(w.split())
        best = min((-text.token_set_ratio(x, set(t.split())), -len(x & set(t.split())), str(i)) for i, t in enumerate(titles))
        assert got[w] == ((best[2], -best[0]) if -best[0] >= 82 and len(w) > 2 else (None, None))
