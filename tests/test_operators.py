import random

from pyspark.sql import functions as F

from adloom.functions import stats, text
from adloom.operators import matching, sentences, upsert
from adloom.operators.components import components
from adloom.operators.keyness import keyness


def test_components_against_union_find(spark):
    random.seed(5)
    edges = [(random.randrange(400), random.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 50)] + [(7, 7)]
    parent = {}

    def find(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        if a != b:
            parent[b] = a
    want = {(x, find(x)) for e in edges if e[0] != e[1] for x in e}
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {tuple(r) for r in got.collect()} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_upserts(spark):
    target = spark.createDataFrame([(1, "u", "old"), (2, None, "keep"), (3, "w", " ")], "id long, url string, v string")
    source = spark.createDataFrame([("u", "a", 1), ("u", None, 2), ("w", " x ", 1), (None, "n", 1), ("", "e", 1), ("new", "p", 1), ("new", "q", 2)], "url string, v string, o int")
    got = {r.id: (r.v, r.matched) for r in upsert.update_from(target, source, ["url"], ["v"], F.col("o")).collect()}
    assert got == {1: (None, True), 2: ("keep", False), 3: (" x ", True)}
    filled = {r.id: r.v for r in upsert.fill_blanks(target, source, "url", "v", "v", F.col("o")).collect()}
    assert filled == {1: "old", 2: "keep", 3: "x"}
    assert sorted(r.v for r in upsert.insert_absent(target, source, "url").collect()) == ["p", "q"]
    first = upsert.insert_absent(target, source, "url", F.col("o"))
    assert [r.v for r in first.collect()] == ["p"]
    assert upsert.insert_absent(target.unionByName(first.select("url", "v"), allowMissingColumns=True), source, "url").count() == 0


def test_g2_is_not_negative_and_symmetric(spark):
    df = spark.createDataFrame([(3, 4, 5, 6), (0, 1, 2, 3), (0, 0, 0, 0), (7, 0, 0, 7)], "a long, b long, c long, d long")
    x = df.select(stats.g2(*(F.col(k) for k in "abcd")).alias("x"), stats.g2(*(F.col(k) for k in "acbd")).alias("y")).collect()
    assert all(r.x >= -1e-9 and abs(r.x - r.y) < 1e-9 for r in x)


def test_keyness(spark):
    rows = [("A", "x")] * 8 + [("A", "y")] * 4 + [("B", "x")] * 4 + [("B", "y")] * 20
    got = keyness(spark.createDataFrame(rows, "g string, d string"), "g", "d").collect()
    assert {(r.g, r.d, r.a) for r in got} == {("A", "x", 8), ("B", "y", 20)}


def test_text(spark):
    df = spark.createDataFrame([(" Translation: English: hi </s>", 'x ["a ", 1, "bc"] y', "0613.59"), (None, 'no list "ab" "c"', "5"), ("  ", None, "")], "t string, s string, c string")
    got = df.select(text.clean_translation(F.col("t")), text.skill_list(F.col("s")), text.top_category(F.col("c"), F.lit("knowledge"))).collect()
    assert [tuple(r) for r in got] == [("hi", ["bc"], "061"), (None, ["ab"], "005"), (None, [], None)]
    assert spark.range(1).select(text.is_blank(F.lit("\t")), text.strip(F.lit("\t a ")), stats.round_js(F.lit(-0.25))).first()[:] == (False, "a", -0.2)


def test_sentences():
    ad = "## Requirements\n- Knowledge of\nSQL databases. Good English\nand French is a plus!\nPay: 100\n\nOK\nYou lead teams."
    # two words without a verb to do can go on, but only where the next line does
    assert sentences.sentences(ad) == ["Knowledge of", "SQL databases.", "Good English", "and French is a plus!", "You lead teams."]
    assert sentences.sentences("Tools such as\nthe press,\nand the saw\n* Other line here") == ["Tools such as the press, and the saw", "Other line here"]
    assert sentences.sentences(None) == [] and sentences.sentences(" ") == []


def test_matching(spark):
    titles = spark.createDataFrame([("Data Clerk", "1"), ("R&D clerk", "2"), ("clerk", "3")], "title string, code string")
    terms = spark.createDataFrame([("data clerk",), ("rd Clerk",), ("night data clerk x",), (None,)], "term string")
    steps = {r.term: (r.code, r.step) for r in matching.exact_steps(terms, titles, "term", "title", "code").collect()}
    assert steps["data clerk"] == ("1", "exact") and steps["rd Clerk"] == ("2", "bare") and steps[None] == (None, None)
    assert {r.term: r.code for r in matching.longest_contained(terms, titles, "term", "title", "code").collect()} == {"data clerk": "1", "rd Clerk": "3", "night data clerk x": "1", None: None}
    assert {r.term: r.code for r in matching.fuzzy(terms, titles, "term", "title", "code").collect()}["night data clerk x"] == "1"


def test_dissimilarity_and_polarization(spark):
    df = spark.createDataFrame([("JP", g, d, e, False) for g, d, e in ((0, 5.0, 1.0), (1, 10.0, 4.0), (2, 20.0, 16.0), (5, 30.0, None), (9, 35.0, 80.0))], "cc string, g int, d double, e double, m boolean")
    assert stats.dissimilarity(df, ["cc"], "g", "d", "e", "m").first().dissimilarity == 42.5
    assert stats.polarization(df, ["cc"], "g", "d", "e", "m").first().polarization == 25.0
