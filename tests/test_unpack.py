import json

from hypothesis import given
from hypothesis import strategies as st

from adloom.operators.unpack import Grammar, code_grammar, tokens, unpack

G = Grammar(delimiters=",;|、，；・•\n\t", spaced="/", whole=["invoices, receipts and ledgers", "hand/eye inspection methods"])


def test_cases():
    assert tokens('[" a, b ","c"]', G) == ["a, b", "c"]
    assert tokens("['it''s', 'b']", G) == ["it's", "b"]
    assert tokens("a / b/c, d (x, y)", G) == ["a", "b/c", "d (x, y)"]
    assert tokens('- a\n- "b, c"\n- d', G) == ["a", "b, c", "d"]
    assert tokens("x,,y,", G) == ["x", "y"]
    assert tokens("hand/eye inspection methods / b; invoices, receipts and ledgers", G) == ["hand/eye inspection methods", "b", "invoices, receipts and ledgers"]
    assert tokens("S1.1 S2.2\tL3/T1", code_grammar()) == ["S1.1", "S2.2", "L3", "T1"]
    assert tokens('python "a, b" dev, c', G) == ['python "a, b" dev', "c"]
    assert tokens(r"a\, b, c", G) == ["a, b", "c"] and tokens(r"C:\x, d", G) == [r"C:\x", "d"]
    assert tokens("driver's licence, 5\" tools, o'clock", G) == ["driver's licence", '5" tools', "o'clock"]
    assert tokens("(" * 20_000 + "a, b", G) == ["(" * 20_000 + "a", "b"]
    for empty in (None, "", "  ", "[]", ",;"):
        assert tokens(empty, G) == []


@given(st.lists(st.text(alphabet="ab ,;|/\"'xyz", min_size=1).map(str.strip).filter(bool), min_size=1))
def test_json_round_trip(values):
    assert tokens(json.dumps(values), Grammar()) == values


@given(st.text())
def test_never_fails(text):
    assert all(v.strip() for v in tokens(text, G))


def test_table(spark):
    df = spark.createDataFrame([(1, "a; b; a", None, "z"), (1, "a; b; a", "", "z"), (2, "single", "S1 S2", None), (None, "q, r", None, None), (3, "v" * 100_000 + ",w", None, None)], "id long, skills string, codes string, item string")
    got = unpack(df, "id", {"skills": G, "codes": code_grammar()}).collect()
    assert sorted((r.id or 0, r.field_name, r.pos, r.item) for r in got if len(r.item) < 9) == [(0, "skills", 0, "q"), (0, "skills", 1, "r"), (1, "skills", 0, "a"), (1, "skills", 0, "a"), (1, "skills", 1, "b"), (1, "skills", 1, "b"), (1, "skills", 2, "a"), (1, "skills", 2, "a"), (2, "codes", 0, "S1"), (2, "codes", 1, "S2"), (3, "skills", 1, "w")]
    assert unpack(df.limit(0), "id", {"skills": G}).count() == 0
