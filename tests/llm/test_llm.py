import itertools
import math
import os
import random
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from adloom.llm import bpe, canon, langid, packing, pairs
from adloom.llm.copies import collapsed, copy_groups, fingerprints, same
from adloom.llm.encoding import encode_corpus
from adloom.llm.neardup import similar_groups, similarity, version_groups
from adloom.llm.normal import bare
from adloom.llm.packing import fill_containers, pack
from adloom.llm import queries as production
from adloom.llm.splitting import split_long


@pytest.fixture(scope="module")
def encoder():
    return bpe.encoder()


@pytest.fixture(scope="module")
def reference():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda texts: [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def ids(encoder, texts):
    flat, counts = encoder.encode(texts)
    ends = np.cumsum(counts)
    return [flat[e - c : e].tolist() for e, c in zip(ends, counts)]


ODD = ["", "a", " ", "  ", "\n", "don't I'll 's ''s 'str we've'd x'll' 'S", "a  b", "a \n b", " \n", "\n a", "　あ い", "①②x²Ⅷ", "foo 's", "\n's", "a\x00b\x1c\x1d c", "é́", "<|endoftext|>", "x" * 5000, "あ" * 3000, "😀😀 a", "'re'", "\r\n\r\n a"]


def test_encoding_of_odd_texts(encoder, reference):
    assert ids(encoder, ODD) == reference(ODD)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("ab's tlre dm\n\t 0１漢あ.,'\"　 éß"), st.characters(codec="utf-8"))), max_size=6))
def test_encoding_is_the_tokenizers(encoder, reference, texts):
    assert ids(encoder, texts) == reference(texts)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcde lowernight", max_size=30), st.text(alphabet="abcde lowernight", max_size=12), st.integers(0, 30), st.integers(0, 30))
def test_appends_and_edits(encoder, a, b, i, j):
    table = bpe.PrefixTable(encoder.v, a.encode())
    table.append(b.encode())
    assert table.ids() == bpe.PrefixTable(encoder.v, (a + b).encode()).ids()
    i, j = sorted((min(i, len(a + b)), min(j, len(a + b))))
    table.replace(i, j, b"new")
    assert table.ids() == bpe.PrefixTable(encoder.v, ((a + b)[:i] + "new" + (a + b)[j:]).encode()).ids()


@pytest.fixture(scope="module")
def public():
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("b", pat_str=r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""", mergeable_ranks=bpe.load_ranks(bpe.DEFAULT_TOKENIZER), special_tokens={})


def test_unbroken_texts(encoder, public):
    random.seed(12)
    words = ["warehouse", "kitchen", "night", "shift", "Straße", "厨房", "募集", "ação"]
    texts = ["".join(random.choice(words) for _ in range(3000)), "x" * 9000, "ab" * 4000, "-" * 7000 + "=" * 5000, "".join(random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000)), "漢字" * 3000, "".join(chr(random.randrange(0x4E00, 0x9FFF)) for _ in range(4000))]
    assert ids(encoder, texts) == [public.encode_ordinary(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "aa", "lower", "night", "é", "漢", "----", "=", "\u0301", "zq"]), min_size=1, max_size=400), st.integers(1, 12))
def test_windows_are_exact(encoder, parts, times):
    data = ("".join(parts) * times).encode()
    flat, _ = encoder.v.encode_many(np.frombuffer(data, np.uint8), np.array([len(data)]))
    assert encoder.v.encode_long(np.frombuffer(data, np.uint8)).tolist() == flat.tolist()


def test_pieces_with_one_hash(public, monkeypatch):
    monkeypatch.setattr(bpe.Encoder, "_hashes", lambda self, codes, starts, lens: (lens % 2).astype(np.uint64))
    e = bpe.Encoder(bpe.load_ranks(bpe.DEFAULT_TOKENIZER))
    for texts in (["some words of a text", "other words, longer ones"], ["words again", "", "some new words"]):
        assert ids(e, texts) == [public.encode_ordinary(t) for t in texts]


def test_encode_table(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", None), (2, "hello world", "ids"), (None, " ", "y")], "doc_id long, text string, ids string")
    got = sorted((r.doc_id or 0, list(r.ids)) for r in encode_corpus(df, "doc_id", "text").collect())
    assert got == [(0, [220]), (1, []), (2, []), (2, [31373, 995])]
    assert encode_corpus(df.limit(0), "doc_id", "text").count() == 0


@given(st.lists(st.integers(1, 100)))
def test_packing(sizes):
    where = pack(np.array(sizes, np.int64), 100)
    assert len(where) == len(sizes)
    if sizes:
        fill = np.bincount(where, sizes)
        assert fill.max() <= 100 and set(where) == set(range(where.max() + 1))
        assert len(fill) <= 2 * -(-sum(sizes) // 100)


def test_packing_wastes_little_and_balances():
    rng = np.random.default_rng(5)
    sizes = np.minimum(2047, np.maximum(1, rng.lognormal(5.3, 1.1, 20_000))).astype(np.int64)
    where = pack(sizes, 2048)
    fill = np.bincount(where, sizes)
    assert fill.max() <= 2048 and len(fill) <= 1.002 * sizes.sum() / 2048 + 1
    # first fit descending, which doesn't look at costs
    room, other = [], []
    for s in sorted(sizes.tolist(), reverse=True):
        k = next((k for k, r in enumerate(room) if r >= s), len(room))
        if k == len(room):
            room.append(2048)
            other.append(0.0)
        room[k] -= s
        other[k] += s + s * s / 1024
    cost = packing.cost_of(sizes, where)
    print(f"fill {sizes.sum() / 2048 / len(fill):.4f}, costs {cost.mean():.0f} with a deviation of {cost.std():.0f} against {np.std(other):.0f} of first fit")
    assert cost.std() < 0.9 * np.std(other)


def test_containers_of_null_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 50)
    rows = [(None, f"text {i} " * (i % 90 + 1)) for i in range(300)] + [(7, "same words " * 40)] * 300
    df = spark.createDataFrame(rows, "id long, text string")
    got = sorted(str(tuple(r)) for r in fill_containers(df, "id", "text").collect())
    assert len(got) == 600 and len({r.split("'")[1].split("_")[0] for r in got}) >= 10
    assert got == sorted(str(tuple(r)) for r in fill_containers(df.repartition(5), "id", "text").collect())


def test_containers(spark, encoder):
    texts = [(i, "word " * n) for i, n in enumerate([1, 10, 300, 3000, 5000, 40, 40, 40])] + [(50, None), (51, ""), (3, "again")]
    got = fill_containers(spark.createDataFrame(texts, "id long, text string"), "id", "text").collect()
    fill = {}
    for r in got:
        fill[r.container] = fill.get(r.container, 0) + r.n_tokens
    assert max(fill.values()) <= 2048
    assert sum(fill.values()) == sum(len(x) for x in ids(encoder, [t for _, t in texts if t]))
    assert {r.id for r in got if r.part} == {3, 4} and len({(r.container, r.position) for r in got}) == len(got)
    assert fill_containers(spark.createDataFrame([], "id long, text string"), "id", "text").count() == 0


def test_pieces(spark, encoder):
    random.seed(2)
    long = "\n\n".join(" ".join(random.choice(["alpha", "beta", "gamma."]) for _ in range(random.randint(1, 90))) for _ in range(40))
    texts = [(1, long), (2, "あ" * 3000), (3, "short"), (4, None), (5, ""), (6, "x\n\n\n" * 900), (7, "x" * 9000), (7, "w " * 600)]
    got = {}
    for r in split_long(spark.createDataFrame(texts, "id long, text string"), "id", "text").orderBy("id", "piece").collect():
        got.setdefault(r.id, []).append(r)
    assert set(got) == {1, 2, 6, 7}
    for i, rows in got.items():
        for r, n in zip(rows, encoder.sizes([r.text for r in rows]).tolist()):
            assert r.n_tokens == n <= 512
    for i in (1, 2, 6):
        text, rows = dict(texts)[i], got[i]
        assert rows[0].start == 0 and rows[-1].end == len(text)
        for a, b in zip(rows, rows[1:]):
            assert b.start < a.end < b.end and text[b.start : b.end] == b.text
            assert 25 <= encoder.sizes([text[b.start : a.end]])[0] <= 70
    assert all(r.text.endswith("\n") for r in got[1][:-1])


COPIES = [
    (1, "Cook", "ACME", "One two.\nThree!", 0), (2, "acme", "ＣＯＯＫ", "three\none-two", 0), (3, "Cook", "ACME", "One two. Three", 0),
    (4, "Cook", "ACME", "Three. One two", 0), (5, "Cook", None, "One two.\nThree!", 0), (6, "Cook", "ACME", " ", 0), (7, None, "x", "y", 0), (8, "", "X", "Y!", 0), (None, "Cook", "ACME", "One two.\nThree!", 0),
]


def test_copies(spark):
    df = spark.createDataFrame(COPIES, "id long, t string, e string, r string, first_id int")
    got = {(r.first_id, r.copy_id) for r in copy_groups(df, "id", ("t", "e"), "r", ("e", "r")).collect()}
    assert got == {(1, 2), (1, 3), (1, 4), (7, 8)}  # 4 through 2
    assert copy_groups(df.limit(0), "id", ("t", "e"), "r", ("e", "r")).count() == 0
    assert {tuple(r) for r in collapsed(df.unionAll(df), "id", ("t", "e"), "r", ("e", "r")).collect()} == {(1, 4), (5, 1), (6, 1), (7, 2)}
    assert collapsed(df.limit(0), "id", ("t", "e"), "r", ("e", "r")).count() == 0
    assert fingerprints(["a", "b"], "x\ny") == fingerprints(["B", "A"], "x\ny") and not same(["a", "b"], "x\nx", ["a", "b"], "x")


def test_versions_against_brute_force(spark):
    random.seed(11)
    words = ["".join(random.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    rows = []
    for g in range(25):
        base = [random.choice(words) for _ in range(60)]
        for _ in range(random.randint(1, 5)):
            v = list(base)
            for _ in range(random.randint(0, 9)):
                v[random.randrange(len(v))] = random.choice(words)
            rows.append((len(rows) + 1, "t", "e", " ".join(v)))
    hot = [(1000 + i, f"t{i}", "e", rows[0][3] + f" {i % 150}") for i in range(300)]  # a bucket above BUCKET
    rows += hot + [(5000, "t", "e", None), (5001, "t", "e", " ,"), (5002, "t", "e", "ab"), (5003, "u", "e", "AB!"), (5004, "t", "e", "copy of me"), (5005, "T", "E", "copy, of me")]
    parent = {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    texts, links = [(r[0], bare(r[3])) for r in rows if bare(r[3])], []
    for k, (i, x) in enumerate(texts):
        for j, y in texts[:k]:
            if i < 1000 or find(i) != find(j):
                if (sim := similarity(x, y, 5)) >= 0.6:
                    links.append((i, j, sim))
                    a, b = sorted((find(i), find(j)))
                    parent[b] = a
    df = spark.createDataFrame(rows, "id long, t string, e string, r string")
    groups, _ = similar_groups(df, "id", "r")
    group = {r.id: r.component for r in groups.collect()}
    # nothing is joined that isn't connected; of the links nearly all are kept, and all of those that aren't near the threshold
    assert all(find(x) == find(c) for x, c in group.items())
    kept = [group.get(i) is not None and group.get(i) == group.get(j) for i, j, _ in links]
    assert sum(kept) >= 0.95 * len(links)
    assert all(k for k, (_, _, sim) in zip(kept, links) if sim >= 0.75)
    got = {(r.first_id, r.version_id) for r in version_groups(df, "id", "r", ("t", "e"), ("e", "r")).collect()}
    assert (5002, 5003) in got and (5004, 5005) not in got and not {5000, 5001} & {x for p in got for x in p}
    assert similar_groups(df.limit(0), "id", "r")[0].count() == 0


def levenshtein(x, y):
    r = list(range(len(y) + 1))
    for i, c in enumerate(x):
        q = [i + 1]
        for k, d in enumerate(y):
            q.append(min(q[-1] + 1, r[k + 1] + 1, r[k] + (c != d)))
        r = q
    return r[-1]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abcé", min_size=1, max_size=64), st.lists(st.text(alphabet="abcé", max_size=40), min_size=1, max_size=8))
def test_distances(pattern, values):
    codes, lens = canon._codes(values)
    assert canon.distances(pattern, codes, lens).tolist() == [levenshtein(pattern, v) for v in values]


def test_tree_finds_all_within():
    random.seed(3)
    entries = ["".join(random.choice("abc") for _ in range(random.randint(1, 8))) for _ in range(150)]
    values = ["".join(random.choice("abc") for _ in range(random.randint(1, 8))) for _ in range(60)]
    for v, got in zip(values, canon.Tree(entries).within(values, 2)):
        assert {e for _, e in got} == {e for e in entries if levenshtein(e, v) <= 2}


OCCUPATIONS = [("1", "data clerk", ["records clerk", "data department head"]), ("2", "data manager", []), ("3", "tea blending engineer", ["leaf mixing engineer"]), ("4", "tea blending clerk", None)]


def test_canonical(spark):
    c = canon.Canon(OCCUPATIONS)
    cases = {"Data Clerk": "1", "Senior dta clerk (night shift)": "1", "clerk, data": "1", "Manager for data in Aotsuki": "2", "TEA-BLENDING ENGR. #4711": "3", "teablending clerks | 900 yen/h": "4", "leaf mixing enigneer": "3", "data engineer": "none", "sword polisher": "none", "x": "none", "!": "none", "[Urgent] Data department head / weekends off": "1"}
    assert dict(zip(cases, c.find(list(cases)))) == cases
    df = spark.createDataFrame([(1, "data clerk", "q"), (2, "Data Clerk", None), (3, None, "q"), (4, " ", "q"), (2, "zzz " * 9000, None)], "id long, t string, code string")
    entries = spark.createDataFrame(OCCUPATIONS, "code string, title string, alt_titles array<string>")
    got = canon.canonical_codes(df, "id", ("t",), entries, "code", "title", "alt_titles").collect()
    assert sorted(tuple(r) for r in got) == [(2, "t", "1"), (2, "t", "none")]
    assert canon.canonical_codes(df, "id", ("t",), entries.limit(0), "code", "title", "alt_titles").where("code <> 'none'").count() == 0


def test_shards_find_the_same(spark, monkeypatch):
    random.seed(6)
    fields, heads = ["tea blending", "data", "ferry deck", "stone wall", "night market", "payroll"], ["clerk", "manager", "engineer", "planner", "inspector"]
    rows = [(str(i), f"{f} {h}", [f"{h} for {f}"]) for i, (f, h) in enumerate(itertools.product(fields, heads)) if i % 4]
    values = []
    for k in range(300):
        v = list(f"{random.choice(fields)} {random.choice(heads)}")
        for _ in range(random.randrange(3)):
            v[random.randrange(len(v))] = random.choice("abcdefgh ")
        values.append((k, random.choice(["", "Senior ", "[x] "]) + "".join(v)))
    df = spark.createDataFrame([*values, (9999, "sword polisher"), (9999, " "), (9998, None)], "id long, t string")
    entries = spark.createDataFrame(rows, "code string, title string, alt_titles array<string>")
    want = sorted(tuple(r) for r in canon.canonical_codes(df, "id", ("t",), entries, "code", "title", "alt_titles").collect())
    assert {c for _, _, c in want} >= {"none", "1"} and (9999, "t", "none") in want
    monkeypatch.setattr(canon, "SHARD", 7)
    assert sorted(tuple(r) for r in canon.canonical_codes(df, "id", ("t",), entries, "code", "title", "alt_titles").collect()) == want


def test_a_long_list(monkeypatch):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(4, 9)))
    heads, fields = [word() for _ in range(5000)], [word() for _ in range(3000)]
    rows = [(str(i), f"{rng.choice(fields)} {rng.choice(heads)}", []) for i in range(50_000)]
    began = time.time()
    c = canon.Canon(rows)
    assert time.time() - began < 60 and len(c.code) <= 50_000
    some = rng.sample(rows, 40)
    slip = [(code, t[:2] + t[3:]) for code, t, _ in some]
    assert sum(x == code for (code, _), x in zip(slip, c.find([v for _, v in slip]))) >= 36
    assert c.find([f"{'x' * 70} {heads[0]}"]) == ["none"]


@given(st.text(alphabet="ab", min_size=65, max_size=80), st.lists(st.text(alphabet="ab", max_size=80), min_size=1, max_size=4))
@settings(max_examples=20, deadline=None)
def test_long_distances(pattern, values):
    codes, lens = canon._codes(values)
    assert canon.distances(pattern, codes, lens).tolist() == [levenshtein(pattern, v) for v in values]


TEXTS = {
    "en": ["We look for a cook who likes working in the evening.", "The kitchen is open from nine and you will help the team.", "You can start with the preparation of the dough."],
    "de": ["Wir suchen eine Person für die Küche und den Empfang.", "Die Schicht beginnt um neun Uhr und endet am Abend.", "Sie helfen bei der Vorbereitung des Teigs."],
    "pt": ["Procuramos uma pessoa para a cozinha e a recepção.", "O turno começa às nove e termina depois da tarde.", "Você ajuda na preparação da massa."],
    "ja": ["厨房と受付の担当を募集しています。", "シフトは九時に始まります。"],
    "zh": ["我们在工厂招聘负责厨房的人员。", "班次从九点开始。"],
    "ko": ["주방 담당 직원을 모집합니다.", "근무는 아홉 시에 시작합니다."],
}


@pytest.fixture(scope="module")
def model():
    return langid.Model([(k, " ".join(v)) for k, v in TEXTS.items() for _ in range(5)])


def test_segments(model):
    for lang, v in TEXTS.items():
        assert [s[0] for s in langid.segments("\n".join(v), model)] == [lang]
    mixed = " ".join(TEXTS["en"]) + "\nNo.123\n" + "".join(TEXTS["ja"]) + " / " + " ".join(TEXTS["de"])
    got = langid.segments(mixed, model)
    assert [s[0] for s in got] == ["en", "ja", "de"] and all(0 <= s[3] <= 1 for s in got)
    for nothing in ("", " ", None, "123\n---"):
        assert langid.segments(nothing, model) == []


def test_foreign_words_don_t_decide(model):
    # a few characters of another script inside a sentence
    for text, lang in (("We are looking for a cook at the restaurant さくら in Tokyo, please apply by phone today.", "en"), ("주방(カメラ) 담당 직원을 모집합니다.", "ko"), ("厨房と受付の担当を Web system で募集しています。", "ja"), ("Please contact 田中 for the details.", "en")):
        assert [s[0] for s in langid.segments(text, model)] == [lang], text


def test_confidence_is_the_posterior(model):
    scores = [{"en": 0.0, "de": -1.0}, {"en": -2.0, "de": 0.0}, {"en": 0.0, "de": -0.5}]
    toll = math.exp(-langid.SWITCH)
    weight = {}
    for path in itertools.product(("en", "de"), repeat=3):
        w = 1.0
        for k, x in enumerate(path):
            w *= math.exp(scores[k][x]) * (1 if not k else (1 - toll) * (x == path[k - 1]) + toll)
        weight[path] = w
    for k, sure in enumerate(langid._posteriors(["en"] * 3, scores, langid.SWITCH)):
        assert abs(sure - sum(w for p, w in weight.items() if p[k] == "en") / sum(weight.values())) < 1e-9


def test_labels(spark, model):
    rows = [(1, " ".join(TEXTS["de"]), "DE", "Küche", "EN", None), (2, TEXTS["ja"][0], None, "受付スタッフ", "ja", "x"), (3, None, "EN", " ", None, None), (4, TEXTS["en"][0] * 3000, " en ", None, None, None)]
    df = spark.createDataFrame(rows, "id long, b string, bl string, t string, tl string, e string")
    got = {(r.id, r.field_name): (r.lang, r.label_right) for r in langid.language_labels(df, "id", "b", "bl", "t", "tl", "e", model).collect()}
    assert got[1, "b"] == ("de", True) and got[2, "b"] == ("ja", False) and got[2, "t"] == ("ja", True) and got[4, "b"] == ("en", True) and (3, "b") not in got and (3, "t") not in got
    assert langid.language_labels(df.limit(0), "id", "b", "bl", "t", "tl", "e", model).count() == 0


def test_pairs(spark, model):
    random.seed(4)
    ja = ["厨房の掃除を毎日お任せします。", "受付の担当を募集しています。", "シフトは平日の9時に始まります。", "制服は貸与します。", "駐車場は会社の前に20台分あります。", "昼食は休憩室で300円から食べられます。"]
    en = ["Cleaning the kitchen is your daily task.", "We look for someone at the reception desk.", "The shift starts at 9 in the morning.", "Uniforms are lent out by the company.", "There is parking for 20 cars outside.", "The lunch costs 300 yen here."]
    sound = []
    for _ in range(300):
        k = random.sample(range(6), 5)
        sound.append(("\n".join(ja[i] for i in k), "\n".join(en[i] for i in k)))
    titles = ["warehouse stock clerk", "hotel reception manager", "school kitchen clerk"] * 30
    extra = langid.Model([(k, " ".join(v)) for k, v in (TEXTS | {"en": TEXTS["en"] + en}).items() for _ in range(5)] + [("en", t) for t in titles])
    j = pairs.Judge(sound, list(zip(["倉庫在庫スタッフ", "ホテル受付の責任者", "学校給食の調理補助"] * 30, titles)), extra)
    q, a = sound[0]
    assert j.text(q, a) is None and j.text(q, "Translation:\n" + a) is None
    assert j.text(q, "[no output]") == "empty" and j.text(q, "Translation:") == "empty"
    assert j.text(q, "I'm sorry, but I can't translate this text.") == "refusal"
    assert j.text(q, q) == "copy" and j.text(q, "Translation: " + q.replace("\n", " ")) == "copy"
    assert j.text(q, " ".join(TEXTS["pt"] * 2)) == "other_language"
    assert j.text(q, "\n".join(a.split("\n")[:2])) == "truncated"
    assert j.text(q, a[: a.rindex(" ") - 9]) == "truncated"
    assert j.text(q[:-6] + "…", a[: a.rindex(" ")] + "…") is None
    assert j.title("倉庫在庫スタッフ", "School kitche") == "truncated" and j.title("倉庫在庫スタッフ", "warehouse stock clerk") is None
    assert j.title("倉庫在庫スタッフ", "倉庫在庫スタッフ") == "copy" and j.title("倉庫在庫スタッフ", "N/A") == "empty" and j.title("倉庫在庫スタッフ", "店員さんを募集") == "other_language"
    # every defect but empty comes from the tags
    cases = [(q, "I'm sorry, but I can't translate this text."), (q, q), (q, " ".join(TEXTS["pt"] * 2)), (q, "\n".join(a.split("\n")[:2]))]
    assert [j.text(*c) for c in cases] == ["refusal", "copy", "other_language", "truncated"] and j.title("倉庫在庫スタッフ", "倉庫在庫スタッフ") == "copy"
    tag, j.field.tag = j.field.tag, lambda seq: [pairs.ANSWER] * len(seq)
    assert [j.text(*c) for c in cases] == [None] * 4 and j.title("倉庫在庫スタッフ", "School kitche") is j.title("倉庫在庫スタッフ", "倉庫在庫スタッフ") is None
    j.field.tag = tag
    df = spark.createDataFrame([(1, q, a, "t", "clerk"), (2, None, "", None, ""), (3, q, None, "題", None), (4, q, " ", " ", "x"), (5, q * 400, a * 400, "題名", "-")], "id long, q string, a string, tq string, ta string")
    got = sorted(tuple(r) for r in pairs.broken_pairs(df, "id", ("q", "a"), ("tq", "ta"), j).collect())
    assert [r for r in got if r[0] != 1] == [(4, "a", "empty"), (5, "ta", "empty")]
    assert pairs.broken_pairs(df.limit(0), "id", ("q", "a"), ("tq", "ta"), j).count() == 0


def recall_of_pairs(spark, boilerplate, similar, groups, seed):
    """Planted pairs of about one similarity whose texts all hold one boilerplate: the share of links found, by brute force over the pairs."""
    from adloom.llm import neardup

    rng = random.Random(seed)

    def some(n, letters):
        return "".join(rng.choice(letters) for _ in range(n))

    total = 1200
    base = some(int(total * boilerplate), "abcdefghij")
    rows, links = [], []
    for g in range(groups):
        own = some(total - len(base), "klmnopqrst")
        edit = round(total * (1 - similar) / (1 + similar))
        at = rng.randrange(len(own) - edit + 1)
        pair = (base + own, base + own[:at] + some(edit, "uvwxyz") + own[at + edit :])
        if similarity(*pair, 5) >= 0.6:
            links.append((2 * g, 2 * g + 1))
        rows += [(2 * g, pair[0]), (2 * g + 1, pair[1])]
    cross = similarity(rows[0][1], rows[2][1], 5)
    assert cross < 0.6
    found = {r.id: r.component for r in neardup.similar_groups(spark.createDataFrame(rows, "id long, r string"), "id", "r")[0].collect()}
    assert all(c in (i, i - 1) for i, c in found.items())
    got = sum(found.get(a) is not None and found.get(a) == found.get(b) for a, b in links) / len(links)
    print(f"recall of {len(links)} pairs near {similar}, {cross:.2f} to all others: {got:.3f}")
    return got


@pytest.mark.parametrize("boilerplate,similar,groups", [(0.0, 0.65, 150), (0.715, 0.63, 300)])
def test_recall_near_the_threshold(spark, boilerplate, similar, groups):
    assert recall_of_pairs(spark, boilerplate, similar, groups, 3) >= 0.9


def test_prefixes_are_shortened_to_the_target():
    from adloom.llm import neardup

    for threshold in (0.5, 0.6, 0.8, 0.95):
        n = neardup.prefix_length(threshold)
        assert neardup.recall_at(threshold, n) >= neardup.TARGET > neardup.recall_at(threshold, n + 1) or n == 64
    assert neardup.prefix_length(0.6) == 4


def test_blocks_don_t_change_the_result(spark, monkeypatch):
    from adloom.llm import neardup

    random.seed(3)
    base = "".join(random.choice("abcdefghij") for _ in range(900))
    rows = []
    for g in range(40):
        own = "".join(random.choice("klmnopqrst") for _ in range(700))
        rows += [(2 * g + 1, base + own), (2 * g + 2, base + own[:360] + "".join(random.choice("uvwxyz") for _ in range(340)))]
    df = spark.createDataFrame(rows, "id long, r string")
    want = {r.id: r.component for r in similar_groups(df, "id", "r")[0].collect()}
    assert sum(want.get(2 * g + 1) == want.get(2 * g + 2) == 2 * g + 1 for g in range(40)) >= 36
    monkeypatch.setattr(neardup, "BLOCK", 3)
    monkeypatch.setattr(neardup, "PAIRS", 7)
    groups, members = similar_groups(df, "id", "r")
    assert {r.id: r.component for r in groups.collect()} == want
    assert set(want) <= {r.id for r in members.select("id").collect()}


def test_repeated_ids_of_versions(spark):
    random.seed(8)
    a, b, c = ("".join(random.choice("abcdefghij") for _ in range(300)) for _ in range(3))
    df = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b + "x"), (4, c), (4, c), (None, a)], "id long, r string")
    assert {tuple(r) for r in similar_groups(df, "id", "r")[0].collect()} == {(1, 1), (2, 1), (3, 1)}


ADS = "/root/testdata/sf0.01/jobads_jp.parquet"
#: Refusals in words that the field hasn't seen.
UNSEEN = ("This isn't something I'm able to do for you.", "Regrettably, translating this is beyond what I may do.", "I don't have the ability to translate that document.", "We regret that this text will not be translated.", "私はこの文章を訳すことができません。", "我不能翻译这个。", "이 요청은 처리할 수 없습니다.", "Não posso fazer isso.", "Ich kann das nicht tun.")


@pytest.fixture(scope="module")
def fitted():
    """A judge of the even ads, and the sound pairs of the odd ones."""
    pq = pytest.importorskip("pyarrow.parquet")
    if not os.path.exists(ADS):
        pytest.skip("the test tables aren't here")
    rows = pq.read_table(ADS).to_pylist()
    model = langid.fit(rows[::2], production.LABELS)
    judge = pairs.fit_judge(rows[::2], production.TEXTS, production.TITLES, model)
    odd = [r for r in rows[1::2] if r["responsibilities"] and r["description_english"] and len(r["description_english"]) > 300 and len(r["responsibilities"]) > 100]
    return judge, [(r["responsibilities"], r["description_english"]) for r in odd if judge.text(r["responsibilities"], r["description_english"]) is None], rows


def test_pairs_on_held_out_ads(fitted):
    judge, sound, rows = fitted
    rng = random.Random(7)
    right = {"copy": [], "other_language": [], "truncated": [], "refusal": [], None: []}
    foreign = [(q, a) for q, a in sound if not judge._is_english(pairs.clauses(pairs.nfkc(q)))]
    for k, (q, a) in enumerate(foreign[:400]):
        body = pairs._without_lead(a)
        right["copy"].append(judge.text(q, "Translation:\n" + q) == "copy")
        # an answer in the language of another ad that has another script or vocabulary
        other = next((p for p, _ in foreign[k + 1 :] + foreign if not pairs._near(bare(p), pairs._grams(q), 0.2)), None)
        if other:
            right["other_language"].append(judge.text(q, other) == "other_language")
        words = body.split(" ")
        right["truncated"].append(judge.text(q, " ".join(words[: rng.randrange(len(words) // 4, len(words) * 3 // 4)])[:-1]) == "truncated")
        right["refusal"].append(judge.text(q, UNSEEN[k % len(UNSEEN)]) == "refusal")
        # a sentence that says what isn't possible is none
        right[None].append(judge.text(q, body + "\nApplications by phone alone cannot be accepted.") is None)
    share = {k: sum(v) / len(v) for k, v in right.items()}
    print("held out:", {k: f"{v:.3f} of {len(right[k])}" for k, v in share.items()})
    assert all(v >= 0.95 for k, v in share.items() if k) and share[None] >= 0.9


def test_languages_on_held_out_labels(fitted):
    judge, _, rows = fitted
    got = []
    for r in rows[1::2]:
        label, found = (r["responsibilities_lang"] or "").strip().lower(), langid.segments(r["responsibilities"] or "", judge.model)
        if label in langid.LANGUAGES and len(found) == 1:
            got.append(found[0][0] == label)
    print(f"languages: {sum(got) / len(got):.3f} of {len(got)} labels, some of which are wrong")
    assert sum(got) >= 0.85 * len(got)


def test_judge_of_all_rows(spark, tmp_path):
    random.seed(5)
    said = [(" ".join(random.sample(" ".join(TEXTS["en"]).split(), 9)) + ".", "".join(random.sample("".join(TEXTS["ja"]), 20)) + "。") for _ in range(400)]
    rows = []
    for i in range(6_600):
        (a, q), (b, p) = random.choice(said), random.choice(said)
        rows.append((i, f"{q}\n{p}", "ja", "倉庫スタッフ", "ja", f"{a}\n{b}" if i % 50 else a[:20], "Warehouse clerk" if i % 3 else f"Harbour pilot {'zeta' if i % 2 else 'pilots'}"))
    rows[7] = (7, *rows[7][1:5], "", "I'm sorry, but I can't assist with that.")
    names = "id long, responsibilities string, responsibilities_lang string, job_title string, job_title_lang string, description_english string, job_title_english string"
    judges, found = [], []
    for k in (2, 5):
        spark.createDataFrame(rows, names).repartition(k, "description_english").write.parquet(f"{tmp_path}/{k}/jobads_jp.parquet")
        first = sorted(map(tuple, production.p1_found(spark, f"{tmp_path}/{k}").collect()))
        # the second time the judge is there already, and pairs are judged without a table of features
        assert first == sorted(map(tuple, production.p1_found(spark, f"{tmp_path}/{k}").collect()))
        judges.append(production.judge_of(production.ads_of(spark, f"{tmp_path}/{k}")))
        found.append(first)
    # every row is counted, not some of them, wherever it lies
    for j in judges:
        for w in ("zeta", "clerk"):
            assert math.isclose(j.words[w], sum(r[6].endswith(w) for r in rows) * pairs.ROWS / len(rows))
    assert found[0] == found[1] and (7, "description_english", "empty") in found[0] and judges[0].field.index == judges[1].field.index
    assert np.allclose(judges[0].field.w, judges[1].field.w) and judges[0].model.words == judges[1].model.words


def test_clauses_that_come_again(model, monkeypatch):
    """A clause counts as often as it comes, but is cut into words and scored once."""
    random.seed(6)
    ja, en = ["厨房の掃除を毎日お任せします。", "受付の担当を募集しています。", "制服は貸与します。", "応募は電話のみ。"], ["Cleaning the kitchen is your daily task.", "We look for someone at the reception desk.", "Don't bring a uniform.", "Café staff: 9 to 5"]
    said = [("\n".join(random.sample(ja, 3)), "\n".join(random.sample(en, 3)), random.choice(("ja", "en", None))) for _ in range(200)]
    cut_up, scored, words, score = [], [], pairs._WORDS, langid.Model.score

    class Words:
        def findall(self, text):
            cut_up.append(text)
            return words.findall(text)

    monkeypatch.setattr(pairs, "_WORDS", Words())
    monkeypatch.setattr(langid.Model, "score", lambda self, s, all_words=False: scored.append(s) or score(self, s, all_words))

    def counted(most):
        monkeypatch.setattr(pairs, "_READ", most, raising=False)
        tally, out = pairs.Tally(), Counter()
        for q, a, lang in said:
            tally.pair(q, a, lang)
            tally.head("受付スタッフ", "Reception clerk")
            tally.label("ja", "受付スタッフ")
        for kind, key, part, n in tally.rows():
            out[kind, key, part] += n
        return out

    together = counted(10**9)
    assert len(cut_up) <= 4 * len({c for q, a, _ in said for c in (q + "\n" + a).split("\n")})
    assert together == counted(0) and together["t", "clerk", "l"] == 200 and together["u", "kitchen", ""] == sum("kitchen" in a for _, a, _ in said)
    judge = pairs.Judge([x[:2] for x in said], [("受付スタッフ", "Reception clerk")] * 20, model)
    scored.clear()
    for q, a, _ in said:
        assert judge.text(q, a) is None
    assert len(scored) <= len(ja + en)
    # what a few words tell at once is what the model says of the clause
    for c in [*en, *TEXTS["en"], *TEXTS["de"], "Kitchen", "I can't", "I cannot assist", "der Koch und the cook"]:
        known, own = score(judge.model, c), judge._clauses[c]
        assert own[0] == (None if known is None else known.get("en", -9.0) > -1) and own[1] == judge.wording.hints(c)


def test_titles_that_come_again(model, monkeypatch):
    """A title is scored once, however often it comes."""
    said = [("厨房の掃除を毎日お任せします。", "Cleaning the kitchen is your daily task.")] * 20
    judge, scored, score = pairs.Judge(said, [("受付スタッフ", "Reception clerk")] * 20, model), [], langid.Model.score
    monkeypatch.setattr(langid.Model, "score", lambda self, s, all_words=False: scored.append(s) or score(self, s, all_words))
    want = [judge._title_features(q, a) for q, a in (("Küchenhilfe für die Nacht", "Kitchen help"), ("受付スタッフ", "受付スタッフ"))]
    scored.clear()
    for _ in range(50):
        assert [judge._title_features(q, a) for q, a in (("Küchenhilfe für die Nacht", "Kitchen help"), ("受付スタッフ", "受付スタッフ"))] == want
    assert not scored and "title same" in want[1]


def odd_texts(n):
    """Texts of clauses in several scripts with marks, figures and slips at any place."""
    rng = random.Random(11)
    some = ["Cook", "don't", "l’été", "ﾊﾞｲﾄ", "東京Tower", "受付の担当", "10:30", "2,450.5", "İstanbul", "số", "x_y", "a'b'c", "'", "’", "…", "(日本)", "Küche", "調理 ", "がんばる", "한국어", "𠮟る", "²", "3a", "N°5", "cannot", "-", "·"]
    glue = [" ", " ", " ", "", ". ", "。", "\n", "!\n", ", ", "  "]
    return ["".join(rng.choice(some) + rng.choice(glue) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


def test_counts_of_odd_clauses():
    """What is counted of all clauses at once is what is counted of each."""
    texts = [pairs.nfkc(x) for x in odd_texts(300)]
    tally, got, want, sure = pairs.Tally(), Counter(), Counter(), ("A", "A1", "P", "P1", "u", "U")
    for q, a in zip(texts, texts[1:]):
        tally.pair(q, a, "ja")
        for name, text in (("P", q), ("A", a)):
            parts = pairs.clauses(text)
            for k, c in enumerate(parts):
                found = pairs._WORDS.findall(c)
                for u in [u for w in found if not w[0].isdecimal() for u in ([w.lower()[i : i + 2] for i in range(len(w.lower()) - 1)] or [w.lower()] if w.lower()[0] > "⹿" else [w.lower().replace("’", "'")])]:
                    want["u", u, ""] += 1
                    want["U", "", ""] += 1
                if not c.isascii() and (c[-1] > "⹿" or c[0] > "⹿"):
                    inside = list(zip(c[:-2], c[1:-1]))
                else:
                    inside = list(itertools.pairwise(["^", *map(pairs._class, found[:-1])]))
                for part, some in (("m", inside), ("e", [pairs._ending(c)] if k + 1 < len(parts) else [])):
                    for x, y in some:
                        if y != "^":
                            want[name, f"{x}\x1f{y}", part] += 1
                            want[f"{name}1", y, part] += 1
    for kind, key, part, n in tally.rows():
        if kind in sure and n:
            got[kind, key, part] += n
    assert got == want and len({k for k, _, _ in got}) == len(sure)


def test_clauses_known_together(model):
    """What is found of many clauses at once is what is found of each."""
    judge = pairs.Judge([("厨房の掃除を毎日お任せします。", "Cleaning the kitchen is your daily task.")] * 20, [("受付スタッフ", "Reception clerk")] * 20, model)
    some = {c for x in [*odd_texts(300), *(x for v in TEXTS.values() for x in v), *pairs.REFUSALS] for c in pairs.clauses(pairs.nfkc(x))}
    judge.know(some)
    assert len(judge._clauses) > len(some) / 10
    assert dict(judge._clauses) == {c: judge._clause(c) for c in judge._clauses}


def test_likeness_to_prompt():
    """Likeness found from what a response has in common with its prompt is that of each clause's own letters."""
    rng = random.Random(5)
    for q in [*map(pairs.nfkc, odd_texts(200)), "abc", "日本"]:
        body = rng.choice([q, q[: len(q) // 2] + " . Another thing is said here. " + q[-9:], "Nothing of it.\nabc", "We cook."])
        grams, got = pairs._grams(q), pairs.clauses(body)
        share = [len(pairs._grams(c) & grams) / len(pairs._grams(c)) for c in got]
        assert pairs._likeness(got, body, grams) == (pairs._near(bare(body), grams), [pairs._bin(x, 0.35, 0.6) for x in share])


def test_different_clauses_are_cut_into_words_together(monkeypatch):
    """Clauses that are all different aren't cut into words one by one, which p1_found hasn't the time for."""
    cut_up, words, tally = [], pairs._WORDS, pairs.Tally()

    class Words:
        def findall(self, text):
            cut_up.append(text)
            return words.findall(text)

    monkeypatch.setattr(pairs, "_WORDS", Words())
    for i in range(100):
        tally.pair("\n".join(f"受付の担当{20 * i + k}を募集。" for k in range(20)), "\n".join(f"We look for clerk {20 * i + k} at the desk" for k in range(20)), "ja")
    assert sum(n for kind, key, _, n in tally.rows() if (kind, key) == ("u", "clerk")) == 2000
    assert len(cut_up) < 100
