"""Queries of functions on text, arrays and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from adloom.functions import text as T
from adloom.operators.sentences import split_ads
from adloom.plans.aggregates import DAY
from adloom.plans.catalog import query

WS = r"[\s\x{A0}\x{3000}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{1680}\x{85}]+"


@query("str01_label_key", f"SELECT esco_skill_label AS label, lower(trim(regexp_replace(esco_skill_label, '{WS}', ' ', 'g'), ' ')) AS k FROM digital_levels")
def label_key(t):
    return t.digital_levels.select(F.col("esco_skill_label").alias("label"), T.label_key(F.col("esco_skill_label")).alias("k"))


@query("str02_bare_key", "SELECT title, trim(regexp_replace(lower(title), '[^a-z0-9 ]', '', 'g'), ' ') AS k FROM esco_concepts")
def bare_key(t):
    return t.esco_concepts.select("title", T.bare_key(F.col("title")).alias("k"))


@query("str03_clean_text", f"SELECT id, trim(regexp_replace(coalesce(responsibilities, ''), '{WS}', ' ', 'g'), ' ') AS text FROM jobads_jp")
def clean_text(t):
    return t.jobads_jp.select("id", T.collapse(F.col("responsibilities")).alias("text"))


@query("str04_truncate", "SELECT id, substr(responsibilities, 1, 300) AS head FROM jobads_jp")
def truncate(t):
    return t.jobads_jp.select("id", F.substring("responsibilities", 1, 300).alias("head"))


@query("str05_top_category", "SELECT code, CASE skill_type WHEN 'language_skills' THEN 'Language' WHEN 'transversal_skills' THEN 'Transversal' WHEN 'skills' THEN nullif(regexp_extract(code, '^(S\\d)', 1), '') WHEN 'knowledge' THEN CASE WHEN regexp_replace(code, '[^0-9]', '', 'g') <> '' THEN lpad(substr(regexp_replace(code, '[^0-9]', '', 'g'), 1, 3), 3, '0') END END AS category FROM esco_concepts")
def top_category(t):
    return t.esco_concepts.select("code", T.top_category(F.col("code"), F.col("skill_type")).alias("category"))


@query("str06_branches", "SELECT code, CASE WHEN starts_with(code, 'S') THEN substr(code, 1, 2) END AS skill, CASE WHEN length(regexp_replace(code, '[^0-9]', '', 'g')) >= 3 THEN substr(regexp_replace(code, '[^0-9]', '', 'g'), 1, 3) END AS knowledge FROM esco_concepts")
def branches(t):
    return t.esco_concepts.select("code", T.skill_branch(F.col("code")).alias("skill"), T.knowledge_branch(F.col("code")).alias("knowledge"))


@query("str08_domain", "SELECT id, CASE WHEN len(string_split(job_url, '/')) >= 3 THEN string_split(job_url, '/')[3] END AS domain FROM jobads_jp")
def domain(t):
    return t.jobads_jp.select("id", T.url_domain(F.col("job_url")).alias("domain"))


def _stripped(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}|{WS}$', '', 'g')"


def _cleaned() -> str:
    x = _stripped("description_english")
    for lead in T.LEADS:
        x = _stripped(f"regexp_replace({x}, '^{lead}', '', 'i')")
    for mark in T.END_MARKS:
        x = _stripped(f"regexp_replace({x}, '{mark}$', '')")
    return f"SELECT id, nullif({x}, '') AS text FROM jobads_jp"


@query("str09_clean_translation", _cleaned())
def clean_translation(t):
    return t.jobads_jp.select("id", T.clean_translation(F.col("description_english")).alias("text"))


@query("str10_resolve_language", "SELECT id, CASE upper(trim(job_title_lang, ' ')) WHEN 'JA' THEN 'Japanese' WHEN 'EN' THEN 'English' WHEN 'KO' THEN 'Korean' WHEN 'ZH' THEN 'Chinese' ELSE 'Japanese' END AS language FROM jobads_jp")
def resolve_language(t):
    names = F.create_map(*[F.lit(x) for p in {"JA": "Japanese", "EN": "English", "KO": "Korean", "ZH": "Chinese"}.items() for x in p])
    return t.jobads_jp.select("id", F.coalesce(F.try_element_at(names, F.upper(F.trim("job_title_lang"))), F.lit("Japanese")).alias("language"))


@query("str11_prompt", "SELECT id, 'Translate from ' || coalesce(job_title_lang, '?') || ': ' || job_title AS prompt FROM jobads_jp")
def prompt(t):
    return t.jobads_jp.select("id", F.concat(F.lit("Translate from "), F.coalesce("job_title_lang", F.lit("?")), F.lit(": "), F.col("job_title")).alias("prompt"))


@query("str12_task_ids", "WITH x AS (SELECT id, coalesce(source, 'a:b') || ':' || coalesce(CAST(CASE WHEN employer IS NULL THEN NULL ELSE id END AS VARCHAR), 'x') || ':title' AS task FROM jobads_jp) SELECT id, task, CASE WHEN len(string_split(task, ':')) = 3 AND regexp_full_match(split_part(task, ':', 2), '[0-9]+') THEN CAST(split_part(task, ':', 2) AS BIGINT) END AS parsed FROM x")
def task_ids(t):
    # ads without a source or employer stand for ill-formed ids
    key = F.coalesce(F.when(F.col("employer").isNotNull(), F.col("id")).cast("string"), F.lit("x"))
    x = t.jobads_jp.select("id", T.task_id(F.coalesce("source", F.lit("a:b")), key, F.lit("title")).alias("task"))
    return x.select("id", "task", T.parsed_task(F.col("task"))["id"].alias("parsed"))


@query("str14_ellipsis", "SELECT id, CASE WHEN length(job_title) > 12 THEN substr(job_title, 1, 12) || '…' ELSE job_title END AS title FROM jobads_jp")
def ellipsis(t):
    return t.jobads_jp.select("id", T.ellipsis(F.col("job_title"), 12).alias("title"))


@query("dat01_dates", f"SELECT id, strftime({DAY.format('trim(date_posted)')}, '%Y-%m-%d') AS day FROM jobads_jp")
def dates(t):
    return t.jobads_jp.select("id", F.date_format(T.day(F.col("date_posted")), "yyyy-MM-dd").alias("day"))


@query("arr01_explode", "SELECT id, m.uri AS uri, m.label AS label FROM (SELECT id, unnest(skills) AS m FROM jp_mentions)")
def explode(t):
    return t.jp_mentions.select("id", F.explode(F.coalesce("skills", F.array())).alias("m")).select("id", "m.uri", "m.label")


@query("arr02_filter_strings", "SELECT id, array_to_string([trim(x.label, ' ') for x in skills if length(trim(x.label, ' ')) >= 2], '|') AS labels FROM jp_mentions")
def filter_strings(t):
    return t.jp_mentions.select("id", F.array_join(F.filter(F.transform("skills", lambda m: F.trim(m["label"])), lambda x: F.length(x) >= 2), "|").alias("labels"))


@query("arr04_norms", "SELECT vec_id, CAST(round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 5) AS DECIMAL(18,5)) AS norm FROM embeddings")
def norms(t):
    from adloom.operators.matching import dot

    return t.embeddings.select("vec_id", F.round(F.sqrt(dot(F.col("embedding"), F.col("embedding"))), 5).cast("decimal(18,5)").alias("norm"))


@query("jsn01_object_field", "SELECT event_id, coalesce(CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS k FROM events")
def object_field(t):
    return t.events.select("event_id", F.coalesce(F.from_json("props", "k bigint")["k"], F.lit(0)).alias("k"))


LISTS = f"""WITH x AS (SELECT id, skills, regexp_extract(skills, '(?s)\\[.*\\]') AS inside FROM jobads_jp),
y AS (SELECT id, CASE WHEN inside <> '' AND json_valid(inside) THEN [v ->> '$' FOR v IN from_json(inside, '["JSON"]') IF json_type(v) = 'VARCHAR'] ELSE regexp_extract_all(skills, '"([^"]{{2,}})"', 1) END AS found FROM x)
SELECT id, coalesce(array_to_string([s FOR s IN [{_stripped('r')} FOR r IN found] IF length(s) >= 2], '|'), '') AS skills FROM y"""


@query("jsn02_skill_lists", LISTS)
def skill_lists(t):
    return t.jobads_jp.select("id", F.array_join(T.skill_list(F.col("skills")), "|").alias("skills"))


@query("jsn05_requests", "SELECT 'jobads_jp:' || id || ':title' AS custom_id, 'POST' AS method, job_title AS input FROM jobads_jp WHERE needs_title_translation = 1")
def requests(t):
    body = F.struct(T.task_id(F.lit("jobads_jp"), F.col("id"), F.lit("title")).alias("custom_id"), F.lit("POST").alias("method"), F.struct(F.col("job_title").alias("input")).alias("body"))
    x = t.jobads_jp.where("needs_title_translation = 1").select(F.to_json(body).alias("request"))
    return x.select(F.from_json("request", "custom_id string, method string, body struct<input:string>").alias("r")).select("r.custom_id", "r.method", "r.body.input")


@query("txt06_sentences", "WITH p AS (SELECT id, unnest(string_split(regexp_replace(description_english, '([.!?])[ \\t\\n\\r\\f\\v]+([A-Z0-9(\"])', '\\1' || chr(31) || '\\2', 'g'), chr(31))) AS s FROM jobads_jp), q AS (SELECT id, trim(regexp_replace(s, '" + WS + "', ' ', 'g'), ' ') AS s FROM p) SELECT id, count(*) AS n, CAST(sum(length(s)) AS BIGINT) AS chars FROM q WHERE length(s) >= 10 AND len(regexp_extract_all(s, '[\\p{L}\\p{N}_]+')) >= 2 GROUP BY id")
def split_sentences(t):
    x = t.jobads_jp.select("id", F.explode(T.line_sentences(F.col("description_english"))).alias("s"))
    return x.groupBy("id").agg(F.count("*").alias("n"), F.sum(F.length("s")).alias("chars"))


@query("txt05_ad_sentences")
def ad_sentences(t):
    return split_ads(t.jobads_jp, "id", "description_english")
