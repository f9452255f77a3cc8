"""Further queries of the inventory."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from adloom.functions import stats
from adloom.functions import text as T
from adloom.operators import classifier, matching, pipeline
from adloom.operators.ranks import numbered
from adloom.operators.sentences import split_ads
from adloom.operators.upsert import fill_blanks
from adloom.plans.aggregates import MENTIONS, SRC, by_source, mentions
from adloom.plans.catalog import query
from adloom.plans.matches import ATTENTION
from adloom.plans.texts import WS



def source():
    return F.coalesce("source", F.lit("indeed")).alias("source")


@query("prj10_pilot", "SELECT id FROM jobads_jp WHERE (job_title_lang <> 'EN' OR responsibilities_lang <> 'EN') AND (job_title_english IS NULL OR trim(job_title_english, ' ') = '' OR description_english IS NULL OR trim(description_english, ' ') = '') ORDER BY id LIMIT 200")
def pilot(t):
    x = t.jobads_jp.where(((F.col("job_title_lang") != "EN") | (F.col("responsibilities_lang") != "EN")) & (T.is_blank(F.col("job_title_english")) | T.is_blank(F.col("description_english"))))
    return x.select("id").orderBy("id").limit(200)


@query("prj13_threshold", f"SELECT id, m.uri AS uri FROM {MENTIONS} WHERE coalesce(m.score, 0) >= 0.55")
def threshold(t):
    return mentions(t).where(F.coalesce("score", F.lit(0.0)) >= 0.55).select("id", "uri")


STRIPPED = "nullif(regexp_replace({0}, '^[\\s\\x{{A0}}\\x{{3000}}]+|[\\s\\x{{A0}}\\x{{3000}}]+$', '', 'g'), '')"
BLANK = "({0} IS NULL OR trim({0}, ' ') = '')"


@query("joi07_apply_checkpoint", f"WITH c AS (SELECT id AS k, employer AS v, 1 AS ord FROM jobads_jp UNION ALL SELECT id, job_title, 2 FROM jobads_jp WHERE job_title_lang IS NOT NULL), v AS (SELECT k, arg_max({STRIPPED.format('v')}, ord) FILTER (WHERE {STRIPPED.format('v')} IS NOT NULL) AS x FROM c GROUP BY k HAVING x IS NOT NULL) SELECT id, CASE WHEN {BLANK.format('job_title_english')} AND x IS NOT NULL THEN x ELSE job_title_english END AS job_title_english, CASE WHEN {BLANK.format('job_title_english')} AND x IS NOT NULL THEN 0 ELSE needs_title_translation END AS needs_title_translation FROM jobads_jp LEFT JOIN v ON k = id")
def apply_checkpoint(t):
    # a log in which most ids come twice
    early = t.jobads_jp.select("id", F.col("employer").alias("value"), F.lit(1).alias("ord"))
    late = t.jobads_jp.where("job_title_lang is not null").select("id", F.col("job_title").alias("value"), F.lit(2).alias("ord"))
    return fill_blanks(t.jobads_jp.select("id", "job_title_english", "needs_title_translation"), early.unionAll(late), "id", "job_title_english", "value", F.col("ord"), last=True, flag="needs_title_translation")


@query("joi09_batch_results", f"WITH c AS (SELECT id AS k, employer AS v, 1 AS ord FROM jobads_jp UNION ALL SELECT id, job_title, 2 FROM jobads_jp WHERE source IS NOT NULL), v AS (SELECT k, arg_max({STRIPPED.format('v')}, ord) FILTER (WHERE {STRIPPED.format('v')} IS NOT NULL) AS x FROM c GROUP BY k) SELECT id, CASE WHEN {BLANK.format('job_title_english')} THEN coalesce(x, job_title_english) ELSE job_title_english END AS job_title_english FROM jobads_jp LEFT JOIN v ON k = id")
def batch_results(t):
    # an ad's results come in two files, the later only with a source, and each row also under ids that are ill-formed
    ads = t.jobads_jp
    well = lambda a, field: F.concat_ws(":", F.lit(a), F.col("id").cast("string"), F.lit(field))
    early = ads.select(F.explode(F.array(well("jobads_jp", "title"), well("jobads_jp:x", "title"), F.concat(F.lit("bad:"), F.col("id")))).alias("custom_id"), F.col("employer").alias("value"), F.lit(1).alias("ord"))
    late = ads.where("source is not null").select(F.explode(F.array(well("jobads_jp", "title"), F.lit("jobads_jp:x1:title"))).alias("custom_id"), F.col("job_title").alias("value"), F.lit(2).alias("ord"))
    return pipeline.apply_batch_results(ads.select("id", "job_title_english"), early.unionAll(late), {"title": "job_title_english"})


@query("agg10_residual", f"WITH x AS (SELECT {SRC} AS source, CASE WHEN starts_with(code, 'S') THEN substr(code, 1, 2) END AS category FROM jobads_jp JOIN {MENTIONS} USING (id) LEFT JOIN esco_concepts c ON c.uri = m.uri) SELECT source, coalesce(category, 'Other') AS category, count(*) AS n FROM x GROUP BY ALL")
def residual(t):
    c = t.esco_concepts.select("uri", T.skill_branch(F.col("code")).alias("category"))
    return by_source(t).join(c, "uri", "left").groupBy("source", F.coalesce("category", F.lit("Other")).alias("category")).agg(F.count("*").alias("n"))


@query("agg14_table_statistics", "SELECT 'jobads_jp' AS name, count(*) AS n, (SELECT count(*) FROM (DESCRIBE SELECT * FROM jobads_jp)) AS columns FROM jobads_jp UNION ALL SELECT 'offers', count(*), (SELECT count(*) FROM (DESCRIBE SELECT * FROM offers)) FROM offers")
def table_statistics(t):
    of = lambda name, df: df.agg(F.lit(name).alias("name"), F.count("*").alias("n"), F.lit(len(df.columns)).cast("long").alias("columns"))
    return of("jobads_jp", t.jobads_jp).unionAll(of("offers", t.offers))


@query("agg19_sentence_totals")
def sentence_totals(t):
    s = split_ads(t.jobads_jp, "id", "description_english").withColumn("skill", F.lower("sentence").rlike("experience|knowledge|practice"))
    x = s.agg(F.count("*").alias("sentences"), F.count_if("skill").alias("skill_sentences"))
    return x.withColumn("share", F.round(F.try_divide("skill_sentences", "sentences"), 4).cast("decimal(18,4)"))


@query("agg20_matched_at", f"SELECT {SRC} AS source, count(*) AS n, count(*) FILTER (WHERE m.score >= 0.4) AS matched FROM jobads_jp JOIN {MENTIONS} USING (id) GROUP BY 1")
def matched_at(t):
    return by_source(t).groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("score") >= 0.4).alias("matched"))


@query("agg24_division_share", f"SELECT source, section, division, n, CAST(round(n / sum(n) OVER (PARTITION BY source, section), 4) AS DECIMAL(18,4)) AS share FROM (SELECT {SRC} AS source, isic_section AS section, substr(esco_occupation_code_semantic, 1, 2) AS division, count(*) AS n FROM jobads_jp WHERE isic_section IS NOT NULL AND esco_occupation_code_semantic IS NOT NULL GROUP BY ALL)")
def division_share(t):
    x = t.jobads_jp.where("isic_section is not null and esco_occupation_code_semantic is not null")
    n = x.groupBy(source(), F.col("isic_section").alias("section"), F.substring("esco_occupation_code_semantic", 1, 2).alias("division")).agg(F.count("*").alias("n"))
    return stats.share(n, ["source", "section"], "n").withColumn("share", F.round("share", 4).cast("decimal(18,4)"))


@query("agg25_pairwise_v", f"WITH c AS (SELECT {SRC} AS r, isic_section AS k, count(*) AS o FROM jobads_jp WHERE isic_section IS NOT NULL GROUP BY ALL), p AS (SELECT a.r AS x, b.r AS y FROM (SELECT DISTINCT r FROM c) a JOIN (SELECT DISTINCT r FROM c) b ON a.r < b.r), l AS (SELECT x, y, r, k, o FROM p JOIN c ON r = x OR r = y), m AS (SELECT *, sum(o) OVER (PARTITION BY x, y, r) AS rt, sum(o) OVER (PARTITION BY x, y, k) AS ct, sum(o) OVER (PARTITION BY x, y) AS n FROM l) SELECT x, y, CAST(round(sqrt(greatest(sum(o::DOUBLE * o / (rt::DOUBLE * ct)) - 1, 0)), 4) AS DECIMAL(18,4)) AS v FROM m GROUP BY x, y")
def pairwise_v(t):
    c = t.jobads_jp.where("isic_section is not null").groupBy(source(), F.col("isic_section").alias("k")).agg(F.count("*").alias("o"))
    names = c.select("source").distinct()  # a row for each source
    p = names.select(F.col("source").alias("x")).join(names.select(F.col("source").alias("y")), F.col("x") < F.col("y"))
    cells = p.select("x", "y", F.explode(F.array("x", "y")).alias("source")).join(c, "source")
    total = lambda *k: F.sum("o").over(Window.partitionBy("x", "y", *k)).cast("double")
    s = cells.withColumn("e", total("source") * total("k")).groupBy("x", "y").agg(F.sum(F.col("o") * F.col("o") / F.col("e")).alias("s"))
    return s.select("x", "y", F.round(F.sqrt(F.greatest(F.col("s") - 1, F.lit(0.0))), 4).cast("decimal(18,4)").alias("v"))


@query("agg31_gap", "SELECT n_regionkey, g, CAST(round(CASE WHEN e > 0 THEN d - e END, 2) AS DECIMAL(18,2)) AS gap FROM (SELECT n_regionkey, CASE WHEN n_regionkey % 2 = 0 AND c_custkey % 10 = 3 THEN 2 ELSE c_custkey % 10 END AS g, coalesce(sum(c_acctbal) FILTER (WHERE c_custkey % 3 = 0), 0) AS d, coalesce(sum(c_acctbal) FILTER (WHERE c_custkey % 3 = 1), 0) AS e FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)")
def gap(t):
    g = F.when((F.col("n_regionkey") % 2 == 0) & (F.col("c_custkey") % 10 == 3), F.lit(2)).otherwise(F.col("c_custkey") % 10).cast("long").alias("g")
    some = lambda k: F.coalesce(F.sum(F.when(F.col("c_custkey") % 3 == k, F.col("c_acctbal"))), F.lit(0.0))
    x = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey", g).agg(some(0).alias("d"), some(1).alias("e"))
    return x.select("n_regionkey", "g", F.round(F.when(F.col("e") > 0, F.col("d") - F.col("e")), 2).cast("decimal(18,2)").alias("gap"))


@query("agg33_category_titles", "SELECT code, max(title) AS title FROM esco_concepts WHERE skill_type = 'skills' AND level = 1 GROUP BY code")
def category_titles(t):
    return t.esco_concepts.where("skill_type = 'skills' and level = 1").groupBy("code").agg(F.max("title").alias("title"))


@query("win02_group_totals", f"SELECT source, isic_section, n, CAST(sum(n) OVER (PARTITION BY source) AS BIGINT) AS total FROM (SELECT {SRC} AS source, isic_section, count(*) AS n FROM jobads_jp GROUP BY ALL)")
def group_totals(t):
    return t.jobads_jp.groupBy(source(), "isic_section").agg(F.count("*").alias("n")).withColumn("total", F.sum("n").over(Window.partitionBy("source")))


@query("win04_argmax", f"SELECT id, max(m.score) AS score FROM {MENTIONS} WHERE m.score IS NOT NULL GROUP BY id")
def argmax(t):
    return mentions(t).where("score is not null").groupBy("id").agg(F.max("score").alias("score"))


@query("win06_latest_value", "SELECT employer, arg_max(company_revenue, id) FILTER (WHERE company_revenue IS NOT NULL) AS revenue FROM jobads_jp WHERE employer IS NOT NULL GROUP BY employer")
def latest_value(t):
    return t.jobads_jp.where("employer is not null").groupBy("employer").agg(F.max_by("company_revenue", F.when(F.col("company_revenue").isNotNull(), F.col("id"))).alias("revenue"))


@query("win07_softmax", f"SELECT id, uri, CAST(round(exp(s - max(s) OVER w) / sum(e) OVER w, 4) AS DECIMAL(18,4)) AS weight FROM (SELECT *, exp(s - max(s) OVER (PARTITION BY id)) AS e FROM (SELECT id, m.uri AS uri, max(m.score) AS s FROM {MENTIONS} WHERE m.score IS NOT NULL GROUP BY ALL)) WINDOW w AS (PARTITION BY id)")
def softmax(t):
    w = Window.partitionBy("id")
    x = mentions(t).where("score is not null").groupBy("id", "uri").agg(F.max("score").alias("s")).withColumn("e", F.exp(F.col("s") - F.max("s").over(w)))
    return x.select("id", "uri", F.round(F.col("e") / F.sum("e").over(w), 4).cast("decimal(18,4)").alias("weight"))


@query("win08_chunks", "SELECT coalesce(source, 'indeed') AS source, CAST(floor((row_number() OVER (PARTITION BY coalesce(source, 'indeed') ORDER BY id) - 1) / 100) AS BIGINT) AS chunk, id FROM jobads_jp")
def chunks(t):
    x = numbered(t.jobads_jp.select(source(), "id"), ["source"], ["id"])
    return x.select("source", F.floor((F.col("place") - 1) / 100).cast("long").alias("chunk"), "id")


@query("win09_rank", f"SELECT source, section, CAST(row_number() OVER (PARTITION BY source ORDER BY n DESC, section) AS BIGINT) AS rank FROM (SELECT {SRC} AS source, isic_section AS section, count(*) AS n FROM jobads_jp WHERE isic_section IS NOT NULL GROUP BY ALL)")
def rank(t):
    n = t.jobads_jp.where("isic_section is not null").groupBy(source(), F.col("isic_section").alias("section")).agg(F.count("*").alias("n"))
    return n.select("source", "section", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n"), "section")).cast("long").alias("rank"))


@query("srt02_group_then_count", f"SELECT {SRC} AS source, count(*) AS n FROM jobads_jp GROUP BY 1 ORDER BY CASE {SRC} WHEN 'indeed' THEN 0 WHEN 'careerjet' THEN 1 ELSE 2 END, n DESC, source")
def group_then_count(t):
    place = F.coalesce(F.try_element_at(F.create_map(F.lit("indeed"), F.lit(0), F.lit("careerjet"), F.lit(1)), F.col("source")), F.lit(2))
    return t.jobads_jp.groupBy(source()).agg(F.count("*").alias("n")).orderBy(place, F.desc("n"), "source")


@query("srt04_total_last", f"SELECT coalesce(source, 'TOTAL') AS source, n FROM (SELECT {SRC} AS source, count(*) AS n FROM jobads_jp GROUP BY ROLLUP ({SRC})) ORDER BY source IS NULL, source")
def total_last(t):
    x = t.jobads_jp.select(source()).rollup("source").agg(F.count("*").alias("n"))
    return x.orderBy(F.col("source").isNull(), "source").select(F.coalesce("source", F.lit("TOTAL")).alias("source"), "n")


@query("srt05_by_mean", f"SELECT section, CAST(round(avg(n), 4) AS DECIMAL(18,4)) AS mean FROM (SELECT {SRC} AS source, isic_section AS section, count(*) AS n FROM jobads_jp WHERE isic_section IS NOT NULL AND {SRC} IN ('indeed', 'careerjet') GROUP BY ALL) GROUP BY 1 ORDER BY mean DESC")
def by_mean(t):
    n = t.jobads_jp.where("isic_section is not null").select(source(), F.col("isic_section").alias("section")).where(F.col("source").isin("indeed", "careerjet")).groupBy("source", "section").agg(F.count("*").alias("n"))
    return n.groupBy("section").agg(F.avg("n").alias("m")).orderBy(F.desc("m")).select("section", F.round("m", 4).cast("decimal(18,4)").alias("mean"))


@query("str16_column_search", "SELECT column_name AS name FROM (DESCRIBE SELECT * FROM jobads_jp) WHERE replace(lower(column_name), '_', '') IN ('joburl', 'companynumemployees') OR contains(lower(column_name), 'url')")
def column_search(t):
    wanted = {"joburl", "companynumemployees"}
    names = [c for c in t.jobads_jp.columns if c.replace("_", "").lower() in wanted or "url" in c.lower()]
    return t.spark.createDataFrame([(c,) for c in names], "name string")


@query("arr03_regroup", "WITH s AS (SELECT id, flatten(list_sort(list(DISTINCT skills))) AS s FROM jp_mentions GROUP BY id), m AS (SELECT id, unnest(s) AS m, unnest(range(len(s))) AS p FROM s) SELECT id, array_to_string(list(m.label ORDER BY p), '|') AS labels FROM m GROUP BY id")
def regroup(t):
    once = t.jp_mentions.groupBy("id").agg(F.flatten(F.array_sort(F.collect_set("skills"))).alias("skills"))  # a repeated row counts once
    flat = once.select("id", F.posexplode("skills").alias("pos", "m"))
    return flat.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.col("m.label").alias("label")))), lambda x: x["label"]), "|").alias("labels"))


def _responses(t):
    """A response for each ad: an output whose text may be empty, one without text, and one with the title."""
    text = lambda c: F.array(F.struct(c.alias("text")))
    out = F.array(F.struct(text(F.coalesce("job_title_english", F.lit(""))).alias("content")), F.struct(text(F.lit(None).cast("string")).alias("content")), F.struct(text(F.col("job_title")).alias("content")))
    return t.jobads_jp.select("id", F.to_json(F.struct(out.alias("output"))).alias("response"))


@query("jsn03_first_text", "SELECT id, coalesce(nullif(job_title_english, ''), nullif(job_title, '')) AS text FROM jobads_jp")
def first_text(t):
    return _responses(t).select("id", pipeline.first_text(F.col("response")).alias("text"))


@query("jsn04_first_content", "SELECT id, coalesce(job_title_english, '') AS text FROM jobads_jp")
def first_content(t):
    return _responses(t).select("id", pipeline.first_text(F.col("response"), strict=True).alias("text"))


@query("jsn06_last_result", "SELECT job_url, max(id) AS id FROM jobads_jp WHERE job_url IS NOT NULL GROUP BY job_url")
def last_result(t):
    return t.jobads_jp.where("job_url is not null").groupBy("job_url").agg(F.max_by("id", "id").alias("id"))


@query("txt08_token_budget", "SELECT id, array_to_string(list_slice(regexp_extract_all(description_english, '[^ ]+'), 1, 40), ' ') AS head FROM jobads_jp WHERE description_english IS NOT NULL")
def token_budget(t):
    x = t.jobads_jp.where("description_english is not null")
    head = pipeline.within_budget(F.col("description_english"), lambda s: [w for w in s.split(" ") if w], " ".join, 40)
    # the shortening keeps short texts as they are, so whitespace is made equal afterwards
    return x.select("id", F.array_join(F.filter(F.split(head, " "), lambda w: w != ""), " ").alias("head"))


TITLES = (r"\([^)]*\)|\[[^\]]*\]|\*[^*]*\*|\s[|/#].*$|\s-\s.*$|\s+in\s+\S+$", r"^\s*(senior|sr\.?|junior|lead|experienced|night shift|immediate start:)\s+")


@query("txt10_clean_titles", f"SELECT id, trim(regexp_replace(coalesce(regexp_replace(regexp_replace(job_title_english, '{TITLES[0]}', '', 'g'), '{TITLES[1]}', '', 'i'), ''), '{WS}', ' ', 'g'), ' ') AS title FROM jobads_jp")
def clean_titles(t):
    c = F.regexp_replace(F.col("job_title_english"), TITLES[0], "")
    return t.jobads_jp.select("id", T.collapse(F.regexp_replace(c, f"(?i){TITLES[1]}", "")).alias("title"))


@query("sim01_classify")
def classify(t):
    """Sentences that ask for skill. The classifier learns from a bounded sample, those of the least hash, which usual words label."""
    s = split_ads(t.jobads_jp, "id", "description_english")
    some = s.select("sentence").distinct().orderBy(F.xxhash64("sentence")).limit(classifier.SAMPLE)
    rows = some.select("sentence", F.lower("sentence").rlike("experience|knowledge|skill|practice|qualif|welcome").cast("int").alias("label")).collect()
    model = classifier.Classifier().fit([x["sentence"] for x in rows], [x["label"] for x in rows])
    return pipeline.classify_distinct(s, "sentence", lambda d: pipeline.classify(d, "sentence", lambda: model)).where("score is not null")


@query("sim03_redundancy", f"""WITH c AS ({ATTENTION.format(0.1)}), k AS (SELECT CAST(floor(vec_id / 10) AS BIGINT) AS sentence, vec_id AS token, embedding FROM embeddings WHERE vec_id >= 100),
x AS (SELECT c.sentence, k.token, c.skill AS candidate, list_dot_product(k.embedding::DOUBLE[], s.embedding::DOUBLE[]) AS d FROM c JOIN k USING (sentence) JOIN embeddings s ON s.vec_id = c.skill),
y AS (SELECT *, row_number() OVER (PARTITION BY sentence, token ORDER BY d DESC, candidate) AS r, min(token) OVER w AS lo, max(token) OVER w AS hi, min(candidate) OVER w <> max(candidate) OVER w AS several FROM x WINDOW w AS (PARTITION BY sentence))
SELECT DISTINCT sentence, candidate FROM y WHERE (r = 1 AND token > lo AND token < hi AND hi - lo >= 2 AND several) OR hi - lo < 2 OR NOT several""")
def redundancy(t):
    e = t.embeddings
    tokens = e.where("vec_id >= 100").select(F.floor(F.col("vec_id") / 10).cast("long").alias("sentence"), F.col("vec_id").alias("token"), "embedding")
    skills = e.where("vec_id < 100").select(F.col("vec_id").alias("candidate"), F.col("embedding").alias("z"))
    found = matching.attention(tokens, skills, "sentence", "token", "embedding", "candidate", "z", 0.1).select("sentence", F.col("skill").alias("candidate"))
    x = found.join(tokens, "sentence").join(skills, "candidate").select("sentence", "token", "candidate", matching.dot(F.col("embedding"), F.col("z")).alias("d"))
    return pipeline.without_redundant(x, "sentence", "token", "candidate", "d")
