"""Queries of sources, sinks, orders and steps around models that the other modules haven't."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from adloom.functions import lines, registered, stats
from adloom.functions import text as T
from adloom.operators import languages, matching, pipeline, sentences, upsert
from adloom.operators.ranks import numbered
from adloom.plans.aggregates import MENTIONS, SRC, by_source
from adloom.plans.catalog import query
from adloom.plans.matches import ATTENTION
from adloom.plans.more import source
from adloom.plans.texts import WS
from adloom.session import checkpoint_dir, delete_at_end
from adloom.sources import files, sqlite, tables, workbook
from adloom.streaming import incremental


def folder(t, name: str) -> str:
    """A new place in the shared folder; it goes when the driver ends."""
    path = f"{checkpoint_dir(t.spark)}/{name}-{uuid.uuid4().hex}"
    delete_at_end(t.spark, path)
    return path


# sources


@query("src01_sqlite_scan", "SELECT code, title FROM esco_occupations")
def sqlite_scan(t):
    path = folder(t, "sqlite")
    sqlite.write_sqlite(t.esco_occupations.select("code", "title"), path, "occupations")  # a reference list
    return sqlite.read_sqlite(t.spark, path, "occupations", columns=["code", "title"])


@query("src03_database", "SELECT id, strftime(collected_at, '%Y-%m-%d') AS day FROM jobads_jp WHERE collected_at >= TIMESTAMP '2025-01-01' AND collected_at < TIMESTAMP '2026-01-01'")
def database(t):
    # the database that comes with Spark stands for the remote one
    ads = t.jobads_jp.where("collected_at is not null").select("id", F.date_format("collected_at", "yyyy-MM-dd").alias("day"))
    url = tables.derby_database(ads, folder(t, "database"), "ads", '"id" BIGINT, "day" VARCHAR(10)')
    read = tables.read_jdbc(t.spark, url, "ads", tables.year_predicates('"day"', 2024, 2026), ["id", "day"], **tables.DERBY)
    return files.in_year(read, "day", 2025)


@query("src05_catalog", "SELECT name FROM (SHOW TABLES) WHERE starts_with(name, 'esco_')")
def catalog_listing(t):
    return t.spark.createDataFrame([(n,) for n in tables.list_tables(t.spark, t.sf_dir, "esco_")], "name string")


KIND = "CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END"


@query("src06_schema", f"SELECT column_name AS name, {KIND} AS type FROM (DESCRIBE SELECT * FROM jobads_jp)")
def schema(t):
    return tables.describe(t.jobads_jp).select("name", "type")


@query("src07_tolerant_lines", "SELECT id, employer AS value FROM jobads_jp WHERE employer IS NOT NULL")
def tolerant_lines(t):
    path = folder(t, "lines")
    line = F.to_json(F.struct("id", F.col("employer").alias("value")))
    # ads without employer come as a broken line, a blank one and one without the key
    bad = F.array(F.concat(F.lit('{"id": '), F.col("id"), F.lit(', "value": "')), F.lit(""), F.lit('{"value": "no id"}'))
    t.jobads_jp.select(F.explode(F.when(F.col("employer").isNotNull(), F.array(line)).otherwise(bad)).alias("value")).write.text(path)
    return files.read_jsonl(t.spark, path, "id long, value string")


@query("src08_strict_lines", "SELECT id, job_title AS value FROM jobads_jp WHERE job_title IS NOT NULL")
def strict_lines(t):
    path = folder(t, "lines")
    files.write_jsonl(t.jobads_jp.where("job_title is not null").select("id", F.col("job_title").alias("value")), path)
    return files.read_jsonl(t.spark, path, "id long, value string", strict=True)


@query("src09_files_by_name", "SELECT source AS country, id FROM jobads_jp WHERE source IN ('careerjet', 'manpoint')")
def files_by_name(t):
    path = folder(t, "files")
    t.jobads_jp.where("source is not null").select("id", "source").write.partitionBy("source").json(path)  # one folder a source
    return files.read_by_country(t.spark, f"{path}/*", "id long", "source=([a-z]+)", ["careerjet", "manpoint"]).select("country", "id")


@query("src10_dictionary", "SELECT uri AS \"conceptUri\", title AS \"preferredLabel\" FROM esco_concepts WHERE trim(coalesce(uri, '')) <> '' AND trim(coalesce(title, '')) <> ''")
def dictionary(t):
    path = folder(t, "dictionary")
    t.esco_concepts.select(F.col("uri").alias("conceptUri"), F.col("title").alias("preferredLabel"), F.concat(F.lit("of\n\""), "title", F.lit('"')).alias("description")).write.csv(path, header=True, escape='"')
    return files.read_dictionary(t.spark, path).select("conceptUri", "preferredLabel")


@query("src11_sheet", f"SELECT source, CAST(count(*) AS VARCHAR) AS ads, CAST(count(employer) AS VARCHAR) AS employers FROM (SELECT {SRC} AS source, employer FROM jobads_jp) GROUP BY 1")
def sheet(t):
    return workbook.read_sheet(t.spark, _book(t), "by source")


@query("snk04_sheets", f"SELECT section, CAST(count(*) AS VARCHAR) AS ads FROM (SELECT coalesce(isic_section, '?') AS section FROM jobads_jp) GROUP BY 1")
def sheets(t):
    return workbook.read_sheet(t.spark, _book(t), "by section")


def _book(t) -> str:
    path = f"{folder(t, 'book')}.xlsx"
    delete_at_end(t.spark, path)
    ads = t.jobads_jp.select(source(), "employer", F.coalesce("isic_section", F.lit("?")).alias("section"))
    workbook.write_workbook({"by source": ads.groupBy("source").agg(F.count("*").alias("ads"), F.count("employer").alias("employers")), "by section": ads.groupBy("section").agg(F.count("*").alias("ads"))}, path)
    return path


@query("src13_document", f"SELECT {SRC} AS source, count(*) AS n FROM jobads_jp GROUP BY 1")
def document(t):
    path = folder(t, "document")
    tables.write_report(path, t.spark, threshold=F.lit(0.55), sources=t.jobads_jp.groupBy(source()).agg(F.count("*").alias("n")))
    read = files.read_document(t.spark, path, "threshold double, sources array<struct<source:string,n:long>>")
    return read.select(F.explode("sources").alias("x")).select("x.source", "x.n")


# sinks


@query("snk01_append_lines", "SELECT id, job_title FROM jobads_jp WHERE job_title IS NOT NULL")
def append_lines(t):
    path, ads = folder(t, "lines"), t.jobads_jp.where("job_title is not null").select("id", "job_title")
    for part in (ads.where("source is null"), ads.where("source is not null")):
        files.write_jsonl(part, path, append=True)
    return files.read_jsonl(t.spark, path, "id long, job_title string")


@query("snk02_ordered_lines", "SELECT id, employer FROM jobads_jp WHERE employer IS NOT NULL")
def ordered_lines(t):
    path = folder(t, "lines")
    for _ in range(2):  # the second takes the first one's place
        files.write_jsonl(t.jobads_jp.where("employer is not null").select("id", "employer"), path, order="id")
    return files.read_jsonl(t.spark, path, "id long, employer string", strict=True)


REPORT = f"""WITH x AS (SELECT {SRC} AS source, m.uri AS uri, m.score AS score FROM jobads_jp JOIN {MENTIONS} USING (id)) SELECT 0.55::DOUBLE AS threshold, source, coalesce(substr(code, 1, 2), 'unmapped') AS branch, count(*) AS n
FROM x LEFT JOIN esco_concepts c ON c.uri = x.uri WHERE coalesce(score, 0) >= 0.55 GROUP BY ALL"""


@query("snk03_report", REPORT)
def report(t):
    path = folder(t, "report")
    n = by_source(t).where(F.coalesce("score", F.lit(0.0)) >= 0.55).join(t.esco_concepts.select("uri", "code"), "uri", "left").groupBy("source", F.coalesce(F.substring("code", 1, 2), F.lit("unmapped")).alias("branch")).agg(F.count("*").alias("n"))
    nested = n.groupBy("source").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("branch", "n")))).alias("branches"))
    tables.write_report(path, t.spark, threshold=F.lit(0.55), countries=nested.select("source", F.to_json("branches").alias("branches")))
    read = files.read_document(t.spark, path, "threshold double, countries array<struct<source:string,branches:string>>")
    one = read.select("threshold", F.explode("countries").alias("c")).select("threshold", "c.source", F.from_json("c.branches", "map<string,bigint>").alias("b"))
    return one.select("threshold", "source", F.explode("b").alias("branch", "n"))


@query("snk05_insert", "SELECT job_url, source, region_iso, CAST(NULL AS VARCHAR) AS isic FROM jobads_jp UNION ALL SELECT job_url, source, region_iso, NULL FROM offers")
def insert(t):
    path = folder(t, "table")
    t.jobads_jp.select("job_url", "source", "region_iso", F.lit(None).cast("string").alias("isic")).write.parquet(path)
    tables.insert(path, t.offers, per_file=50_000)
    return t.spark.read.parquet(path)


@query("snk06_create", "SELECT column_name AS name, CASE WHEN column_type LIKE '%INT' THEN 'bigint' WHEN column_type LIKE '%CHAR%' THEN 'string' WHEN column_type = 'DOUBLE' THEN 'double' ELSE 'string' END AS type FROM (DESCRIBE SELECT * FROM orders)")
def create(t):
    names = {"bigint": "BIGINT(20)", "string": "VARCHAR(255)", "double": "DOUBLE"}
    path, found = folder(t, "table"), [(f.name, names.get(f.dataType.simpleString(), "DATETIME"), True) for f in t.orders.schema.fields]
    for _ in range(2):  # the second finds it there
        tables.create_table(t.spark, path, tables.declared(found))
    return tables.describe(t.spark.read.parquet(path)).select("name", "type")


@query("snk07_rebuild", "SELECT id, job_title, CAST(NULL AS VARCHAR) AS nace, CASE WHEN job_title IS NULL OR trim(job_title, ' ') = '' THEN 0 ELSE 1 END AS flag FROM jobads_jp WHERE source = 'careerjet'")
def rebuild(t):
    path = folder(t, "table")
    t.jobads_jp.select("id", "job_title", "source").write.parquet(path)
    old = t.spark.read.parquet(path).where("source = 'careerjet'")
    tables.rebuild(path, upsert.project(old, ["id", "job_title", "nace"]).withColumn("flag", F.when(T.is_blank(F.col("job_title")), 0).otherwise(1)))
    return t.spark.read.parquet(path)


@query("snk09_drop_columns", "SELECT column_name AS name FROM (DESCRIBE SELECT * FROM jobads_jp) WHERE NOT starts_with(column_name, 'company_')")
def drop_columns(t):
    gone = [c for c in t.jobads_jp.columns if c.startswith("company_")] + ["not_there"]
    return tables.describe(upsert.without_columns(t.jobads_jp, gone)).select("name")


@query("snk11_prefix", "SELECT DISTINCT 'jobads_' || CASE WHEN region_iso IS NULL THEN '' ELSE lower(substr(region_iso, 1, 2)) || '_' END || source AS name FROM jobads_jp WHERE source IS NOT NULL")
def prefix(t):
    return t.jobads_jp.where("source is not null").select(T.prefixed_table(F.col("source"), F.lower(F.substring("region_iso", 1, 2))).alias("name")).distinct()


@query("snk12_lookup", "SELECT id, job_url FROM jobads_jp WHERE job_url >= 'https://www.' AND job_url < 'https://www/'")
def lookup(t):
    path = folder(t, "indexed")
    tables.write_indexed(t.jobads_jp.select("id", "job_url"), path, "job_url")
    return t.spark.read.parquet(path).where("job_url >= 'https://www.' and job_url < 'https://www/'")


# projections, joins, aggregations

CORE = ["job_url", "job_title", "job_title_lang", "description_english", "skills", "nace_code", "source"]


@query("prj01_core_columns", "SELECT job_url, CAST(NULL AS VARCHAR) AS job_title, CAST(NULL AS VARCHAR) AS job_title_lang, description_english, skills, CAST(NULL AS VARCHAR) AS nace_code, source FROM offers")
def core_columns(t):
    return upsert.project(t.offers, CORE)


@query("joi20_nearest_occupation", "WITH s AS (SELECT q.vec_id AS ad, b.vec_id AS occupation, list_dot_product(q.embedding::DOUBLE[], b.embedding::DOUBLE[]) / sqrt(list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[]) * list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[])) AS score FROM embeddings q JOIN embeddings b ON b.vec_id < 100 WHERE q.vec_id >= 100), r AS (SELECT *, row_number() OVER (PARTITION BY ad ORDER BY score DESC, occupation) AS r FROM s) SELECT ad, occupation, CAST(round(score, 4) AS DECIMAL(18,4)) AS score FROM r WHERE r = 1")
def nearest_occupation(t):
    # the first hundred vectors stand for the occupations, as in joi19
    unit = lambda c: F.transform(c, lambda x: x / F.sqrt(matching.dot(c, c)))
    e = t.embeddings.select("vec_id", unit(F.col("embedding")).alias("v"))
    x = matching.best_entry(e.where("vec_id >= 100"), e.where("vec_id < 100"), "vec_id", "v")
    return x.select(F.col("query").alias("ad"), F.col("entry").alias("occupation"), F.round("score", 4).cast("decimal(18,4)").alias("score"))


@query("agg09_shares", f"WITH n AS (SELECT {SRC} AS source, isic_section AS k, count(*) FILTER (WHERE needs_skill_extraction = 1) AS n FROM jobads_jp WHERE isic_section IS NOT NULL GROUP BY ALL), s AS (SELECT *, sum(n) OVER (PARTITION BY source) AS t FROM n) SELECT source, coalesce(string_agg(k || '=' || CAST(round(n::DOUBLE / t, 4) AS DECIMAL(18,4)), ' ' ORDER BY k) FILTER (WHERE t > 0), '') AS shares FROM s GROUP BY source")
def shares(t):
    n = t.jobads_jp.where("isic_section is not null").groupBy(source(), F.col("isic_section").alias("k")).agg(F.count_if(F.col("needs_skill_extraction") == 1).alias("n"))
    x = stats.share_map(n, ["source"], "k", "n")
    return x.select("source", F.array_join(F.transform(F.array_sort(F.map_entries("shares")), lambda e: F.concat(e["key"], F.lit("="), F.round(e["value"], 4).cast("decimal(18,4)").cast("string"))), " ").alias("shares"))


@query("win01_top_composite", f"WITH x AS (SELECT {SRC} AS source, m.uri AS uri, count(*) AS n, count(DISTINCT id) AS ads FROM jobads_jp JOIN {MENTIONS} USING (id) GROUP BY ALL) SELECT source, uri, n, CAST(r AS BIGINT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, ads DESC, uri) AS r FROM x) WHERE r <= 15")
def top_composite(t):
    x = by_source(t).groupBy("source", "uri").agg(F.count("*").alias("n"), F.countDistinct("id").alias("ads"))
    return upsert.top_per_group(x, ["source"], [F.desc("n"), F.desc("ads"), F.col("uri").asc_nulls_last()], 15).select("source", "uri", "n", F.col("rank").cast("long").alias("rank"))


@query("srt01_by_id", "SELECT id, CAST(row_number() OVER (ORDER BY id) AS BIGINT) AS place FROM jobads_jp")
def by_id(t):
    return numbered(t.jobads_jp.select("id"), [], ["id"])


@query("srt07_region_then_share", f"WITH x AS (SELECT {SRC} AS source, avg(CASE WHEN needs_skill_extraction = 1 THEN 1.0 ELSE 0.0 END) AS a FROM jobads_jp GROUP BY 1) SELECT source, CAST(row_number() OVER (ORDER BY CASE WHEN source IN ('indeed', 'careerjet') THEN 0 ELSE 1 END, a DESC, source) AS BIGINT) AS place FROM x")
def region_then_share(t):
    x = t.jobads_jp.groupBy(source()).agg(F.avg(F.when(F.col("needs_skill_extraction") == 1, 1.0).otherwise(0.0)).alias("a"))
    region = F.when(F.col("source").isin("indeed", "careerjet"), 0).otherwise(1)
    return numbered(x.withColumn("region", region), [], ["region", F.desc("a"), "source"]).select("source", "place")


@query("top03_pages", "SELECT id, CAST(floor((row_number() OVER (ORDER BY id) - 1) / 500) AS BIGINT) AS page FROM jobads_jp WHERE job_title_lang IS NULL OR trim(job_title_lang, ' ') = '' OR responsibilities_lang IS NULL OR trim(responsibilities_lang, ' ') = ''")
def pages(t):
    todo = t.jobads_jp.where(T.is_blank(F.col("job_title_lang")) | T.is_blank(F.col("responsibilities_lang"))).select("id")
    return numbered(todo, [], ["id"]).select("id", F.floor((F.col("place") - 1) / 500).cast("long").alias("page"))


@query("set03_shared_columns", "SELECT column_name AS name FROM (DESCRIBE SELECT * FROM jobads_jp) WHERE column_name <> 'id' INTERSECT SELECT column_name FROM (DESCRIBE SELECT * FROM offers)")
def shared_columns(t):
    return t.spark.createDataFrame([(c,) for c in upsert.shared_columns(t.jobads_jp, t.offers)], "name string")


@query("set04_lacking_columns", "SELECT column_name AS name FROM (DESCRIBE SELECT * FROM offers) EXCEPT SELECT column_name FROM (DESCRIBE SELECT * FROM jobads_jp)")
def lacking_columns(t):
    return t.spark.createDataFrame([(c,) for c in upsert.lacking_columns(t.offers, t.jobads_jp)], "name string")


# functions


@query("str07_knowledge_branch", "SELECT code, CASE WHEN length(regexp_replace(code, '[^0-9]', '', 'g')) >= 3 THEN substr(regexp_replace(code, '[^0-9]', '', 'g'), 1, 3) END AS branch FROM esco_concepts")
def knowledge_branches(t):
    return t.esco_concepts.select("code", T.knowledge_branch(F.col("code")).alias("branch"))


NAMES = "SELECT DISTINCT 'jobads_' || coalesce(lower(substr(region_iso, 1, 2)), 'xx') || '_' || coalesce(source, 'esco') AS name FROM jobads_jp"


@query("str13_country", f"SELECT name, CASE WHEN ends_with(name, '_esco') THEN regexp_replace(regexp_replace(name, '^jobads_', ''), '_esco$', '') ELSE upper(split_part(name, '_', 2)) END AS country FROM ({NAMES})")
def country(t):
    x = t.jobads_jp.select(F.concat(F.lit("jobads_"), F.coalesce(F.lower(F.substring("region_iso", 1, 2)), F.lit("xx")), F.lit("_"), F.coalesce("source", F.lit("esco"))).alias("name")).distinct()
    return x.select("name", F.when(F.col("name").endswith("_esco"), T.between_affixes(F.col("name"), "jobads_", "_esco")).otherwise(T.second_part(F.col("name"))).alias("country"))


@query("str15_output_name", "SELECT DISTINCT coalesce(source, 'x_desc') || '.jsonl' AS name, CASE WHEN source IS NULL THEN 'x_skills.jsonl' ELSE source || '_skills.jsonl' END AS out FROM jobads_jp")
def output_name(t):
    x = t.jobads_jp.select(F.concat(F.coalesce("source", F.lit("x_desc")), F.lit(".jsonl")).alias("name")).distinct()
    return x.select("name", T.output_name(F.col("name"), "_desc", "_skills").alias("out"))


@query("dat02_month", "SELECT id, strftime(collected_at, '%Y-%m') AS month FROM jobads_jp")
def month(t):
    return t.jobads_jp.select("id", F.date_format("collected_at", "yyyy-MM").alias("month"))


@query("dat03_year_of_text", "SELECT id FROM jobads_jp WHERE date_posted >= '2025-01-01' AND date_posted < '2026-01-01'")
def year_of_text(t):
    return files.in_year(t.jobads_jp, "date_posted", 2025).select("id")


def _language_of(fields: dict[str, str]) -> str:
    strip = f"'^{WS}|{WS}$'"
    text = ", ".join(f"nullif(regexp_replace({t}, {strip}, '', 'g'), '') AS t{k}" for k, t in enumerate(fields))
    words = ", ".join(f"string_split(regexp_replace(lower(t{k}), '[^\\p{{L}}\\p{{M}}]+', ' ', 'g'), ' ') AS w{k}" for k in range(len(fields)))
    listed = {c: ", ".join(f"'{w}'" for w in ws) for c, ws in languages.WORDS.items()}
    counts = ", ".join(f"len([x FOR x IN w{k} IF x IN ({ws})]) AS n{k}_{c}" for k in range(len(fields)) for c, ws in listed.items())
    out = []
    for k, lang in enumerate(fields.values()):
        most = f"greatest({', '.join(f'n{k}_{c}' for c in listed)})"
        scripts = " ".join(f"WHEN regexp_matches(t{k}, '{p}') THEN '{c}'" for c, p in languages.SCRIPTS)
        usual = " ".join(f"WHEN n{k}_{c} = {most} AND {most} > 0 THEN '{c}'" for c in listed)
        out.append(f"CASE WHEN {lang} IS NOT NULL AND trim({lang}, ' ') <> '' THEN {lang} WHEN t{k} IS NULL THEN NULL {scripts} {usual} END AS {lang}")
    return f"WITH a AS (SELECT *, {text} FROM jobads_jp), b AS (SELECT *, {words} FROM a), c AS (SELECT *, {counts} FROM b) SELECT id, {', '.join(out)} FROM c"


@query("txt07_fill_languages", _language_of({"job_title": "job_title_lang", "responsibilities": "responsibilities_lang"}))
def fill_languages(t):
    x = languages.fill_languages(t.jobads_jp.select("id", "job_title", "job_title_lang", "responsibilities", "responsibilities_lang"), {"job_title": "job_title_lang", "responsibilities": "responsibilities_lang"})
    return x.select("id", "job_title_lang", "responsibilities_lang")


PROMPT = "List the skills that the job ad names as JSON"


@query("txt09_span_budget", f"SELECT doc_id, array_to_string(list_slice(regexp_extract_all(text, '[^ ]+'), 1, {3072 - 200 - len(PROMPT.split()) - 8}), ' ') AS head FROM documents WHERE text IS NOT NULL")
def span_budget(t):
    budget = pipeline.token_budget(3072, 200, len(PROMPT.split()), 8)
    head = pipeline.within_budget(F.col("text"), lambda s: [w for w in s.split(" ") if w], " ".join, budget)
    return t.documents.where("text is not null").select("doc_id", F.array_join(F.filter(F.split(head, " "), lambda w: w != ""), " ").alias("head"))


@query("sim04_paper_threshold", ATTENTION.format(0.15))
def paper_threshold(t):
    e = t.embeddings
    tokens = e.where("vec_id >= 100").select(F.floor(F.col("vec_id") / 10).alias("sentence"), "vec_id", "embedding")
    skills = e.where("vec_id < 100").select(F.col("vec_id").alias("skill"), F.col("embedding").alias("z"))
    # these vectors are far apart, so the defaults are given on their scale
    cut = matching.effective_threshold(0.1, redundancy_filter=False, default=0.1, unfiltered=0.15)
    return matching.attention(tokens, skills, "sentence", "vec_id", "embedding", "skill", "z", cut).withColumn("score", F.round("score", 4).cast("decimal(18,4)"))


@query("sim05_generate", "SELECT id, 'EN ' || upper(job_title) AS translation FROM jobads_jp WHERE needs_title_translation = 1 AND job_title IS NOT NULL")
def generate(t):
    # a stand-in for a model; what is checked is the step around it
    load = lambda: lambda prompts: [f"Translation: EN {p.upper()}</s>" for p in prompts]
    x = pipeline.generate(t.jobads_jp.where("needs_title_translation = 1 and job_title is not null").select("id", "job_title"), "job_title", load)
    return x.select("id", T.clean_translation(F.col("answer")).alias("translation"))


@query("sim06_spans", f"SELECT id, array_to_string([x FOR x IN string_split(employer, ' ') IF length(x) >= 2], '|') AS skills FROM jobads_jp WHERE employer IS NOT NULL AND NOT contains(employer, '\"') AND NOT contains(employer, '\\')".replace("string_split(employer, ' ')", f"regexp_split_to_array(employer, '{WS}')"))
def spans(t):
    load = lambda: lambda prompts: [f"Here you are: {json.dumps(p.split())}" for p in prompts]
    ads = t.jobads_jp.where(F.col("employer").isNotNull() & ~F.col("employer").contains('"') & ~F.col("employer").contains("\\"))
    x = pipeline.generate(ads.select("id", "employer"), "employer", load)
    return x.select("id", F.array_join(T.skill_list(F.col("answer")), "|").alias("skills"))


@query("stm03_round_robin", f"WITH c AS (SELECT {SRC} AS source, CAST(floor((row_number() OVER (PARTITION BY {SRC} ORDER BY id) - 1) / 100) AS BIGINT) AS chunk FROM jobads_jp) SELECT source, chunk, n, CAST(row_number() OVER (ORDER BY chunk, source) AS BIGINT) AS turn FROM (SELECT source, chunk, count(*) AS n FROM c GROUP BY ALL)")
def round_robin(t):
    x = numbered(t.jobads_jp.select(source(), "id"), ["source"], ["id"])
    c = x.groupBy("source", F.floor((F.col("place") - 1) / 100).cast("long").alias("chunk")).agg(F.count("*").alias("n"))
    return numbered(c, [], ["chunk", "source"], "turn").select("source", "chunk", "n", "turn")


@query("stm05_cached_heads", "SELECT id, array_to_string(list_slice(regexp_extract_all(description_english, '[^ ]+'), 1, 40), ' ') AS head FROM jobads_jp WHERE description_english IS NOT NULL")
def cached_heads(t):
    path = folder(t, "cache")

    def make():
        head = pipeline.within_budget(F.col("description_english"), lambda s: [w for w in s.split(" ") if w], " ".join, 40)
        return t.jobads_jp.where("description_english is not null").select("id", F.array_join(F.filter(F.split(head, " "), lambda w: w != ""), " ").alias("head"))

    for model in ("words-1", "words-2", "words-2"):  # another model's cache isn't used
        out = pipeline.cached(t.spark, path, model, make)
    return out


# lines

_SPACES = r"\s\x{A0}\x{3000}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{1680}\x{85}\x{1C}-\x{1F}\x{0B}"


def _re2(pattern: str) -> str:
    """A pattern in which whitespace is Unicode's."""
    out, inside, k = "", False, 0
    while k < len(pattern):
        two = pattern[k : k + 2]
        if two in (r"\s", r"\S"):
            out += _SPACES if inside and two == r"\s" else f"[{'^' if two == r'\S' else ''}{_SPACES}]"
            k += 2
        elif two[0] == "\\":
            out += two
            k += 2
        else:
            inside = two[0] == "[" or (inside and two[0] != "]")
            out += two[0]
            k += 1
    return out.replace("'", "''")


def _cleaned(line: str) -> str:
    for pattern, by in sentences.CLEANING:
        line = f"regexp_replace({line}, '{_re2(pattern)}', '{by}', 'g')"
    return f"regexp_replace({line}, '^[{_SPACES}]+|[{_SPACES}]+$', '', 'g')"


LINES = f"(SELECT id, {_cleaned('line')} AS line FROM (SELECT id, unnest(string_split(description_english, chr(10))) AS line FROM jobads_jp))"


def _lines(t):
    return t.jobads_jp.select("id", F.explode(lines.clean_lines(F.col("description_english"))).alias("line"))


@query("txt01_clean_lines", f"SELECT id, line FROM {LINES} WHERE line <> ''")
def clean_lines(t):
    return _lines(t)


@query("txt02_particulars", f"SELECT id, line FROM {LINES} WHERE regexp_matches(line, '^(?:{_re2(sentences.PARTICULARS)})[{_SPACES}]*[:\\-]', 'i') OR regexp_full_match(line, '[^{_SPACES}]{{40,}}')")
def particulars(t):
    return _lines(t).where(lines.is_particular(F.col("line")))


_KEY = f"lower(trim(regexp_replace(regexp_replace(regexp_replace(line, '^#+[{_SPACES}]*', ''), '[\\[\\]()*:_]', ' ', 'g'), '[{_SPACES}]+', ' ', 'g')))"


@query("txt03_headings", f"SELECT id, line FROM (SELECT id, line, {_KEY} AS k FROM {LINES} WHERE line <> '') WHERE k <> '' AND (regexp_full_match(line, '\\[.+\\]') OR (len(regexp_extract_all(k, '[\\p{{L}}\\p{{N}}_]+')) <= 6 AND (k IN ({', '.join(chr(39) + h.replace(chr(39), chr(39) * 2) + chr(39) for h in sorted(sentences.HEADINGS))}) OR regexp_matches(line, ':[{_SPACES}]*$'))))")
def headings(t):
    return _lines(t).where(lines.is_heading(F.col("line")))


@query("udf01_registered", f"SELECT id, {_cleaned('job_title_english')} AS line FROM jobads_jp")
def registered_functions(t):
    registered.register(t.spark)
    t.jobads_jp.select("id", "job_title_english").createOrReplaceTempView("adloom_ads")
    return t.spark.sql("SELECT id, clean_line(job_title_english) AS line FROM adloom_ads")


@query("udf01_table_function")
def table_function(t):
    registered.register(t.spark)
    t.jobads_jp.select("id", "description_english").createOrReplaceTempView("adloom_texts")
    return t.spark.sql("SELECT id, s.pos, s.sentence FROM adloom_texts, LATERAL ad_sentences(description_english) s")


def _listed(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(words))


_TOKENS = "regexp_extract_all(line, '[\\p{L}\\p{N}_](?:[\\p{L}\\p{N}_''\\-]*[\\p{L}\\p{N}_])?')"
_FIRST = f"regexp_replace(lower(regexp_extract(line, '^[{_SPACES}]*([^{_SPACES}]+)', 1)), '^[.,;:()\\[\\]\"'']+|[.,;:()\\[\\]\"'']+$', '', 'g')"
_VERBS = f"regexp_matches(line, '(^|[^\\p{{L}}\\p{{N}}_])(?:{sentences.VERBS})($|[^\\p{{L}}\\p{{N}}_])', 'i')"


@query("txt04_continuations", f"SELECT id, line, NOT regexp_matches(line, '[.!?:;]$') AND (ends_with(line, ',') OR coalesce(lower({_TOKENS}[-1]) IN ({_listed(sentences.CONNECTING)}), false) OR (len({_TOKENS}) BETWEEN 1 AND 3 AND NOT {_VERBS})) AS may_go_on, regexp_matches(line, '^[\\p{{Ll}},;)\\]]') OR {_FIRST} IN ({_listed(sentences.CONNECTING)}) AS goes_on FROM {LINES} WHERE line <> ''")
def continuations(t):
    return _lines(t).select("id", "line", lines.may_go_on(F.col("line")).alias("may_go_on"), lines.goes_on(F.col("line")).alias("goes_on"))


# incremental batches


@query("stm01_new_files", "SELECT id, upper(employer) AS employer FROM jobads_jp WHERE employer IS NOT NULL")
def new_files(t):
    path, ads = folder(t, "in"), t.jobads_jp.where("employer is not null").select("id", "employer")
    sink, checkpoint = folder(t, "out"), folder(t, "checkpoint")
    for part in (ads.where("source is null"), ads.where("source is not null"), None):  # the third run finds nothing new
        if part is not None:
            files.write_jsonl(part, path, append=True)
        incremental.process_new_files(t.spark, path, "id long, employer string", lambda s: s.withColumn("employer", F.upper("employer")), sink, checkpoint)
    return t.spark.read.parquet(sink)


@query("stm02_chunks", "SELECT id FROM jobads_jp")
def flushed(t):
    path, sink = folder(t, "in"), folder(t, "out")
    files.write_requests(t.jobads_jp.select("id"), path, 1_000)
    incremental.process_new_files(t.spark, path, "id long", lambda s: s, sink, folder(t, "checkpoint"), files_a_batch=2)
    return t.spark.read.parquet(sink)


@query("stm04_daily", "SELECT job_url, arg_min(id, CASE WHEN source = 'careerjet' THEN 0 ELSE 1000000000000 END + id) AS id FROM jobads_jp WHERE job_url <> '' GROUP BY job_url")
def daily(t):
    path, ads = folder(t, "in"), t.jobads_jp.select("id", "job_url", "source")
    master, checkpoint = folder(t, "master"), folder(t, "checkpoint")
    for part in (ads.where("source = 'careerjet'"), ads.where("source is null or source <> 'careerjet'")):
        files.write_jsonl(part.select("id", "job_url"), path, append=True)
        incremental.collect_daily(t.spark, path, "id long, job_url string", master, checkpoint, "job_url", "id")
    return t.spark.read.parquet(master).select("job_url", "id")
