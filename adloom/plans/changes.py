"""Queries of scans, projections, joins and changes to tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from adloom.functions.text import filled, is_blank, table_name, url_domain
from adloom.operators import upsert
from adloom.operators.ranks import numbered
from adloom.plans.catalog import query
from adloom.sources.files import in_year

ORD = "md5(concat_ws('|', coalesce(description,'<null>'), coalesce(job_title_english,'<null>'), coalesce(region_iso,'<null>'), coalesce(skills,'<null>'), coalesce(skill_match,'<null>'), coalesce(isic_section,'<null>'), coalesce(source,'<null>')))"
BLANK = "({0} IS NULL OR trim({0}, ' ') = '')"


@query("src04_year_range", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'")
def year_range(t):
    return in_year(t.orders, "o_orderdate", 1996).select("o_orderkey", "o_custkey")


@query("src02_by_source", "SELECT job_url, region_iso, source FROM offers WHERE source = 'careerjet'")
def by_source(t):
    return t.offers.where("source = 'careerjet'").select("job_url", "region_iso", "source")


@query("src12_parquet_scan", "SELECT id, job_title FROM jobads_jp WHERE needs_title_translation = 1")
def parquet_scan(t):
    return t.jobads_jp.where("needs_title_translation = 1").select("id", "job_title")


@query("src14_first_indicator", "WITH x AS (SELECT region_iso, skill_match, id FROM jobads_jp) SELECT region_iso, coalesce(CASE WHEN region_iso = 'JP-01' THEN 'fixed' END, arg_min(skill_match, id) FILTER (WHERE skill_match IS NOT NULL)) AS value FROM x WHERE region_iso IS NOT NULL GROUP BY region_iso")
def first_indicator(t):
    g = t.jobads_jp.where("region_iso is not null").groupBy("region_iso").agg(F.min_by(F.col("skill_match"), F.when(F.col("skill_match").isNotNull(), F.col("id"))).alias("fetched"))
    return g.select("region_iso", F.coalesce(F.when(F.col("region_iso") == "JP-01", F.lit("fixed")), "fetched").alias("value"))


@query("src15_first_rows_per_source", "SELECT id, source FROM (SELECT id, coalesce(source,'indeed') AS source, row_number() OVER (PARTITION BY coalesce(source,'indeed') ORDER BY id) AS r FROM jobads_jp) WHERE r <= 500")
def first_rows_per_source(t):
    x = t.jobads_jp.select("id", F.coalesce("source", F.lit("indeed")).alias("source"))
    return upsert.top_per_group(x, ["source"], [F.col("id")], 500).select("id", "source")


@query("snk08_add_columns", "SELECT id, source, CAST(NULL AS VARCHAR) AS nace_code, CAST(NULL AS VARCHAR) AS isco_code FROM jobads_jp")
def add_columns(t):
    return upsert.with_columns_if_missing(t.jobads_jp.select("id", "source"), ["source", "nace_code", "isco_code"])


@query("snk10_rename_tables", "SELECT DISTINCT s AS old_name, CASE WHEN starts_with(s, 'jobads_') THEN s ELSE 'jobads_' || CASE WHEN regexp_replace(replace(regexp_replace(s, 'indeed|Indeed|INDEED', '', 'g'), '__', '_'), '^_+|_+$', '', 'g') = '' THEN 'table' ELSE regexp_replace(replace(regexp_replace(s, 'indeed|Indeed|INDEED', '', 'g'), '__', '_'), '^_+|_+$', '', 'g') END END AS new_name FROM (SELECT coalesce(source,'indeed') || '_' || coalesce(isic_section,'') AS s FROM jobads_jp UNION ALL SELECT coalesce(source,'indeed') FROM jobads_jp UNION ALL SELECT 'jobads_' || coalesce(source,'indeed') FROM jobads_jp)")
def rename_tables(t):
    s = F.coalesce("source", F.lit("indeed"))
    names = t.jobads_jp.select(F.explode(F.array(F.concat(s, F.lit("_"), F.coalesce("isic_section", F.lit(""))), s, F.concat(F.lit("jobads_"), s))).alias("old_name")).distinct()
    return names.withColumn("new_name", table_name(F.col("old_name")))


@query("snk13_request_files", "SELECT id, CAST(floor((row_number() OVER (ORDER BY id) - 1) / 1000) AS BIGINT) AS file_no FROM jobads_jp WHERE needs_description_translation = 1")
def request_files(t):
    x = numbered(t.jobads_jp.where("needs_description_translation = 1").select("id"), [], ["id"])
    return x.select("id", F.floor((F.col("place") - 1) / 1000).cast("long").alias("file_no"))


@query("snk14_fill_source", "SELECT id, coalesce(source, 'indeed') AS source FROM jobads_jp")
def fill_source(t):
    return t.jobads_jp.select("id", F.coalesce("source", F.lit("indeed")).alias("source"))




def _flag(text: str, english: str, lang: str):
    return F.when(~is_blank(F.col(text)) & is_blank(F.col(english)) & (F.col(lang).isNull() | (F.col(lang) != "EN")), 1).otherwise(0)


@query(
    "prj02_flags",
    "SELECT id, "
    + "CASE WHEN NOT {0} AND {1} AND (job_title_lang IS NULL OR job_title_lang <> 'EN') THEN 1 ELSE 0 END AS title_flag, ".format(BLANK.format("job_title"), BLANK.format("job_title_english"))
    + "CASE WHEN NOT {0} AND {1} AND (responsibilities_lang IS NULL OR responsibilities_lang <> 'EN') THEN 1 ELSE 0 END AS description_flag, ".format(BLANK.format("responsibilities"), BLANK.format("description_english"))
    + f"CASE WHEN {BLANK.format('skills')} THEN 1 ELSE 0 END AS skill_flag FROM jobads_jp",
)
def flags(t):
    return t.jobads_jp.select("id", _flag("job_title", "job_title_english", "job_title_lang").alias("title_flag"), _flag("responsibilities", "description_english", "responsibilities_lang").alias("description_flag"), F.when(is_blank(F.col("skills")), 1).otherwise(0).alias("skill_flag"))


@query("prj05_copy_english", f"SELECT id, CASE WHEN {BLANK.format('job_title_english')} AND job_title_lang = 'EN' AND NOT {BLANK.format('job_title')} THEN job_title ELSE job_title_english END AS job_title_english FROM jobads_jp")
def copy_english(t):
    c = is_blank(F.col("job_title_english")) & (F.col("job_title_lang") == "EN") & ~is_blank(F.col("job_title"))
    return t.jobads_jp.select("id", F.when(c, F.col("job_title")).otherwise(F.col("job_title_english")).alias("job_title_english"))


@query("prj06_fill_if_blank", "SELECT id, coalesce(nullif(trim(description_english, ' '), ''), responsibilities) AS description_english FROM jobads_jp")
def fill_if_blank(t):
    return t.jobads_jp.select("id", F.coalesce(filled(F.col("description_english")), "responsibilities").alias("description_english"))


@query("prj07_pending_language", f"SELECT id FROM jobads_jp WHERE {BLANK.format('responsibilities_lang')}")
def pending_language(t):
    return t.jobads_jp.where(is_blank(F.col("responsibilities_lang"))).select("id")


@query("prj08_pending_translation", f"SELECT id, responsibilities FROM jobads_jp WHERE needs_description_translation = 1 AND NOT {BLANK.format('responsibilities')}")
def pending_translation(t):
    return t.jobads_jp.where((F.col("needs_description_translation") == 1) & ~is_blank(F.col("responsibilities"))).select("id", "responsibilities")


@query("prj09_tasks", "SELECT 'jobads_jp:' || id || ':title' AS custom_id, job_title AS text FROM jobads_jp WHERE needs_title_translation = 1 UNION ALL SELECT 'jobads_jp:' || id || ':resp', responsibilities FROM jobads_jp WHERE needs_description_translation = 1")
def tasks(t):
    def task(flag, field, text):
        return F.struct((F.col(flag) == 1).alias("todo"), F.concat_ws(":", F.lit("jobads_jp"), F.col("id").cast("string"), F.lit(field)).alias("custom_id"), F.col(text).alias("text"))

    made = F.array(task("needs_title_translation", "title", "job_title"), task("needs_description_translation", "resp", "responsibilities"))
    return t.jobads_jp.select(F.explode(F.filter(made, lambda x: x["todo"])).alias("x")).select("x.custom_id", "x.text")


@query("prj11_rename_columns", "SELECT job_url, location_posting AS workplace, title_lang AS job_title_lang, description AS responsibilities FROM offers")
def rename_columns(t):
    names = {"job_url": "job_url", "location_posting": "workplace", "title_lang": "job_title_lang", "description": "responsibilities"}
    return t.offers.select(*[F.col(a).alias(b) for a, b in names.items() if a in t.offers.columns])


@query("prj12_domains", "SELECT coalesce(nullif(split_part(job_url, '/', 3), ''), 'none') AS domain, count(*) AS n FROM jobads_jp WHERE job_url IS NOT NULL GROUP BY 1")
def domains(t):
    return t.jobads_jp.where("job_url is not null").groupBy(F.coalesce(F.nullif(url_domain(F.col("job_url")), F.lit("")), F.lit("none")).alias("domain")).agg(F.count("*").alias("n"))


@query("prj14_valid_ads", f"SELECT id FROM jobads_jp WHERE NOT {BLANK.format('job_title')} AND NOT {BLANK.format('responsibilities')} AND NOT {BLANK.format('job_url')}")
def valid_ads(t):
    return t.jobads_jp.where(~is_blank(F.col("job_title")) & ~is_blank(F.col("responsibilities")) & ~is_blank(F.col("job_url"))).select("id")


@query("prj15_concept_sets", "SELECT uri, 'skills' AS concept_set FROM esco_concepts WHERE skill_type = 'skills' AND starts_with(code, 'S5') UNION ALL SELECT uri, 'knowledge' FROM esco_concepts WHERE skill_type = 'knowledge' AND starts_with(code, '06')")
def concept_sets(t):
    c = t.esco_concepts
    return c.where((F.col("skill_type") == "skills") & F.col("code").startswith("S5")).select("uri", F.lit("skills").alias("concept_set")).unionAll(c.where((F.col("skill_type") == "knowledge") & F.col("code").startswith("06")).select("uri", F.lit("knowledge")))




@query(
    "joi01_update_from",
    f"WITH s AS (SELECT job_url AS u, max_by(struct_pack(t := job_title_english, g := region_iso), {ORD}) AS r FROM offers WHERE job_url IS NOT NULL GROUP BY job_url) "
    "SELECT id, CASE WHEN u IS NOT NULL THEN r.t ELSE job_title_english END AS job_title_english, CASE WHEN u IS NOT NULL THEN r.g ELSE region_iso END AS region_iso, u IS NOT NULL AS matched FROM jobads_jp LEFT JOIN s ON job_url = u",
)
def update_from(t):
    target = t.jobads_jp.select("id", "job_url", "job_title_english", "region_iso")
    return upsert.update_from(target, t.offers, ["job_url"], ["job_title_english", "region_iso"], F.expr(ORD)).drop("job_url")


@query("joi02_update_coverage", "SELECT (SELECT count(*) FROM offers o WHERE o.job_url IN (SELECT job_url FROM jobads_jp WHERE job_url IS NOT NULL)) AS source_rows, (SELECT count(*) FROM jobads_jp WHERE job_url IN (SELECT job_url FROM offers WHERE job_url IS NOT NULL)) AS target_rows, (SELECT count(*) FROM jobads_jp WHERE job_url IS NOT NULL) AS total, (SELECT CAST(round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM jobads_jp), 2) AS DECIMAL(18,2)) FROM offers o WHERE o.job_url IN (SELECT job_url FROM jobads_jp WHERE job_url IS NOT NULL)) AS coverage")
def update_coverage(t):
    per = lambda df, n: df.where("job_url is not null").groupBy("job_url").agg(F.count("*").alias(n))
    x = per(t.jobads_jp, "a").join(per(t.offers, "o"), "job_url", "left")
    n = t.jobads_jp.agg(F.count("*").alias("n"))
    sums = x.agg(F.coalesce(F.sum("o"), F.lit(0)).alias("source_rows"), F.coalesce(F.sum(F.when(F.col("o").isNotNull(), F.col("a"))), F.lit(0)).alias("target_rows"), F.coalesce(F.sum("a"), F.lit(0)).alias("total"))
    # source rows that match, each counted, so the coverage of a source with repeats may be above 100
    return sums.crossJoin(n).select("source_rows", "target_rows", "total", F.round(F.try_divide(100.0 * F.col("source_rows"), F.col("n")), 2).cast("decimal(18,2)").alias("coverage"))


@query("joi03_update_by_id", "WITH s AS (SELECT id AS k, max(array_to_string([m.label FOR m IN skills], '|')) AS x FROM jp_mentions GROUP BY id) SELECT id, CASE WHEN k IS NOT NULL THEN x ELSE skills END AS skills, isic_section, k IS NOT NULL AS matched FROM jobads_jp LEFT JOIN s ON id = k")
def update_by_id(t):
    labels = F.array_join(F.transform("skills", lambda m: m["label"]), "|")
    source = t.jp_mentions.select("id", labels.alias("skills"))
    target = t.jobads_jp.select("id", "skills", "isic_section")
    wanted = [c for c in ("skills", "isic_section", "company_founded") if c in upsert.shared_columns(target, source)]
    return upsert.update_from(target, source, ["id"], wanted, F.col("skills"))


@query("joi04_insert_absent", "SELECT job_url, title_lang, region_iso FROM offers WHERE job_url <> '' AND job_url NOT IN (SELECT job_url FROM jobads_jp WHERE job_url IS NOT NULL)")
def insert_absent(t):
    return upsert.insert_absent(t.jobads_jp, t.offers, "job_url").select("job_url", "title_lang", "region_iso")


@query("joi05_insert_sequential", f"SELECT job_url, min({ORD}) AS chosen FROM offers WHERE job_url <> '' AND job_url NOT IN (SELECT job_url FROM jobads_jp WHERE job_url IS NOT NULL) GROUP BY job_url")
def insert_sequential(t):
    batch = t.offers.withColumn("chosen", F.expr(ORD))
    return upsert.insert_absent(t.jobads_jp, batch, "job_url", F.col("chosen")).select("job_url", "chosen")


@query("joi06_fill_blanks", f"WITH v AS (SELECT job_url AS u, arg_min(regexp_replace(job_title_english, '^[\\s\\x{{A0}}\\x{{3000}}]+|[\\s\\x{{A0}}\\x{{3000}}]+$', '', 'g'), {ORD}) AS x FROM offers WHERE job_url IS NOT NULL AND regexp_replace(job_title_english, '[\\s\\x{{A0}}\\x{{3000}}]+', '', 'g') <> '' GROUP BY job_url) SELECT id, CASE WHEN {BLANK.format('job_title_english')} THEN coalesce(x, job_title_english) ELSE job_title_english END AS job_title_english FROM jobads_jp LEFT JOIN v ON job_url = u")
def fill_blanks(t):
    target = t.jobads_jp.select("id", "job_url", "job_title_english")
    return upsert.fill_blanks(target, t.offers.withColumnRenamed("job_title_english", "v"), "job_url", "job_title_english", "v", F.expr(ORD.replace("job_title_english", "v"))).drop("job_url")


@query("joi08_reset", "SELECT id, CASE WHEN id IN (SELECT id FROM jp_mentions) THEN NULL ELSE description_english END AS description_english, CASE WHEN id IN (SELECT id FROM jp_mentions) THEN 1 ELSE needs_description_translation END AS needs_description_translation FROM jobads_jp")
def reset(t):
    return upsert.reset(t.jobads_jp.select("id", "description_english", "needs_description_translation"), t.jp_mentions, "id", "description_english", "needs_description_translation")


@query("joi10_pending_ids", "SELECT id FROM jobads_jp WHERE id NOT IN (SELECT id FROM jp_mentions WHERE id IS NOT NULL)")
def pending_ids(t):
    return t.jobads_jp.select("id").join(t.jp_mentions.select("id"), "id", "left_anti")


@query("joi23_deduplicate", "SELECT DISTINCT job_title, responsibilities FROM jobads_jp")
def deduplicate(t):
    return t.jobads_jp.select("job_title", "responsibilities").dropDuplicates(["job_title", "responsibilities"])


@query("set01_union_tables", "SELECT job_url, source, region_iso, 'ads' AS origin, id FROM jobads_jp UNION ALL SELECT job_url, source, region_iso, 'offers', NULL FROM offers")
def union_tables(t):
    a = t.jobads_jp.select("job_url", "source", "region_iso", F.lit("ads").alias("origin"), "id")
    return a.unionByName(t.offers.select("job_url", "source", "region_iso", F.lit("offers").alias("origin")), allowMissingColumns=True)


@query("set02_union_distinct", "SELECT region_iso FROM jobads_jp UNION SELECT region_iso FROM offers")
def union_distinct(t):
    return t.jobads_jp.select("region_iso").union(t.offers.select("region_iso")).distinct()


@query("set05_multiset_add", "SELECT term, CAST(sum(n) AS BIGINT) AS n FROM (SELECT source AS term, count(*) AS n FROM jobads_jp GROUP BY 1 UNION ALL SELECT source, count(*) FROM offers GROUP BY 1) GROUP BY term")
def multiset_add(t):
    return t.jobads_jp.select("source").unionAll(t.offers.select("source")).groupBy(F.col("source").alias("term")).agg(F.count("*").alias("n"))
