"""Queries of joins by similarity."""

from __future__ import annotations


from pyspark.sql import functions as F

from adloom.functions.text import label_key
from adloom.operators import matching
from adloom.operators.upsert import top_per_group
from adloom.plans.aggregates import LEVELS, MENTIONS, levels, mentions
from adloom.plans.catalog import query


def terms(t):
    """Distinct labels of mentions with their counts."""
    return mentions(t).where("label is not null").groupBy(F.col("label").alias("term")).agg(F.count("*").alias("n"))


@query("joi11_concept_lookup", f"SELECT skill_type, count(*) AS n, count(*) FILTER (WHERE c.uri IS NULL) AS unmapped FROM {MENTIONS} LEFT JOIN esco_concepts c ON c.uri = m.uri GROUP BY 1")
def concept_lookup(t):
    c = t.esco_concepts.select("uri", "skill_type", F.lit(1).alias("hit"))
    return mentions(t).join(c, "uri", "left").groupBy("skill_type").agg(F.count("*").alias("n"), F.count_if(F.col("hit").isNull()).alias("unmapped"))


@query("joi12_set_membership", f"SELECT id, m.uri AS uri FROM {MENTIONS} WHERE m.uri IN (SELECT uri FROM esco_concepts WHERE starts_with(code, 'S5'))")
def set_membership(t):
    return mentions(t).join(t.esco_concepts.where(F.col("code").startswith("S5")).select("uri"), "uri", "left_semi").select("id", "uri")


@query("joi13_first_level", f"SELECT uri, CAST(min(p) AS BIGINT) AS level FROM esco_concepts JOIN {LEVELS} ON lower(trim(title, ' ')) = k GROUP BY uri")
def first_level(t):
    return levels(t).withColumn("level", F.col("level").cast("long"))


@query("joi14_label_join", "SELECT esco_skill_label AS label, max(code) AS code FROM digital_levels LEFT JOIN esco_concepts ON lower(trim(title, ' ')) = lower(trim(regexp_replace(esco_skill_label, '[\\s\\x{A0}]+', ' ', 'g'), ' ')) GROUP BY 1")
def label_join(t):
    by_title = t.esco_concepts.groupBy(label_key(F.col("title")).alias("k")).agg(F.max("code").alias("c"))
    return t.digital_levels.select(F.col("esco_skill_label").alias("label")).distinct().withColumn("k", label_key(F.col("label"))).join(by_title, "k", "left").select("label", F.col("c").alias("code"))


BARE = "trim(regexp_replace(lower({}), '[^a-z0-9 ]', '', 'g'), ' ')"


@query("joi15_exact_steps", f"WITH t AS (SELECT DISTINCT m.label AS term FROM {MENTIONS} WHERE m.label IS NOT NULL), a AS (SELECT lower(title) AS k, min(code) AS c FROM esco_concepts GROUP BY 1), b AS (SELECT {BARE.format('title')} AS k, min(code) AS c FROM esco_concepts GROUP BY 1 HAVING {BARE.format('title')} <> '') SELECT term, coalesce(a.c, b.c) AS code, CASE WHEN a.c IS NOT NULL THEN 'exact' WHEN b.c IS NOT NULL THEN 'bare' END AS step FROM t LEFT JOIN a ON a.k = lower(term) LEFT JOIN b ON b.k = {BARE.format('term')}")
def exact_steps(t):
    return matching.exact_steps(terms(t).select("term"), t.esco_concepts, "term", "title", "code")


@query("joi16_longest_contained", "WITH t AS (SELECT DISTINCT job_title_english AS term FROM jobads_jp WHERE job_title_english IS NOT NULL), h AS (SELECT term, code, row_number() OVER (PARTITION BY term ORDER BY length(title) DESC, lower(title)) AS r FROM t JOIN esco_occupations ON length(title) >= 4 AND contains(lower(term), lower(title))) SELECT t.term, code FROM t LEFT JOIN h ON h.term = t.term AND r = 1")
def longest_contained(t):
    x = t.jobads_jp.where("job_title_english is not null").select(F.col("job_title_english").alias("term")).distinct()
    return matching.longest_contained(x, t.esco_occupations, "term", "title", "code").select("term", "code")


@query("joi17_fuzzy")
def fuzzy(t):
    left = matching.exact_steps(terms(t), t.esco_concepts, "term", "title", "code").where("step is null")
    # the most frequent of what no cheaper step found
    asked = left.where("n >= 3").orderBy(F.desc("n"), "term").limit(15_000).select("term")
    return matching.fuzzy(asked, t.esco_concepts, "term", "title", "code")


@query("joi18_nearest", "WITH s AS (SELECT q.vec_id AS query, b.vec_id AS neighbour, list_dot_product(q.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS score FROM embeddings q JOIN embeddings b ON q.vec_id <> b.vec_id WHERE q.vec_id % 20 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, neighbour) AS rank FROM s) SELECT query, neighbour, CAST(round(score, 4) AS DECIMAL(18,4)) AS score, CAST(rank AS BIGINT) AS rank FROM r WHERE rank <= 2")
def nearest(t):
    x = matching.nearest(t.embeddings.where("vec_id % 20 = 0"), t.embeddings, "vec_id", "embedding", 2)
    return x.select("query", "neighbour", F.round("score", 4).cast("decimal(18,4)").alias("score"), F.col("rank").cast("long").alias("rank"))


ATTENTION = "WITH s AS (SELECT vec_id, embedding::DOUBLE[] AS z FROM embeddings WHERE vec_id < 100), k AS (SELECT CAST(floor(vec_id / 10) AS BIGINT) AS sentence, embedding::DOUBLE[] AS x FROM embeddings WHERE vec_id >= 100), d AS (SELECT sentence, s.vec_id AS skill, list_dot_product(x, z) AS dot, list_cosine_similarity(x, z) AS c FROM k, s), w AS (SELECT *, exp(dot - max(dot) OVER (PARTITION BY sentence, skill)) AS e FROM d) SELECT sentence, skill, CAST(round(sum(e * c) / sum(e), 4) AS DECIMAL(18,4)) AS score FROM w GROUP BY 1, 2 HAVING sum(e * c) / sum(e) >= {0}"


@query("joi19_token_attention", ATTENTION.format(0.1))
def token_attention(t):
    e = t.embeddings
    tokens = e.where("vec_id >= 100").select(F.floor(F.col("vec_id") / 10).alias("sentence"), "vec_id", "embedding")
    x = matching.attention(tokens, e.where("vec_id < 100").select(F.col("vec_id").alias("skill"), F.col("embedding").alias("z")), "sentence", "vec_id", "embedding", "skill", "z", 0.1)
    return x.withColumn("score", F.round("score", 4).cast("decimal(18,4)"))


@query("joi21_sector_tiers", "WITH o AS (SELECT esco_occupation_title_semantic AS occ, esco_occupation_code_semantic AS code, count(*) AS n FROM jobads_jp WHERE esco_occupation_title_semantic IS NOT NULL AND esco_occupation_code_semantic IS NOT NULL GROUP BY 1, 2) SELECT occ, CASE WHEN count(DISTINCT code) = 1 THEN 1 WHEN count(DISTINCT substr(code, 1, 2)) = 1 THEN 2 ELSE 3 END AS tier, CASE WHEN count(DISTINCT code) = 1 THEN min(code) WHEN count(DISTINCT substr(code, 1, 2)) = 1 THEN min(substr(code, 1, 2)) ELSE arg_max(code, n * 1000000 - CAST(replace(code, '.', '') AS BIGINT)) END AS sector FROM o GROUP BY occ")
def sector_tiers(t):
    o = t.jobads_jp.where("esco_occupation_title_semantic is not null and esco_occupation_code_semantic is not null").groupBy(F.col("esco_occupation_title_semantic").alias("occ"), F.col("esco_occupation_code_semantic").alias("code")).agg(F.count("*").alias("n"))
    d = F.substring("code", 1, 2)
    x = o.groupBy("occ").agg(F.count("*").alias("k"), F.min("code").alias("c"), F.min(d).alias("lo"), F.max(d).alias("hi"), F.max_by("code", F.col("n") * 1000000 - F.replace("code", F.lit("."), F.lit("")).cast("long")).alias("best"))
    tier = F.when(F.col("k") == 1, 1).when(F.col("lo") == F.col("hi"), 2).otherwise(3)
    return x.select("occ", tier.alias("tier"), F.when(F.col("k") == 1, F.col("c")).when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("best")).alias("sector"))


@query("joi22_country_meta", "SELECT n_name, r_name, count(s_suppkey) AS suppliers FROM nation LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1, 2")
def country_meta(t):
    s = t.supplier.groupBy("s_nationkey").agg(F.count("*").alias("suppliers"))
    x = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left").join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    return x.select("n_name", "r_name", F.coalesce("suppliers", F.lit(0)).alias("suppliers"))


@query("top02_top_twice", f"WITH a AS (SELECT id, m.uri AS uri, max(m.score) AS score FROM {MENTIONS} WHERE m.score IS NOT NULL GROUP BY 1, 2), b AS (SELECT uri, id, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, uri) AS r FROM a), c AS (SELECT uri, id, row_number() OVER (PARTITION BY uri ORDER BY score DESC, id) AS q FROM b WHERE r <= 3) SELECT uri, id FROM c WHERE q <= 50")
def top_twice(t):
    a = mentions(t).where("score is not null").groupBy("id", "uri").agg(F.max("score").alias("score"))
    b = top_per_group(a, ["id"], [F.desc("score"), F.col("uri")], 3)
    return top_per_group(b, ["uri"], [F.desc("score"), F.col("id")], 50, "q").select("uri", "id")
