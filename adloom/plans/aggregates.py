"""Queries of aggregations, windows, orders and statistics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from adloom.functions import stats
from adloom.functions.text import day, knowledge_branch, label_key, skill_branch
from adloom.operators.keyness import keyness
from adloom.operators.ranks import numbered
from adloom.operators.upsert import top_per_group
from adloom.plans.catalog import query

SRC = "coalesce(source, 'indeed')"
DAY = "coalesce(" + ", ".join(f"try_strptime({{0}}, '{f}')" for f in ("%Y-%m-%d", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S", "%Y/%m/%d", "%d.%m.%Y")) + ")"
MENTIONS = "(SELECT id, unnest(skills) AS m FROM (SELECT DISTINCT id, skills FROM jp_mentions))"


def mentions(t):
    """(id, uri, label, score) of the distinct rows of mentions."""
    return t.jp_mentions.distinct().select("id", F.explode(F.coalesce("skills", F.array())).alias("m")).select("id", "m.uri", "m.label", "m.score")


def by_source(t):
    ads = t.jobads_jp.select("id", F.coalesce("source", F.lit("indeed")).alias("source"))
    return mentions(t).join(ads, "id")


@query("agg01_rows", f"SELECT {SRC} AS source, count(*) AS n FROM jobads_jp GROUP BY 1")
def rows(t):
    return t.jobads_jp.groupBy(F.coalesce("source", F.lit("indeed")).alias("source")).agg(F.count("*").alias("n"))


@query("agg02_flag_sums", "SELECT CAST(coalesce(sum(needs_title_translation), 0) AS BIGINT) AS titles, CAST(coalesce(sum(needs_description_translation), 0) AS BIGINT) AS descriptions, count(*) FILTER (WHERE needs_skill_extraction = 1) AS skills FROM jobads_jp")
def flag_sums(t):
    return t.jobads_jp.agg(*(F.coalesce(F.sum(f"needs_{a}"), F.lit(0)).cast("long").alias(b) for a, b in (("title_translation", "titles"), ("description_translation", "descriptions"))), F.count_if(F.col("needs_skill_extraction") == 1).alias("skills"))


@query("agg03_term_frequency", f"SELECT {SRC} AS source, lower(trim(m.label, ' ')) AS term, count(*) AS n FROM jobads_jp JOIN {MENTIONS} USING (id) WHERE trim(m.label, ' ') <> '' GROUP BY 1, 2")
def term_frequency(t):
    return by_source(t).where("trim(label) <> ''").groupBy("source", F.lower(F.trim("label")).alias("term")).agg(F.count("*").alias("n"))


@query("agg04_three_grains", f"WITH x AS (SELECT {SRC} AS source, id, m.uri AS uri FROM jobads_jp JOIN {MENTIONS} USING (id)) SELECT source, uri, count(*) AS n FROM x GROUP BY GROUPING SETS ((source, uri), (source)) ")
def three_grains(t):
    return by_source(t).groupingSets([["source", "uri"], ["source"]], "source", "uri").agg(F.count("*").alias("n"))


KEYNESS = """WITH x AS (SELECT {src} AS source, m.uri AS uri FROM jobads_jp JOIN {m} USING (id) WHERE m.uri IN (SELECT uri FROM esco_concepts WHERE skill_type = 'skills')),
c AS (SELECT source, uri, count(*) AS a FROM x GROUP BY ALL), t AS (SELECT *, sum(a) OVER (PARTITION BY source) AS t, sum(a) OVER (PARTITION BY uri) AS g, sum(a) OVER () AS n FROM c),
q AS (SELECT source, uri, a, g, a AS ca, t - a AS b, g - a AS c, (n - t) - (g - a) AS d, n, a / t AS rate, CASE WHEN n - t = 0 THEN 0 ELSE (g - a) / (n - t) END AS other FROM t),
f AS (SELECT *, 2 * (CASE WHEN a > 0 THEN a * ln(a / ((a + b)::DOUBLE * (a + c) / n)) ELSE 0 END + CASE WHEN b > 0 THEN b * ln(b / ((a + b)::DOUBLE * (b + d) / n)) ELSE 0 END + CASE WHEN c > 0 THEN c * ln(c / ((c + d)::DOUBLE * (a + c) / n)) ELSE 0 END + CASE WHEN d > 0 THEN d * ln(d / ((c + d)::DOUBLE * (b + d) / n)) ELSE 0 END) AS g2 FROM q WHERE a >= 3 AND g >= 10 AND d >= 0 AND rate > other),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY round(g2, 6) DESC, a DESC, uri) AS rank FROM f)
SELECT source, uri, CAST(a AS BIGINT) AS a, CAST(c AS BIGINT) AS c, CAST(round(g2, 4) AS DECIMAL(18,4)) AS g2, CAST(round(CASE WHEN other = 0 THEN NULL ELSE rate / other END, 4) AS DECIMAL(18,4)) AS lift, CAST(rank AS BIGINT) AS rank FROM r WHERE rank <= 15"""


@query("agg05_keyness", KEYNESS.format(src=SRC, m=MENTIONS))
def typical(t):
    skills = t.esco_concepts.where("skill_type = 'skills'").select("uri").distinct()
    k = keyness(by_source(t).join(skills, "uri", "left_semi"), "source", "uri")
    return k.select("source", "uri", "a", "c", F.round("g2", 4).cast("decimal(18,4)").alias("g2"), F.round("lift", 4).cast("decimal(18,4)").alias("lift"), F.col("rank").cast("long").alias("rank"))


LEVELS = "(SELECT k, min(p) AS p FROM (SELECT lower(trim(regexp_replace(esco_skill_label, '[\\s\\x{A0}]+', ' ', 'g'), ' ')) AS k, CASE digital_taxonomy WHEN 'Dig./Basic ICT' THEN 1 WHEN 'Dig./Intermediate ICT' THEN 2 ELSE 3 END AS p FROM digital_levels) GROUP BY k)"


def levels(t):
    """(uri, level): the first of basic, intermediate and advanced that a concept's title is listed under."""
    p = F.when(F.col("digital_taxonomy") == "Dig./Basic ICT", 1).when(F.col("digital_taxonomy") == "Dig./Intermediate ICT", 2).otherwise(3)
    listed = t.digital_levels.groupBy(label_key(F.col("esco_skill_label")).alias("k")).agg(F.min(p).alias("level"))
    return t.esco_concepts.select("uri", label_key(F.col("title")).alias("k")).join(listed, "k").groupBy("uri").agg(F.min("level").alias("level"))


@query("agg06_level_shares", f"WITH u AS (SELECT uri, min(p) AS level FROM esco_concepts JOIN {LEVELS} ON lower(trim(title, ' ')) = k GROUP BY uri), x AS (SELECT {SRC} AS source, level, count(*) AS n FROM jobads_jp JOIN {MENTIONS} USING (id) JOIN u ON u.uri = m.uri GROUP BY ALL) SELECT source, CAST(level AS BIGINT) AS level, n, CAST(round(n / sum(n) OVER (PARTITION BY source), 4) AS DECIMAL(18,4)) AS share FROM x")
def level_shares(t):
    n = by_source(t).join(levels(t), "uri").groupBy("source", "level").agg(F.count("*").alias("n"))
    return stats.share(n, ["source"], "n").select("source", F.col("level").cast("long").alias("level"), "n", F.round("share", 4).cast("decimal(18,4)").alias("share"))


_BUCKET = "CASE WHEN c.uri IS NULL THEN 'unmapped' WHEN skill_type = 'skills' THEN coalesce(CASE WHEN starts_with(code, 'S') THEN substr(code, 1, 2) END, 'other') WHEN skill_type = 'knowledge' THEN coalesce(CASE WHEN length(regexp_replace(code, '[^0-9]', '', 'g')) >= 3 THEN substr(regexp_replace(code, '[^0-9]', '', 'g'), 1, 3) END, 'other') ELSE skill_type END"


def bucketed(t, threshold=0.55):
    kept = by_source(t).where(F.coalesce("score", F.lit(0.0)) >= threshold)
    c = t.esco_concepts.select("uri", "code", "skill_type")
    b = F.when(F.col("code").isNull(), "unmapped").when(F.col("skill_type") == "skills", F.coalesce(skill_branch(F.col("code")), F.lit("other"))).when(F.col("skill_type") == "knowledge", F.coalesce(knowledge_branch(F.col("code")), F.lit("other"))).otherwise(F.col("skill_type"))
    return kept.join(c, "uri", "left").select("source", "uri", b.alias("bucket"))


@query("agg07_category_shares", f"WITH x AS (SELECT {SRC} AS source, {_BUCKET} AS bucket, count(*) AS n FROM jobads_jp JOIN {MENTIONS} USING (id) LEFT JOIN esco_concepts c ON c.uri = m.uri WHERE coalesce(m.score, 0) >= 0.55 GROUP BY ALL) SELECT source, bucket, n, CAST(round(n / sum(n) OVER (PARTITION BY source), 4) AS DECIMAL(18,4)) AS share FROM x")
def category_shares(t):
    n = bucketed(t).groupBy("source", "bucket").agg(F.count("*").alias("n"))
    return stats.share(n, ["source"], "n").withColumn("share", F.round("share", 4).cast("decimal(18,4)"))


@query("agg08_top_knowledge", f"SELECT bucket, n FROM (SELECT {_BUCKET} AS bucket, count(*) AS n FROM jobads_jp JOIN {MENTIONS} USING (id) JOIN esco_concepts c ON c.uri = m.uri WHERE skill_type = 'knowledge' AND coalesce(m.score, 0) >= 0.55 GROUP BY ALL) ORDER BY n DESC, bucket LIMIT 12")
def top_knowledge(t):
    return bucketed(t).where(F.col("bucket").rlike("^[0-9]{3}$")).groupBy("bucket").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "bucket").limit(12)


@query("agg11_coverage", f"WITH f AS (SELECT lower(m.label) AS term, count(*) AS n FROM {MENTIONS} GROUP BY 1), k AS (SELECT DISTINCT lower(title) AS term FROM esco_concepts) SELECT count(*) AS terms, count(k.term) AS matched, CAST(sum(n) AS BIGINT) AS mentions, CAST(sum(n) FILTER (WHERE k.term IS NOT NULL) AS BIGINT) AS matched_mentions FROM f LEFT JOIN k USING (term)")
def coverage(t):
    f = mentions(t).groupBy(F.lower("label").alias("term")).agg(F.count("*").alias("n"))
    k = t.esco_concepts.select(F.lower("title").alias("term")).distinct().withColumn("hit", F.lit(1))
    return f.join(k, "term", "left").agg(F.count("*").alias("terms"), F.count("hit").alias("matched"), F.sum("n").alias("mentions"), F.sum(F.when(F.col("hit") == 1, F.col("n"))).alias("matched_mentions"))


@query("agg12_months", f"SELECT strftime(collected_at, '%Y-%m') AS month, {SRC} AS source, count(*) AS n FROM jobads_jp WHERE collected_at IS NOT NULL GROUP BY ALL")
def months(t):
    return t.jobads_jp.where("collected_at is not null").groupBy(F.date_format("collected_at", "yyyy-MM").alias("month"), F.coalesce("source", F.lit("indeed")).alias("source")).agg(F.count("*").alias("n"))


@query("agg12_months_posted", f"SELECT strftime(d, '%Y-%m') AS month, count(*) AS n FROM (SELECT {DAY.format('trim(date_posted)')} AS d FROM jobads_jp) WHERE d IS NOT NULL GROUP BY 1")
def months_posted(t):
    return t.jobads_jp.select(day(F.col("date_posted")).alias("d")).where("d is not null").groupBy(F.date_format("d", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


@query("agg12_months_wide", f"WITH x AS (SELECT strftime(collected_at, '%Y-%m') AS month, {SRC} AS s FROM jobads_jp WHERE collected_at IS NOT NULL) SELECT month, count(*) FILTER (WHERE s = 'careerjet') AS careerjet, count(*) FILTER (WHERE s = 'indeed') AS indeed, count(*) AS total FROM x GROUP BY month")
def months_wide(t):
    x = t.jobads_jp.where("collected_at is not null").select(F.date_format("collected_at", "yyyy-MM").alias("month"), F.coalesce("source", F.lit("indeed")).alias("s"))
    total = x.groupBy("month").agg(F.count("*").alias("total"))
    return x.groupBy("month").pivot("s", ["careerjet", "indeed"]).count().fillna(0).join(total, "month")


@query("agg13_unpivot", "SELECT id, 'min_amount' AS field, min_amount AS value FROM jobads_jp UNION ALL SELECT id, 'max_amount', max_amount FROM jobads_jp")
def unpivot(t):
    return t.jobads_jp.unpivot("id", ["min_amount", "max_amount"], "field", "value")


@query("agg15_null_percent", f"SELECT {SRC} AS source, " + ", ".join(f"CAST(round(100.0::DOUBLE * count(*) FILTER (WHERE {c} IS NULL) / count(*), 2) AS DECIMAL(18,2)) AS {c}" for c in ("employer", "workplace", "min_amount", "company_revenue")) + " FROM jobads_jp GROUP BY 1")
def null_percent(t):
    cols = ("employer", "workplace", "min_amount", "company_revenue")
    return t.jobads_jp.groupBy(F.coalesce("source", F.lit("indeed")).alias("source")).agg(*(F.round(100.0 * F.count_if(F.col(c).isNull()) / F.count("*"), 2).cast("decimal(18,2)").alias(c) for c in cols))


@query("agg16_region_rollup", "SELECT split_part(region_iso, '-', 1) AS country, count(DISTINCT region_iso) AS regions, count(*) AS n FROM jobads_jp WHERE region_iso IS NOT NULL GROUP BY 1")
def region_rollup(t):
    per = t.jobads_jp.where("region_iso is not null").groupBy("region_iso").agg(F.count("*").alias("k"))
    return per.groupBy(F.split("region_iso", "-")[0].alias("country")).agg(F.count("*").alias("regions"), F.sum("k").alias("n"))


@query("agg17_totals", f"SELECT source, n, filled, CAST(round(100.0::DOUBLE * filled / n, 2) AS DECIMAL(18,2)) AS percent FROM (SELECT {SRC} AS source, count(*) AS n, count(employer) AS filled FROM jobads_jp GROUP BY ROLLUP (1))".replace("ROLLUP (1)", f"ROLLUP ({SRC})"))
def totals(t):
    x = t.jobads_jp.select(F.coalesce("source", F.lit("indeed")).alias("source"), "employer").rollup("source").agg(F.count("*").alias("n"), F.count("employer").alias("filled"))
    return x.withColumn("percent", F.round(100.0 * F.col("filled") / F.col("n"), 2).cast("decimal(18,2)"))


@query("agg18_best_skills", f"SELECT id, uri, CAST(round(score, 4) AS DECIMAL(18,4)) AS score FROM (SELECT id, m.uri AS uri, max(m.score) AS score, row_number() OVER (PARTITION BY id ORDER BY max(m.score) DESC NULLS LAST, m.uri) AS r FROM {MENTIONS} GROUP BY id, m.uri) WHERE r <= 50")
def best_skills(t):
    best = mentions(t).groupBy("id", "uri").agg(F.max("score").alias("score"))
    return top_per_group(best, ["id"], [F.col("score").desc_nulls_last(), F.col("uri").asc_nulls_last()], 50).select("id", "uri", F.round("score", 4).cast("decimal(18,4)").alias("score"))


@query("agg21_threshold_histogram", f"SELECT CAST(x / 10.0 AS DECIMAL(3,1)) AS threshold, count(*) FILTER (WHERE m.score >= x / 10.0::DOUBLE) AS n FROM range(3, 10) r(x), {MENTIONS} GROUP BY x")
def threshold_histogram(t):
    # one pass: a score counts for every threshold up to its own, so counts by tenth are summed from above
    tenths = mentions(t).select(F.explode(F.filter(F.array(*[F.lit(k) for k in range(3, 10)]), lambda k: F.col("score") >= k / 10.0)).alias("k"))
    return tenths.groupBy("k").agg(F.count("*").alias("n")).select((F.col("k") / 10).cast("decimal(3,1)").alias("threshold"), "n")


@query("agg22_skills_per_ad", f"WITH x AS (SELECT {SRC} AS source, count(*) AS k FROM jobads_jp JOIN {MENTIONS} USING (id) GROUP BY 1, id) SELECT source, CAST(round(avg(k), 4) AS DECIMAL(18,4)) AS mean, CAST(quantile_disc(k, 0.1) AS BIGINT) AS p10, CAST(quantile_disc(k, 0.5) AS BIGINT) AS median, CAST(quantile_disc(k, 0.9) AS BIGINT) AS p90 FROM x GROUP BY ROLLUP (source)")
def skills_per_ad(t):
    x = by_source(t).groupBy("source", "id").agg(F.count("*").alias("k"))
    pct = lambda p, n: F.expr(f"percentile_disc({p}) within group (order by k)").cast("long").alias(n)
    return x.rollup("source").agg(F.round(F.avg("k"), 4).cast("decimal(18,4)").alias("mean"), pct(0.1, "p10"), pct(0.5, "median"), pct(0.9, "p90"))


@query("agg23_section_share", f"SELECT source, section, n, CAST(round(n / sum(n) OVER (PARTITION BY source), 4) AS DECIMAL(18,4)) AS share FROM (SELECT {SRC} AS source, isic_section AS section, count(*) AS n FROM jobads_jp WHERE isic_section IS NOT NULL GROUP BY ALL)")
def section_share(t):
    n = t.jobads_jp.where("isic_section is not null").groupBy(F.coalesce("source", F.lit("indeed")).alias("source"), F.col("isic_section").alias("section")).agg(F.count("*").alias("n"))
    return stats.share(n, ["source"], "n").withColumn("share", F.round("share", 4).cast("decimal(18,4)"))


CELLS = f"(SELECT {SRC} AS r, isic_section AS k, count(*) AS o FROM jobads_jp WHERE isic_section IS NOT NULL GROUP BY ALL)"


@query("agg25_chi_square", f"WITH c AS (SELECT *, sum(o) OVER (PARTITION BY r) AS rt, sum(o) OVER (PARTITION BY k) AS ct, sum(o) OVER () AS n FROM {CELLS}), s AS (SELECT max(n) AS n, max(n) * (sum(o::DOUBLE * o / (rt::DOUBLE * ct)) - 1) AS chi2, count(DISTINCT r) AS nr, count(DISTINCT k) AS nk FROM c) SELECT CAST(round(chi2, 3) AS DECIMAL(18,3)) AS chi2, CAST((nr - 1) * (nk - 1) AS BIGINT) AS df, CAST(n AS BIGINT) AS n, CAST(round(sqrt(chi2 / (n * (least(nr, nk) - 1))), 5) AS DECIMAL(18,5)) AS v FROM s")
def chi_square(t):
    cells = t.jobads_jp.where("isic_section is not null").groupBy(F.coalesce("source", F.lit("indeed")).alias("source"), "isic_section").agg(F.count("*").alias("o"))
    return stats.chi_square(cells, "source", "isic_section", "o").select(F.round("chi2", 3).cast("decimal(18,3)").alias("chi2"), F.col("df").cast("long").alias("df"), "n", F.round("v", 5).cast("decimal(18,5)").alias("v"))


@query("agg26_dissimilarity", "SELECT n_regionkey, CAST(round(sum(abs(d - e)) / 2, 4) AS DECIMAL(18,4)) AS dissimilarity FROM (SELECT n_regionkey, CASE WHEN n_regionkey % 2 = 0 AND g = 3 THEN 2 ELSE g END AS g, sum(coalesce(d, 0)) AS d, sum(coalesce(e, 0)) AS e FROM (SELECT n_regionkey, CAST(c_custkey % 10 AS INTEGER) AS g, sum(c_acctbal) FILTER (WHERE c_custkey % 3 = 0) AS d, sum(c_acctbal) FILTER (WHERE c_custkey % 3 = 1) AS e FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2) WHERE g <> 0 GROUP BY 1, 2) GROUP BY 1")
def dissimilarity(t):
    return stats.dissimilarity(_groups(t), ["n_regionkey"], "g", "d", "e", "merge").withColumn("dissimilarity", F.round("dissimilarity", 4).cast("decimal(18,4)"))


def _groups(t):
    x = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey", (F.col("c_custkey") % 10).cast("int").alias("g"))
    x = x.agg(F.sum(F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal"))).alias("d"), F.sum(F.when(F.col("c_custkey") % 3 == 1, F.col("c_acctbal"))).alias("e"))
    return x.withColumn("merge", F.col("n_regionkey") % 2 == 0)


@query("agg27_polarization", "SELECT n_regionkey, CAST(floor(round(((hd - he) - (ld - le)) * 10, 6) + 0.5) / 10 AS DECIMAL(18,1)) AS polarization FROM (SELECT n_regionkey, sum(CASE WHEN g BETWEEN 1 AND 3 THEN coalesce(d, 0) ELSE 0 END) AS hd, sum(CASE WHEN g BETWEEN 1 AND 3 AND NOT (n_regionkey % 2 = 0 AND g = 3) THEN coalesce(e, 0) ELSE 0 END) AS he, sum(CASE WHEN g BETWEEN 4 AND 9 THEN coalesce(d, 0) ELSE 0 END) AS ld, sum(CASE WHEN g BETWEEN 4 AND 9 THEN coalesce(e, 0) ELSE 0 END) AS le FROM (SELECT n_regionkey, CAST(c_custkey % 10 AS INTEGER) AS g, sum(c_acctbal) FILTER (WHERE c_custkey % 3 = 0) AS d, sum(c_acctbal) FILTER (WHERE c_custkey % 3 = 1) AS e FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2) GROUP BY 1)")
def polarization(t):
    return stats.polarization(_groups(t), ["n_regionkey"], "g", "d", "e", "merge").withColumn("polarization", F.col("polarization").cast("decimal(18,1)"))


@query("agg28_location_quotient", f"WITH s AS (SELECT r AS source, k AS section, o / sum(o) OVER (PARTITION BY r) AS share FROM {CELLS}) SELECT source, section, CAST(round(share / avg(share) OVER (PARTITION BY section), 4) AS DECIMAL(18,4)) AS lq FROM s")
def location_quotient(t):
    n = t.jobads_jp.where("isic_section is not null").groupBy(F.coalesce("source", F.lit("indeed")).alias("source"), F.col("isic_section").alias("section")).agg(F.count("*").alias("n"))
    return stats.location_quotient(stats.share(n, ["source"], "n"), "source", "section", "share").select("source", "section", F.round("lq", 4).cast("decimal(18,4)").alias("lq"))


@query("agg29_top_occupations", "SELECT section, code, n, CAST(total AS BIGINT) AS total, CAST(rank AS BIGINT) AS rank FROM (SELECT isic_section AS section, split_part(esco_occupation_code_semantic, '.', 1) AS code, count(*) AS n, sum(count(*)) OVER (PARTITION BY isic_section) AS total, row_number() OVER (PARTITION BY isic_section ORDER BY count(*) DESC, split_part(esco_occupation_code_semantic, '.', 1)) AS rank FROM jobads_jp WHERE isic_section IS NOT NULL AND esco_occupation_code_semantic IS NOT NULL GROUP BY 1, 2) WHERE rank <= 5")
def top_occupations(t):
    x = t.jobads_jp.where("isic_section is not null and esco_occupation_code_semantic is not null").groupBy(F.col("isic_section").alias("section"), F.split("esco_occupation_code_semantic", r"\.")[0].alias("code")).agg(F.count("*").alias("n"))
    x = x.withColumn("total", F.sum("n").over(Window.partitionBy("section")))
    return top_per_group(x, ["section"], [F.desc("n"), F.col("code")], 5).withColumn("rank", F.col("rank").cast("long"))


@query("agg30_per_labour_force", "SELECT n_name, n, CAST(round(CASE WHEN balance = 0 THEN NULL ELSE n * 100000.0::DOUBLE / balance END, 4) AS DECIMAL(18,4)) AS per_100k FROM (SELECT n_name, count(c_custkey) AS n, sum(c_acctbal) AS balance FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1)")
def per_labour_force(t):
    x = t.nation.join(t.customer, F.col("c_nationkey") == F.col("n_nationkey"), "left").groupBy("n_name").agg(F.count("c_custkey").alias("n"), F.sum("c_acctbal").alias("b"))
    return x.select("n_name", "n", F.round(F.try_divide(F.col("n") * F.lit(100000.0), F.col("b")), 4).cast("decimal(18,4)").alias("per_100k"))


@query("agg32_taxonomy_counts", "SELECT digital_taxonomy, count(*) AS n, count(*) FILTER (WHERE k IS NULL) AS unmatched FROM digital_levels LEFT JOIN (SELECT DISTINCT lower(trim(title, ' ')) AS k FROM esco_concepts) ON k = lower(trim(regexp_replace(esco_skill_label, '[\\s\\x{A0}]+', ' ', 'g'), ' ')) GROUP BY 1")
def taxonomy_counts(t):
    k = t.esco_concepts.select(label_key(F.col("title")).alias("k")).distinct().withColumn("hit", F.lit(1))
    return t.digital_levels.withColumn("k", label_key(F.col("esco_skill_label"))).join(k, "k", "left").groupBy("digital_taxonomy").agg(F.count("*").alias("n"), F.count_if(F.col("hit").isNull()).alias("unmatched"))


@query("win03_leave_one_out", f"SELECT r AS source, k AS section, CAST(sum(o) OVER (PARTITION BY k) - o AS BIGINT) AS others FROM {CELLS}")
def leave_one_out(t):
    n = t.jobads_jp.where("isic_section is not null").groupBy(F.coalesce("source", F.lit("indeed")).alias("source"), F.col("isic_section").alias("section")).agg(F.count("*").alias("o"))
    return n.select("source", "section", (F.sum("o").over(Window.partitionBy("section")) - F.col("o")).alias("others"))


@query("win05_top_margin", f"SELECT id, uri, CAST(round(score - next, 4) AS DECIMAL(18,4)) AS margin FROM (SELECT id, m.uri AS uri, m.score AS score, lead(m.score) OVER w AS next, row_number() OVER w AS r FROM {MENTIONS} WHERE m.score IS NOT NULL WINDOW w AS (PARTITION BY id ORDER BY m.score DESC, m.uri)) WHERE r = 1")
def top_margin(t):
    w = Window.partitionBy("id").orderBy(F.desc("score"), "uri")
    x = mentions(t).where("score is not null").withColumn("next", F.lead("score").over(w)).withColumn("r", F.row_number().over(w)).where("r = 1")
    return x.select("id", "uri", F.round(F.col("score") - F.col("next"), 4).cast("decimal(18,4)").alias("margin"))


@query("srt03_nulls_last", "SELECT id, CAST(row_number() OVER (ORDER BY skill_match DESC NULLS LAST, id) AS BIGINT) AS place FROM jobads_jp ORDER BY place LIMIT 100")
def nulls_last(t):
    x = t.jobads_jp.select("id", "skill_match").orderBy(F.col("skill_match").desc_nulls_last(), "id").limit(100)
    return x.select("id", F.row_number().over(Window.orderBy(F.col("skill_match").desc_nulls_last(), "id")).cast("long").alias("place"))


@query("srt06_by_length", "SELECT id, CAST(row_number() OVER (ORDER BY coalesce(source, ''), length(responsibilities), id) AS BIGINT) AS place FROM jobads_jp WHERE responsibilities IS NOT NULL")
def by_length(t):
    x = t.jobads_jp.where("responsibilities is not null").select("id", F.coalesce("source", F.lit("")).alias("s"), F.length("responsibilities").alias("n"))
    return numbered(x, [], ["s", "n", "id"]).select("id", "place")


@query("top01_most_common", "SELECT employer, count(*) AS n FROM jobads_jp WHERE employer IS NOT NULL GROUP BY 1 ORDER BY n DESC, employer LIMIT 30")
def most_common(t):
    return t.jobads_jp.where("employer is not null").groupBy("employer").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "employer").limit(30)
