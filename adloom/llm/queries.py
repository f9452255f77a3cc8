"""The queries of the llm operators, with production parameters over whole tables."""

from __future__ import annotations

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm.canon import canonical_codes
from adloom.llm.copies import collapsed, copy_groups
from adloom.llm.encoding import encode_corpus
from adloom.llm.langid import Model, fit, language_labels
from adloom.llm.neardup import version_groups
from adloom.llm.packing import fill_containers
from adloom.llm.pairs import Judge, broken_pairs, table_judge, tagged_pairs
from adloom.llm.sampling import row_sample
from adloom.llm.splitting import split_long
from adloom.session import file_versions, free, table


LABELS = {"responsibilities": "responsibilities_lang", "job_title": "job_title_lang"}
TEXTS, TITLES = ("responsibilities", "description_english"), ("job_title", "job_title_english")


_JUDGES: dict[str, Judge] = {}


def ads_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "jobads_jp")


def language_model(ads: DataFrame) -> Model:
    return fit(row_sample(ads, "id", [F.col(c) for pair in LABELS.items() for c in pair]), LABELS)


def judge_of(ads: DataFrame) -> Judge:
    """The judge of all rows."""
    return _judged(ads)[0]


def _judged(ads: DataFrame, every: bool = False) -> tuple[Judge, DataFrame | None]:
    """The judge, and the features of all pairs if every, unless the judge was there already: it is kept for the session's other queries on the same files."""
    key = xxhash.xxh3_128_hexdigest(repr(file_versions(ads)))
    if key in _JUDGES:
        return _JUDGES[key], None
    judge, found = table_judge(ads, "id", TEXTS, TITLES, tuple(LABELS.values()), every)
    while len(_JUDGES) >= 2:
        _JUDGES.pop(next(iter(_JUDGES)))
    _JUDGES[key] = judge
    if not every:
        free(found)
    return judge, found if every else None


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    ads = ads_of(spark, sf_dir)
    judge, found = _judged(ads, every=True)
    return tagged_pairs(found, judge) if found is not None else broken_pairs(ads, "id", TEXTS, TITLES, judge)


def p2_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text and segment with its language and confidence."""
    ads = ads_of(spark, sf_dir)
    return language_labels(ads, "id", "responsibilities", "responsibilities_lang", "job_title", "job_title_lang", "employer", language_model(ads))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_labels(spark, sf_dir).where((F.col("n_segments") > 1) | ~F.col("label_right")).select("id", "field_name", "seg", "lang")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    ads = table(spark, sf_dir, "jobads_jp")
    return copy_groups(ads, "id", ("job_title", "employer"), "responsibilities", ("employer", "responsibilities"))


def p4_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each posting, with its number of copies."""
    ads = table(spark, sf_dir, "jobads_jp")
    return collapsed(ads, "id", ("job_title", "employer"), "responsibilities", ("employer", "responsibilities"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    ads = table(spark, sf_dir, "jobads_jp").select("id", "job_title", "employer", "responsibilities")
    return version_groups(ads, "id", "responsibilities", ("job_title", "employer"), ("employer", "responsibilities"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    ads = table(spark, sf_dir, "jobads_jp")
    fields = ("job_title_english", "esco_occupation_title_semantic")
    return canonical_codes(ads, "id", fields, table(spark, sf_dir, "esco_occupations"), "code", "title", "alt_titles", judge_of(ads), TITLES)


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"), "doc_id", "text")


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_containers(table(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")


def p10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_long(table(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")


def queries() -> dict:
    return {"p1_found": p1_found, "p2_found": p2_found, "p2_labels": p2_labels, "p4_found": p4_found, "p4_records": p4_records, "p5_found": p5_found, "p7_found": p7_found, "p8_ids": p8_ids, "p9_containers": p9_containers, "p10_pieces": p10_pieces}


def oracle_sql() -> dict[str, str]:
    return {}
