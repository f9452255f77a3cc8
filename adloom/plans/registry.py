"""All queries outside the llm subpackage, by name, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adloom.operators.units import to_common_unit
from adloom.operators.unpack import code_grammar, skill_grammar, unpack
from adloom.plans import aggregates, catalog, changes, further, matches, more, texts  # noqa: F401
from adloom.session import table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_common_unit(
        table(spark, sf_dir, "jobads_jp"), "id", "min_amount", "max_amount", "job_type", "source",
        table(spark, sf_dir, "pay_units"), table(spark, sf_dir, "pay_sources"),
    )


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {"skills": skill_grammar(table(spark, sf_dir, "esco_concepts")), "esco_codes": code_grammar()}
    return unpack(table(spark, sf_dir, "jobads_jp"), "id", fields)


def queries() -> dict:
    return {"p3_found": p3_found, "p6_found": p6_found} | catalog.QUERIES


def oracle_sql() -> dict[str, str]:
    return dict(catalog.SQL)
