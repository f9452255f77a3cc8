"""Readers and writers of the formats ads come in."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_jsonl(spark: SparkSession, path: str | list[str], schema: str, key: str = "id", strict: bool = False) -> DataFrame:
    """JSON lines of a given schema. Blank and malformed lines and those without the key are left out, or raise if strict."""
    df = spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)
    return df if strict else df.where(F.col(key).isNotNull())


def read_by_country(spark: SparkSession, glob: str, schema: str, pattern: str, countries: list[str] | None = None) -> DataFrame:
    """Many JSON lines files with the country from their paths. With a whitelist only its files are read."""
    place = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = [s.getPath().toString() for s in place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []]
    paths = [p for p in found if (m := re.search(pattern, p)) and (not countries or m[1] in countries)]
    if not paths:
        return spark.createDataFrame([], schema).withColumn("country", F.lit(None).cast("string"))
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(paths).withColumn("country", F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))


def read_dictionary(spark: SparkSession, path: str, uri: str = "conceptUri", label: str = "preferredLabel") -> DataFrame:
    """A CSV dictionary with quoted line breaks; entries need a uri and a label."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return df.where((F.trim(F.coalesce(uri, F.lit(""))) != "") & (F.trim(F.coalesce(label, F.lit(""))) != ""))


def read_document(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One JSON document a file."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def first_rows(df: DataFrame, per: str, order: str, n: int) -> DataFrame:
    """The first n rows of each file or other part."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(per).orderBy(order))).where(F.col("_r") <= n).drop("_r")


def in_year(df: DataFrame, column: str, year: int) -> DataFrame:
    """Rows of one year by a half-open range that reaches the scan; unchanged if there is no such column."""
    return df.where((F.col(column) >= F.lit(f"{year}-01-01").cast(df.schema[column].dataType)) & (F.col(column) < F.lit(f"{year + 1}-01-01").cast(df.schema[column].dataType))) if column in df.columns else df


def write_jsonl(df: DataFrame, path: str, order: str | None = None, append: bool = False) -> None:
    (df.orderBy(order) if order else df).write.mode("append" if append else "overwrite").json(path)


def write_requests(df: DataFrame, path: str, per_file: int = 40_000) -> None:
    """JSON lines in files of at most per_file rows; Spark rolls files over by itself, without numbering rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", per_file).json(path)


def write_sheets(sheets: dict[str, DataFrame], path: str) -> None:
    """One directory of CSV a sheet."""
    for name, df in sheets.items():
        df.coalesce(1).write.mode("overwrite").csv(f"{path}/{name}", header=True)
