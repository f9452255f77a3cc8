"""Tables as folders of Parquet: listing, making, filling, rebuilding and indexing them; reports as JSON documents; databases over JDBC."""

from __future__ import annotations

import glob
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from adloom.sources.sqlite import _local, spark_type


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _system(spark, path)
    return system.exists(place)


def list_tables(spark: SparkSession, folder: str, prefix: str = "") -> list[str]:
    """The names of a folder's Parquet tables that have a prefix, in order."""
    system, place = _system(spark, folder)
    names = (s.getPath().getName() for s in system.listStatus(place))
    return sorted(n.removesuffix(".parquet") for n in names if n.endswith(".parquet") and n.startswith(prefix))


def describe(df: DataFrame) -> DataFrame:
    """(name, type, position) of each column."""
    rows = [(f.name, f.dataType.simpleString(), k) for k, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "name string, type string, position long")


def declared(columns: list[tuple[str, str, bool]]) -> StructType:
    """The schema of (name, declared type, nullable) of another database, types by the rules of sqlite.py. Keys aren't enforced."""
    return StructType([StructField(n, _parse_datatype_string(spark_type(t)), nullable) for n, t, nullable in columns])


def create_table(spark: SparkSession, path: str, schema: StructType) -> None:
    """An empty table, unless there is one."""
    if not exists(spark, path):
        spark.createDataFrame([], schema).write.parquet(path)


def insert(path: str, rows: DataFrame, per_file: int = 0) -> None:
    """Append rows to a table by column names: columns it lacks are left out, those the rows lack are NULL. per_file: most rows of a file, if any."""
    schema = rows.sparkSession.read.parquet(path).schema
    there = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    writer = rows.select(*there).write.mode("append")
    (writer.option("maxRecordsPerFile", per_file) if per_file else writer).parquet(path)


def rebuild(path: str, rows: DataFrame) -> None:
    """Make a table anew: it is written beside the old one and takes its place, so rows may come from the table itself."""
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(f"{path}.new")
    system, place = _system(spark, path)
    if system.exists(place):
        system.delete(place, True)
    if not system.rename(_system(spark, f"{path}.new")[1], place):
        raise OSError(f"{path} couldn't be put in place")


def write_indexed(rows: DataFrame, path: str, *keys: str) -> None:
    """A table ordered by keys across its files, so that their least and greatest values lead a lookup to the few row groups that may match."""
    rows.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def write_report(path: str, spark: SparkSession, **parts: DataFrame | Column) -> None:
    """One JSON document: constants as fields, and of each table a list of its rows. For aggregates of a report, which one file holds."""
    row = spark.range(1).select(*[c.alias(n) for n, c in parts.items() if isinstance(c, Column)])
    for name, df in parts.items():
        if isinstance(df, DataFrame):
            row = row.crossJoin(df.agg(F.array_sort(F.collect_list(F.struct(*df.columns))).alias(name)))  # one row each
    row.coalesce(1).write.mode("overwrite").json(path)


def year_predicates(column: str, first: int, last: int) -> list[str]:
    """A condition for each year, half-open, and one for what lies outside: the parts of a partitioned read."""
    years = [f"{column} >= '{y}-01-01' AND {column} < '{y + 1}-01-01'" for y in range(first, last + 1)]
    return [*years, f"{column} < '{first}-01-01' OR {column} >= '{last + 1}-01-01' OR {column} IS NULL"]


def read_jdbc(spark: SparkSession, url: str, table: str, predicates: list[str], columns: list[str] | None = None, **properties: str) -> DataFrame:
    """A table of a database in as many parts as there are predicates; column choice and filters reach the database. The driver's jar must be there; a tunnel
    is opened outside, as executors need it too."""
    df = spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    return df.select(*columns) if columns else df


DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def derby_database(rows: DataFrame, path: str, name: str, columns: str) -> str:
    """The URL of a new database of one table, filled with rows of figures and words, by the database that comes with Spark.

    A database of it that may be written to belongs to one process. So tasks write lines, the driver loads these as a stream and closes the database, and what
    any number of processes then read is an archive of it in a shared folder, which must be mounted where executors run.
    """
    jvm = rows.sparkSession._jvm
    jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")  # no log in the working folder
    rows.write.option("emptyValue", '""').csv(f"{path}.lines")
    own = tempfile.mkdtemp(prefix="adloom-database-")
    driver, nothing = jvm.org.apache.derby.iapi.jdbc.AutoloadedDriver(), jvm.java.util.Properties()
    try:
        with open(f"{own}/lines", "wb") as out:
            for part in sorted(glob.glob(f"{glob.escape(_local(path))}.lines/part-*")):
                with open(part, "rb") as f:
                    shutil.copyfileobj(f, out)
        connection = driver.connect(f"jdbc:derby:{own}/db;create=true", nothing)
        statement = connection.createStatement()
        statement.execute(f"CREATE TABLE {name} ({columns})")
        statement.execute(f"CALL SYSCS_UTIL.SYSCS_IMPORT_TABLE(NULL, '{name.upper()}', '{own}/lines', ',', '\"', 'UTF-8', 0)")
        connection.close()
        try:
            driver.connect(f"jdbc:derby:{own}/db;shutdown=true", nothing)
        except Exception as closed:
            if "08006" not in str(closed.java_exception.getSQLState()):  # the state of a database that was closed
                raise
        with zipfile.ZipFile(_local(path), "w", zipfile.ZIP_STORED) as archive:  # not compressed, as pages are read in any order
            for folder, _, files in os.walk(f"{own}/db"):
                for f in files:
                    archive.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), own))
    finally:
        shutil.rmtree(own)
        system, place = _system(rows.sparkSession, f"{path}.lines")
        system.delete(place, True)
    return f"jdbc:derby:jar:({_local(path)})db"
