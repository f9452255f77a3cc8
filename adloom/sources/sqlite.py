"""SQLite tables as a Spark data source, split by rowid. The columns to read are an option; comparisons of a column with a value go into the database's query."""

from __future__ import annotations

import json
import os
import sqlite3

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType


def spark_type(declared: str) -> str:
    """By the first that the declared type contains."""
    t = (declared or "").upper()
    for parts, name in ((("INT",), "bigint"), (("CHAR", "TEXT", "BLOB", "CLOB"), "string"), (("FLOAT", "DOUBLE", "REAL", "DECIMAL"), "double")):
        if any(p in t for p in parts):
            return name
    return "string"


class _Part(InputPartition):
    def __init__(self, low: int, high: int):
        super().__init__((low, high))
        self.low, self.high = low, high


_COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


class SqliteReader(DataSourceReader):
    where: list[tuple[str, list]] = []

    def pushFilters(self, filters):
        """Take comparisons of text and figures; Spark does the others. A figure isn't compared with a column of text, as the database would order them by kind."""
        self.where = []
        for f in filters:
            place = getattr(f, "attribute", ())
            name = place[0] if len(place) == 1 else None
            if name in self.names and isinstance(f, IsNotNull):
                self.where.append((f'"{name}" IS NOT NULL', []))
            elif name in self.names and type(f) in _COMPARED and isinstance(f.value, str if self.kinds[self.names.index(name)] == "string" else (int, float)):
                self.where.append((f'"{name}" {_COMPARED[type(f)]} ?', [f.value]))
            else:
                yield f

    def __init__(self, schema: StructType, options: dict):
        self.names, self.kinds = [f.name for f in schema.fields], [f.dataType.simpleString() for f in schema.fields]
        self.path, self.table, self.parts = options["path"], options["table"], int(options.get("partitions", "4"))

    def partitions(self):
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as c:
            low, high = c.execute(f'SELECT min(rowid), max(rowid) FROM "{self.table}"').fetchone()
        if low is None:
            return []
        step = max(1, -(-(high - low + 1) // self.parts))
        return [_Part(k, min(k + step, high + 1)) for k in range(low, high + 1, step)]

    def read(self, partition):
        if partition is None:  # an empty table
            return
        make = [{"bigint": int, "double": float}.get(k, str) for k in self.kinds]
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as c:
            cols = ", ".join(f'"{n}"' for n in self.names)
            more = "".join(f" AND {x}" for x, _ in self.where)
            values = [v for _, vs in self.where for v in vs]
            for row in c.execute(f'SELECT {cols} FROM "{self.table}" WHERE rowid >= ? AND rowid < ?{more}', (partition.low, partition.high, *values)):
                yield tuple(None if v is None else f(v) for f, v in zip(make, row))


class SqliteSource(DataSource):
    @classmethod
    def name(cls):
        return "sqlite_table"

    def schema(self):
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as c:
            found = {r[1]: spark_type(r[2]) for r in c.execute(f'PRAGMA table_info("{self.options["table"]}")')}
        wanted = json.loads(self.options.get("columns", "null")) or list(found)
        return ", ".join(f"`{n}` {found[n]}" for n in wanted)

    def reader(self, schema):
        return SqliteReader(schema, self.options)


def _local(path: str) -> str:
    """The path itself: SQLite opens files only, so a shared folder must be mounted where executors run."""
    return path.removeprefix("file://").removeprefix("file:")


def read_sqlite(spark: SparkSession, path: str, table: str, partitions: int = 4, columns: list[str] | None = None) -> DataFrame:
    """A table, or some of its columns: only these are asked of the database."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SqliteSource)
    return spark.read.format("sqlite_table").option("path", _local(path)).option("table", table).option("partitions", partitions).option("columns", json.dumps(columns)).load()


def write_sqlite(df: DataFrame, path: str, table: str, most: int = 1_000_000) -> None:
    """A list of at most `most` rows as a table of text, figures and numbers."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("too many rows for one file that the driver writes")
    os.makedirs(os.path.dirname(_local(path)), exist_ok=True)
    kinds = {"bigint": "INTEGER", "int": "INTEGER", "double": "REAL"}
    with sqlite3.connect(_local(path)) as c:
        c.execute(f'CREATE TABLE "{table}" (' + ", ".join(f'"{f.name}" {kinds.get(f.dataType.simpleString(), "TEXT")}' for f in df.schema.fields) + ")")
        c.executemany(f'INSERT INTO "{table}" VALUES (' + ", ".join("?" * len(df.columns)) + ")", [tuple(r) for r in rows])


def sqlite_tables(path: str, prefix: str = "") -> list[str]:
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as c:
        return [r[0] for r in c.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name") if r[0].startswith(prefix)]
