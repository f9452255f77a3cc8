"""Changes to tables as joins that make a new version; nothing is updated in place.

A source may hold a key several times. Which row counts is said by an order column, never by where rows lie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adloom.functions.text import is_blank, strip


def one_per_key(source: DataFrame, keys: list[str], order: Column, last: bool = True) -> DataFrame:
    """The last (or first) row of each key, whole, NULLs included. Combined before the shuffle: no window, so a hot key costs a task nothing."""
    rest = [c for c in source.columns if c not in keys]
    pick = F.max if last else F.min
    return source.groupBy(*keys).agg(pick(F.struct(order.alias("_o"), *[F.col(c) for c in rest])).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def update_from(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], order: Column) -> DataFrame:
    """Target with `columns` of the last source row of its key; NULLs overwrite too. Rows whose key is NULL or not in the source stay; matched says which were updated."""
    s = one_per_key(source.where(" and ".join(f"`{k}` is not null" for k in keys)), keys, order)
    s = s.select(*keys, F.struct(*columns).alias("_new"))
    joined = target.join(s, keys, "left")
    hit = F.col("_new").isNotNull()
    return joined.select(*[F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns], hit.alias("matched"))


def insert_absent(target: DataFrame, batch: DataFrame, key: str, order: Column | None = None) -> DataFrame:
    """Rows of batch whose key is in no row of target; rows without a key (NULL or '') are left out. Without `order` rows of the batch
    with one key all come in, as the target is looked at once; with it only the first does, as if inserted one by one."""
    new = batch.where(F.col(key).isNotNull() & (F.col(key) != ""))
    new = new.join(target.select(key).where(F.col(key).isNotNull()), key, "left_anti")
    return one_per_key(new, [key], order, last=False) if order is not None else new


def fill_blanks(target: DataFrame, values: DataFrame, key: str, column: str, value: str, order: Column, last: bool = False, flag: str | None = None) -> DataFrame:
    """Target with blank cells of `column` filled from the first (or last) non-blank, stripped value of the row's key; flag: a column that becomes 0 where a cell was filled."""
    v = values.where(F.col(key).isNotNull()).select(key, strip(F.col(value)).alias("_v"), order.alias("_when")).where(F.col("_v") != "")
    v = one_per_key(v, [key], F.col("_when"), last).select(key, "_v")
    hit = is_blank(F.col(column)) & F.col("_v").isNotNull()
    return target.join(v, key, "left").select(*[F.when(hit, F.col("_v")).otherwise(F.col(c)).alias(c) if c == column else F.when(hit, F.lit(0)).otherwise(F.col(c)).alias(c) if c == flag else F.col(c) for c in target.columns])


def reset(target: DataFrame, done: DataFrame, key: str, column: str, flag: str) -> DataFrame:
    """Target in which rows whose key is in `done` have no value in `column` and the flag set."""
    d = done.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_d", F.lit(True))
    hit = F.coalesce(F.col("_d"), F.lit(False))
    return target.join(d, key, "left").select(*[F.when(~hit, F.col(c)).alias(c) if c == column else F.when(hit, F.lit(1)).otherwise(F.col(c)).alias(c) if c == flag else F.col(c) for c in target.columns])


def with_columns_if_missing(df: DataFrame, columns: list[str], kind: str = "string") -> DataFrame:
    return df.select("*", *[F.lit(None).cast(kind).alias(c) for c in columns if c not in df.columns])


def project(df: DataFrame, columns: list[str], kind: str = "string") -> DataFrame:
    """Fixed columns in a fixed order, NULL where df has none."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(kind).alias(c) for c in columns])


def lacking_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Columns of a that b hasn't."""
    return [c for c in a.columns if c not in b.columns]


def without_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """df without those of the columns that it has."""
    return df.drop(*columns)


def shared_columns(a: DataFrame, b: DataFrame, without: tuple[str, ...] = ("id",)) -> list[str]:
    return [c for c in a.columns if c in b.columns and c not in without]


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first n rows of each group. Spark turns the filter on the rank into a limit before the shuffle."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(rank) <= n)
